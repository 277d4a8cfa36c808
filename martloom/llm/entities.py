"""Personal data in a text: where it stands, what it refers to, and how a surrogate is written in its place.

Kinds: email, phone, ip, ip6, card (13 to 19 digits), ssn, iban (with right check digits), token (secrets
after a name such as ``token =``, long hex strings, keys of some services), given and surname.  A name needs evidence: a
title, a phrase such as ``my name is``, or a given name of the list below followed by a capitalised word; once a text names a person,
its given name and surname are found there alone as well.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from dataclasses import dataclass

# Given names by gender and script, titles by gender.
MALE = "james john robert michael william david richard thomas daniel paul mark george peter hans klaus jürgen wolfgang stefan pierre jean jacques philippe luc carlos josé juan miguel pedro luis kevin brian jason jeffrey ryan jacob nicholas eric jonathan stephen justin brandon benjamin samuel gregory patrick andrew matthew иван сергей алексей дмитрий николай андрей михаил"
FEMALE = "mary patricia jennifer linda elizabeth barbara susan sarah karen emma alice julia anna ingrid ursula sabine monika marie claire sophie camille maría carmen lucía isabel elena emily ashley kimberly donna michelle amanda melissa deborah stephanie rebecca laura sharon cynthia kathleen angela brenda pamela nicole katherine samantha ольга татьяна наталья ирина светлана мария екатерина"
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "Господин", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа", "госпожа"),
    "n": ("Dr", "Prof"),
}

GENDER = {name: "m" for name in MALE.split()} | {name: "f" for name in FEMALE.split()}
_TITLE_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_CAP = r"[^\W\d_a-zа-яßà-öø-ÿ][^\W\d_]+(?:-[^\W\d_]+)?"
_TITLED = re.compile(rf"\b({'|'.join(_TITLE_GENDER)})\.? ({_CAP}(?: {_CAP}){{0,2}})\b")
# Words that a person's own name follows.
_CUE = re.compile(rf"\b(?:[Mm]y name is|[Mm]ein Name ist|[Mm]e llamo|[Mm]i nombre es|[Jj]e m'appelle|[Мм]еня зовут) ({_CAP}(?: {_CAP})?)\b")
_PAIR = re.compile(rf"\b({_CAP})(?= ({_CAP})\b)")
_TOKEN = re.compile(r"\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_+/=.-]{8,})", re.IGNORECASE)
_HEX = re.compile(r"(?<!\w)(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?!\w)")
_PLUS = re.compile(r"(?<![\w.])\+\d{1,3}(?:[ .()/-]{0,2}\d){6,12}(?!\w)")
_IP6 = re.compile(r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])")
# The beginnings of some services' keys.
_SERVICE = re.compile(r"(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,}|xox[abp]-[A-Za-z0-9-]{10,})(?!\w)")
_DOMAIN = re.compile(r"@[\w-]+(?:\.[\w-]+)+")
_LOCAL = re.compile(r"[\w.+%-]")
#: What any of the above needs: lets the JVM pass texts without it by.  (Java syntax.)
SUSPICIOUS = r"[0-9@]|\p{Lu}\p{L}+ \p{Lu}\p{L}|(?i)(token|secret|password|passwd|key)\s*[=:]|\bgh[pousr]_|\bsk-|\bxox[abp]-|AKIA|\b(" + "|".join(_TITLE_GENDER) + r")\.? \p{Lu}"


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    #: What the mention refers to: the same for all ways of writing it.
    value: str


def found(text: str) -> list[Entity]:
    """Entities of a text, in order, none overlapping another."""
    taken: list[Entity] = []
    busy = bytearray(len(text))

    def take(start: int, end: int, kind: str, value: str) -> None:
        if not any(busy[start:end]):
            busy[start:end] = b"\1" * (end - start)
            taken.append(Entity(start, end, kind, value))

    for m in _TOKEN.finditer(text):
        take(*m.span(1), "token", m[1])
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < m.start():
                take(start, m.end(), "email", text[start : m.end()].lower())
    for m in _SERVICE.finditer(text):
        take(*m.span(), "token", m[0])
    if any(c in text for c in "0123456789"):
        for m in _HEX.finditer(text):
            take(*m.span(), "token", m[0])
        for m in _IBAN.finditer(text):
            value = m[0].replace(" ", "")
            if _mod97(value) == 1:
                take(*m.span(), "iban", value)
        for m in _IP.finditer(text):
            take(*m.span(), "ip", m[0])
        for m in _IP6.finditer(text):
            if sum(map(bool, m[0].split(":"))) > 2:  # two groups are as likely names of source code
                take(*m.span(), "ip6", m[0].lower())
        for m in _SSN.finditer(text):
            take(*m.span(), "ssn", _digits(m[0]))
        for m in _CARD.finditer(text):
            take(*m.span(), "card", _digits(m[0]))
        for m in (*_PLUS.finditer(text), *_PHONE.finditer(text)):
            digits = _digits(m[0])
            marked = "+" in m[0] or "(" in m[0]
            if (7 if marked else 9) <= len(digits) <= 15:
                national = digits[-10:] if len(digits) > 10 and (marked or digits[0] == "1") else digits
                take(*m.span(), "phone", national)
    _names(text, take)
    return sorted(taken, key=lambda e: e.start)


def _names(text: str, take) -> None:
    parts: dict[str, tuple[str, str]] = {}
    for m in _TITLED.finditer(text):
        gender = _TITLE_GENDER[m[1]]
        *given, surname = m[2].split(" ")
        parts.setdefault(surname, ("surname", surname_stem(surname)))
        for name in given:
            parts.setdefault(name, ("given", f"{GENDER.get(name.lower(), gender)}:{name.lower()}"))
    for m in _CUE.finditer(text):
        name, *surname = m[1].split(" ")
        parts.setdefault(name, ("given", f"{GENDER.get(name.lower(), 'n')}:{name.lower()}"))
        for x in surname:
            parts.setdefault(x, ("surname", surname_stem(x)))
    for m in _PAIR.finditer(text):
        gender = GENDER.get(m[1].lower())
        if gender and m[2].lower() != m[1].lower():
            parts[m[1]] = ("given", f"{gender}:{m[1].lower()}")
            parts.setdefault(m[2], ("surname", surname_stem(m[2])))
    if parts:
        for m in re.finditer(rf"\b(?:{'|'.join(map(re.escape, sorted(parts, key=len, reverse=True)))})\b", text):
            take(*m.span(), *parts[m[0]])


def surname_stem(surname: str) -> str:
    """A surname in lower case; of a Russian one in its feminine form, the masculine."""
    low = surname.lower()
    return low[:-1] if re.search(r"(ов|ев|ин)а$", low) else low


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdecimal())


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


class _Stream:
    """Numbers that follow from the key, the entity and the number of the try."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.seed, self.block, self.left = key, f"{kind}|{value}|{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + b"|%d" % self.block, hashlib.sha256).digest()
            self.block += 1
        taken, self.left = self.left[:4], self.left[4:]
        return int.from_bytes(taken, "big") % n

    def of(self, choices):
        return choices[self.below(len(choices))]


_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def _alphabet(letter: str) -> str:
    return _CYRILLIC if "а" <= letter.lower() <= "я" or letter in "ёЁ" else _GREEK if "α" <= letter.lower() <= "ω" else _LATIN


def _shaped(text: str, s: _Stream) -> str:
    """Letters for letters of the same script and case, digits for digits, all else as it is."""
    out = []
    for c in text:
        if c.isdecimal():
            out.append(str(s.below(10)))
        elif c.isalpha():
            new = s.of(_alphabet(c))
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


_SYLLABLES = {
    _LATIN: ("bdfgklmnprstv", "aeiou", {"m": ("o", "en", "ard"), "f": ("a", "ine", "elle"), "n": ("y", "is", "el"), "s": ("son", "er", "ing", "and")}),
    _CYRILLIC: ("бвгдзклмнпрст", "аеиоу", {"m": ("ор", "ан", "ий"), "f": ("а", "ина", "ия"), "n": ("ель", "ис", "ей"), "s": ("ов", "ев", "ин")}),
    _GREEK: ("βγδζκλμνπρστ", "αειου", {"m": ("ος", "ης"), "f": ("α", "η"), "n": ("ι", "ω"), "s": ("ου", "ιδης")}),
}


def _name(like: str, gender: str, s: _Stream, longer: int) -> str:
    consonants, vowels, ends = _SYLLABLES[_alphabet(like[0])]
    body = "".join(s.of(consonants) + s.of(vowels) for _ in range(1 + s.below(2) + longer)) + s.of(consonants)
    return body + s.of(ends[gender])


def surrogate(kind: str, value: str, key: bytes, attempt: int) -> str:
    """The surrogate of an entity's value: of the same kind, gender, script and format.  Later tries may be longer."""
    s, longer = _Stream(key, kind, value, attempt), attempt // 3
    if kind == "email":
        local, _, domain = value.partition("@")
        d, top = _Stream(key, "domain", domain, attempt), domain.rsplit(".", 1)[-1]
        host = _shaped(domain.split(".")[0], d)
        more = "".join(s.of(_LATIN) for _ in range(longer))
        return f"{_shaped(local, s)}{more}@{host}.example.{top if top in ('com', 'org', 'net') else 'com'}"
    if kind == "ip":
        return ".".join(str(1 + s.below(254 if i else 223)) for i in range(4))
    if kind == "ip6" and longer > 1:  # a short form has few others
        return ":".join("".join(s.of("0123456789abcdef") for _ in range(4)) for _ in range(8))
    if kind == "ip6":
        return "".join(s.of("0123456789abcdef") if c != ":" else c for c in value)
    if kind == "card":
        body = value[0] + "".join(str(s.below(10)) for _ in value[1:-1])
        last = s.below(10)
        while luhn(f"{body}{last % 10}") != luhn(value):
            last += 1
        return f"{body}{last % 10}"
    if kind == "ssn":
        return f"{1 + s.below(665):03d}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "phone":
        return (str(1 + s.below(9)) if value[0] != "0" else "0") + "".join(str(s.below(10)) for _ in value[1:])
    if kind == "iban":
        body = _shaped(value[4:], s)
        return f"{value[:2]}{98 - _mod97(f'{value[:2]}00{body}'):02d}{body}"
    if kind == "token":
        if re.fullmatch(r"[0-9a-f]+", value):
            return "".join(s.of("0123456789abcdef") for _ in range(len(value) + longer))
        return _shaped(value, s) + "".join(s.of(_LATIN) for _ in range(longer))
    if kind == "given":
        gender, name = value.split(":", 1)
        return f"{gender}:{_name(name, gender, s, longer)}"
    return _name(value, "s", s, longer)


def written(mention: str, kind: str, new: str) -> str:
    """A surrogate as the mention wrote the entity: its separators, its prefix, its case."""
    if kind in ("card", "ssn", "phone", "iban"):
        fresh = list(new)
        out = []
        for c in reversed(mention):  # from the right: what a phone has before its national number stays
            solid = c.isalnum() if kind == "iban" else c.isdecimal()
            out.append(fresh.pop() if solid and fresh else c)
        return "".join(reversed(out))
    if kind in ("given", "surname"):
        new = new.split(":", 1)[-1]
        if kind == "surname" and surname_stem(mention) != mention.lower():
            new += "а"
        return new.upper() if mention.isupper() else new.capitalize()
    if kind in ("email", "ip6") and mention.isupper():
        return new.upper()
    return new


def replaced(text: str, entities: list[Entity], names: dict[tuple[str, str], str]) -> str:
    out, at = [], 0
    for e in entities:
        out += [text[at : e.start], written(text[e.start : e.end], e.kind, names[e.kind, e.value])]
        at = e.end
    return "".join([*out, text[at:]])
