from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from martloom.llm.urls import BLOCKED, RULES, Automaton, Rule, escaped, judged

SCHEMA = "page_id long, url string, HOST string, _rank string, verdict long"


def pattern(glob: str) -> re.Pattern:
    """The same glob for Python's own matcher."""
    token = {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}
    parts = re.findall(r"\\.|\*\*|[*?]|.", glob, re.DOTALL)
    return re.compile("".join(token.get(p) or re.escape(p[1] if p[0] == "\\" else p) for p in parts))


def brute(url: str | None, rules=RULES, blocked=BLOCKED) -> tuple:
    host = path = ""
    if url is not None and "://" in url:
        tail = url.split("://", 1)[1]
        host = re.split("[/?#]", tail)[0]
        path = re.split("[?#]", tail[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    bad = any(pattern(g).fullmatch(f".{host}{path}") for g in blocked)
    return host, path, None, "block" if bad else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG/", "http://org", "https://a.example.org/es/x", "https://example.org/es",
    "https://notexample.org/es/", "http://x.org/?a=/es/", "HTTP://É.ORG/É", "http://a.com/fr/", "http://a.com/de/1#x", "http://com/de/",
    "http://x.net/a://b.org/", "http://u@b.example.org:80/en/1", "http://example.org:80/en/1", "http://example.org/en/12?q", "http://casino.net",
    "http://x.casinos.net/a/b", "http://spam-farm.net", "http://x.net/wp-login.php5", "http://x.net/wp-login.php/x", "http://x.net/a.exe",
    "http://x.net/a.exe?x", "http://a/b/org/", "http://x.net/casino", "http://evil.example.org\n/en/1", "http://" + "a" * 50_000 + ".org/" + "b" * 50_000 + ".exe",
]


@pytest.mark.parametrize("part_bits", [1 << 15, 150])
def test_as_brute_force(spark, part_bits):
    rows = [(i, u, "old", "r", 5) for i, u in enumerate(URLS)] + [(None, "http://org/", None, None, None)] * 2
    found = judged(spark.createDataFrame(rows, SCHEMA), part_bits=part_bits)
    assert [c.lower() for c in found.columns] == ["page_id", "url", "host", "_rank", "verdict", "path", "rule"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {r[0]: brute(r[1]) for r in rows}
    assert found.count() == len(rows)


def test_automaton_as_another_matcher():
    random.seed(3)
    alphabet = "ab/.é日"
    globs = ["".join(random.choice([*alphabet, "*", "**", "?", "\\*", "\\?"]) for _ in range(random.randrange(0, 9))) for _ in range(300)]
    texts = ["".join(random.choice(alphabet + "*?") for _ in range(random.randrange(0, 12))) for _ in range(400)]
    texts += [re.sub(r"\\(.)|\*+|\?", lambda m: m[1] or random.choice(["", "a", "b"]), g) for g in globs]
    ranks = list(range(7, 7 + len(globs)))
    patterns = [pattern(g) for g in globs]
    found = Automaton(globs, ranks).best(pa.array(texts)).tolist()
    assert found == [next((r for r, p in zip(ranks, patterns) if p.fullmatch(t)), -1) for t in texts]
    assert len(set(found)) > 50


def test_equally_long_rules_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://b.a/cc")], "page_id long, url string")
    first, second = Rule("block", "b.a", "/c"), Rule("allow", "a", "/cc")
    assert second.name == "a/cc" and judged(pages, [first, second]).first().rule == "b.a/c"
    tied = [Rule("allow", "a", "/c"), Rule("block", "a", "/c")]
    assert judged(pages, tied).first().verdict == "allow"
    assert judged(pages, [], []).first().verdict == "allow"
    assert judged(pages.limit(0)).count() == 0


def test_escapes():
    assert escaped("a*b?c\\d") == "a\\*b\\?c\\\\d"
    with pytest.raises(ValueError, match="backslash"):
        Automaton(["a\\"], [0])
