"""Deep-shallow suffix sorting of byte strings, with the length each shares with the one before.

Strings are parted by multikey quicksort, eight bytes at a time, down to a shallow depth.  What is
still alike there goes into a blind trie (Ferragina and Manzini, 2004): inner nodes keep only where
strings part and on which byte, so finding a string's place looks at a few bytes and compares it once.
"""

from __future__ import annotations

STEP = 8
#: Depth, in bytes, from which on groups that are still alike are put into tries.
SHALLOW = 64


def common(a: bytes, b: bytes) -> int:
    """How many first bytes two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    apart = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (apart.bit_length() + 7) // 8


def ordered(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Places of the strings in sorted order, and what each shares with the one before it (0 for the first)."""
    order: list[int] = []
    todo = [(list(range(len(strings))), 0)] if strings else []
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            order += group
        elif depth >= SHALLOW:
            order += _trie_order(strings, group)
        else:
            low, same, high = [], [], []
            pivot = strings[group[len(group) // 2]][depth : depth + STEP]
            for i in group:
                part = strings[i][depth : depth + STEP]
                (low if part < pivot else high if part > pivot else same).append(i)
            todo += [(high, depth)] if high else []
            if len(pivot) < STEP:  # they end here, alike
                todo += [([i], SHALLOW) for i in reversed(same)]
            else:
                todo.append((same, depth + STEP))
            todo += [(low, depth)] if low else []
    shared = [0] + [common(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    return order, shared


class _Node:
    """A branching: strings below share ``depth`` bytes; ``next`` leads on by the byte there (-1: the end)."""

    __slots__ = ("depth", "next", "leaf")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.leaf = depth, leaf
        self.next: dict[int, _Node | list[int]] = {}


def _byte(string: bytes, at: int) -> int:
    return string[at] if at < len(string) else -1


def _trie_order(strings: list[bytes], group: list[int]) -> list[int]:
    root: _Node | list[int] = [group[0]]
    for i in group[1:]:
        root = _inserted(strings, root, i)
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, list):
            order += node
        else:
            todo += [node.next[b] for b in sorted(node.next, reverse=True)]
    return order


def _inserted(strings: list[bytes], root: _Node | list[int], i: int) -> _Node | list[int]:
    """The trie with one more string; leaves are lists of equal strings."""
    new, node = strings[i], root
    while not isinstance(node, list):  # blind: only branching bytes are looked at
        node = node.next.get(_byte(new, node.depth)) or [node.leaf]
    like = strings[node[0]]
    depth = common(new, like)
    if depth == len(new) == len(like):
        node.append(i)
        return root
    above, node = None, root
    while not isinstance(node, list) and node.depth < depth:
        above, node = node, node.next[_byte(new, node.depth)]
    if not isinstance(node, list) and node.depth == depth:
        node.next[_byte(new, depth)] = [i]
        return root
    branch = _Node(depth, node[0] if isinstance(node, list) else node.leaf)
    branch.next = {_byte(like, depth): node, _byte(new, depth): [i]}
    if above is None:
        return branch
    above.next[_byte(new, above.depth)] = branch
    return root
