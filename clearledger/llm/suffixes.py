"""Deep-shallow sorting of suffixes that share a gram, and the repeats their order shows.

Suffixes are ordered by multikey quicksort on eight bytes at a time to a shallow depth. Groups
still equal there have long common prefixes; each goes into a blind trie, which is walked by
branching bytes alone and needs one full comparison for each suffix put in. The order and the
common prefixes of neighbours give the internal nodes of the suffix tree. Within a node, the same
is done for what lies before the anchors, backwards; so for each suffix the longest stretch that
another one has, before and after the anchor, follows without comparing all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHALLOW = 64
STEP = 8


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix of two strings of which `known` bytes are equal."""
    n = min(len(a), len(b))
    while known < n:
        step = min(n - known, 512)
        x, y = a[known : known + step], b[known : known + step]
        if x != y:
            differ = np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8)
            return known + int(differ.argmax())
        known += step
    return n


class BlindTrie:
    """A trie of branching bytes: a node is [depth, {byte: node or leaf}], a leaf a list of strings
    that are equal. The end of a string counts as byte -1."""

    def __init__(self, strings: list[bytes], first: int):
        self.strings = strings
        self.root: list = [first]

    def _at(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def add(self, i: int) -> None:
        path, node = [], self.root
        while isinstance(node, _Node):
            path.append(node)
            child = node.children.get(self._at(i, node.depth))
            node = child if child is not None else next(iter(node.children.values()))
        alike = common(self.strings[i], self.strings[node[0]])
        if alike == len(self.strings[i]) == len(self.strings[node[0]]):
            node.append(i)
            return
        above = None
        for at in path:
            if at.depth >= alike:
                break
            above = at
        below = self.root if above is None else above.children.get(self._at(i, above.depth))
        if isinstance(below, _Node) and below.depth == alike:
            below.children[self._at(i, alike)] = [i]
            return
        old = node[0]
        fork = _Node(alike, {self._at(old, alike): below, self._at(i, alike): [i]})
        if above is None:
            self.root = fork
        else:
            above.children[self._at(i, above.depth)] = fork

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, _Node):
                stack.extend(c for _, c in sorted(node.children.items(), reverse=True, key=lambda x: x[0]))
            else:
                out.extend(node)
        return out


class _Node:
    __slots__ = ("children", "depth")

    def __init__(self, depth: int, children: dict):
        self.depth, self.children = depth, children


def deep_shallow(strings: list[bytes]) -> list[int]:
    """The numbers of the strings in their order."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out += group
        elif depth >= SHALLOW:
            trie = BlindTrie(strings, group[0])
            for i in group[1:]:
                trie.add(i)
            out += trie.order()
        else:
            key = [strings[i][depth : depth + STEP] for i in group]
            pivot = sorted((key[0], key[len(key) // 2], key[-1]))[1]
            less = [i for i, k in zip(group, key, strict=True) if k < pivot]
            same = [i for i, k in zip(group, key, strict=True) if k == pivot]
            more = [i for i, k in zip(group, key, strict=True) if k > pivot]
            if more:
                stack.append((more, depth))
            if len(pivot) < STEP:  # the strings end here
                stack.extend(([i], depth) for i in same)
            else:
                stack.append((same, depth + STEP))
            if less:
                stack.append((less, depth))
    return out


def nodes(alike: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the internal nodes at least so deep, from neighbours' common prefixes."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*alike, -1]):
        first = i
        while stack and stack[-1][0] >= depth:
            d, f = stack.pop()
            if d > depth and d >= least:
                yield d, f, i
            first = f
        stack.append((depth, first))


def longest(before: list[bytes], after: list[bytes], window: int) -> list[tuple[int, int]]:
    """For each place the longest stretch before and after it, of a window or more in all, that
    another place has too; (0, 0) without any. The two may come from different places.

    ``before`` is read backwards from the place, ``after`` forwards."""
    n = len(after)
    best = [(0, 0)] * n
    if n == 2:
        l, r = common(*before), common(*after)
        return [(l, r) if l + r >= window else (0, 0)] * 2
    order = deep_shallow(after)
    alike = [common(after[a], after[b]) for a, b in zip(order[:-1], order[1:], strict=True)]
    back_rank = [0] * n
    for rank, i in enumerate(deep_shallow(before)):
        back_rank[i] = rank
    deepest = max(map(len, before))
    for depth, first, last in nodes(alike, window - deepest):
        inside = sorted(order[first : last + 1], key=back_rank.__getitem__)
        back = [0, *(common(before[a], before[b]) for a, b in zip(inside[:-1], inside[1:], strict=True)), 0]
        for k, i in enumerate(inside):
            reach = max(back[k], back[k + 1])
            if reach + depth >= window:
                best[i] = (max(best[i][0], reach), max(best[i][1], depth))
    return best
