"""Deep-shallow sorting of byte strings that share long prefixes.

Multikey quicksort orders the strings by the bytes in which they differ, to a shallow depth beyond
what all begin with. Groups that still agree there are ordered by a blind trie: a Patricia trie that keeps only the depth of each branching, so
inserting a string costs one blind descent and one comparison with the leaf it ends at.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 24
_END = -1


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else _END


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = a[:n], b[:n]
    if x == y:
        return n
    difference = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (difference.bit_length() + 7) // 8


class _BlindTrie:
    """Inner nodes are [depth, {byte: node}], leaves are lists of equal strings' numbers."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = ["leaf", [i]]
            return
        node = self.root
        while node[0] != "leaf":  # blind: bytes between branchings are not looked at
            child = node[1].get(_byte(s, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(i)
            return
        parent, key, node = None, None, self.root
        while node[0] != "leaf" and node[0] < depth:
            parent, key = node, _byte(s, node[0])
            node = node[1][key]
        if node[0] != "leaf" and node[0] == depth:
            node[1][_byte(s, depth)] = ["leaf", [i]]
            return
        branch = [depth, {_byte(other, depth): node, _byte(s, depth): ["leaf", [i]]}]
        if parent is None:
            self.root = branch
        else:
            parent[1][key] = branch

    def order(self) -> list[int]:
        out: list[int] = []
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node[0] == "leaf":
                out.extend(node[1])
            else:
                todo.extend(node[1][k] for k in sorted(node[1], reverse=True))
        return out


def sort(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """The numbers of the strings in order; a string sorts before those it begins.

    What all strings of a group begin with is passed over, as the least and the greatest tell it.
    """
    out: list[int] = []
    todo = [list(range(len(strings)))]
    limit = None
    while todo:
        group = todo.pop()
        if len(group) == 1:
            out.append(group[0])
            continue
        own = [strings[i] for i in group]
        least, greatest = min(own), max(own)
        if least == greatest:
            out.extend(group)
            continue
        depth = common_prefix(least, greatest)
        if limit is None:
            limit = depth + shallow
        if depth >= limit:
            trie = _BlindTrie(strings)
            for i in group:
                trie.insert(i)
            out.extend(trie.order())
            continue
        # The byte that decides; it is empty behind the end, and so the least.
        bytes_ = [s[depth : depth + 1] for s in own]
        pivot = bytes_[len(group) // 2]
        parts = (
            [i for i, b in zip(group, bytes_) if b < pivot],
            [i for i, b in zip(group, bytes_) if b == pivot],
            [i for i, b in zip(group, bytes_) if b > pivot],
        )
        todo.extend(part for part in reversed(parts) if part)
    return out


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """The common prefix of every pair, from the sorted order and its neighbours' prefixes."""
    n = len(strings)
    if n == 2:
        both = common_prefix(*strings)
        return np.array([[0, both], [both, 0]], dtype=np.int32)
    order = sort(strings)
    lcp = np.array(
        [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])], dtype=np.int32
    )
    by_rank = np.zeros((n, n), dtype=np.int32)
    for i in range(n - 1):
        by_rank[i, i + 1 :] = np.minimum.accumulate(lcp[i:])
    by_rank += by_rank.T
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    return by_rank[np.ix_(rank, rank)]
