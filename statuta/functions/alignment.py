"""Alignment of two token sequences.

Common ends are set apart, then tokens that are unique in both sides are taken as anchors; what lies between anchors is
treated likewise, and a stretch without anchors by a longest common subsequence. That is found exactly, whatever the
length, in linear space: the second side is halved where the lengths of both halves add up best, and each row of
lengths is one machine integer of as many bits as the first side has tokens (a zero bit is a step up).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np

_TOKEN = re.compile(r"\S+|\n")


def tokens_of(text: str | None) -> list[str]:
    """Words and line ends; none for null."""
    return _TOKEN.findall(text or "")


def align(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of positions with equal tokens, ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        anchors = _rising(_unique_in_both(a, b, i, m, j, n))
        if not anchors:
            out += [(i + p, j + q) for p, q in longest_common(a[i:m], b[j:n])]
            continue
        p, q = i, j
        for k, z in anchors:
            out.append((k, z))
            todo.append((p, k, q, z))
            p, q = k + 1, z + 1
        todo.append((p, m, q, n))
    return sorted(out)


def _unique_in_both(a: Sequence[str], b: Sequence[str], i: int, m: int, j: int, n: int) -> list[tuple[int, int]]:
    at: dict[str, list[int]] = {}
    for k in range(i, m):
        at.setdefault(a[k], [0, 0, k, -1])[0] += 1
    for k in range(j, n):
        if (x := at.get(b[k])) is not None:
            x[1] += 1
            x[3] = k
    return sorted((x[2], x[3]) for x in at.values() if x[0] == x[1] == 1)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of ``pairs`` (ascending in the first) that ascends in the second."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, z) in enumerate(pairs):
        at = bisect_left(tails, z)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(z)
            ends.append(k)
        else:
            tails[at], ends[at] = z, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _steps(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """The length of a longest common subsequence of b and the first 0, 1, ... len(a) tokens of a."""
    masks: dict[str, int] = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << k)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        if hit := row & masks.get(y, 0):
            row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def longest_common(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of positions of a longest common subsequence."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        if i == m or j == n:
            continue
        if n - j == 1:
            k = next((k for k in range(i, m) if a[k] == b[j]), None)
            if k is not None:
                out.append((k, j))
            continue
        middle = (j + n) // 2
        total = _steps(a[i:m], b[j:middle]) + _steps(a[i:m][::-1], b[middle:n][::-1])[::-1]
        if total.max() == 0:
            continue
        cut = i + int(total.argmax())
        todo += [(i, cut, j, middle), (cut, m, middle, n)]
    return sorted(out)
