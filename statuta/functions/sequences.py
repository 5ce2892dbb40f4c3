"""Sequence comparison, which built-in functions can't express: pandas UDFs over whole batches.

``paragraph_diff`` and ``word_diff`` align two sequences by a longest common subsequence. Common ends are set apart
first, so the quadratic part is what really differs.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

Step = tuple[str, str | None, str | None]


def common_subsequence(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """A longest common subsequence; where two are possible, the one that leaves b's later items first."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    # lengths[i][j] of the first i and j items
    lengths = [[0] * (len(y) + 1)]
    for p in x:
        last, row = lengths[-1], [0]
        for j, q in enumerate(y):
            row.append(last[j] + 1 if p == q else max(last[j + 1], row[j]))
        lengths.append(row)
    out, i, j = [], len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            out.append(x[i - 1])
            i, j = i - 1, j - 1
        elif lengths[i - 1][j] > lengths[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return [*a[:head], *out[::-1], *a[len(a) - tail :]]


def edit_script(old: Sequence[str], new: Sequence[str], pair: bool) -> list[Step]:
    """(op, old, new) with op context, del, add or, if ``pair``, modified for items that replace each other."""
    out: list[Step] = []
    i = j = 0
    for anchor in [*common_subsequence(old, new), None]:
        end_i = next((k for k in range(i, len(old)) if old[k] == anchor), len(old)) if anchor is not None else len(old)
        end_j = next((k for k in range(j, len(new)) if new[k] == anchor), len(new)) if anchor is not None else len(new)
        while pair and i < end_i and j < end_j:
            out.append(("modified", old[i], new[j]))
            i, j = i + 1, j + 1
        out += [("del", x, None) for x in old[i:end_i]] + [("add", None, x) for x in new[j:end_j]]
        i, j = end_i, end_j
        if anchor is not None:
            out.append(("context", anchor, anchor))
            i, j = i + 1, j + 1
    return out


_STEPS = ArrayType(StructType([StructField("op", StringType()), StructField("old", StringType()), StructField("new", StringType())]))


def _scripts(old: pd.Series, new: pd.Series, pair: bool) -> pd.Series:
    rows = [edit_script(list(a) if a is not None else [], list(b) if b is not None else [], pair) for a, b in zip(old, new, strict=True)]
    return pd.Series([[{"op": o, "old": x, "new": y} for o, x, y in r] for r in rows])


@F.pandas_udf(_STEPS)
def paragraph_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """The edit script of two arrays of paragraphs; null counts as an empty array."""
    return _scripts(old, new, True)


@F.pandas_udf(_STEPS)
def word_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """The edit script of two arrays of tokens."""
    return _scripts(old, new, False)


@F.pandas_udf(DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all characters of two texts; null if one is null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")
