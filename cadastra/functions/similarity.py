"""Similarity scores of names, 0 to 100, as Arrow functions; every fuzzy join calls them within a scope key only.

``indel_ratio`` is 200 * LCS / (|a| + |b|). ``weighted_ratio`` is the greatest of it and, weighted, the ratios of sorted
words, of shared and remaining words, and of the best part of the longer name. The published anchors (85.7 for one
substitution in seven letters, 95.5 for one in twenty-two) are of the plain ratio; the weighted branches follow their
public description and are approximate parity.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation a letter of b."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def _partial(a: str, b: str) -> float:
    a, b = sorted((a, b), key=len)
    if not a:
        return 0.0
    return max(indel_ratio(a, b[i : i + len(a)]) for i in range(len(b) - len(a) + 1))


def _token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, [both, " ".join(sorted(d))])) for d in (x - y, y - x))
    pairs = [(left, right), *([(both, left), (both, right)] if both else [])]
    return max(indel_ratio(p, q) for p, q in pairs)


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    best, size = indel_ratio(a, b), max(len(a), len(b)) / min(len(a), len(b))
    in_order = [" ".join(sorted(s.split())) for s in (a, b)]
    if size < 1.5:
        return max(best, 0.95 * indel_ratio(*in_order), 0.95 * _token_set(a, b))
    part = 0.9 if size < 8 else 0.6
    return max(best, part * _partial(a, b), 0.95 * part * _partial(*in_order))


@F.pandas_udf(DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def weighted_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else weighted_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
