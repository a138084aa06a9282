"""Fuzzy similarity of text pairs as Arrow UDFs: Spark has edit distance but no common-subsequence ratio."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step a character of the longer text."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for k, char in enumerate(a):
        where[char] = where.get(char, 0) | 1 << k
    full = (1 << len(a)) - 1
    gaps = full  # a zero bit for each character of a that ends a common subsequence
    for char in b:
        hit = gaps & where.get(char, 0)
        gaps = ((gaps + hit) | (gaps - hit)) & full
    return len(a) - gaps.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """0 to 100: twice the common subsequence over both lengths; 100 for two empty texts."""
    if a == b:
        return 100.0
    return 200.0 * common_subsequence(a, b) / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the shared words and each side's words put behind them; 100 if one side's words contain the other's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, [both, " ".join(sorted(own))])) for own in (x - y, y - x))
    if both and (x <= y or y <= x):
        return 100.0
    best = indel_ratio(left, right)
    return max(best, indel_ratio(both, left), indel_ratio(both, right)) if both else best


def _pairwise(score):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known = lru_cache(maxsize=20_000)(score)
        return pd.Series([None if x is None or y is None else round(known(x, y), 1) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(run, T.DoubleType())


#: Scores of two text columns with one decimal; NULL if either is NULL.
indel_score = _pairwise(indel_ratio)
token_set_score = _pairwise(token_set_ratio)
