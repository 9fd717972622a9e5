"""Similarity of strings by common subsequences, in Arrow batches."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """The length of the longest common subsequence, a machine word of ``a`` at a time."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    open_ = full = (1 << len(a)) - 1
    for c in b:
        hit = open_ & places.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * common_subsequence(a, b) / total


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_x or not only_y):
        return 100.0
    with_x, with_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    found = [ratio(with_x, with_y)]
    if both:
        found += [ratio(both, with_x), ratio(both, with_y)]
    return max(found)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """ratio of each pair; null where one is null."""
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def set_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def sorted_tokens(x: Column) -> Column:
    return F.array_join(F.array_sort(F.split(F.trim(x), r"\s+")), " ")


def can_reach(a: Column, b: Column, least: float) -> Column:
    """False where the lengths alone keep the ratio under ``least``: a native filter before ``similarity``."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= least * (F.length(a) + F.length(b))


def letters(x: Column) -> Column:
    """A set of 64 bits of the characters of a text."""
    return F.aggregate(F.split(x, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)))


def letters_can_reach(a: Column, b: Column, a_letters: Column, b_letters: Column, least: float) -> Column:
    """False where the characters that only one text has keep the ratio under ``least``: each costs a deletion at least."""
    apart = F.bit_count(a_letters.bitwiseXOR(b_letters))
    return 100.0 * apart <= (100.0 - least) * (F.length(a) + F.length(b))


def similar_pairs(left: DataFrame, right: DataFrame, a: str, b: str, least: float, keys: list[str] = (), where: Column | None = None) -> DataFrame:
    """Pairs of rows of equal ``keys`` with ratio(a, b) >= ``least``, and the ratio as ``ratio``. No such pair is lost.

    Two texts that are similar enough differ in length by a bounded factor, so texts meet by the logarithm of
    their length: a left row looks into its own bucket and both neighbours, which is a hash join. Lengths and
    characters are compared natively before the subsequence is searched. Rows should be distinct in what they
    compare; columns of both sides must differ but for ``keys``. Empty texts equal only each other.
    """
    factor = (200.0 - least) / least  # the longer of two similar texts has so many times the other's length at most
    bucket = lambda c: F.when(F.length(c) == 0, F.lit(-9).cast("long")).otherwise(F.floor(F.log(F.length(c).cast("double")) / F.lit(math.log(factor) if factor > 1 else 1e-9) + 1e-9).cast("long"))
    left = left.withColumns({"_a_letters": letters(F.col(a)), "_bucket": F.explode(F.array(*(bucket(F.col(a)) + i for i in (-1, 0, 1))))})
    right = right.withColumns({"_b_letters": letters(F.col(b)), "_bucket": bucket(F.col(b))})
    pairs = left.join(right, [*keys, "_bucket"])
    if where is not None:
        pairs = pairs.filter(where)
    pairs = pairs.filter(can_reach(F.col(a), F.col(b), least) & letters_can_reach(F.col(a), F.col(b), F.col("_a_letters"), F.col("_b_letters"), least))
    return pairs.withColumn("ratio", similarity(a, b)).filter(F.col("ratio") >= least).drop("_bucket", "_a_letters", "_b_letters")
