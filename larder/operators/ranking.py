"""First row per key, top-k, ties and seeded order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total.

    Spark puts a group limit in front of the shuffle, so each task sends at most
    one row per key and a hot key stays cheap.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def lowest_with_ties(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All rows that share the smallest value of their key.

    The smallest value is found by a partial aggregate and joined back, so the ties of
    a key need not meet in one task. Null keys and null values, which sort first, count like others.
    """
    ranked = df.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(
        F.max(F.col(value).isNull()).alias("_null"), F.min(value).alias("_least"))
    same = F.when(F.col("_null"), F.col(value).isNull()).otherwise(F.col(value) == F.col("_least"))
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(ranked, same).select(*df.columns)


def seeded_order(keys: Sequence[str], seed: int) -> Column:
    """A reproducible random order: the digest of key and seed."""
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def seeded_shuffle(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    return df.orderBy(seeded_order(keys, seed), *keys)


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    return seeded_shuffle(df, keys, seed).limit(n)


def last_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of an order (a small top-k, not a full sort)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
