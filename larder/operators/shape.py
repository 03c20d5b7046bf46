"""Reshaping, cleansing and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larder.session import materialize


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def unpivot_others(df: DataFrame, keep: Sequence[str], name: str, value: str) -> DataFrame:
    """Every column outside ``keep`` becomes (name, value) rows; null values are dropped."""
    others = [c for c in df.columns if c not in keep]
    texts = df.select(*keep, *[F.col(f"`{c}`").cast("string").alias(c) for c in others])
    return texts.unpivot([F.col(c) for c in keep], [F.col(f"`{c}`") for c in others], name, value).where(
        F.col(value).isNotNull()
    )


def split_rows(df: DataFrame, column: str, separator: str) -> DataFrame:
    """One row per piece of a text column; ``separator`` is a regular expression."""
    return df.withColumn(column, F.explode(F.split(F.col(column), separator)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any (of the given) columns."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def sorted_distinct(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Ordered distinct values of a column under a filter (a pick list)."""
    picked = df if where is None else df.where(where)
    return picked.select(column).distinct().orderBy(column)


def left_join_known(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join on one key in which the left rows without a key take no part.

    A null matches nothing; shuffled by key, all of them would meet in one task. They
    are dealt by their other columns instead, and ``left`` is still read once.
    """
    # The key and a stand-in number: 0 for keys, one of many for null keys, which no right row has.
    # A hash of the row, unlike a random number, is the same when a lost task is run again; maps have none.
    plain = [c for c, t in left.dtypes if "map<" not in t]
    stand_in = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*plain), F.lit(4096)).cast("int") + 1).otherwise(0)
    known = right.where(F.col(key).isNotNull()).withColumnRenamed(key, "_key").withColumn("_zero", F.lit(0))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_stand_in") == F.col("_zero"))
    return left.withColumn("_stand_in", stand_in).join(known, same, "left").drop("_key", "_zero", "_stand_in")


# Fixed value: the work of a join is dealt into no more than about so many pairs of slots, however much it is.
MOST_SLOTS = 4096


def hot_slots(counts: DataFrame, key: str, hot_rows: int, most: int = MOST_SLOTS) -> DataFrame:
    """The keys to split, with their left and right slots (``_ls``, ``_rs``), from the keys' left and right rows (``_l``, ``_r``).

    A pair of slots makes no more than about ``hot_rows`` ** 2 / 100 rows and reads no more than ``hot_rows`` of a side,
    or one of ``most`` parts of all that is made and read where that is more: rows are repeated once for every slot of
    the other side, and more pairs of slots than tasks could share would only add copies.
    """
    l_rows, r_rows = F.col("_l").cast("double"), F.col("_r").cast("double")
    all_made, all_read = counts.agg(F.sum(l_rows * r_rows), F.sum(l_rows + r_rows)).first()  # one row
    # Rows made by a pair of slots, and rows read by one.
    made = F.lit(max(float(hot_rows) ** 2 / 100, (all_made or 0.0) / most))
    read = F.lit(max(float(hot_rows), (all_read or 0.0) / most))
    by_read = [F.ceil(l_rows / read), F.ceil(r_rows / read)]
    more = F.greatest(F.lit(1.0), F.ceil(l_rows * r_rows / made / (by_read[0] * by_read[1])))
    larger = l_rows >= r_rows
    slots = [by_read[0] * F.when(larger, more).otherwise(1), by_read[1] * F.when(larger, 1).otherwise(more)]
    return counts.select(key, *[s.cast("int").alias(n) for s, n in zip(slots, ("_ls", "_rs"))]).where((F.col("_ls") > 1) | (F.col("_rs") > 1))


def salted_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Inner many-to-many equi-join on one key, with the keys that make many rows split over tasks.

    A key's left and right rows are dealt over left and right slots (``hot_slots``); each side is repeated once for
    every slot of the other. The result equals the plain join. Null keys match nothing.

    Both sides are stored first: they are read twice, and rows are dealt by their
    position in the stored files, so that equal rows part as well.
    """
    left, right = materialize(left, "left", "zstd"), materialize(right, "right", "zstd")
    counts = [d.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(c)) for d, c in ((left, "_l"), (right, "_r"))]
    hot = materialize(hot_slots(materialize(counts[0].join(counts[1], key), "counts"), key, hot_rows), "hot")

    def dealt(side: DataFrame, own: str, other: str, own_slot: str, other_slot: str) -> DataFrame:
        known = side.where(F.col(key).isNotNull()).withColumn("_at", F.monotonically_increasing_id()).join(hot, key, "left")
        return (
            known.withColumn(own_slot, F.pmod(F.xxhash64("_at"), F.coalesce(F.col(own), F.lit(1))).cast("int"))
            .withColumn(other_slot, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)))
            .drop("_at", "_ls", "_rs")
        )

    return dealt(left, "_ls", "_rs", "_a", "_b").join(dealt(right, "_rs", "_ls", "_b", "_a"), [key, "_a", "_b"]).drop("_a", "_b")
