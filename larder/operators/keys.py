"""Surrogate keys and running positions without a one-partition window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from larder.session import materialize

# monotonically_increasing_id puts the partition number above these bits.
_POSITION_BITS = 33


def content_key(*columns: str | Column) -> Column:
    """128-bit digest of the given columns as hex text.

    A row-local replacement for random UUIDs and layout-dependent ids: the same
    row gets the same key on every retry, and no shuffle is needed. Each value is
    preceded by its length and a null is marked, so no two rows read alike.
    """
    return F.md5(key_text(*columns))


def key_text(*columns: str | Column) -> Column:
    """The text of which ``content_key`` is the digest.

    The text of some columns followed by that of others is the text of all: both sides of a join
    can prepare theirs, and the digest of the pair is ``F.md5(F.concat(...))``.
    """
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts])


def key_value(text: str, kind: str) -> Column:
    """The value of one column, a string or a whole number of type ``kind``, from its ``key_text``.

    Rows that go through a shuffle need not hold a value beside the text made of it.
    """
    value = F.substr(F.col(text), F.instr(F.col(text), ":") + 1)
    return F.when(F.col(text) != "n", value).cast(kind)


def dense_key(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Number rows start, start+1, ... in the given order.

    Rows are range-partitioned on the whole order, so that a value shared by many
    rows is still spread by the later columns, sorted inside each partition, and
    written out once: range bounds come from a sample, so the layout must be fixed
    before it is counted. The only global window runs over one row per partition.
    ``order`` should identify a row; full ties are numbered in any order.
    """
    laid_out = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    fixed = materialize(laid_out, "dense").withColumn("_part", F.shiftright("_slot", _POSITION_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # offsets holds one row per partition of a single shuffle: bounded, safe to broadcast.
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + in_part + F.lit(start))
        .drop("_part", "_slot", "_offset")
    )


def ranked_counts(df: DataFrame, value: str, within: str) -> DataFrame:
    """Distinct (group, value) with ``n`` rows each and ``before`` rows of the group below.

    A cumulative distribution per group, for exact quantiles: equal values are
    collapsed before the range shuffle, so a hot value costs nothing, and one
    group may span many partitions. Running sums are taken while the sorted
    partitions are written, so nothing is shuffled a second time.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(within, value).agg(F.count("*").alias("n"))
    sorted_parts = counts.repartitionByRange(F.col(within), F.col(value)).sortWithinPartitions(within, value).withColumn(
        "_part", F.spark_partition_id())
    schema = T.StructType([*sorted_parts.schema.fields, T.StructField("_inside", T.LongType())])
    fixed = materialize(sorted_parts.mapInArrow(_running_sum, schema), "ranks")

    def running_start(keys: Sequence[str], name: str) -> DataFrame:
        # One row per partition or per group.
        earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
        sums = fixed.groupBy(*keys).agg(F.sum("n").alias("_rows"))
        return sums.select(*keys, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(name))

    return (
        # One row per partition of a single shuffle: bounded, safe to broadcast.
        fixed.join(F.broadcast(running_start(["_part"], "_offset")), "_part")
        .join(running_start([within], "_start"), within)
        .select(within, value, "n", (F.col("_offset") + F.col("_inside") - F.col("_start")).alias("before"))
    )


def _running_sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the partition before each row, as ``_inside``."""
    total = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        upto = total + np.cumsum(n)
        total = int(upto[-1]) if len(n) else total
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - n)], names=[*batch.schema.names, "_inside"])
