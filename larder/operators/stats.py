"""Summaries, histograms, trend lines and data profiles, all in bounded aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame, functions as F

from larder.operators.keys import ranked_counts

QUARTILES = (("25%", 0.25), ("50%", 0.5), ("75%", 0.75))


def summary(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, as
    (column, statistic, value) rows.

    Quartiles interpolate linearly and are exact: they are read off the ranked
    distinct values, so no task ever holds a whole distribution. All columns
    share one pass over the data. Nulls and NaN do not count.
    """
    tall = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], [F.col(c) for c in columns], "column", "value"
    )
    ranks = ranked_counts(tall.where(~F.isnan("value")), "value", "column")
    value, n = F.col("value"), F.col("n")
    totals = ranks.groupBy("column").agg(F.sum("n").alias("_total"), (F.sum(value * n) / F.sum(n)).alias("_mean"))
    known = ranks.join(totals, "column")
    squares = F.sum(n * F.pow(value - F.col("_mean"), 2))
    found = {
        "count": F.max("_total").cast("double"),
        "mean": F.max("_mean"),
        "std": F.sqrt(squares / F.nullif(F.max("_total") - 1, F.lit(0))),
        "min": F.min(value),
        "max": F.max(value),
    }
    for label, share in QUARTILES:
        # Each quartile lies between the values at two neighbouring ranks.
        at = (F.col("_total") - 1) * F.lit(share)
        low, high = (
            F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + n), value))
            for rank in (F.floor(at), F.ceil(at))
        )
        found[label] = low + (high - low) * F.max(at - F.floor(at))
    rows = known.groupBy("column").agg(*[F.round(c, digits).alias(name) for name, c in found.items()])
    return rows.unpivot(["column"], [F.col(f"`{name}`") for name in found], "statistic", "value")


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; empty bins are absent.

    Nulls and NaN do not count. The input is read twice: for its limits, and to be binned.
    """
    known = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    limits = known.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    low, high = F.col("_limits.lo"), F.col("_limits.hi")
    # The largest value belongs to the last bin.
    number = F.least(F.floor((F.col("_v") - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return (
        known.select("_v", limits.alias("_limits"))
        .groupBy(F.when(high > low, number).otherwise(0).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def mean_by(df: DataFrame, key: str, value: str, out: str, digits: int = 4) -> DataFrame:
    return df.groupBy(key).agg(F.round(F.avg(value), digits).alias(out))


def count_and_mean(df: DataFrame, value: str, digits: int = 4) -> DataFrame:
    return df.agg(F.count("*").alias("total_items"), F.round(F.avg(value), digits).alias("average"))


def trend_line(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """Least-squares line of y on x."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return both.agg(
        F.count("*").alias("n"),
        F.round(F.regr_slope(ys, xs), digits).alias("slope"),
        F.round(F.regr_intercept(ys, xs), digits).alias("intercept"),
        F.round(F.regr_r2(ys, xs), digits).alias("r2"),
    )


def profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, columns, distinct keys and nulls per column.

    The frame is first collapsed to one row per key with null tallies (partial
    aggregation in each task), then to one row, so one read serves all figures.
    """
    tallies = [F.sum(F.col(c).isNull().cast("long")).alias(f"nulls_{c}") for c in df.columns]
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"), *[
        t for c, t in zip(df.columns, tallies) if c != key
    ])
    key_nulls = F.sum(F.when(F.col(key).isNull(), F.col("_n")).otherwise(0)).alias(f"nulls_{key}")
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count(key).alias("n_keys"),
        *[key_nulls if c == key else F.sum(f"nulls_{c}").alias(f"nulls_{c}") for c in df.columns],
    )


def match_audit(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """How many left rows do and do not find a partner."""
    keys = right.select(F.col(right_key).alias("_k")).distinct().withColumn("_hit", F.lit(1))
    counts = left.groupBy(F.col(left_key).alias("_k")).agg(F.count("*").alias("_n"))
    hit = F.col("_hit").isNotNull()
    return counts.join(keys, "_k", "left").agg(
        F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum(F.when(~hit, F.col("_n"))), F.lit(0)).alias("unmatched"),
    )
