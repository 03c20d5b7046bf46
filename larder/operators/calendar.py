"""Date spines, gap filling, lags and calendar rollups of daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from larder.session import materialize


def date_spine(spark: SparkSession, first: str, last: str, name: str = "date") -> DataFrame:
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def spine_of(df: DataFrame, column: str, name: str = "date") -> DataFrame:
    """Every day between the smallest and the largest date of a column."""
    return df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi")).select(
        F.explode(F.sequence("_lo", "_hi")).alias(name)
    )


def fill_gaps(daily: DataFrame, spine: DataFrame, date: str, values: Sequence[str]) -> DataFrame:
    """One row per spine day, missing values as 0. Both sides have one row per day."""
    return spine.join(daily, date, "left").select(
        date, *[F.coalesce(F.col(v), F.lit(0.0)).alias(v) for v in values]
    )


# Fixed value: days of a daily series that a task of a fit takes at most.
DAYS_A_TASK = 50_000


def in_few_parts(daily: DataFrame, date: str) -> DataFrame:
    """A daily series, stored, in as many partitions as its days need, not as many as the sales behind it had.

    A fit runs thousands of short jobs over its rows, and each sends a result per partition to the driver. Days are in
    order, as forests draw their samples by position.
    """
    stored = materialize(daily, "daily")
    return stored.coalesce(max(1, -(-stored.count() // DAYS_A_TASK))).sortWithinPartitions(date)


def days_of(date: str, series: Sequence[str] = ()):
    """The days of each series, or of the only one, in order."""
    return Window.partitionBy(*(series or [F.lit(0)])).orderBy(date)


def once_a_day(date: str, days, value: Column) -> Column:
    """``value``, or an error where a day has another row: what bounds such a window is the calendar."""
    again = F.lag(date).over(days).eqNullSafe(F.col(date)) & F.col(date).isNotNull()
    return F.when(again, F.raise_error(F.lit("a daily series has more than one row of a day"))).otherwise(value)


def add_lags(df: DataFrame, date: str, metrics: Sequence[str], steps: int, series: Sequence[str] = ()) -> DataFrame:
    """metric_lag_1..steps per series; rows without a full history are dropped.

    Input is a daily series, so a window partition holds at most one row per day;
    a second row of a day is an error.
    """
    w = days_of(date, series)
    names = {f"{m}_lag_{k}": once_a_day(date, w, F.lag(m, k).over(w)) for m in metrics for k in range(1, steps + 1)}
    return df.withColumns(names).na.drop("any", subset=list(names))


def weekly(daily: DataFrame, date: str, value: str, out: str) -> DataFrame:
    """Sums by calendar year and ISO week. The last days of December can fall in
    week 1 of the same calendar year; that pairing is kept on purpose."""
    return daily.groupBy(F.year(date).alias("year"), F.weekofyear(date).alias("week")).agg(
        F.round(F.sum(value), 2).alias(out)
    )


def monthly(daily: DataFrame, date: str, value: str, out: str) -> DataFrame:
    return daily.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(
        F.round(F.sum(value), 2).alias(out)
    )


def until(df: DataFrame, date: str, last: str) -> DataFrame:
    return df.where(F.col(date) <= F.lit(last).cast("date"))


def after(df: DataFrame, date: str, last: str) -> DataFrame:
    return df.where(F.col(date) > F.lit(last).cast("date"))


def between_days(c: Column, first: str, last: str) -> Column:
    return c.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
