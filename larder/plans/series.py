"""Daily sales series and their features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.dates import calendar_features, parse_iso
from larder.operators.calendar import add_lags, date_spine, fill_gaps
from larder.operators.ranking import first_per_key
from larder.operators.shape import drop_incomplete
from larder.session import materialize

CALENDAR_FEATURES = ("month", "day", "week", "quarter", "dayofyear")
# The metrics of the multi-metric series and their lags.
METRICS = ("unique_locations", "unique_postal_codes", "unique_customers", "total_sales", "unique_stores")
LAG_STEPS = 3


def daily_sales(df: DataFrame, date: str, price: str, quantity: str | None = None) -> DataFrame:
    """Sum of price (times quantity) per day."""
    worth = F.col(price) if quantity is None else F.col(price) * F.col(quantity)
    return df.groupBy(F.col(date)).agg(F.round(F.sum(worth), 2).alias("total_sales"))


def daily_sales_filled(df: DataFrame, date: str, price: str, needed: Sequence[str], first: str, last: str) -> DataFrame:
    """Daily sums over rows complete in the needed columns; days without sales are 0."""
    complete = drop_incomplete(df.select(*needed)).withColumn(date, parse_iso(F.col(date)))
    daily = complete.groupBy(date).agg(F.round(F.sum(price), 2).alias("total_sales"))
    return fill_gaps(daily, date_spine(df.sparkSession, first, last, date), date, ["total_sales"])


# The columns behind the distinct counts of METRICS.
COUNTED = {"unique_locations": "location_id", "unique_postal_codes": "postal_code", "unique_customers": "customer_id", "unique_stores": "store_id"}


def daily_presence(df: DataFrame, date: str = "date", counted: Mapping[str, str] = COUNTED) -> DataFrame:
    """Which numbers occur on which day, as bitmaps: ``date``, ``metric``, ``bucket``, ``bits``.

    The counted columns hold whole numbers that lie close together, such as dense keys: a bitmap has room for
    32,768 of them. Pairs of day and number are made distinct before they are set as bits, each column by
    itself, so no sale is copied per metric. Null numbers are not counted.
    """
    found = None
    for metric, column in counted.items():
        pairs = df.where(F.col(column).isNotNull()).select(date, F.col(column).cast("long").alias("number")).distinct()
        bits = pairs.groupBy(date, F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")).withColumn("metric", F.lit(metric))
        found = bits if found is None else found.unionByName(bits)
    return found


def present(presence: DataFrame, period: Mapping[str, Column]) -> DataFrame:
    """``metric``, ``n``: distinct numbers of each period, whose days' bitmaps are put together."""
    merged = presence.groupBy(*[c.alias(name) for name, c in period.items()], "metric", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*period, "metric").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def _metrics(presence: DataFrame, sales: DataFrame, period: Mapping[str, Column]) -> DataFrame:
    """Counts and sales of each period in one row; periods known to either side, unknown dates among them."""
    counts = present(presence, period).withColumn("total", F.lit(None).cast("double"))
    sums = sales.groupBy(*[c.alias(name) for name, c in period.items()]).agg(F.sum("total").alias("total")).withColumns(
        {"metric": F.lit("total_sales"), "n": F.lit(None).cast("long")})
    one = {m: F.coalesce(F.max(F.when(F.col("metric") == m, F.col("n"))), F.lit(0)) for m in COUNTED}
    one["total_sales"] = F.round(F.max(F.when(F.col("metric") == "total_sales", F.col("total"))), 2)
    return counts.unionByName(sums).groupBy(*period).agg(*[one[m].alias(m) for m in METRICS])


def _sold(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bitmaps and sales of each day; the columns needed are stored, as each is read by itself."""
    lines = materialize(df.select("date", "price", *COUNTED.values()), "lines")
    return daily_presence(lines), lines.groupBy("date").agg(F.sum("price").alias("total"))


def daily_metrics(df: DataFrame) -> DataFrame:
    """Four distinct counts and the sales of each day."""
    return _metrics(*_sold(df), {"date": F.col("date")})


def weekly_metrics(df: DataFrame) -> DataFrame:
    """The same of each ISO week, exact, from the bitmaps and sums of its days."""
    presence, sales = _sold(df)
    return _metrics(materialize(presence, "presence"), sales, {"year": F.year("date"), "week": F.weekofyear("date")})


def monthly_metrics(df: DataFrame) -> DataFrame:
    """The same of each month."""
    presence, sales = _sold(df)
    return _metrics(materialize(presence, "presence"), sales, {"year": F.year("date"), "month": F.month("date")})


def daily_sales_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy("date", key).agg(F.round(F.sum("price"), 2).alias(f"total_sales_{key}"))


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(calendar_features(F.col(date)))


def with_lags(daily: DataFrame, metrics: Sequence[str] = METRICS, steps: int = LAG_STEPS) -> DataFrame:
    return add_lags(daily, "date", metrics, steps)


def as_vector(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def lag_vector(df: DataFrame, metric: str, steps: int = LAG_STEPS) -> DataFrame:
    return as_vector(df, [f"{metric}_lag_{k}" for k in range(1, steps + 1)])


def store_sales(purchases: DataFrame, customers: DataFrame, inventory: DataFrame) -> DataFrame:
    """Purchases with customer and product details.

    Of the stores that list a product only the first counts, so that a purchase
    keeps one row.
    """
    listed = first_per_key(
        inventory.drop("quantity"), ["product_id"], [F.col("product_name"), F.col("store_id")]
    )
    # Stored, so that Spark sees its size and can split hot products in the join below.
    listed = materialize(listed, "listed")
    return (
        purchases.join(listed, "product_id").join(customers, "customer_id")
        .select(
            "date", "purchase_id", "customer_name", "product_id", "product_name",
            F.col("product_price").alias("unit_price"), "quantity", "manufacture_date", "expiry_date",
        )
    )


def all_store_sales(purchases: DataFrame, customers: DataFrame, inventory: DataFrame) -> DataFrame:
    """The unreduced variant: one row per store listing the product."""
    return (
        purchases.join(inventory.drop("quantity"), "product_id").join(customers, "customer_id")
    )
