"""Sales series, rollups, features and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import inputs as i
from larder.catalog.inputs import table
from larder.operators.calendar import after, monthly, until, weekly
from larder.operators.ranking import last_rows
from larder.plans import series


def dated_lines(s, d):
    """Lines with day, customer place, store and price."""
    return (
        table(s, d, "lineitem").join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("date"), F.col("c_nationkey").cast("long").alias("location_id"),
            (F.col("c_nationkey") + 8000).cast("long").alias("postal_code"), F.col("c_custkey").alias("customer_id"),
            F.col("l_extendedprice").alias("price"), F.col("l_suppkey").alias("store_id"),
        )
    )


def order_days(s, d):
    orders = table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("price"))
    return series.daily_sales(orders, "date", "price")


def purchase_days(s, d):
    lines = table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sold = lines.select(F.col("l_shipdate").cast("date").alias("date"), "p_retailprice", "l_quantity")
    return series.daily_sales(sold, "date", "p_retailprice", "l_quantity")


def filled(s, d):
    """Event values per day, filled to the end of May; clicks have no price and are dropped."""
    events = table(s, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("purchase_date"), "user_id", "event_type",
        F.when(F.col("event_type") != "click", F.col("value")).alias("expected_price"),
    )
    needed = ("purchase_date", "user_id", "event_type", "expected_price")
    return series.daily_sales_filled(events, "purchase_date", "expected_price", needed, "2024-01-01", "2024-05-31")


def lag_features(s, d):
    return series.with_lags(series.daily_metrics(dated_lines(s, d)))


def _purchase_lines(s, d):
    return (
        table(s, d, "lineitem").join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("date"), F.format_string("%d-%d", "l_orderkey", "l_linenumber").alias("purchase_id"),
            F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )
    )


def _listings(s, d):
    """Which stores list which products, priced by their cheapest line."""
    lines = table(s, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.min("l_extendedprice").alias("product_price"), F.min("l_shipdate").alias("made"))
    return lines.join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        "product_price", F.lit(1).alias("quantity"), F.col("made").cast("date").alias("manufacture_date"),
        F.date_add(F.col("made").cast("date"), F.col("p_size")).alias("expiry_date"),
    )


def enriched(s, d):
    people = i.customers(s, d).select("customer_id", "customer_name")
    return series.store_sales(_purchase_lines(s, d), people, _listings(s, d))


def enriched_all(s, d):
    people = i.customers(s, d).select("customer_id", "customer_name")
    rows = series.all_store_sales(_purchase_lines(s, d), people, _listings(s, d))
    return rows.groupBy("store_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("quantity") * F.col("product_price")), 2).alias("sales"))


QUERIES = {
    "daily_sales": purchase_days,
    "daily_sales_filled": filled,
    "weekly_sales": lambda s, d: weekly(order_days(s, d), "date", "total_sales", "total_sales"),
    "monthly_sales": lambda s, d: monthly(order_days(s, d), "date", "total_sales", "total_sales"),
    "daily_multi_metric": lambda s, d: series.daily_metrics(dated_lines(s, d)),
    "weekly_multi_metric": lambda s, d: series.weekly_metrics(dated_lines(s, d)),
    "monthly_multi_metric": lambda s, d: series.monthly_metrics(dated_lines(s, d)),
    "sales_by_postal_code": lambda s, d: series.daily_sales_by(dated_lines(s, d), "postal_code"),
    "sales_by_location": lambda s, d: series.daily_sales_by(dated_lines(s, d), "location_id"),
    "calendar_features": lambda s, d: series.with_calendar(order_days(s, d), "date"),
    "lag_features": lag_features,
    "time_split": lambda s, d: until(order_days(s, d), "date", "1998-12-31").agg(F.count("*").alias("train")).select(
        "train", after(order_days(s, d), "date", "1998-12-31").agg(F.count("*")).scalar().alias("test")),
    "last_days": lambda s, d: last_rows(order_days(s, d), ["date"], 31),
    "enrich_sales": enriched,
    "enrich_sales_all_stores": enriched_all,
}

_DATED = """
    SELECT CAST(o_orderdate AS DATE) AS date, CAST(c_nationkey AS BIGINT) AS location_id,
           CAST(c_nationkey + 8000 AS BIGINT) AS postal_code, c_custkey AS customer_id, l_extendedprice AS price, l_suppkey AS store_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
_ORDER_DAYS = "SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS total_sales FROM orders GROUP BY 1"
_METRICS = f"""
    SELECT date, count(DISTINCT location_id) AS unique_locations, count(DISTINCT postal_code) AS unique_postal_codes,
           count(DISTINCT customer_id) AS unique_customers, round(sum(price), 2) AS total_sales,
           count(DISTINCT store_id) AS unique_stores FROM ({_DATED}) GROUP BY date"""


def _metrics_of(unit: str, part: str) -> str:
    return f"""
    SELECT CAST(year(date) AS INTEGER) AS year, CAST({part}(date) AS INTEGER) AS {unit}, count(DISTINCT location_id) AS unique_locations,
           count(DISTINCT postal_code) AS unique_postal_codes, count(DISTINCT customer_id) AS unique_customers,
           round(sum(price), 2) AS total_sales, count(DISTINCT store_id) AS unique_stores FROM ({_DATED}) GROUP BY 1, 2"""


_LAGS = ", ".join(
    f"lag({m}, {k}) OVER (ORDER BY date) AS {m}_lag_{k}" for m in series.METRICS for k in range(1, series.LAG_STEPS + 1)
)
_LISTINGS = """
    SELECT l_suppkey AS store_id, l_partkey AS product_id, p_name AS product_name, min(l_extendedprice) AS product_price,
           CAST(min(l_shipdate) AS DATE) AS manufacture_date, CAST(min(l_shipdate) AS DATE) + any_value(p_size) AS expiry_date
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3"""

ORACLES = {
    "daily_sales": """
        SELECT CAST(l_shipdate AS DATE) AS date, round(sum(p_retailprice * l_quantity), 2) AS total_sales
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "daily_sales_filled": """
        SELECT CAST(d AS DATE) AS purchase_date, coalesce(total, 0.0) AS total_sales
        FROM generate_series(DATE '2024-01-01', DATE '2024-05-31', INTERVAL 1 DAY) g(d)
        LEFT JOIN (SELECT CAST(ts AS DATE) AS day, round(sum(value), 2) AS total FROM events
                   WHERE event_type <> 'click' AND value IS NOT NULL AND user_id IS NOT NULL GROUP BY 1) ON day = CAST(d AS DATE)""",
    "weekly_sales": f"""
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week, round(sum(total_sales), 2) AS total_sales
        FROM ({_ORDER_DAYS}) GROUP BY 1, 2""",
    "monthly_sales": f"""
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, round(sum(total_sales), 2) AS total_sales
        FROM ({_ORDER_DAYS}) GROUP BY 1, 2""",
    "daily_multi_metric": _METRICS,
    "weekly_multi_metric": _metrics_of("week", "weekofyear"),
    "monthly_multi_metric": _metrics_of("month", "month"),
    "sales_by_postal_code": f"SELECT date, postal_code, round(sum(price), 2) AS total_sales_postal_code FROM ({_DATED}) GROUP BY 1, 2",
    "sales_by_location": f"SELECT date, location_id, round(sum(price), 2) AS total_sales_location_id FROM ({_DATED}) GROUP BY 1, 2",
    "calendar_features": f"""
        SELECT *, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, CAST(weekofyear(date) AS INTEGER) AS week,
               CAST(quarter(date) AS INTEGER) AS quarter, CAST(dayofyear(date) AS INTEGER) AS dayofyear FROM ({_ORDER_DAYS})""",
    "lag_features": f"SELECT * FROM (SELECT *, {_LAGS} FROM ({_METRICS})) WHERE total_sales_lag_3 IS NOT NULL",
    "time_split": f"""
        SELECT count(*) FILTER (WHERE date <= DATE '1998-12-31') AS train, count(*) FILTER (WHERE date > DATE '1998-12-31') AS test
        FROM ({_ORDER_DAYS})""",
    "last_days": f"SELECT * FROM ({_ORDER_DAYS}) ORDER BY date DESC LIMIT 31",
    "enrich_sales": f"""
        SELECT CAST(o_orderdate AS DATE) AS date, l_orderkey || '-' || l_linenumber AS purchase_id, c_name AS customer_name,
               k.product_id, product_name, product_price AS unit_price, CAST(l_quantity AS INTEGER) AS quantity,
               manufacture_date, expiry_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN (SELECT * FROM ({_LISTINGS}) QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_name, store_id) = 1) k
          ON k.product_id = l_partkey""",
    "enrich_sales_all_stores": f"""
        SELECT k.store_id, count(*) AS n, round(sum(CAST(l_quantity AS INTEGER) * product_price), 2) AS sales
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN ({_LISTINGS}) k ON k.product_id = l_partkey GROUP BY 1""",
}
