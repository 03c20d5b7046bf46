"""Grocery tables as projections of the benchmark tables, in Spark and in SQL.

Orders and line items stand for purchases, parts for products, suppliers for
stores, nations for customer locations, documents with labels for reviews.
Attributes the benchmark lacks (coordinates, price text, shelf-life text) follow
from existing columns by fixed formulas, stated once per language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_TS = "2024-06-01 00:00:00"
AS_OF = "2001-06-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest_sql(*columns: str) -> str:
    """The digest of ``content_key`` in SQL."""
    cells = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in columns]
    return f"md5({' || '.join(cells)})"


def with_ctes(body: str, *names: str) -> str:
    """A statement over the named grocery tables, with the tables they build on."""
    needed: list[str] = []

    def add(name: str) -> None:
        for base in BUILT_ON.get(name, ()):
            add(base)
        if name not in needed:
            needed.append(name)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in needed) + "\n" + body


# --- customers, places, stores ------------------------------------------------------


def customers(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.format_string("c%d@example.com", "c_custkey").alias("email_id"),
    )


def customer_location(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("long").alias("location_id")
    )


def locations(spark, sf):
    key = F.col("n_nationkey").cast("long")
    return table(spark, sf, "nation").select(
        key.alias("location_id"), (key + 8000).alias("postal_code"), F.col("n_name").alias("place_name"),
        (F.lit(36.0) + key * 0.5).alias("latitude"), (F.lit(-9.0) + key * 0.75).alias("longitude"),
    )


def establishments(spark, sf):
    """Two stores share an address; every seventh lacks a usable location."""
    spot = F.floor(F.col("s_suppkey") / 2).cast("long")
    lat = F.format_string("%d.%03d", spot % 8 + 36, spot % 1000)
    lon = F.format_string("%d.%03d", spot % 5, spot * 7 % 1000)
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("commercial_name"),
        F.col("s_nationkey").cast("string").alias("county_code"),
        F.format_string("Street %d", spot).alias("full_address"),
        (spot * 10.0 + 400000).alias("UTMx"), (spot * 10.0 + 4500000).alias("UTMy"),
        F.when(F.col("s_suppkey") % 7 == 6, lat).otherwise(F.concat(lat, F.lit(","), lon)).alias("location"),
    )


# --- purchases and stock ------------------------------------------------------------


def _sold_parts(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))


def purchases(spark, sf):
    return (
        _sold_parts(spark, sf)
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("p_name").alias("product_name"), F.format_number("p_retailprice", 2).alias("unit_price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("purchase_date"),
        )
    )


def stock(spark, sf):
    """Stock lines of stores: product, price, quantity and best-before date."""
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_suppkey").cast("string").alias("store_id"), F.col("s_name").alias("store_name"),
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("quantity"),
            F.date_format(F.date_add(F.col("l_shipdate").cast("date"), F.col("p_size")), "yyyy-MM-dd").alias("expiry_date"),
        )
    )


def store_goods(spark, sf):
    """The distinct (store_name, store_id, product_id) of ``stock``.

    Lines are made distinct as two numbers, before the longer names join them; no store or
    product repeats in what they join, so nothing need be made distinct after it.
    """
    sold = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    products = table(spark, sf, "part").select("p_partkey").distinct()
    stores = table(spark, sf, "supplier").select("s_suppkey", "s_name").distinct()
    return (
        sold.join(products, F.col("l_partkey") == F.col("p_partkey"))
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("s_name").alias("store_name"), F.col("l_suppkey").cast("string").alias("store_id"),
            F.col("p_partkey").alias("product_id"),
        )
    )


def offers(spark, sf):
    """Platform items: two of three lines are resold to the next customer."""
    sold = F.col("l_linenumber") % 3 != 0
    day = F.col("o_orderdate").cast("date")
    return _sold_parts(spark, sf).select(
        F.format_string("%d-%d", "l_orderkey", "l_linenumber").alias("id"),
        F.col("o_custkey").alias("customer_id"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("unit_price"), F.col("l_quantity").cast("int").alias("quantity"),
        F.date_format(day, "yyyy-MM-dd").alias("purchase_date"),
        (F.col("l_discount") * 10 + F.lit(0.0)).alias("percentage_consumed"),
        (F.col("p_size") * 4).alias("avg_expiry_days"),
        F.date_format(F.date_add(day, F.col("p_size") * 2), "yyyy-MM-dd").alias("expected_expiry_date"),
        F.when(sold, (F.col("o_custkey") + 1).cast("string")).alias("buying_customer_id"),
        F.when(sold, F.date_format(F.date_add(day, F.col("p_size")), "yyyy-MM-dd")).alias("selling_date"),
    )


def store_sales(spark, sf):
    """Shop sales with a hidden character in the store id and a best-before text."""
    day = F.col("o_orderdate").cast("date")
    expiry = F.date_format(F.date_add(day, F.col("p_size") * 5), "d MMM yyyy")
    return _sold_parts(spark, sf).select(
        F.concat(F.lit("​ "), F.col("l_suppkey").cast("string"), F.lit("\n")).alias("store_id"),
        F.col("o_custkey").alias("customer_id"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("unit_price"), F.col("l_quantity").cast("int").alias("quantity"),
        F.date_format(day, "yyyy-MM-dd").alias("purchase_date"),
        F.when(F.col("l_linenumber") != 7, expiry).alias("expiry_date"),
    )


def holidays(spark, sf):
    """The days of the first orders of each month, as holidays of one country."""
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf, "orders").where(F.dayofmonth(day) == 1)
        .select(day.alias("date"), F.lit("ES").alias("country")).distinct()
    )


# --- reviews ------------------------------------------------------------------------


def review_texts(spark, sf):
    """Documents as reviews of a store by a customer, without what ``ratings`` knows of them."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("Supplier#"), F.lpad(F.floor(F.col("doc_id") / 10).cast("string"), 9, "0")).alias("business_name"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("user_name"),
        "text",
        F.date_format(F.date_add(F.lit("2024-04-20").cast("date"), (F.col("doc_id") % 60).cast("int")), "yyyy-MM-dd").alias("date"),
    )


def ratings(spark, sf):
    """Labels as ratings of reviews."""
    rating = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 5)
        .when(F.col("quality") == 1, 3).when(F.col("quality") == 0, 1)
    )
    return table(spark, sf, "labels").select(
        "doc_id", rating.cast("long").alias("rating"), F.when(F.col("quality") == 1, "Yes").otherwise("No").alias("verified"))


def reviews(spark, sf):
    """Documents as reviews of a store by a customer; unlabelled ones have no rating."""
    return review_texts(spark, sf).join(ratings(spark, sf), "doc_id", "left").select(
        "doc_id", "business_name", "user_name", "rating", "text", F.coalesce("verified", F.lit("No")).alias("verified"), "date")


# The texts are invented words, so the lexicon names words that occur in them.
DEMO_POSITIVE = ("the", "que", "und", "los", "by")
DEMO_NEGATIVE = ("of", "les", "der", "las", "and")

_TOTALS = """
    list_aggregate(list_transform(string_split_regex(lower(text), '[^\\p{L}]+'),
        lambda w: CASE WHEN w IN ('the','que','und','los','by') THEN 1 ELSE 0 END), 'sum') AS p,
    list_aggregate(list_transform(string_split_regex(lower(text), '[^\\p{L}]+'),
        lambda w: CASE WHEN w IN ('of','les','der','las','and') THEN 1 ELSE 0 END), 'sum') AS n
"""

SQL = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               'c' || c_custkey || '@example.com' AS email_id FROM customer""",
    "customer_location": """
        SELECT c_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS location_id FROM customer""",
    "locations": """
        SELECT CAST(n_nationkey AS BIGINT) AS location_id, CAST(n_nationkey AS BIGINT) + 8000 AS postal_code,
               n_name AS place_name, CAST(36 + n_nationkey * 0.5 AS DOUBLE) AS latitude,
               CAST(-9 + n_nationkey * 0.75 AS DOUBLE) AS longitude FROM nation""",
    "establishments": """
        SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS commercial_name,
               CAST(s_nationkey AS VARCHAR) AS county_code, 'Street ' || spot AS full_address,
               CAST(spot * 10 + 400000 AS DOUBLE) AS "UTMx", CAST(spot * 10 + 4500000 AS DOUBLE) AS "UTMy",
               lat || CASE WHEN s_suppkey % 7 = 6 THEN '' ELSE ',' || lon END AS location
        FROM (SELECT *, (spot % 8 + 36) || '.' || lpad(CAST(spot % 1000 AS VARCHAR), 3, '0') AS lat,
                     (spot % 5) || '.' || lpad(CAST(spot * 7 % 1000 AS VARCHAR), 3, '0') AS lon
              FROM (SELECT *, s_suppkey // 2 AS spot FROM supplier))""",
    "clean_est": """
        SELECT id, commercial_name, county_code, full_address, "UTMx", "UTMy",
               CAST(split_part(location, ',', 1) AS FLOAT) AS latitude,
               CAST(split_part(location, ',', 2) AS FLOAT) AS longitude
        FROM establishments WHERE contains(location, ',')""",
    "sold_parts": """
        SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "purchases": """
        SELECT o_custkey AS customer_id, c_name AS customer_name, p_name AS product_name,
               format('{:,.2f}', p_retailprice) AS unit_price, CAST(l_quantity AS INTEGER) AS quantity,
               strftime(o_orderdate, '%Y-%m-%d') AS purchase_date
        FROM sold_parts JOIN customer ON o_custkey = c_custkey""",
    "clean_purch": f"""
        SELECT {digest_sql('customer_id', 'customer_name', 'product_name', 'unit_price', 'quantity', 'purchase_date')} AS id,
               customer_id, customer_name, product_name, replace(unit_price, ',', '') AS unit_price, quantity, purchase_date
        FROM (SELECT DISTINCT * FROM purchases)""",
    "stock": """
        SELECT CAST(l_suppkey AS VARCHAR) AS store_id, s_name AS store_name, p_partkey AS product_id,
               p_name AS product_name, l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS quantity,
               strftime(CAST(l_shipdate AS DATE) + p_size, '%Y-%m-%d') AS expiry_date
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "offers": """
        SELECT l_orderkey || '-' || l_linenumber AS id, o_custkey AS customer_id, p_name AS product_name,
               p_retailprice AS unit_price, CAST(l_quantity AS INTEGER) AS quantity,
               strftime(o_orderdate, '%Y-%m-%d') AS purchase_date,
               l_discount * 10 + 0.0 AS percentage_consumed, p_size * 4 AS avg_expiry_days,
               CAST(o_orderdate AS DATE) + p_size * 2 AS expiry,
               CASE WHEN l_linenumber % 3 <> 0 THEN o_custkey + 1 END AS buyer,
               CASE WHEN l_linenumber % 3 <> 0 THEN CAST(o_orderdate AS DATE) + p_size END AS sold_on
        FROM sold_parts""",
    "dim_products": """
        SELECT CAST(row_number() OVER (ORDER BY product_name) AS INTEGER) AS product_id, product_name
        FROM (SELECT DISTINCT product_name FROM purchases)""",
    "dim_dates": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date,
               CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
        FROM (SELECT unnest(generate_series(min(CAST(purchase_date AS DATE)), max(CAST(purchase_date AS DATE)),
                                            INTERVAL 1 DAY)) AS d FROM purchases)""",
    "dim_customers": """
        SELECT DISTINCT customer_id, customer_name, email_id, location_id
        FROM customers JOIN customer_location USING (customer_id) JOIN (SELECT location_id FROM locations) USING (location_id)""",
    "dim_places": """
        SELECT 6999 + row_number() OVER (ORDER BY full_address, "UTMx", "UTMy", latitude, longitude) AS location_id, *
        FROM (SELECT DISTINCT full_address, "UTMx", "UTMy", latitude, longitude FROM clean_est)""",
    "dim_stores": """
        SELECT id AS supermarket_id, commercial_name AS supermarket_name, location_id
        FROM clean_est JOIN dim_places USING (full_address)""",
    "fact_inv": """
        SELECT id AS inventory_id, customer_id, location_id, product_id, unit_price, quantity,
               replace(purchase_date, '-', '') AS purchase_date_id
        FROM clean_purch JOIN dim_products USING (product_name) JOIN dim_customers USING (customer_id)""",
    "reviews": """
        SELECT doc_id, 'Supplier#' || lpad(CAST(doc_id // 10 AS VARCHAR), 9, '0') AS business_name,
               'Customer#' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS user_name,
               CAST(CASE WHEN quality = 1 AND toxic = 0 THEN 5 WHEN quality = 1 THEN 3 WHEN quality = 0 THEN 1 END AS BIGINT) AS rating,
               text, CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS verified,
               DATE '2024-04-20' + CAST(doc_id % 60 AS INTEGER) AS day
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "scored": f"""
        SELECT *, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS sentiment_label,
               CASE WHEN p + n > 0 THEN CAST(greatest(p, n) AS DOUBLE) / (p + n) ELSE 0.0 END AS sentiment_score
        FROM (SELECT *, {_TOTALS} FROM reviews)""",
}

BUILT_ON = {
    "clean_est": ("establishments",),
    "purchases": ("sold_parts",),
    "clean_purch": ("purchases",),
    "offers": ("sold_parts",),
    "dim_products": ("purchases",),
    "dim_dates": ("purchases",),
    "dim_customers": ("customers", "customer_location", "locations"),
    "dim_places": ("clean_est",),
    "dim_stores": ("clean_est", "dim_places"),
    "fact_inv": ("clean_purch", "dim_products", "dim_customers"),
    "scored": ("reviews",),
}
