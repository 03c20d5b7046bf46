"""Star schema: dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.dates import date_key, date_key_int, parse_iso
from larder.functions.text import strip_hidden
from larder.operators.calendar import spine_of
from larder.operators.keys import content_key, dense_key, key_text, key_value
from larder.operators.shape import left_join_known, salted_join
from larder.plans.pricing import retail_prices

# First surrogate numbers.
STORE_LOCATION_START = 7000
BUSINESS_REVIEW_START = 10000
CUSTOMER_REVIEW_START = 20000
# Fixed value: expiry key used while an inventory carries no expiry date.
DEFAULT_EXPIRY_KEY = "20240524"


def _stamped(df: DataFrame, created_on: str) -> DataFrame:
    return df.withColumn("created_on", F.lit(created_on))


# --- dimensions ---------------------------------------------------------------------


def dim_product(purchases: DataFrame, created_on: str) -> DataFrame:
    """Distinct product names numbered from 1 in name order."""
    names = purchases.select("product_name").where("product_name is not null").distinct()
    numbered = dense_key(names, ["product_name"], "product_id")
    return _stamped(numbered.select(F.col("product_id").cast("int"), "product_name"), created_on)


def dim_date(purchases: DataFrame, created_on: str, column: str = "purchase_date") -> DataFrame:
    """Every day from the first to the last purchase."""
    days = spine_of(purchases.select(parse_iso(F.col(column)).alias("d")), "d")
    return _stamped(days.select(
        date_key_int(F.col("date")).alias("date_id"), "date",
        F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
    ), created_on)


def dim_customer(customers: DataFrame, link: DataFrame, locations: DataFrame, created_on: str) -> DataFrame:
    known = locations.select("location_id").distinct()
    rows = customers.join(link, "customer_id").join(known, "location_id", "left_semi")
    return _stamped(
        rows.select("customer_id", "customer_name", "email_id", "location_id").dropDuplicates(), created_on
    )


def dim_customer_location(customers: DataFrame, link: DataFrame, locations: DataFrame, created_on: str) -> DataFrame:
    """One row per location in use, each attribute being its smallest value."""
    used = link.join(customers.select("customer_id"), "customer_id", "left_semi").select("location_id")
    # Whether a location is used needs no customer rows: a semi join keeps the input at one row per location.
    kept = locations.join(used.distinct(), "location_id", "left_semi")
    attributes = [c for c in ("postal_code", "place_name", "latitude", "longitude") if c in locations.columns]
    return _stamped(kept.groupBy("location_id").agg(*[F.min(c).alias(c) for c in attributes]), created_on)


_ADDRESS = ("full_address", "UTMx", "UTMy", "latitude", "longitude")


def dim_store_location(establishments: DataFrame, created_on: str, start: int = STORE_LOCATION_START) -> DataFrame:
    """Distinct addresses numbered from ``start``. Stores at one address share it; the
    original job numbered every store row and so multiplied them."""
    places = establishments.select(*_ADDRESS).distinct()
    numbered = dense_key(places, list(_ADDRESS), "location_id", start)
    return _stamped(numbered.select("location_id", *_ADDRESS), created_on)


def dim_store(establishments: DataFrame, locations: DataFrame, created_on: str) -> DataFrame:
    stores = establishments.select("id", "commercial_name", *_ADDRESS).distinct().alias("s")
    places = locations.alias("l")
    same = F.lit(True)
    for c in _ADDRESS:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}"))
    return _stamped(stores.join(places, same).select(
        F.col("s.id").cast("string").alias("supermarket_id"),
        F.col("s.commercial_name").alias("supermarket_name"), "l.location_id",
    ).dropDuplicates(), created_on)


# --- facts --------------------------------------------------------------------------


def fact_customer_inventory(
    purchases: DataFrame, products: DataFrame, customers: DataFrame, created_on: str
) -> DataFrame:
    """Purchases with product and location keys. A numeric id is counted from 1."""
    key: Column = F.col("id")
    if dict(purchases.dtypes)["id"] != "string":
        key = key + 1
    return _stamped(
        purchases.join(products.select("product_name", "product_id"), "product_name")
        .join(customers.select("customer_id", "location_id"), "customer_id")
        .select(
            key.alias("inventory_id"), "customer_id", "location_id", "product_id", "unit_price", "quantity",
            F.replace("purchase_date", F.lit("-"), F.lit("")).alias("purchase_date_id"),
        ),
        created_on,
    )


def fact_store_inventory(
    inventory: DataFrame, stores: DataFrame, products: DataFrame, created_on: str,
    expiry_key: str = DEFAULT_EXPIRY_KEY,
) -> DataFrame:
    """Stock lines with store location and product keys, numbered in product order.

    The expiry key comes from ``expiry_date`` when the inventory has one.
    """
    expiry = F.lit(expiry_key)
    if "expiry_date" in inventory.columns:
        expiry = F.coalesce(date_key(parse_iso(F.col("expiry_date"))), expiry)
    rows = (
        inventory.withColumnRenamed("store_id", "supermarket_id").drop("product_id")
        .withColumn("expiry_date_id", expiry)
        .join(stores.select("supermarket_id", "location_id"), "supermarket_id")
        .join(products.select("product_name", "product_id"), "product_name")
        .select("product_name", "supermarket_id", "location_id", "product_id", "price", "quantity", "expiry_date_id")
    )
    order = ["product_name", "supermarket_id", "price", "quantity", "expiry_date_id", "location_id"]
    numbered = dense_key(rows, order, "supermarket_inventory_id")
    return _stamped(numbered.select(
        "supermarket_inventory_id", "supermarket_id", "location_id", "product_id", "price", "quantity",
        "expiry_date_id",
    ), created_on)


def fact_customer_sale(
    sales: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame, created_on: str
) -> DataFrame:
    """Customer-to-customer sales. The customer dimension plays buyer and seller."""
    places = customers.select("customer_id", "location_id")
    buyer = places.toDF("buying_customer_id", "buyer_location_id")
    seller = places.toDF("selling_customer_id", "seller_location_id")
    day = dates.select(F.col("date").alias("_d"), F.col("date_id").alias("selling_date_id"))
    rows = (
        sales.withColumnRenamed("customer_id", "selling_customer_id")
        .withColumn("_d", parse_iso(F.col("selling_date")))
        .withColumn("buying_customer_id", F.col("buying_customer_id").try_cast("long"))
        .join(seller, "selling_customer_id", "left")
        .join(products.select("product_name", "product_id"), "product_name", "left")
    )
    # Unsold items have neither buyer nor day; many rows share that null, so they stay out of those joins.
    rows = left_join_known(rows, day, "_d")
    return _stamped(
        left_join_known(rows, buyer, "buying_customer_id")
        .select(
            "id", "selling_customer_id", "buying_customer_id", "seller_location_id", "buyer_location_id",
            "selling_date_id", "product_id", "unit_price", "quantity", "expected_price", "dynamic_price",
        ),
        created_on,
    )


def fact_store_sale(
    sales: DataFrame, stores: DataFrame, products: DataFrame, dates: DataFrame, customers: DataFrame,
    created_on: str,
) -> DataFrame:
    """Store-to-customer sales of stores with a known location, with the retail price.

    ``sales`` carries store_id, customer_id, product_name, unit_price, quantity,
    purchase_date and expiry_date ("d MMM yyyy").
    """
    places = stores.select(strip_hidden(F.col("supermarket_id").cast("string")).alias("store_id"), "location_id")
    buyers = customers.select("customer_id", F.col("location_id").alias("buyer_location_id"))
    day = dates.select(F.col("date").alias("_d"), F.col("date_id").alias("purchase_date_id"))
    return _stamped(
        retail_prices(sales)
        .withColumn("store_id", strip_hidden(F.col("store_id").cast("string")))
        .withColumn("_d", parse_iso(F.col("purchase_date")))
        # A left join followed by "location known" is an inner join plus that test.
        .join(places.where("location_id is not null"), "store_id")
        .join(products.select("product_name", "product_id"), "product_name", "left")
        .join(day, "_d", "left")
        .join(buyers, "customer_id", "left")
        .select(
            "store_id", "customer_id", "location_id", "buyer_location_id", "product_id", "purchase_date_id",
            "unit_price", "quantity", "dynamic_price",
        ),
        created_on,
    )


_REVIEW_FACT = ("date_id", "sentiment_label", "sentiment_score")


def fact_store_review(
    stock: DataFrame, reviews: DataFrame, created_on: str, review_key: str, numbered: bool = False
) -> DataFrame:
    """Every review of a store applied to every product the store sells.

    The pairs are the stated result, so the output is as large as that. Busy
    stores are split over tasks. Review ids are digests, or dense numbers from
    10000 with ``numbered=True``.
    """
    notes = reviews.select(
        F.col("business_name").alias("store_name"), F.col(review_key).alias("review_key"),
        F.replace(F.col("date").cast("string"), F.lit("-"), F.lit("")).alias("date_id"),
        "sentiment_label", "sentiment_score",
    )
    goods = stock.select("store_name", "store_id", "product_id")
    if numbered:
        order = ["store_id", "product_id", "date_id", "sentiment_label", "sentiment_score", "review_key"]
        rows = dense_key(salted_join(goods, notes, "store_name"), order, "review_id", BUSINESS_REVIEW_START)
    else:
        # There are many more pairs than rows of a side: each side prepares its part of the digest's text.
        # Goods are stored and shuffled as these texts alone, which hold their store and product.
        kinds = dict(goods.dtypes)
        goods = goods.select("store_name", key_text("store_id").alias("_store"), key_text("product_id").alias("_product"))
        notes = notes.withColumn("_note", key_text("review_key")).drop("review_key")
        rows = salted_join(goods, notes, "store_name").select(
            F.md5(F.concat("_store", "_product", "_note")).alias("review_id"),
            *[key_value(f"_{c}", kinds[f"{c}_id"]).alias(f"{c}_id") for c in ("store", "product")], *_REVIEW_FACT,
        )
    return _stamped(rows.select("review_id", "store_id", "product_id", *_REVIEW_FACT), created_on)


def fact_customer_review(
    purchases: DataFrame, reviews: DataFrame, products: DataFrame, created_on: str, review_key: str,
    numbered: bool = False,
) -> DataFrame:
    """Every review a customer wrote applied to every purchase the customer made."""
    notes = reviews.select(
        F.col("user_name").alias("customer_name"), F.col(review_key).alias("review_key"),
        "sentiment_label", "sentiment_score",
    )
    bought = purchases.join(products.select("product_name", "product_id"), "product_name").select(
        "id", "customer_id", "customer_name", "product_id",
        F.replace(F.col("purchase_date").cast("string"), F.lit("-"), F.lit("")).alias("date_id"),
    )
    rows = salted_join(bought, notes, "customer_name")
    if numbered:
        rows = dense_key(rows, ["customer_id", "product_id", "date_id", "id", "review_key"], "review_id", CUSTOMER_REVIEW_START)
    else:
        rows = rows.withColumn("review_id", content_key("id", "review_key"))
    return _stamped(rows.select("review_id", "customer_id", "product_id", *_REVIEW_FACT), created_on)
