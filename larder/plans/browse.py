"""The filter, ranking and summary queries behind the serving pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from larder.functions.text import blank_to_null, capitalize, title_words
from larder.operators.calendar import between_days
from larder.operators.filters import matching, searching, within
from larder.operators.nearest import nearest
from larder.operators.ranking import first_per_key
from larder.operators.shape import drop_incomplete, sorted_distinct

# Fixed values.
CLOSEST_STORES = 5
MIN_SHELF_DAYS = 10
FULL_SCORE = 100


def closest_stores(
    products: DataFrame, establishments: DataFrame, points: DataFrame | Sequence[tuple[str, float, float]], k: int = CLOSEST_STORES
) -> DataFrame:
    """The k stores with products on offer that lie closest to each point (``point_id``, ``lat``, ``lon``)."""
    if not isinstance(points, DataFrame):
        points = products.sparkSession.createDataFrame(list(points), "point_id string, lat double, lon double")
    # Reduce to one row per store before looking up its location; distinct shrinks the lines in the tasks.
    names = products.select("store_id", "store_name").distinct()
    stores = first_per_key(names, ["store_id"], [F.col("store_name")])
    located = stores.join(establishments.select("store_id", "full_address", "latitude", "longitude"), "store_id", "left")
    one_each = first_per_key(located, ["store_id"], [F.col("full_address"), F.col("latitude"), F.col("longitude")])
    return nearest(one_each, points, k, "store_id")


def map_centre(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.agg(
        F.round(F.avg("latitude"), digits).alias("latitude"), F.round(F.avg("longitude"), digits).alias("longitude")
    )


def store_deals(products: DataFrame, store: str | None = None, query: str | None = None) -> DataFrame:
    """Products of one store, or of all, whose name contains the query."""
    return searching(matching(products, {"store_name": store}, "Show All"), {"product_name": query})


def price_view(
    df: DataFrame, days: tuple = (None, None), consumed: tuple = (None, None), price: tuple = (None, None)
) -> DataFrame:
    """Priced items in the chosen ranges, all of them by default, with the price drop in percent."""
    drop = (F.col("unit_price") - F.col("dynamic_price")) / F.col("unit_price") * 100
    priced = df.where("dynamic_price is not null").withColumn("percentage_decrease", drop)
    return within(priced, {"days_to_expiry": days, "percentage_consumed": consumed, "dynamic_price": price})


def best_scored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col("score") == FULL_SCORE).select(*columns)


def browse_reviews(
    reviews: DataFrame, name: str, sentiment: str = "All", verified: str = "All",
    score: tuple = (None, None), rating: tuple = (None, None), first: str | None = None, last: str | None = None,
) -> DataFrame:
    """Reviews by label, verification, score, rating and date, all by default, cased for display."""
    picked = matching(reviews, {"verified": verified})
    if sentiment != "All":
        picked = picked.where(F.lower("sentiment_label") == sentiment.lower())
    picked = within(picked, {"sentiment_score": score, "rating": rating})
    day = F.col("date").cast("date")
    if first is not None:
        picked = picked.where(day >= F.lit(first).cast("date"))
    if last is not None:
        picked = picked.where(day <= F.lit(last).cast("date"))
    return picked.withColumns({
        name: title_words(F.col(name)),
        "sentiment_label": title_words(F.col("sentiment_label")),
        "review": capitalize(F.col("review")),
    })


def perishability_view(catalogue: DataFrame, source: str = "Flipkart") -> DataFrame:
    """Products of one source in display form; rows with a blank field are dropped."""
    names = ["category", "sub_category", "product_name"]
    shown = catalogue.where(F.col("source") == source).select(
        *[title_words(blank_to_null(F.col(c))).alias(c) for c in names], "avg_expiry_days"
    )
    return drop_incomplete(shown)


def browse_perishability(
    view: DataFrame, queries: Mapping[str, str | None], days: tuple = (None, None)
) -> DataFrame:
    return searching(within(view, {"avg_expiry_days": days}), queries)


def day_limits(view: DataFrame) -> DataFrame:
    return view.agg(F.min("avg_expiry_days").alias("lowest"), F.max("avg_expiry_days").alias("highest"))


def pick_list(view: DataFrame, column: str, chosen: Mapping[str, str | None]) -> DataFrame:
    """Ordered choices of a column under the choices already made."""
    return sorted_distinct(matching(view, chosen), column)


def expiry_view(expiry: DataFrame, min_days: int = MIN_SHELF_DAYS) -> DataFrame:
    """Items that keep at least ``min_days`` after purchase."""
    bought = F.col("purchase_date").cast("date")
    return (
        expiry.where(F.col("expected_expiry_date") >= F.date_add(bought, min_days))
        .select(
            F.trim("customer_name").alias("customer_name"),
            F.trim(title_words(F.col("product_name"))).alias("product_name"),
            bought.alias("purchase_date"), "expected_expiry_date",
        )
    )


def browse_expiry(
    view: DataFrame, queries: Mapping[str, str | None], bought: tuple[str, str], expires: tuple[str, str]
) -> DataFrame:
    found = searching(view, queries).where(
        between_days(F.col("purchase_date"), *bought) & between_days(F.col("expected_expiry_date"), *expires)
    )
    shown = {c: F.date_format(c, "yyyy-MM-dd") for c in ("purchase_date", "expected_expiry_date")}
    return found.withColumns(shown)
