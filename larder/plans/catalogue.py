"""One product list from three shops, and how long products keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from larder.functions.dates import parse_day_month_year, parse_iso
from larder.functions.money import convert, gbp_text_to_eur, inr_text_to_eur, spec_sentence
from larder.functions.shelf_life import duration_days
from larder.functions.text import (
    dashes_to_spaces_lower, drop_parentheses, drop_phrases, first_like, keep_alnum_lower, once, squeeze,
)
from larder.operators.filters import excluding
from larder.operators.keys import dense_key
from larder.operators.ranking import lowest_with_ties
from larder.operators.shape import split_rows, union_all, unpivot_others
from larder.session import materialize

# Categories that hold no food.
NON_FOOD = ("Beauty & Hygiene", "Kitchen, Garden & Pets", "Cleaning & Household", "Baby Care")

CATALOGUE_COLUMNS = ("product_name", "price", "product_description")


def british_products(raw: DataFrame) -> DataFrame:
    """Price text in pounds or pence, possibly "n for ...", to euro per unit."""
    return raw.select(
        F.col("Product_name").alias("product_name"),
        F.round(gbp_text_to_eur(F.col("Price")), 2).alias("price"),
        F.col("Product_Description").alias("product_description"),
    )


def indian_products(raw: DataFrame) -> DataFrame:
    """Rupee text to euro; the specification list becomes the description."""
    return raw.select(
        F.col("name").alias("product_name"),
        F.round(inr_text_to_eur(F.col("selling_price")), 2).alias("price"),
        spec_sentence(F.col("specifications")).alias("product_description"),
    )


def food_products(raw: DataFrame, excluded: Sequence[str] = NON_FOOD) -> DataFrame:
    """Priced products outside the excluded categories; no category means excluded."""
    return excluding(raw, "category", excluded).select(
        F.col("product").alias("product_name"),
        convert(F.col("sale_price"), "INR").alias("price"),
        F.col("description").alias("product_description"),
    )


def all_products(british: DataFrame, indian: DataFrame, food: DataFrame) -> DataFrame:
    """The three lists in one, every row with a number of its own, in the order of its columns."""
    rows = union_all([british_products(british), indian_products(indian), food_products(food)])
    return dense_key(rows, CATALOGUE_COLUMNS, "product_id").select("product_id", *CATALOGUE_COLUMNS)


SHELF_KEY = ("category", "sub_category", "product_name")

# Phrases removed from shelf-life item text, in matching order.
ITEM_PHRASES = (
    "last for", "lasts for", "is good for", "lasts", "last", "for", "are good for", "until",
)
# State of the product, first match wins.
STATE_RULES = (
    ("unopen", "unopened"), ("uncook", "uncooked"), ("unprepare", "uncooked"), ("cook", "cooked"),
    ("prepare", "cooked"), ("open", "opened"), ("seal", "unopened"),
)
# Where the product is kept, first match wins.
PLACE_RULES = (
    ("refrigerator", "refrigerator"), ("pantry", "pantry"), ("outside", "outside"),
    ("counter", "counter"), ("freezer", "freezer"), ("fridge", "fridge"),
    ("past printed date", "outside"), ("unopened", "outside"), ("opened", "outside"),
)
# Pack sizes in product names, removed in this order.
PACK_SIZES = (r"\([^)]*\)", r"\b\d+\s*[xX]\s*\d+\s*\D*\b", r"\b\d+\s*(g|kg|L|ml)\b")


def _shortest(df: DataFrame, source: str) -> DataFrame:
    return (
        df.groupBy(*SHELF_KEY).agg(F.min("days").alias("avg_expiry_days"))
        .withColumn("source", F.lit(source))
    )


def shelf_life_from_dates(raw: DataFrame, source: str = "Flipkart") -> DataFrame:
    """Days from manufacture to expiry, the shortest per product."""
    level = [dashes_to_spaces_lower(F.get("prod_heirarachy", F.lit(i))) for i in range(3)]
    days = F.datediff(parse_day_month_year(F.col("expiry_date")), parse_day_month_year(F.col("manufacturing_date")))
    # Equal packages are told apart from others before their texts are parsed, which costs far more than a shuffle.
    raw = raw.select("prod_heirarachy", "expiry_date", "manufacturing_date").distinct()
    return _shortest(raw.select(*[c.alias(n) for c, n in zip(level, SHELF_KEY)], days.alias("days")), source)


def shelf_life_rows(raw: DataFrame, phrases: Sequence[str] = ITEM_PHRASES, compat: bool = False) -> DataFrame:
    """One row per item, state and place with its shelf life in days."""
    keep = ("item_description", "category", "sub_category", "type")
    item = drop_phrases(drop_parentheses(F.col("item_description")), phrases)
    tall = unpivot_others(raw.withColumn("item_description", item), keep, "kept_place", "life")
    for column, separator in (("type", "/"), ("type", " or "), ("kept_place", "/")):
        tall = split_rows(tall, column, separator)
    place = first_like(F.col("kept_place"), PLACE_RULES, F.col("kept_place"))
    return (
        tall.where(~F.col("life").isin("-", "--"))
        .select(
            F.lower("category").alias("category"),
            F.lower("sub_category").alias("sub_category"),
            F.lower(F.trim(F.regexp_replace("item_description", r"\s*\([^()]*\)", ""))).alias("product_name"),
            once(keep_alnum_lower(F.col("type")), lambda state: first_like(state, STATE_RULES, F.lit("unspecified"))).alias("type"),
            F.trim(F.replace(place, F.lit(" - beyond printed date"), F.lit(""))).alias("kept_place"),
            duration_days(F.col("life"), compat).alias("days"),
        )
        .where("days is not null")
    )


def shelf_life_from_text(
    raw: DataFrame, phrases: Sequence[str] = ITEM_PHRASES, source: str = "Eat by Date", compat: bool = False
) -> DataFrame:
    """Shortest life per product over all states and places."""
    # Equal rows once, and dealt over tasks by a shuffle: a small file is read by one task, and its texts are dear to read.
    texts = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns]).distinct()
    return _shortest(shelf_life_rows(texts, phrases, compat), source)


def shelf_life_from_best_before(raw: DataFrame, seen_on: str, source: str = "Approved Food") -> DataFrame:
    """Days left at the time a product was seen on sale; already expired rows go.

    ``seen_on`` names the column with that date.
    """
    name = F.col("Product_name")
    for size in PACK_SIZES:
        name = F.regexp_replace(name, size, "")
    days = F.datediff(parse_day_month_year(F.col("Expiry_Date")), parse_iso(F.col(seen_on)))
    rows = raw.select("Product_name", "Expiry_Date", seen_on).distinct().select(
        F.lit(" ").alias("category"), F.lit(" ").alias("sub_category"),
        name.alias("product_name"), days.alias("days"),
    )
    return _shortest(rows.where("days > 0"), source)


def perishability(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources together; per product the shortest life, ties between sources kept."""
    # Stored, as the ties are found by reading it twice.
    together = materialize(union_all(sources).withColumn("product_name", squeeze(F.col("product_name"))), "sources")
    return lowest_with_ties(together, SHELF_KEY, "avg_expiry_days")
