"""Recipe text preparation and ingredient search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions.text import any_of_ci, clean_ingredients
from larder.operators.word_index import build_index, search_index


def prepare_recipes(meals: DataFrame, compat: bool = False) -> DataFrame:
    return meals.select(
        *[c for c in meals.columns if c != "ingredients"],
        clean_ingredients(F.col("ingredients"), compat).alias("clean_ingredients"),
        F.lower(F.concat_ws(", ", "ingredients")).alias("ingredients_lower"),
    )


def find_recipes(recipes: DataFrame, ingredients: Sequence[str]) -> DataFrame:
    """Recipes naming any of the ingredients; an empty result means none was found."""
    return recipes.where(any_of_ci(F.col("clean_ingredients"), ingredients)).select(
        "food_name", "clean_ingredients", "description"
    )


def index_recipes(recipes: DataFrame, folder: str, key: str = "food_name", parts: int = 64) -> None:
    """Store recipes for ``find_indexed``; ``key`` tells them apart."""
    build_index(recipes, key, "clean_ingredients", folder, parts)


def find_indexed(spark: SparkSession, folder: str, ingredients: Sequence[str], key: str = "food_name") -> DataFrame:
    """What ``find_recipes`` finds, from the stored index."""
    return search_index(spark, folder, key, "clean_ingredients", ingredients).select("food_name", "clean_ingredients", "description")
