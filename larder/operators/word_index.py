"""A stored index of the words of a text column, for searches that read a few files instead of all texts.

Three tables lie in one folder: the rows themselves, dealt over parts by their key; the words, with the number of
rows that hold them; and the postings, sorted by word, that lead from a word to keys and parts. A search looks for
its terms in the words, follows the postings of the words that contain them, and tests the texts it gets there,
so the result is that of a search through all texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.functions.text import any_of_ci
from larder.session import materialize

_WORD = r"[\p{L}\p{N}\p{M}]+"


def _folded(c: Column) -> Column:
    """Letters that a search ignoring case takes for the same are the same here; some others are too.

    The dot that a lower-cased dotted capital leaves is taken away. It also stands between the conversions
    because the optimizer would otherwise leave out all but the last, and long s or final sigma stayed apart.
    """
    for convert in (F.lower, F.upper, F.lower):
        c = F.replace(convert(c), F.lit("\u0307"), F.lit(""))
    return c


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_folded(c), F.lit(f"({_WORD})"), F.lit(1)))


def build_index(df: DataFrame, key: str, text: str, folder: str, parts: int = 64) -> None:
    """Write ``df``, whose ``key`` tells its rows apart, with its index to ``folder``. Rows without a key or a text cannot be found."""
    rows = df.where(F.col(key).isNotNull()).withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    rows.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{folder}/rows")
    stored = df.sparkSession.read.parquet(f"{folder}/rows")
    # Stored, so that texts are cut into words once: the bounds of the ranges below come from a pass of their own.
    cut = materialize(stored.select(_words(F.col(text)).alias("_words"), F.col(key).alias("_key"), "_part"), "words")
    postings = cut.select(F.explode("_words").alias("_word"), "_key", "_part")
    # A common word's postings are spread over files by key.
    postings.repartitionByRange("_word", "_key").sortWithinPartitions("_word", "_key").write.mode("overwrite").parquet(f"{folder}/postings")
    kept = df.sparkSession.read.parquet(f"{folder}/postings")
    kept.groupBy("_word").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{folder}/words")


def _longest_words(spark: SparkSession, terms: Sequence[str]) -> list[str | None]:
    """The longest word of each term, null for a term that holds none."""
    found = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "i int, t string")
    runs = F.regexp_extract_all(_folded(F.col("t")), F.lit(f"({_WORD})"), F.lit(1))
    longest = F.array_max(F.transform(runs, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return [r[0] for r in found.select(longest, "i").orderBy("i").collect()]


def search_index(spark: SparkSession, folder: str, key: str, text: str, terms: Sequence[str]) -> DataFrame:
    """The rows whose text contains any of the terms literally, ignoring case. No terms find nothing.

    A term is looked up by its longest word, which may be the middle of a longer one; a term without a word is
    looked for in all rows.
    """
    rows = spark.read.parquet(f"{folder}/rows")
    found = any_of_ci(F.col(text), terms)
    needles = _longest_words(spark, terms) if terms else []
    if not needles or None in needles:
        return rows.where(found).drop("_part")
    holds = reduce(lambda a, b: a | b, [F.contains("_word", F.lit(n)) for n in needles])
    words = spark.read.parquet(f"{folder}/words").where(holds).select("_word")
    keys = spark.read.parquet(f"{folder}/postings").join(words, "_word").select(F.col("_key"), F.col("_part").alias("_in")).distinct()
    # Only the parts that hold a candidate are read.
    return rows.join(keys, (F.col("_part") == F.col("_in")) & (F.col(key) == F.col("_key")), "left_semi").where(found).drop("_part")
