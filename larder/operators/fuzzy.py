"""Best fuzzy match between two sets of names, without comparing all pairs.

For a given threshold, a match leaves most two-letter grams of the shorter name
intact, so a bounded number of its grams is certain to contain one that also
occurs in the longer name. Joining just those grams (the rarest ones) against the
grams of the longer names yields every pair that can reach the threshold.
Names too short for that guarantee use single letters under the same argument.

Pairs met that way must then share enough grams, counted with their repeats: a
match keeps so many letters, and so many of them side by side in both names.
Candidates stay complete, and scoring decides among the few that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.functions.similarity import METHODS, comparable, score
from larder.operators.shape import salted_join
from larder.session import materialize

# Names with one gram that a task reads at most, on either side.
HOT_GRAM_ROWS = 100_000


def _losses(size: Column, method: str, threshold: int) -> tuple[Column, Column]:
    """Most letters, and most two-letter grams, of a name of this size that a match can lose."""
    keep = (threshold - 0.5) / 100  # scores are rounded to whole numbers
    if method == "levenshtein":
        # Up to (1-keep)*longer edits, longer <= size/keep; an edit touches two grams.
        edits = size * ((1 - keep) / keep)
        return F.floor(edits + 1e-9), F.floor(2 * edits + 1e-9)
    # A lost letter touches two grams, and each is paired with a gain that touches one.
    return F.floor(size * (1 - keep) + 1e-9), F.floor(size * 3 * (1 - keep) + 1e-9)


def _grams(names: DataFrame) -> DataFrame:
    """Distinct (name, width, gram) with the number of times the gram occurs in the name."""
    def cut(width: int) -> Column:
        starts = F.when(F.length("text") >= width, F.sequence(F.lit(1), F.length("text") - (width - 1)))
        pieces = F.transform(starts, lambda i: F.substring(F.col("text"), i, F.lit(width)))
        return F.coalesce(pieces, F.array().cast("array<string>"))

    return (
        names.select("text", F.explode(F.concat(cut(1), cut(2))).alias("gram"))
        .groupBy("text", "gram").agg(F.count("*").alias("times"))
    )


def _probes(grams: DataFrame, rarity: DataFrame, method: str, threshold: int) -> DataFrame:
    """The rarest grams of each name, just enough that a match must keep one of them."""
    size = F.length("text")
    lost1, lost2 = _losses(size, method, threshold)
    use_pairs = size - 1 > lost2
    wanted = grams.where(F.length("gram") == F.when(use_pairs, 2).otherwise(1))
    # One window partition is one name: bounded by the length of a name.
    by_rarity = Window.partitionBy("text").orderBy("found", "gram").rowsBetween(Window.unboundedPreceding, -1)
    return (
        # A gram the other side lacks is lost for certain: it counts, but cannot match.
        wanted.join(rarity, "gram", "left").withColumn("found", F.coalesce("found", F.lit(0)))
        .withColumn("_before", F.coalesce(F.sum("times").over(by_rarity), F.lit(0)))
        .where(F.col("_before") <= F.when(use_pairs, lost2).otherwise(lost1))
        .where("found > 0")
        .select("text", "gram")
    )


def _shared_at_least(short: Column, long: Column, method: str, threshold: int) -> tuple[Column, Column]:
    """Letters, and two-letter grams, that names of these sizes have in common if they match."""
    keep = (threshold - 0.5) / 100
    if method == "levenshtein":
        edits = F.floor(long * (1 - keep) + 1e-9)
        return long - edits, long - 1 - 2 * edits
    other = long if method == "ratio" else short  # the others compare stretches as long as the shorter name
    letters = F.ceil((short + other) / 2 * keep - 1e-9)
    # Of the common letters in a row, each letter left out on either side can part one pair.
    return letters, 3 * letters - short - other - 1


def _bags(grams: DataFrame, side: str) -> DataFrame:
    """Letters and grams of each name as numbers, a repeat being a further number; equal numbers of others only add candidates."""
    numbered = F.transform(F.sequence(F.lit(1), F.col("times").cast("int")), lambda k: F.hash("gram", k))
    cells = [F.flatten(F.collect_list(F.when(F.length("gram") == width, numbered))).alias(f"{side}_bag{width}") for width in (1, 2)]
    return grams.groupBy(F.col("text").alias(side)).agg(*cells)


def sharing_enough(pairs: DataFrame, left_grams: DataFrame, right_grams: DataFrame, method: str, threshold: int) -> DataFrame:
    """The pairs (``l``, ``r``) with as many letters and grams in common as a match must have."""
    l_size, r_size = F.length("l"), F.length("r")
    needed = _shared_at_least(F.least(l_size, r_size), F.greatest(l_size, r_size), method, threshold)
    counted = pairs.join(_bags(left_grams, "l"), "l").join(_bags(right_grams, "r"), "r")
    enough = F.lit(True)
    for width, least in zip((1, 2), needed):
        enough = enough & (F.size(F.array_intersect(f"l_bag{width}", f"r_bag{width}")) >= least)
    return counted.where(enough).select("l", "r")


def candidate_pairs(left: DataFrame, right: DataFrame, method: str, threshold: int) -> DataFrame:
    """Distinct (l, r) text pairs that hold, for every left text, its best pair scoring at least ``threshold``.

    ``left`` has ``text``; ``right`` has ``text`` and ``r_name``, the name that stands for it.
    """
    lg, rg = materialize(_grams(left), "grams"), materialize(_grams(right), "grams")
    l_rare = lg.groupBy("gram").agg(F.count("*").alias("found"))
    r_rare = rg.groupBy("gram").agg(F.count("*").alias("found"))
    l_probe = _probes(lg, r_rare, method, threshold).withColumnRenamed("text", "l")
    r_probe = _probes(rg, l_rare, method, threshold).withColumnRenamed("text", "r")
    l_all = lg.select(F.col("text").alias("l"), "gram")
    r_all = rg.select(F.col("text").alias("r"), "gram")
    l_size, r_size = F.length("l"), F.length("r")
    # There are few grams and some are in very many names: their rows are dealt over tasks.
    pairs = (
        salted_join(l_probe, r_all, "gram", HOT_GRAM_ROWS).where(l_size <= r_size)
        .unionByName(salted_join(l_all, r_probe, "gram", HOT_GRAM_ROWS).where(l_size > r_size))
        .select("l", "r")
    )
    if method in ("ratio", "levenshtein"):
        # Whole-text scores also bound the sizes; windowed ones do not.
        keep = (threshold - 0.5) / 100
        ratio = keep / (2 - keep) if method == "ratio" else keep
        pairs = pairs.where(F.least(l_size, r_size) >= F.greatest(l_size, r_size) * ratio - 1e-9)
    pairs = sharing_enough(pairs.distinct(), lg, rg, method, threshold)
    if method == "partial_token_set_ratio":
        # One shared word already scores 100, so only the text of the first right name per word can win.
        word = lambda side: F.explode(F.filter(F.split(side, " "), lambda w: w != "")).alias("word")
        first = right.select(word(F.col("text")), "text", "r_name").groupBy("word").agg(F.min_by("text", "r_name").alias("r"))
        shared = left.select(F.col("text").alias("l"), word(F.col("text"))).join(first, "word").select("l", "r")
        pairs = pairs.unionByName(shared).distinct()
    return pairs


def best_match(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str,
    method: str = "partial_token_sort_ratio", threshold: int = 80,
) -> DataFrame:
    """For each distinct left name the best right name scoring at least ``threshold``.

    Ties go to the alphabetically first right name. Left names without a match
    are absent. Columns: left_name, right_name, score. Under ``levenshtein`` a match
    below 52 need not keep a letter in place, so lower thresholds are refused.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    lowest = 52 if method == "levenshtein" else 1  # below, a match need not keep any letter
    if not lowest <= threshold <= 100:
        raise ValueError(f"threshold must be between {lowest} and 100 for {method}")

    def names(df: DataFrame, column: str) -> DataFrame:
        # Several steps below read the names; store the distinct ones so that the
        # table they come from is scanned once.
        found = df.select(F.col(column).alias("name")).where("name is not null").distinct()
        return materialize(found.withColumn("text", comparable(F.col("name"), method)).where("text <> ''"), "names")

    l, r = names(left, left_name), names(right, right_name)
    # Names that compare alike share one text; the first right name stands for its text.
    r_first = r.groupBy("text").agg(F.min("name").alias("r_name"))
    pairs = candidate_pairs(l.select("text").distinct(), r_first, method, threshold)
    scored = pairs.withColumn("score", score(F.col("l"), F.col("r"), method, threshold)).where(F.col("score") >= threshold)
    best = (
        scored.join(r_first, scored["r"] == r_first["text"])
        .groupBy("l")
        .agg(F.min(F.struct((-F.col("score")).alias("neg"), "r_name")).alias("b"))
    )
    return l.join(best, l["text"] == best["l"]).select(
        F.col("name").alias(left_name), F.col("b.r_name").alias(right_name), (-F.col("b.neg")).alias("score")
    )
