"""Column helpers against plain Python restatements."""

import random

import numpy as np
import slow_similarity
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from larder.functions import dates, geo, money, pricing, sentiment, shelf_life, similarity, text


def column_values(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_gbp_price_text(spark):
    cases = {
        "£1.50": 1.74, "75p": 0.87, "3 for £2.00": 1.16 * 2 / 3, "2 for 50p": 0.29, "£1,234.50": 1432.02,
        "garbage": 0.0, "": 0.0, None: 0.0, "0 for £2.00": 0.0, "3 for": 0.0, "£1.50 each": 0.0, "£1.5f": 0.0,
    }
    got = column_values(spark, list(cases), money.gbp_text_to_eur)
    assert [round(g, 6) for g in got] == [round(w, 6) for w in cases.values()]


def test_inr_price_text(spark):
    got = column_values(spark, ["100", "1,000.5", "no selling price", "", None, "12d"], money.inr_text_to_eur)
    assert [round(g, 6) for g in got] == [1.1, 11.0055, 0, 0, 0, 0]


def _gbp(value):
    """The price grammar, restated."""
    try:
        words = value.split(" ")
        count, token = (int(words[0]), words[2]) if len(words) > 1 else (1, value)
        amount = float(token[1:].replace(",", "")) if token[0] == "£" else float(token[:-1].replace(",", "")) / 100
        return amount / count * 1.16
    except Exception:
        return 0.0


# Western digits only: shop pages write no others.
PRICE = st.from_regex(r"\A([0-9]{1,2} for )?(£[0-9]{1,3}(,[0-9]{3})?(\.[0-9]{2})?|[0-9]{1,3}p|[a-z ]{0,6})\Z")


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PRICE, min_size=20, max_size=40))
def test_gbp_grammar(spark, values):
    got = column_values(spark, values, money.gbp_text_to_eur)
    assert [round(g, 9) for g in got] == [round(_gbp(v), 9) for v in values]


def test_durations(spark):
    cases = {
        "3-4 Days": 3, "3 - 4 Days": 3, "2 Weeks": 14, "1+ Years": 365, "6 * Months": 6, "6* Months": 180,
        "Lasts 2-3 months": 60, "12 Hours": 1, "36 Hours": 2, "-": None, "": None, "abc": None, "5": 5, None: None,
    }
    assert column_values(spark, list(cases), shelf_life.duration_days) == list(cases.values())
    hours = column_values(spark, ["12 Hours"], lambda c: shelf_life.duration_days(c, compat=True))
    assert hours == [12]


def test_text_helpers(spark):
    assert column_values(spark, ["o'brien-smith JOHN", "élan vital", "", None], text.title_words) == [
        "O'Brien-Smith John", "Élan Vital", "", None]
    assert column_values(spark, ["hELLO World", ""], text.capitalize) == ["Hello world", ""]
    assert column_values(spark, ["a\x00b​ ", "\n12 "], text.strip_hidden) == ["ab", "12"]
    assert column_values(spark, ["1+1", "x", None], lambda c: text.any_of_ci(c, ["1+1", "Z"])) == [True, False, False]
    assert column_values(spark, [r"a\E.b"], lambda c: text.any_of_ci(c, [r"\E."])) == [True]
    assert column_values(spark, ["ABC", None], lambda c: text.contains_ci(c, "b")) == [True, False]
    phrases = column_values(spark, ["milk lasts for long"], lambda c: text.drop_phrases(c, ("lasts for", "last")))
    assert phrases == ["milk  long"]


def test_ingredients(spark):
    df = spark.createDataFrame([(["200g flour", "½ lemon to serve", "10 litres gas", "2 large eggs, "],)], "v array<string>")
    plain, compat = df.select(
        text.clean_ingredients(F.col("v")), text.clean_ingredients(F.col("v"), compat=True)).first()
    assert plain == "flour, lemon , litres gas, large eggs"
    assert compat == "flour, lemon , itres gas, arge eggs"


def test_price_block_and_specs(spark):
    blocks = ["₹45₹5010% off", "₹45", "no price", "₹60₹5020% off"]
    got = column_values(spark, blocks, money.rupee_block)
    assert [tuple(g) for g in got] == [(45.0, 50.0, "10"), (45.0, 45.0, "0"), (None, None, None), (50.0, 60.0, "20")]
    df = spark.createDataFrame([(["a\nb\nc", "d\ne", "last"],), ([],), (None,)], "v array<string>")
    pairs = [r[0] for r in df.select(money.pair_spec_lines(F.col("v"))).collect()]
    assert pairs == [["a b", "c", "d e"], [], []]
    specs = [r[0] for r in df.select(money.spec_sentence(F.col("v"))).collect()]
    assert specs == [" a\nb\nc d\ne last", "", "no description available"]


def test_dates(spark):
    got = column_values(spark, ["3 Feb 2025", "23 Feb 2025", "31 Feb 2025", "", "x", None], dates.parse_day_month_year)
    assert [str(g) if g else None for g in got] == ["2025-02-03", "2025-02-23", None, None, None, None]


def test_retail_price_nulls_and_clamps(spark):
    df = spark.createDataFrame(
        [(10.0, "2024-01-01", "2024-01-02"), (10.0, "2024-01-01", "2026-01-01"), (10.0, None, "2024-01-02"), (None, "2024-01-01", "2024-01-02")],
        "p double, a string, b string")
    got = [r[0] for r in df.select(pricing.retail_price(F.col("p"), F.to_date("a"), F.to_date("b"))).collect()]
    assert got == [1.0, 10.0, 10.0, None]


def test_haversine(spark):
    df = spark.createDataFrame([(41.39, 2.11, 48.86, 2.35)], "a double, b double, c double, d double")
    km = df.select(geo.haversine_km(*[F.col(c) for c in "abcd"])).first()[0]
    assert 830 < km < 832


def test_lexicon(spark):
    got = column_values(spark, ["Great, fresh but slow", "bad BAD", "good bad", "nothing", None], sentiment.lexicon_sentiment)
    assert [(g.label, round(g.score, 4)) for g in got] == [
        ("positive", 0.6667), ("negative", 1.0), ("neutral", 0.5), ("neutral", 0.0), ("neutral", 0.0)]


def test_batches_equal_one_pair_at_a_time(monkeypatch):
    rng = random.Random(8)
    letters = ["ab", "abcdefgh ", "aé漢🙂b c", "ab cd "]
    texts = ["", " ", "apple juice", "apple juce", "aaaa", "abab", "small ring", "smal rings", "ring", "a" * 300]
    texts += ["".join(rng.choices(rng.choice(letters), k=rng.choice([1, 2, 5, 9, 20, 33, 70]))) for _ in range(250)]
    left, right = [rng.choice(texts) for _ in range(1500)], [rng.choice(texts) for _ in range(1500)]
    slow = {"ratio": slow_similarity.ratio, "partial_ratio": slow_similarity.partial_ratio,
            "partial_token_sort_ratio": slow_similarity.partial_ratio, "partial_token_set_ratio": slow_similarity.token_set}
    for method, one in slow.items():
        want = [one(a, b) for a, b in zip(left, right)]
        assert similarity.batch_scores(left, right, method).tolist() == want
        high = similarity.batch_scores(left, right, method, 70)
        assert [w if w >= 70 else 0 for w in want] == np.where(high >= 70, high, 0).tolist()
        monkeypatch.setattr(similarity, "BRAID_CELLS", 200)  # many small parts
        assert similarity.batch_scores(left, right, method).tolist() == want
        monkeypatch.undo()
        assert similarity.batch_scores([], [], method).tolist() == []
    assert similarity.batch_scores(["ring", "apple juice"], ["small ring", "apple juce"], "partial_ratio").tolist() == [100, 90]
    # Strands of long texts do not fit 16 bits.
    long = "".join(rng.choices("ab", k=40_000))
    assert similarity.batch_scores(["abba"], [long], "ratio").tolist() == [0]


def test_match_score(spark):
    df = spark.createDataFrame([("Small ring!", "ring"), ("apple", "pear"), (None, "x"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(similarity.match_score(F.col("a"), F.col("b"))).collect()]
    assert got == [100, 0, 0, 100]
    native = [r[0] for r in df.select(similarity.match_score(F.col("a"), F.col("b"), "levenshtein", 20)).collect()]
    # Seven letters go from the eleven of "Small ring!".
    assert native == [36, 20, 0, 100]
