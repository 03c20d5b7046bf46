"""Every registered query against its SQL twin, or against its invariants."""

import pytest

import __spark_entry__ as driver
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and [f for f in rows[0].asDict()] == ["year", "month", "new_customers"]


def _rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def test_model_select(spark):
    rows = _rows(spark, "model_select")
    assert {r.model for r in rows} == {"linear", "tree", "forest", "boosted"}
    best = [r for r in rows if r.chosen]
    assert len(best) == 1 and best[0].mae == min(r.mae for r in rows)


def test_forecast_range(spark):
    rows = _rows(spark, "forecast_range")
    ahead = [r for r in rows if r.kind == "forecast"]
    assert len(ahead) == 365 and len({r.date for r in ahead}) == 365
    assert all(r.value is not None for r in rows)


def test_seasonal(spark):
    rows = _rows(spark, "seasonal_forecast")
    assert sum(r.kind == "forecast" for r in rows) == 365
    assert all(0 <= r.lower <= r.yhat <= r.upper for r in rows)


def test_seasonal_by_series(spark):
    rows = _rows(spark, "seasonal_forecast_by_location")
    ahead = {}
    for r in rows:
        assert 0 <= r.lower <= r.yhat <= r.upper
        if r.kind == "forecast":
            ahead[r.location_id] = ahead.get(r.location_id, 0) + 1
    assert ahead and set(ahead.values()) == {90}


def test_tuning(spark):
    rows = _rows(spark, "cv_tuning_total_sales")
    assert {(r.model, r.part) for r in rows} == {(m, p) for m in ("linear", "tree", "forest") for p in ("train", "test")}
    assert all(r.mae > 0 and abs(r.rmse ** 2 - r.mse) < 1e-6 * r.mse for r in rows)


def test_sentiment_model(spark):
    rows = _rows(spark, "sentiment_model")
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.sentiment_label in ("positive", "negative") and 0.5 <= r.sentiment_score <= 1 for r in rows)


def test_expected_expiry_partial(spark):
    rows = _rows(spark, "expected_expiry_partial")
    assert rows and all(r.avg_expiry_days > 0 and str(r.expected_expiry_date) > r.purchase_date for r in rows)


def test_fuzzy_partial_and_ratio(spark):
    for name in ("fuzzy_match_partial", "fuzzy_match_ratio"):
        rows = _rows(spark, name)
        assert rows and all(r.score >= 80 for r in rows)
        assert len({r.product_name for r in rows}) == len(rows)
