"""Forecasts. Fits of whole trees and the tuning of several lags have no SQL twin; tests check their invariants."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from larder.catalog.sales import ORACLES as ORACLES_OF_SALES, dated_lines, lag_features, order_days
from larder.operators.calendar import date_spine
from larder.plans import forecast, linear, series
from larder.session import materialize

TRAIN_UNTIL = "2000-12-31"


def selection(s, d):
    return forecast.select_model(order_days(s, d), "date", "total_sales", TRAIN_UNTIL).table(s)


def ranged(s, d):
    daily = order_days(s, d)
    best = forecast.select_model(daily, "date", "total_sales", TRAIN_UNTIL)
    return forecast.forecast_range(daily, "date", "total_sales", best.model, "2001-09-01", "2002-08-31")


def _lags(metric):
    return [f"{metric}_lag_{k}" for k in range(1, series.LAG_STEPS + 1)]


def tuned(metric):
    """All models over their whole grids, for one metric of the daily series."""
    return lambda s, d: forecast.tune(materialize(lag_features(s, d), "lags"), "date", metric, _lags(metric), "2001-01-01")


def lag_vectors(s, d):
    """The lagged values of a day as one vector, written out."""
    made = series.lag_vector(lag_features(s, d), "unique_customers")
    return made.select("date", F.array_join(F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string")), ",").alias("features"))


def fold_numbers(s, d):
    train = lag_features(s, d).where("date < DATE '2001-01-01'")
    return forecast.with_folds(train.select("date"), "date", 5, "fold")


def lag_measures(s, d):
    """How well yesterday's sales predict today's."""
    return forecast.regression_measures(lag_features(s, d), "total_sales", "total_sales_lag_1", 4)


def linear_range(s, d):
    """The daily sales, and a straight line through them by day number drawn into the future."""
    day = F.datediff("date", F.lit("2000-01-01").cast("date")).cast("double")
    daily = order_days(s, d).withColumn("day", day)
    ready = series.as_vector(daily, ["day"])
    model = LinearRegression(featuresCol="features", labelCol="total_sales", solver="normal").fit(ready)
    ahead = series.as_vector(date_spine(s, "2001-09-01", "2001-12-31").withColumn("day", day), ["day"])
    return forecast.with_history(daily, "date", "total_sales", model.transform(ahead)).withColumn("value", F.round("value", 3))


def seasonal_features(s, d):
    """The trend and waves of each day, summed with their numbers as weights."""
    made = forecast.seasonal_columns(F.datediff("date", F.lit("2000-01-01").cast("date")))
    total = sum((c * k for k, c in enumerate(made.values(), 1)), F.lit(0.0))
    return order_days(s, d).select("date", F.lit(len(made)).alias("n_columns"), F.round(total, 5).alias("weighted"))


def seasonal_by_place(s, d):
    daily = series.daily_sales_by(dated_lines(s, d), "location_id")
    return forecast.seasonal_forecast_by(daily, "location_id", "date", "total_sales_location_id", 90)


# One feature, for which the elastic net has a closed form; a penalty of zero is ordinary least squares.
_GRID = {"regParam": (0.0, 0.01, 0.1, 0.5), "elasticNetParam": (0.0, 0.5, 1.0)}


def fold_scores(s, d):
    """How well the last day's value predicts each metric, per fold and grid point."""
    days = materialize(fold_numbers(s, d).withColumnRenamed("date", "day").join(lag_features(s, d), F.col("day") == F.col("date")), "folds")
    found = None
    for m in series.METRICS:
        scores = linear.cross_validate(days, [f"{m}_lag_1"], m, "fold", _GRID).select(
            F.lit(m).alias("metric"), "reg_param", "elastic_net_param", "fold", "n",
            F.round("mae", 3).alias("mae"), F.round(F.sqrt("mse"), 3).alias("rmse"))
        found = scores if found is None else found.unionByName(scores)
    return found


def first_splits(s, d):
    """The best cut of the daily sales by each calendar feature, as a tree would make it first."""
    found = linear.best_splits(series.with_calendar(order_days(s, d), "date"), series.CALENDAR_FEATURES, "total_sales")
    return found.select("feature", "threshold", "n_left", "n_right", F.round("mean_left", 3).alias("mean_left"),
                        F.round("mean_right", 3).alias("mean_right"), F.round(F.sqrt("gain"), 3).alias("root_gain"))


def trend_by_place(s, d):
    """A constant and a trend for every place, drawn 90 days into the future."""
    daily = series.daily_sales_by(dated_lines(s, d), "location_id")
    found = forecast.seasonal_forecast_by(daily, "location_id", "date", "total_sales_location_id", 90, seasons={})
    return found.select("location_id", "date", "kind", *[F.round(c, 2).alias(c) for c in ("yhat", "lower", "upper")])


def vectors(s, d):
    made = series.as_vector(series.with_calendar(order_days(s, d), "date"), series.CALENDAR_FEATURES)
    return made.select("date", F.array_join(F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string")), ",").alias("features"))


QUERIES = {
    "feature_vector": vectors,
    "model_select": selection,
    "forecast_range": ranged,
    **{f"cv_tuning_{m}": tuned(m) for m in series.METRICS},
    "lag_vector": lag_vectors,
    "fold_numbers": fold_numbers,
    "regression_metrics": lag_measures,
    "linear_forecast_range": linear_range,
    "seasonal_features": seasonal_features,
    "seasonal_forecast": lambda s, d: forecast.seasonal_forecast(order_days(s, d), "date", "total_sales", 365),
    "seasonal_forecast_by_location": seasonal_by_place,
    "seasonal_trend_by_location": trend_by_place,
    "cv_fold_scores": fold_scores,
    "best_split": first_splits,
}

_LAGGED = ORACLES_OF_SALES["lag_features"]
_DAYS = "SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS total_sales FROM orders GROUP BY 1"


def _waves(day: str) -> list[str]:
    """The seasonal columns in SQL: trend, then sine and cosine of each wave of each season."""
    found = [f"{day} / 365.25"]
    for period, waves in ((365.25, 10), (7.0, 3), (30.0, 5)):
        for k in range(1, waves + 1):
            found += [f"{f}({day} * 2 * pi() * {k} / {period})" for f in ("sin", "cos")]
    return found


_WAVES = _waves("date_diff('day', DATE '2000-01-01', date)")

# Of one scaled feature: the correlation, made smaller by the first penalty and divided by one plus the second.
_FOLD_SCORES = " UNION ALL ".join(f"""
    SELECT '{m}' AS metric, reg_param, elastic_net_param, fold, count(*) AS n, round(avg(abs(off)), 3) AS mae, round(sqrt(avg(off * off)), 3) AS rmse
    FROM (SELECT f.fold, g.reg_param, g.elastic_net_param, {m} - my - ({m}_lag_1 - mx) * sy / sx * sign(r)
                 * greatest(abs(r) - reg_param * elastic_net_param / sy, 0) / (1 + reg_param * (1 - elastic_net_param) / sy) AS off
          FROM folded f JOIN (
            SELECT k.fold, avg({m}) AS my, avg({m}_lag_1) AS mx, stddev_pop({m}) AS sy, stddev_pop({m}_lag_1) AS sx,
                   covar_pop({m}, {m}_lag_1) / (stddev_pop({m}) * stddev_pop({m}_lag_1)) AS r
            FROM folded f JOIN (SELECT DISTINCT fold FROM folded) k ON f.fold <> k.fold GROUP BY k.fold) t ON t.fold = f.fold,
          (SELECT a AS reg_param, b AS elastic_net_param FROM (VALUES (0.0::DOUBLE), (0.01), (0.1), (0.5)) x(a), (VALUES (0.0::DOUBLE), (0.5), (1.0)) y(b)) g)
    GROUP BY ALL""" for m in series.METRICS)
_PARTS = {"month": "month(date)", "day": "day(date)", "week": "weekofyear(date)", "quarter": "quarter(date)", "dayofyear": "dayofyear(date)"}

ORACLES = {
    "cv_fold_scores": f"""
        WITH folded AS (SELECT *, CAST(ntile(5) OVER (ORDER BY date) - 1 AS INTEGER) AS fold FROM ({_LAGGED}) WHERE date < DATE '2001-01-01')
        {_FOLD_SCORES}""",
    "best_split": f"""
        WITH v AS (
          SELECT feature, value, count(*) AS n, sum(total_sales) AS s
          FROM ({' UNION ALL '.join(f"SELECT '{k}' AS feature, CAST({v} AS DOUBLE) AS value, total_sales FROM ({_DAYS})" for k, v in _PARTS.items())})
          GROUP BY 1, 2
        ), cuts AS (
          SELECT feature, (value + lead(value) OVER (PARTITION BY feature ORDER BY value)) / 2 AS threshold,
                 sum(n) OVER (PARTITION BY feature ORDER BY value) AS nl, sum(s) OVER (PARTITION BY feature ORDER BY value) AS sl,
                 sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s FROM v
        ), scored AS (
          SELECT feature, threshold, CAST(nl AS BIGINT) AS n_left, CAST(n - nl AS BIGINT) AS n_right, sl / nl AS mean_left,
                 (s - sl) / nullif(n - nl, 0) AS mean_right FROM cuts WHERE threshold IS NOT NULL
        )
        SELECT feature, threshold, n_left, n_right, round(mean_left, 3) AS mean_left, round(mean_right, 3) AS mean_right,
               round(sqrt(n_left::DOUBLE * n_right) / (n_left + n_right) * abs(mean_left - mean_right), 3) AS root_gain
        FROM scored
        QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n_left::DOUBLE * n_right * pow(mean_left - mean_right, 2) DESC, threshold) = 1""",
    "seasonal_trend_by_location": f"""
        WITH y AS (
          SELECT location_id, date, total_sales_location_id AS y, date_diff('day', DATE '2000-01-01', date) / 365.25 AS x
          FROM ({ORACLES_OF_SALES['sales_by_location']})
        ), sums AS (
          SELECT location_id, count(*) AS n, sum(x) AS sx, sum(x * x) + 0.001 AS sxx, sum(y) AS sy, sum(x * y) AS sxy, max(date) AS last FROM y GROUP BY 1
        ), line AS (
          SELECT location_id, last, (sxx * sy - sx * sxy) / ((n + 0.001) * sxx - sx * sx) AS a, ((n + 0.001) * sxy - sx * sy) / ((n + 0.001) * sxx - sx * sx) AS b FROM sums
        ), fitted AS (
          SELECT location_id, a, b, last, sqrt(avg(pow(y - a - b * x, 2))) AS sigma FROM y JOIN line USING (location_id) GROUP BY ALL
        ), days AS (
          SELECT location_id, date, 'history' AS kind FROM y
          UNION ALL
          SELECT location_id, last + CAST(k AS INTEGER), 'forecast' FROM line, range(1, 91) r(k)
        )
        SELECT location_id, date, kind, round(greatest(p, 0.0), 2) AS yhat, round(greatest(p - {forecast.INTERVAL_Z} * sigma, 0.0), 2) AS lower,
               round(greatest(p + {forecast.INTERVAL_Z} * sigma, 0.0), 2) AS upper
        FROM (SELECT d.*, a + b * date_diff('day', DATE '2000-01-01', date) / 365.25 AS p, sigma FROM days d JOIN fitted USING (location_id))""",
    "lag_vector": f"""
        SELECT date, concat_ws(',', unique_customers_lag_1, unique_customers_lag_2, unique_customers_lag_3) AS features FROM ({_LAGGED})""",
    "fold_numbers": f"""
        SELECT date, CAST(ntile(5) OVER (ORDER BY date) - 1 AS INTEGER) AS fold FROM ({_LAGGED}) WHERE date < DATE '2001-01-01'""",
    "regression_metrics": f"""
        SELECT round(avg(abs(y - p)), 4) AS mae, round(avg(pow(y - p, 2)), 4) AS mse, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse,
               round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 4) AS r2
        FROM (SELECT total_sales AS y, total_sales_lag_1 AS p, avg(total_sales) OVER () AS m FROM ({_LAGGED}))""",
    "linear_forecast_range": f"""
        SELECT date, round(total_sales, 3) AS value, 'history' AS kind FROM ({_DAYS})
        UNION ALL
        SELECT CAST(d AS DATE) AS date, round(intercept + slope * date_diff('day', DATE '2000-01-01', CAST(d AS DATE)), 3) AS value, 'forecast' AS kind
        FROM (SELECT regr_slope(total_sales, x) AS slope, regr_intercept(total_sales, x) AS intercept
              FROM (SELECT total_sales, CAST(date_diff('day', DATE '2000-01-01', date) AS DOUBLE) AS x FROM ({_DAYS}))),
             generate_series(DATE '2001-09-01', DATE '2001-12-31', INTERVAL 1 DAY) g(d)""",
    "seasonal_features": f"""
        SELECT date, {len(_WAVES)} AS n_columns, round({' + '.join(f'{k} * ({w})' for k, w in enumerate(_WAVES, 1))}, 5) AS weighted
        FROM ({_DAYS})""",
    "feature_vector": """
        SELECT date, concat_ws(',', month(date), day(date), weekofyear(date), quarter(date), dayofyear(date)) AS features
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)""",
}
