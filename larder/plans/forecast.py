"""Forecasts of daily series with MLlib.

A daily series is bounded by the calendar, so a fitted frame is small whatever
the size of the sales behind it; the aggregation in front of it is the scalable
part. Many series at once are fitted from sums that Spark adds up per series.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from larder.operators.calendar import after, date_spine, days_of, in_few_parts, once_a_day, until
from larder.plans import linear
from larder.plans.series import CALENDAR_FEATURES, with_calendar
from larder.session import materialize

MEASURES = ("mae", "mse", "rmse", "r2")


@dataclass(frozen=True)
class ModelSettings:
    """The settings of the original model comparison."""

    iterations: int = 100
    elastic_net: float = 0.1
    depth: int = 20
    trees: int = 100
    boosts: int = 100
    seed: int = 42


def regressors(label: str, s: ModelSettings = ModelSettings()) -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "linear": LinearRegression(maxIter=s.iterations, elasticNetParam=s.elastic_net, **common),
        "tree": DecisionTreeRegressor(maxDepth=s.depth, seed=s.seed, **common),
        "forest": RandomForestRegressor(maxDepth=s.depth, numTrees=s.trees, seed=s.seed, **common),
        "boosted": GBTRegressor(maxDepth=s.depth, maxIter=s.boosts, seed=s.seed, **common),
    }


def measure(predictions: DataFrame, label: str, measures: Sequence[str] = MEASURES) -> dict[str, float]:
    return {m: RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=m).evaluate(predictions)
            for m in measures}


@dataclass
class Selection:
    best: str
    model: Model
    scores: dict[str, float] = field(default_factory=dict)

    def table(self, spark) -> DataFrame:
        """(model, mae, chosen) rows; one per candidate."""
        return spark.createDataFrame(
            [(n, float(v), n == self.best) for n, v in sorted(self.scores.items())],
            "model string, mae double, chosen boolean",
        )


def select_model(
    daily: DataFrame, date: str, label: str, train_until: str, settings: ModelSettings = ModelSettings(),
) -> Selection:
    """Fit each regressor on the days up to ``train_until`` and keep the lowest error after it."""
    ready = VectorAssembler(inputCols=list(CALENDAR_FEATURES), outputCol="features").transform(
        in_few_parts(with_calendar(daily, date), date)
    ).cache()
    train, test = until(ready, date, train_until), after(ready, date, train_until)
    models = {name: est.fit(train) for name, est in regressors(label, settings).items()}
    scores = {name: measure(m.transform(test), label, ("mae",))["mae"] for name, m in models.items()}
    best = min(scores, key=lambda n: (scores[n], n))
    ready.unpersist()
    return Selection(best, models[best], scores)


def regression_measures(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """MAE, MSE, RMSE and R2 of a prediction column in one aggregate; rows lacking either value do not count."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    off = y - p
    squares = F.avg(off * off)
    return df.where(y.isNotNull() & p.isNotNull()).agg(
        F.round(F.avg(F.abs(off)), digits).alias("mae"), F.round(squares, digits).alias("mse"),
        F.round(F.sqrt(squares), digits).alias("rmse"), F.round(1 - squares / F.var_pop(y), digits).alias("r2"),
    )


def forecast_range(daily: DataFrame, date: str, label: str, model: Model, first: str, last: str) -> DataFrame:
    """History and predictions for every day of a future range, told apart by ``kind``."""
    future = with_calendar(date_spine(daily.sparkSession, first, last, date), date)
    ready = VectorAssembler(inputCols=list(CALENDAR_FEATURES), outputCol="features").transform(future)
    return with_history(daily, date, label, model.transform(ready))


def with_history(daily: DataFrame, date: str, label: str, predicted: DataFrame) -> DataFrame:
    """The known days and the predicted ones under each other: (date, value, kind)."""
    ahead = predicted.select(date, F.col("prediction").alias("value"))
    return daily.select(date, F.col(label).alias("value")).withColumn("kind", F.lit("history")).unionByName(
        ahead.withColumn("kind", F.lit("forecast"))
    )


# The tuning grids.
GRIDS = {
    "linear": {"regParam": (0.01, 0.1, 0.5), "elasticNetParam": (0.0, 0.5, 1.0)},
    "tree": {"maxDepth": (3, 5, 7), "maxBins": (20, 32, 50)},
    "forest": {"numTrees": (10, 20, 30), "maxDepth": (5, 10, 15)},
}


def with_folds(daily: DataFrame, date: str, folds: int, name: str) -> DataFrame:
    """Consecutive stretches of time, numbered from 0; the input is a daily series, one row per day."""
    days = days_of(date)
    return daily.withColumn(name, once_a_day(date, days, (F.ntile(folds).over(days) - 1).cast("int")))


def tune(
    df: DataFrame, date: str, metric: str, features: Sequence[str], test_from: str,
    models: Sequence[str] = ("linear", "tree", "forest"), folds: int = 5, parallelism: int = 4,
    grids: dict[str, dict[str, Sequence]] = GRIDS,
) -> DataFrame:
    """Cross-validated grid search per model: (model, part, mae, mse, rmse, r2).

    Folds are consecutive stretches of time, so neighbouring days never sit on
    both sides of a split. Linear models are not refitted for every fold and grid
    point: they are solved from sums of products that one pass over the days gives.
    """
    boundary = F.lit(test_from).cast("date")
    train = in_few_parts(with_folds(df.where(F.col(date) < boundary), date, folds, "_fold"), date).cache()
    test = in_few_parts(df.where(F.col(date) >= boundary), date).cache()
    estimators = regressors(metric)
    rows = []
    for name in models:
        if name == "linear":
            points = linear.best_point(linear.cross_validate(train, features, metric, "_fold", grids[name]))
            weights = linear.fit(train, features, metric, *points)
            for part, data in (("train", train), ("test", test)):
                scores = measure(linear.predict(data, features, weights), metric)
                rows.append((name, part, *[float(scores[m]) for m in MEASURES]))
            continue
        estimator = estimators[name]
        grid = ParamGridBuilder()
        for param, values in grids[name].items():
            grid = grid.addGrid(estimator.getParam(param), list(values))
        steps = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), estimator])
        search = CrossValidator(
            estimator=steps, estimatorParamMaps=grid.build(), numFolds=folds, foldCol="_fold",
            parallelism=parallelism, evaluator=RegressionEvaluator(labelCol=metric, metricName="mae"),
        )
        best = search.fit(train)
        for part, data in (("train", train), ("test", test)):
            scores = measure(best.transform(data), metric)
            rows.append((name, part, *[float(scores[m]) for m in MEASURES]))
    train.unpersist()
    test.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, part string, mae double, mse double, rmse double, r2 double")


# --- additive seasonal model --------------------------------------------------------

# Fixed values: (period in days, number of harmonics). A one-day period is constant on daily data.
SEASONS = {"yearly": (365.25, 10), "weekly": (7.0, 5), "monthly": (30.0, 5)}
# Width of the reported interval: 80%.
INTERVAL_Z = 1.2815515655446004


def _waves(seasons: Mapping[str, tuple[float, int]] = SEASONS) -> list[tuple[str, float]]:
    """Name and turn per day of every wave; at half the sampling rate and beyond, waves repeat lower ones."""
    return [(f"{name}_{{}}_{k}", 2 * math.pi * k / period) for name, (period, order) in seasons.items()
            for k in range(1, min(order, math.ceil(period / 2) - 1) + 1)]


def seasonal_columns(day_number: Column, seasons: Mapping[str, tuple[float, int]] = SEASONS) -> dict[str, Column]:
    """Trend plus sine and cosine waves of every season."""
    columns = {"trend": day_number / 365.25}
    for name, turn in _waves(seasons):
        columns[name.format("sin")] = F.sin(day_number * turn)
        columns[name.format("cos")] = F.cos(day_number * turn)
    return columns


def seasonal_forecast(daily: DataFrame, date: str, label: str, horizon: int, ridge: float = 1e-6) -> DataFrame:
    """Fitted and future values with an interval, none below zero: (date, yhat, lower, upper, kind)."""
    day_number = F.datediff(F.col(date), F.lit("2000-01-01").cast("date"))
    waves = seasonal_columns(day_number)
    assemble = VectorAssembler(inputCols=list(waves), outputCol="features")
    history = daily.select(date, F.col(label).cast("double").alias("y"))
    ready = assemble.transform(history.withColumns(waves)).cache()
    model = LinearRegression(labelCol="y", regParam=ridge).fit(ready)
    sigma = model.summary.rootMeanSquaredError
    ahead = history.agg(F.max(date).alias("_last")).select(
        F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias(date)
    )
    days = ready.select(date, "features", F.lit("history").alias("kind")).unionByName(
        assemble.transform(ahead.withColumns(waves)).select(date, "features", F.lit("forecast").alias("kind"))
    )
    floor = lambda c: F.greatest(c, F.lit(0.0))
    yhat = F.col("prediction")
    return model.transform(days).select(
        date, floor(yhat).alias("yhat"), floor(yhat - INTERVAL_Z * sigma).alias("lower"),
        floor(yhat + INTERVAL_Z * sigma).alias("upper"), "kind",
    )


def _solved(size: int, ridge: float) -> Callable:
    """From the sums of products of (1, waves, y) of each series: the weights, and the deviation of what is left."""
    # Products come feature by feature: the feature itself, then its products with the earlier ones and itself.
    places = {}
    for j in range(size):
        places[(j,)] = len(places)
        places.update({(i, j): len(places) + i for i in range(j + 1)})
    cells = np.array([[places[tuple(sorted((i, j)))] for j in range(size)] for i in range(size)])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.array(batch.column("sums").to_pylist(), float).reshape(len(batch), -1)[:, cells]
            xx, xy, yy, n = sums[:, :-1, :-1], sums[:, :-1, -1], sums[:, -1, -1], sums[:, 0, 0]
            weights = np.linalg.solve(xx + ridge * np.eye(size - 1), xy[:, :, None])[:, :, 0]
            left = yy - 2 * (weights * xy).sum(axis=1) + np.einsum("si,sij,sj->s", weights, xx, weights)
            sigma = np.sqrt(np.maximum(left, 0) / n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights.tolist(), pa.list_(pa.float64())), pa.array(sigma)],
                                             names=[batch.schema.names[0], "weights", "sigma"])

    return solve


def seasonal_forecast_by(
    daily: DataFrame, series: str, date: str, label: str, horizon: int, ridge: float = 1e-3,
    seasons: Mapping[str, tuple[float, int]] = SEASONS,
) -> DataFrame:
    """The same model fitted separately for each series.

    Spark adds up the products of every two columns of a series' days, from partial sums of all tasks, and one small
    system of equations is solved per series. Values and days of a series never come together in a task. A series
    without any value has no forecast.
    """
    kind = dict(daily.dtypes)[series]
    day_number = F.datediff(F.col(date), F.lit("2000-01-01").cast("date"))
    per_day = materialize(daily.groupBy(series, date).agg(F.sum(F.col(label).cast("double")).alias("y")), "per-day")
    waves = {"constant": F.lit(1.0), **seasonal_columns(day_number, seasons)}
    known = per_day.where(F.col("y").isNotNull()).select(series, array_to_vector(F.array(*waves.values(), F.col("y"))).alias("x"))
    products = PolynomialExpansion(degree=2, inputCol="x", outputCol="products").transform(known)
    sums = products.groupBy(series).agg(Summarizer.sum(F.col("products")).alias("sums")).select(series, vector_to_array("sums").alias("sums"))
    models = sums.mapInArrow(_solved(len(waves) + 1, ridge), f"`{series}` {kind}, weights array<double>, sigma double")
    ahead = per_day.groupBy(series).agg(F.max(date).alias("_last")).select(
        series, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias(date), F.lit("forecast").alias("kind"))
    days = per_day.select(series, date, F.lit("history").alias("kind")).unionByName(ahead)
    models = models.withColumnRenamed(series, "_of")
    parts = F.zip_with(F.array(*waves.values()), "weights", lambda x, w: x * w)
    yhat = F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)
    floor = lambda c: F.greatest(c, F.lit(0.0))
    fitted = days.join(models, F.col(series).eqNullSafe(F.col("_of"))).withColumn("_yhat", yhat)
    return fitted.select(
        series, date, floor(F.col("_yhat")).alias("yhat"), floor(F.col("_yhat") - INTERVAL_Z * F.col("sigma")).alias("lower"),
        floor(F.col("_yhat") + INTERVAL_Z * F.col("sigma")).alias("upper"), "kind")
