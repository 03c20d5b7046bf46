"""Linear models and first splits from sums, against MLlib and against all cuts."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from larder.plans import forecast, linear


def frame(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(50, 20, n), rng.integers(0, 7, n).astype(float), rng.normal(size=n)
    y = 3 * a - 20 * b + 0.1 * c + rng.normal(size=n) * 30 + 400
    rows = [(int(i % 5), *map(float, r)) for i, r in enumerate(zip(a, b, c, np.full(n, 2.0), y))]
    return spark.createDataFrame(rows, "fold int, a double, b double, c double, same double, y double")


def mllib(df, features, penalty, mix):
    ready = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    model = LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=mix, tol=1e-14, maxIter=5000).fit(ready)
    return np.array([model.intercept, *model.coefficients])


@pytest.mark.parametrize("penalty,mix", [(0.0, 0.0), (0.5, 0.0), (5.0, 0.5), (0.1, 1.0), (20.0, 1.0)])
def test_elastic_net_equals_mllib(spark, penalty, mix):
    df, features = frame(spark), ["a", "b", "c"]
    assert np.allclose(linear.fit(df, features, "y", penalty, mix), mllib(df, features, penalty, mix), rtol=1e-6, atol=1e-6)
    left_out = linear.product_sums(df, features, "y", "fold")
    others = linear.elastic_net(sum(left_out.values()) - left_out[2], penalty, mix)
    assert np.allclose(others, mllib(df.where("fold <> 2"), features, penalty, mix), rtol=1e-6, atol=1e-6)


def test_cross_validation_equals_one_fit_per_fold(spark):
    df, features = frame(spark, 120), ["a", "b"]
    grid = {"regParam": (0.0, 1.0), "elasticNetParam": (0.0, 1.0)}
    got = {(r.reg_param, r.elastic_net_param, r.fold): (r.n, r.mae, r.mse) for r in linear.cross_validate(df, features, "y", "fold", grid).collect()}
    assert len(got) == 4 * 5
    for penalty, mix in linear.grid_points(grid):
        for fold in range(5):
            w = mllib(df.where(F.col("fold") != fold), features, penalty, mix)
            rows = np.array(df.where(F.col("fold") == fold).select("a", "b", "y").collect())
            off = rows[:, 2] - w[0] - rows[:, :2] @ w[1:]
            assert np.allclose(got[penalty, mix, fold], (len(rows), np.abs(off).mean(), (off ** 2).mean()), rtol=1e-6)
    best = linear.best_point(linear.cross_validate(df, features, "y", "fold", grid))
    means = {p: np.mean([got[(*p, k)][1] for k in range(5)]) for p in linear.grid_points(grid)}
    assert best == min(means, key=lambda p: (means[p], p))


def test_features_and_labels_that_do_not_vary_nulls_and_no_rows(spark):
    df = frame(spark, 60)
    w = linear.fit(df, ["a", "same"], "y", 0.1, 0.5)
    assert w[2] == 0 and np.allclose(w[:2], linear.fit(df, ["a"], "y", 0.1, 0.5))
    assert np.allclose(linear.fit(df, ["a"], "same", 0.1, 0.5), [2.0, 0.0])
    assert linear.fit(df.where("false"), ["a"], "y", 0.1, 0.5).tolist() == [0.0, 0.0]
    holes = df.unionByName(spark.createDataFrame([(0, None, 1.0, 1.0, 2.0, 5.0), (1, 1.0, 1.0, 1.0, 2.0, None)], df.schema))
    assert np.allclose(linear.fit(holes, ["a"], "y", 0.0, 0.0), linear.fit(df, ["a"], "y", 0.0, 0.0))
    assert linear.cross_validate(df.where("false"), ["a"], "y", "fold", {"regParam": (0.0,), "elasticNetParam": (0.0,)}).count() == 0


def test_best_split_equals_a_tree_of_depth_one(spark):
    df = frame(spark, 200, 3).withColumns({"a": F.round("a"), "c": F.round("c", 1)})
    got = {r.feature: r for r in linear.best_splits(df, ["a", "b", "c", "same"], "y").collect()}
    assert set(got) == {"a", "b", "c"}
    rows = {c: np.array([[r[c], r.y] for r in df.collect()]) for c in got}
    for feature, r in got.items():
        x, y = rows[feature].T
        values = np.unique(x)
        gains = {}
        for t in (values[1:] + values[:-1]) / 2:
            low, high = y[x <= t], y[x > t]
            gains[t] = y.var() - (len(low) * low.var() + len(high) * high.var()) / len(y)
        assert r.threshold == max(gains, key=gains.get) and np.isclose(r.gain, max(gains.values()))
        ready = VectorAssembler(inputCols=[feature], outputCol="features").transform(df)
        tree = DecisionTreeRegressor(labelCol="y", maxDepth=1, maxBins=400).fit(ready)
        root = tree._call_java("rootNode")
        assert np.isclose(root.split().threshold(), r.threshold) and np.isclose(root.gain(), r.gain)
    assert linear.best_splits(df.where("false"), ["a"], "y").count() == 0


def test_seasonal_fit_per_series_equals_the_matrix_solved_alone(spark):
    rng = np.random.default_rng(4)
    rows = [(name, int(d), float(max(0, base + 3 * np.sin(d * 2 * np.pi / 7) + rng.normal()))) for name, base in (("a", 20), (None, 5)) for d in range(0, 200 + base)]
    rows += [("a", 0, 1.0), ("holes", 3, None)]
    df = spark.createDataFrame(rows, "place string, d int, y double").selectExpr("place", "date_add(DATE '2001-01-01', d) AS date", "y")
    made = forecast.seasonal_forecast_by(df, "place", "date", "y", 30)
    assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()
    got = made.toPandas()
    assert set(got["place"].fillna("-")) == {"a", "-"}
    waves = forecast.seasonal_columns(F.datediff("date", F.lit("2000-01-01").cast("date")))
    table = df.where("y IS NOT NULL").groupBy("place", "date").agg(F.sum("y").alias("y")).select("place", "date", "y", F.array(F.lit(1.0), *waves.values()).alias("x"))
    for place in ("a", None):
        part = table.where(F.col("place").eqNullSafe(F.lit(place))).orderBy("date").toPandas()
        x, y = np.array(part["x"].tolist()), part["y"].to_numpy()
        w = np.linalg.solve(x.T @ x + 1e-3 * np.eye(x.shape[1]), x.T @ y)
        mine = got[got["place"].isna() if place is None else got["place"] == place].sort_values("date")
        history = mine[mine.kind == "history"]
        assert np.allclose(history.yhat, np.maximum(x @ w, 0), atol=1e-6) and len(mine) == len(part) + 30
        sigma = np.sqrt(np.mean((x @ w - y) ** 2))
        assert np.allclose(history.upper, np.maximum(x @ w + forecast.INTERVAL_Z * sigma, 0), atol=1e-5)
