"""Linear models from sums of products: cross-validation in two passes, whatever the grid.

The first pass adds up, per fold, the products of every two of the features, the label and one. The sums of a training
set are those of all folds less those of the fold held out, so every fold and every grid point is solved from the same
small table. The second pass measures all of these models at once: a row meets those that were trained without its fold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F


def product_sums(df: DataFrame, features: Sequence[str], label: str, by: str) -> dict[object, np.ndarray]:
    """For each value of ``by`` the matrix of sums of products of (1, features, label); rows lacking a value do not count."""
    columns = [F.lit(1.0), *[F.col(c).cast("double") for c in [*features, label]]]
    n = len(columns)
    cells = [(i, j) for i in range(n) for j in range(i, n)]
    complete = df.dropna(subset=[*features, label])
    rows = complete.groupBy(by).agg(*[F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}") for i, j in cells]).collect()  # one row a fold
    found = {}
    for row in rows:
        sums = np.zeros((n, n))
        for i, j in cells:
            sums[i, j] = sums[j, i] = row[f"s{i}_{j}"]
        found[row[by]] = sums
    return found


def elastic_net(sums: np.ndarray, penalty: float, mix: float, rounds: int = 10_000, tolerance: float = 1e-14) -> np.ndarray:
    """Intercept and coefficients that minimise half the mean squared error plus ``penalty`` times the elastic net.

    Features and label are scaled to a deviation of one, and the penalty by the label's deviation, as MLlib does;
    a feature that does not vary gets no weight. Solved by coordinate descent, directly where there is no penalty.
    """
    n, p = sums[0, 0], len(sums) - 2
    if n == 0:
        return np.zeros(p + 1)
    means = sums[0] / n
    spread = sums[1:, 1:] / n - np.outer(means[1:], means[1:])
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    scale[scale <= 1e-12 * np.abs(means[1:])] = 0.0
    live = np.flatnonzero(scale[:-1])
    weights = np.zeros(p)
    if scale[-1] > 0 and len(live):
        gram = spread[np.ix_(live, live)] / np.outer(scale[live], scale[live])
        target = spread[live, -1] / (scale[live] * scale[-1])
        lasso, ridge = penalty / scale[-1] * mix, penalty / scale[-1] * (1 - mix)
        beta = np.linalg.lstsq(gram + ridge * np.eye(len(live)), target, rcond=None)[0] if lasso == 0 else np.zeros(len(live))
        for _ in range(rounds if lasso else 0):
            before = beta.copy()
            for j in range(len(live)):
                rest = target[j] - gram[j] @ beta + gram[j, j] * beta[j]
                beta[j] = np.sign(rest) * max(abs(rest) - lasso, 0.0) / (gram[j, j] + ridge)
            if np.abs(beta - before).max() <= tolerance:
                break
        weights[live] = beta * scale[-1] / scale[live]
    return np.concatenate([[means[-1] - weights @ means[1:-1]], weights])


def _predicted(models: Mapping[object, np.ndarray], features: Sequence[str], by: str) -> Column:
    """The prediction of the model that belongs to the row's value of ``by``."""
    found = None
    for value, weights in models.items():
        y = F.lit(float(weights[0]))
        for c, w in zip(features, weights[1:]):
            y = y + F.col(c).cast("double") * float(w)
        test = F.col(by).eqNullSafe(F.lit(value))
        found = F.when(test, y) if found is None else found.when(test, y)
    return found


def grid_points(grid: Mapping[str, Sequence[float]]) -> list[tuple[float, float]]:
    return list(product(grid["regParam"], grid["elasticNetParam"]))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str, grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """``reg_param``, ``elastic_net_param``, ``fold``, ``n``, ``mae``, ``mse`` of every grid point on every fold left out."""
    by_fold = product_sums(df, features, label, fold)
    total = sum(by_fold.values())
    points = grid_points(grid)
    complete = df.dropna(subset=[*features, label])
    y, errors = F.col(label).cast("double"), []
    for i, (penalty, mix) in enumerate(points):
        off = y - _predicted({k: elastic_net(total - s, penalty, mix) for k, s in by_fold.items()}, features, fold) if by_fold else F.lit(None).cast("double")
        errors += [F.avg(F.abs(off)).alias(f"mae{i}"), F.avg(off * off).alias(f"mse{i}")]
    measured = complete.groupBy(F.col(fold).alias("fold")).agg(F.count("*").alias("n"), *errors)
    cells = [F.struct(F.lit(float(a)).alias("reg_param"), F.lit(float(b)).alias("elastic_net_param"), F.col(f"mae{i}").alias("mae"), F.col(f"mse{i}").alias("mse"))
             for i, (a, b) in enumerate(points)]
    return measured.select("fold", "n", F.explode(F.array(*cells)).alias("c")).select(
        "c.reg_param", "c.elastic_net_param", "fold", "n", "c.mae", "c.mse")


def best_point(scores: DataFrame) -> tuple[float, float]:
    """The grid point with the lowest mean of its folds' absolute errors; of equal ones the first."""
    mean = scores.groupBy("reg_param", "elastic_net_param").agg(F.avg("mae").alias("mae"))
    row = mean.orderBy("mae", "reg_param", "elastic_net_param").first()
    return row["reg_param"], row["elastic_net_param"]


def predict(df: DataFrame, features: Sequence[str], weights: np.ndarray) -> DataFrame:
    whole = df.withColumn("_all", F.lit(0))
    return whole.withColumn("prediction", _predicted({0: weights}, features, "_all")).drop("_all")


def fit(df: DataFrame, features: Sequence[str], label: str, penalty: float, mix: float) -> np.ndarray:
    """Intercept and coefficients fitted on all rows."""
    sums = product_sums(df.withColumn("_all", F.lit(0)), features, label, "_all")
    return elastic_net(sums.get(0, np.zeros((len(features) + 2,) * 2)), penalty, mix)


def best_splits(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The exact first split of a regression tree on each feature: ``feature``, ``threshold``, ``n_left``, ``n_right``,
    ``mean_left``, ``mean_right``, ``gain`` (fall of the variance), rows up to the threshold going left.

    Rows are added up per value before the values are put in order, and running sums give the error of every cut
    between two values. Of cuts that gain the same the lowest is taken; a feature with one value has none. A feature's
    different values pass through one task, so this is for features of days: their number is bounded by the calendar.
    """
    y = F.col(label).cast("double")
    sides = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    values = df.where(y.isNotNull()).select(F.explode(sides).alias("s"), y.alias("y")).where("s.value is not null").groupBy(
        "s.feature", "s.value").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    order = Window.partitionBy("feature").orderBy("value")
    upto, whole = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy("feature")
    cuts = values.select(
        "feature", ((F.col("value") + F.lead("value").over(order)) / 2).alias("threshold"),
        F.sum("n").over(upto).alias("n_left"), F.sum("s").over(upto).alias("left"),
        F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("all")).where("threshold is not null")
    right, n_right = F.col("all") - F.col("left"), F.col("n") - F.col("n_left")
    mean_left, mean_right = F.col("left") / F.col("n_left"), right / n_right
    gain = F.col("n_left") * n_right / (F.col("n") * F.col("n")) * F.pow(mean_left - mean_right, 2)
    scored = cuts.select("feature", "threshold", "n_left", n_right.alias("n_right"), mean_left.alias("mean_left"), mean_right.alias("mean_right"), gain.alias("gain"))
    first = F.row_number().over(Window.partitionBy("feature").orderBy(F.col("gain").desc(), "threshold"))
    return scored.withColumn("_n", first).where("_n = 1").drop("_n")
