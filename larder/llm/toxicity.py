"""Toxicity by a classifier chain.

Categories are predicted one after another by logistic models; the probabilities of the categories
before are features of the next one. The later models are trained on out-of-fold probabilities:
those of a row come from models that have not seen it, as they will be for new documents.

The labels say only whether a document is toxic. Two narrower categories are derived from them for
training: the toxic rows of the sample are parted into two kinds by the features that mark them, so no
words or languages are presumed. Their models feed the last one, whose category is the label itself
and which decides, at the threshold
that parts the out-of-fold probabilities best. Features are words and their beginnings, chosen by how far their document
frequencies differ between labels; the models are fitted in numpy, by one task, on a bounded sample
of labelled rows, and every document is scored in its own task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.rows import append_columns, pieces, select_as

#: Labelled rows the chain is fitted on at most: those with the smallest hash of their id.
SAMPLE_ROWS = 8_000
#: Words and word beginnings with a weight.
FEATURES = 1_500
#: Labelled documents a feature must be found in at least.
LEAST_DOCS = 8
#: Lengths of the word beginnings that are features beside whole words.
BEGINNINGS = (5, 7)
FOLDS = 5

#: How many times commoner a feature must be in toxic rows than in others to mark them.
LEAST_LIFT = 3.0
#: Sweeps in which toxic rows move between the two kinds.
KIND_ROUNDS = 20

CATEGORIES = ("kind_1", "kind_2", "toxic")

_WORD = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(words: list[str]) -> dict[str, int]:
    """How often each word and word beginning occurs; beginnings are marked by a trailing star."""
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
        for size in BEGINNINGS:
            if len(w) > size:
                start = w[:size] + "*"
                counts[start] = counts.get(start, 0) + 1
    return counts


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300, penalty: float = 1e-3) -> Linear:
    """Logistic regression by accelerated gradient steps; a label seen on no row, or on all, gives a constant model."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Linear(np.zeros(x.shape[1]), 30.0 if share else -30.0)
    # Columns are scaled by their root mean square, so that rare words learn as fast as common ones.
    scale = np.sqrt(np.einsum("ij,ij->j", x, x) / len(y)) + x.dtype.type(1e-3)
    z, y = x / scale, y.astype(x.dtype)
    bias = x.dtype.type(np.log(y.mean() / (1 - y.mean())))
    weights, ahead, bias_ahead = np.zeros_like(scale), np.zeros_like(scale), bias
    # The largest eigenvalue of the features' second moments bounds the curvature.
    probe, norm = np.ones_like(scale), 1.0
    for _ in range(15):
        probe = z.T @ (z @ (probe / norm))
        norm = float(np.linalg.norm(probe)) + 1e-12
    step = x.dtype.type(1 / (0.25 * (norm / len(y) + 1) + penalty))
    for k in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ ahead + bias_ahead, -30, 30))) - y
        new = ahead - step * (z.T @ error / len(y) + x.dtype.type(penalty) * ahead)
        new_bias = bias_ahead - step * error.mean()
        pull = x.dtype.type(k / (k + 3))
        ahead, bias_ahead = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias = new, new_bias
    return Linear((weights / scale).astype(np.float64), float(bias))


def toxic_kinds(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The kind of every row, 1 or 2, and 0 for rows that are not toxic or hold no marking feature.

    A feature marks toxic rows if it is ``LEAST_LIFT`` times commoner in them. Rows are compared by the angle
    between their marking features, weighed by the logarithm of that ratio, and parted around two means that
    start at the row nearest to all and the row least like it (of equals the first). Rows that all hold the
    same features are one kind.
    """
    kinds, rows = np.zeros(len(x), np.int64), np.flatnonzero(toxic)
    there = x > 0
    in_toxic, in_others = (there[rows].sum(axis=0) + 0.5) / (len(rows) + 1), (there[~toxic].sum(axis=0) + 0.5) / (len(x) - len(rows) + 1)
    weights = np.log(in_toxic / in_others)
    found = there[rows] * np.where(weights >= np.log(LEAST_LIFT), weights, 0.0)
    sizes = np.linalg.norm(found, axis=1)
    rows, found = rows[sizes > 0], found[sizes > 0] / sizes[sizes > 0, None]
    if not len(rows):
        return kinds
    first = found[np.argmax(np.round(found @ found.sum(axis=0), 9))]
    likeness = np.round(found @ first, 9)
    means = np.stack([first, found[np.argmin(likeness)]])
    second = np.zeros(len(rows), bool)
    for _ in range(KIND_ROUNDS if likeness.min() < 1 else 0):
        near = np.round(found @ means.T, 9)
        moved, second = second, near[:, 1] > near[:, 0]
        if not second.any() or second.all() or np.array_equal(moved, second):
            break
        means = np.stack([found[~second].sum(axis=0), found[second].sum(axis=0)])
        means /= np.linalg.norm(means, axis=1, keepdims=True)
    kinds[rows] = np.where(second, 2, 1)
    return kinds


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> tuple[list[Linear], np.ndarray]:
    """One model for each column of ``labels``, the k-th taking ``x`` and k probabilities; and all out-of-fold probabilities."""
    models, earlier = [], np.zeros((len(x), 0), x.dtype)
    for k in range(labels.shape[1]):
        inputs, y = np.hstack([x, earlier]), labels[:, k]
        unseen = np.zeros((len(x), 1), x.dtype)
        for fold in np.unique(folds):
            held = folds == fold
            unseen[held, 0] = fit_logistic(inputs[~held], y[~held])(inputs[held])
        models.append(fit_logistic(inputs, y))
        earlier = np.hstack([earlier, unseen])
    return models, earlier


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that parts the labels with the best F1, half-way to the next lower one; the highest of equals."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(np.flatnonzero(np.diff(p[order])), len(p) - 1)  # ends of runs of equal probabilities
    at = last[int(np.argmax(f1[last]))]
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)


def predict_chain(models: list[Linear], x: np.ndarray) -> np.ndarray:
    """Probabilities, a column for each category; a later model sees the earlier ones' columns."""
    found = np.zeros((len(x), 0))
    for model in models:
        found = np.hstack([found, model(np.hstack([x, found]))[:, None]])
    return found


@dataclass
class ToxicityModel:
    vocabulary: dict[str, int]
    models: list[Linear]
    categories: tuple[str, ...] = CATEGORIES
    threshold: float = 0.5
    beginnings: dict[int, dict[str, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.beginnings = {s: {f[:-1]: i for f, i in self.vocabulary.items() if f.endswith("*") and len(f) == s + 1} for s in BEGINNINGS}

    def matrix(self, texts: list[str]) -> np.ndarray:
        """Logarithms of one plus the counts of the chosen features."""
        x, known = np.zeros((len(texts), len(self.vocabulary))), self.vocabulary
        for row, text in zip(x, texts):
            words = tokens(text)
            for i in [known[w] for w in words if w in known]:
                row[i] += 1
            for size, starts in self.beginnings.items():
                for i in [starts[w[:size]] for w in words if w[:size] in starts and len(w) > size]:
                    row[i] += 1
        return np.log1p(x)

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = [predict_chain(self.models, self.matrix(texts[i:i + 256])) for i in range(0, len(texts), 256)]
        return np.vstack(out) if out else np.zeros((0, len(self.models)))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample_rows: int) -> DataFrame:
    """The sampled documents with their label: at most ``sample_rows`` rows, one for each id, so the ids can be sent to every task.

    Of rows that repeat an id, the one whose text has the smallest hash is taken.
    """
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    named = select_as(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    sampled = named.join(F.broadcast(chosen), "doc_id")
    return sampled.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
        n_features: int = FEATURES) -> ToxicityModel:
    """A chain fitted on at most ``sample_rows`` rows of ``labels`` (``doc_id``, ``toxic``) with a document.

    Feature frequencies are counted in Spark; the driver sees the chosen features and the fitted
    weights. Several labels of one id count as toxic if one of them does; of several documents with
    one id, one is learnt from. Without labelled rows nothing is toxic.
    """
    sample = _labelled(docs, labels, id_col, text_col, sample_rows)

    def present(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                found = [list(features(tokens(t))) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(found, pa.list_(pa.string()))], names=["toxic", "found"])

    seen = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(present, "toxic int, found array<string>")
    counted = seen.select("toxic", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")).where(F.col("n") >= LEAST_DOCS)
    bad, total = seen.agg(F.sum("toxic"), F.count("*")).first()
    if not total or not bad or bad == total:
        return ToxicityModel({}, [Linear(np.zeros(k), -30.0) for k in range(len(CATEGORIES))])
    expected = F.col("n") * (bad / total)
    surprise = F.abs(F.col("bad") - expected) / F.sqrt(expected * (1 - F.col("n") / (total + 1)))
    chosen = [r.feature for r in counted.orderBy(F.desc(surprise), "feature").limit(n_features).select("feature").collect()]
    vocabulary = {f: i for i, f in enumerate(sorted(chosen))}
    reader = ToxicityModel(vocabulary, [])

    def counts(batches):
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                x = reader.matrix(texts)
                rows = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("toxic"),
                    pa.array(rows, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(x, rows)], pa.list_(pa.float32()))],
                    names=["doc_id", "toxic", "at", "value"])

    rows = sample.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        counts, "doc_id long, toxic int, at array<int>, value array<float>")
    # The sample is bounded, so one task fits the models, on its rows in one order whatever their layout was.
    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "toxic", "at", "value")
    fitted = ordered.mapInArrow(_fit_sample(len(vocabulary)), "place int, weights array<double>, bias double, threshold double")
    found = sorted(fitted.collect())
    return ToxicityModel(vocabulary, [Linear(np.array(r.weights), r.bias) for r in found], threshold=found[-1].threshold)


def _fit_sample(width: int):
    """A task that fits the chain on all rows it sees and gives a row for each model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = pa.Table.from_batches(batches)
        ats = seen.column("at").combine_chunks()
        x = np.zeros((seen.num_rows, width), np.float32)
        row_of = np.repeat(np.arange(seen.num_rows), ats.value_lengths().to_numpy())
        x[row_of, ats.flatten().to_numpy()] = seen.column("value").combine_chunks().flatten().to_numpy()
        toxic = seen.column("toxic").to_numpy() > 0
        kinds = toxic_kinds(x, toxic)
        labels = np.stack([kinds == 1, kinds == 2, toxic], axis=1).astype(np.float64)
        models, unseen = fit_chain(x, labels, np.arange(len(x)) % FOLDS)
        threshold = best_threshold(unseen[:, -1].astype(np.float64), labels[:, -1])
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(models)), pa.int32()), pa.array([m.weights for m in models], pa.list_(pa.float64())),
            pa.array([m.bias for m in models]), pa.array([threshold] * len(models))], names=["place", "weights", "bias", "threshold"])

    return run


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``p_kind_1``, ``p_kind_2``, ``p_toxic`` (six decimals) and ``is_toxic``; such columns are replaced.

    Every document is read whole. Null and empty texts have no words and get the chain's answer to that.
    """
    added = T.StructType([*(T.StructField(f"p_{c}", T.DoubleType()) for c in model.categories), T.StructField("is_toxic", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of features

    def run(texts: list[str], part: pa.RecordBatch) -> list[pa.Array]:
        found = shared.value(texts)
        return [*(pa.array(np.round(c, 6)) for c in found.T), pa.array(found[:, -1] >= shared.value.threshold)]

    return append_columns(docs, text_col, added, run)
