import random
from collections import Counter

import numpy as np

from larder.llm import queries, toxicity


def _rows(rng, count, kinds=(("idiot", "worthless", "scum", "pathetic", "achlichkeit", "réeuxment"),)):
    """Documents of invented words; some that call names, each by the words of one kind."""
    plain = [f"{a}{b}" for a in ("the", "tion", "er", "ing", "and") for b in ("ha", "sh", "ou", "re", "nd", "ea")]
    docs, labels = [], []
    for i in range(count):
        words = rng.choices(plain, k=rng.randint(30, 200))
        toxic = rng.random() < 0.15
        if toxic:
            bad = rng.choice(kinds)
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_logistic_regression_learns_a_known_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    truth = np.array([2.0, -1.0, 0, 0, 0.5, 0])
    y = (rng.random(3000) < 1 / (1 + np.exp(-(x @ truth - 1)))).astype(float)
    model = toxicity.fit_logistic(x, y)
    assert np.abs(model.weights - truth).max() < 0.25 and abs(model.bias + 1) < 0.2
    assert toxicity.fit_logistic(x, np.ones(3000))(x).min() > 0.99 > 0.01 > toxicity.fit_logistic(x, np.zeros(3000))(x).max()


def test_later_models_use_unseen_earlier_probabilities():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4)).astype(np.float32)
    first = (x[:, 0] > 0).astype(float)
    labels = np.stack([first, first], axis=1)
    folds = np.arange(600) % 3
    models, unseen = toxicity.fit_chain(x, labels, folds)
    assert [len(m.weights) for m in models] == [4, 5] and models[1].weights[4] > 0
    held = folds == 0
    again = toxicity.fit_logistic(x[~held], first[~held])(x[held])
    assert np.allclose(unseen[held, 0], again, atol=1e-5)
    found = toxicity.predict_chain(models, x)
    assert np.allclose(found[:, 1], models[1](np.hstack([x, found[:, :1]])))


def test_threshold_has_the_best_f1():
    rng = random.Random(3)
    for _ in range(50):
        p = np.array([rng.choice([0.1, 0.2, 0.35, 0.5, 0.9]) for _ in range(30)])
        y = np.array([float(rng.random() < q) for q in p])
        if not y.any():
            continue

        def f1(t):
            return 2 * y[p >= t].sum() / ((p >= t).sum() + y.sum())

        assert f1(toxicity.best_threshold(p, y)) == max(f1(t) for t in p)


def test_held_out_accuracy(spark, tmp_path):
    docs, labels = _rows(random.Random(4), 1500)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels[:900], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == 1500
    held = [(got[i].is_toxic, bool(t)) for i, _, t in labels[900:]]
    caught = sum(a and b for a, b in held) / sum(b for _, b in held)
    wrong = sum(a and not b for a, b in held)
    assert caught > 0.97 and wrong <= 2
    assert max(got[i].p_kind_1 + got[i].p_kind_2 for i, _, t in labels if not t) < 0.5


def test_kinds_follow_the_words_of_the_sample(spark, tmp_path):
    """Words no list could know, of two scripts: each kind's documents get one category, and held-out ones are caught."""
    kinds = (("zorblat", "quixnar", "fribbem"), ("дурня", "гнидок", "швальт"))
    docs, labels = _rows(random.Random(6), 1500, kinds)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels[:1000], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, str(tmp_path)).collect()}
    assert [got[i].is_toxic for i, _, _ in labels[1000:]] == [bool(t) for _, _, t in labels[1000:]]
    means = np.array([[np.mean([got[i][c] for i, text in docs[1000:] if not set(words).isdisjoint(text.split())])
                       for c in ("p_kind_1", "p_kind_2")] for words in kinds])
    assert sorted(means.argmax(axis=1)) == [0, 1] and means.max(axis=1).min() > 0.8 > 0.2 > means.min(axis=1).max()


def test_kinds_of_few_rows_and_of_equal_ones():
    x = np.array([[1, 0, 1], [0, 1, 1], [1, 0, 1], [0, 0, 1], *[[0, 0, 1]] * 8], np.float32)
    toxic = np.arange(12) < 4
    assert toxicity.toxic_kinds(x, toxic).tolist() == [1, 2, 1] + [0] * 9
    same = np.array([[1.0], [1], [1], [0], [0], [0]])
    assert toxicity.toxic_kinds(same, np.array([1, 1, 1, 0, 0, 0], bool)).tolist() == [1, 1, 1, 0, 0, 0]
    assert not toxicity.toxic_kinds(np.zeros((4, 2)), np.array([1, 0, 0, 0], bool)).any()


def test_query_equals_a_plain_chain(spark, tmp_path):
    """The query's probabilities, worked out again without Spark from the texts and labels."""
    docs, labels = _rows(random.Random(7), 400, (("zorblat", "quixnar"), ("gnidok", "shvalt")))
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    toxic = np.array([t for _, _, t in labels], bool)
    found = [toxicity.features(toxicity.tokens(text)) for _, text in docs]
    in_docs = Counter(f for row in found for f in row)
    names = sorted(f for f, n in in_docs.items() if n >= toxicity.LEAST_DOCS)
    assert len(names) <= toxicity.FEATURES
    x = np.log1p(np.array([[row.get(f, 0) for f in names] for row in found])).astype(np.float32)
    kinds = toxicity.toxic_kinds(x, toxic)
    y = np.stack([kinds == 1, kinds == 2, toxic], axis=1).astype(float)
    earlier, answers = np.zeros((len(x), 0), np.float32), np.zeros((len(x), 0))
    for k in range(3):
        seen, unseen = np.hstack([x, earlier]), np.zeros((len(x), 1), np.float32)
        for fold in range(toxicity.FOLDS):
            held = np.arange(len(x)) % toxicity.FOLDS == fold
            unseen[held, 0] = toxicity.fit_logistic(seen[~held], y[~held, k])(seen[held])
        model = toxicity.fit_logistic(seen, y[:, k])
        answers = np.hstack([answers, model(np.hstack([x, answers]))[:, None]])
        earlier = np.hstack([earlier, unseen])
    cut = max(sorted(set(earlier[:, 2])), key=lambda t: (round(2 * toxic[earlier[:, 2] >= t].sum() / ((earlier[:, 2] >= t).sum() + toxic.sum()), 12), t))
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, str(tmp_path)).collect()}
    for i, row in enumerate(answers):
        assert np.allclose([got[i].p_kind_1, got[i].p_kind_2, got[i].p_toxic], row, atol=1e-4)
        assert got[i].is_toxic == (row[2] >= cut) or abs(row[2] - cut) < 0.2


def test_nulls_repeats_clashes_and_no_labels(spark):
    docs, labels = _rows(random.Random(5), 300)
    rows = [(*d, "x") for d in docs] + [(None, None, "n"), (None, "scum idiot worthless pathetic", "n"), (5000, "", "e"), (0, docs[0][1], "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, p_toxic string")
    marks = spark.createDataFrame([*[(i, t) for i, _, t in labels], (0, None), (None, 1), (1, 0), (1, labels[1][2])], "doc_id long, toxic int")
    model = toxicity.fit(frame, marks)
    scored = toxicity.score(frame, model).collect()
    assert len(scored) == len(rows) and not any(r.is_toxic for r in scored if not r.text)
    assert [r.is_toxic for r in scored if r.doc_id is None and r.text] == [True]
    same = [r.p_toxic for r in scored if r.doc_id == 0]
    assert same[0] == same[1]
    unlabelled = toxicity.fit(frame, marks.where("false"))
    assert not any(r.is_toxic for r in toxicity.score(frame, unlabelled).collect())
    assert toxicity.score(frame.where("false"), model).count() == 0
    assert not toxicity.fit(frame.where("false"), marks).vocabulary
