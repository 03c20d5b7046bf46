import math
import random

import numpy as np

from larder.llm import lm_scoring as lm
from larder.llm import queries


def _texts(rng, count):
    """A small grammar, so that neighbours tell a word."""
    out = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(5, 40)):
            parts.append(rng.choice(["the red cat sat", "a blue dog ran", "my old fish swam"]) + " .")
        out.append(" ".join(parts))
    return out


def test_probabilities_sum_to_one():
    network = lm.Network.fresh()
    context = np.array([[1, 2, 3, lm.EDGE]] * lm.VOCABULARY)
    logs = network.log_probabilities(context, np.arange(lm.VOCABULARY))
    assert abs(np.exp(logs.astype(np.float64)).sum() - 1) < 1e-4


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    network = lm.Network({k: v.astype(np.float64) + rng.normal(0, 0.05, v.shape) for k, v in lm.Network.fresh().parts.items()})
    context, targets = rng.integers(0, lm.VOCABULARY + 1, (30, 4)), rng.integers(0, lm.VOCABULARY, 30)
    found = network.gradients(context, targets)
    for name, part in network.parts.items():
        flat, where = part.ravel(), np.flatnonzero(np.abs(found[name].ravel()) > 1e-4)[:3]
        for i in where:
            old, loss = flat[i], []
            for step in (1e-2, -1e-2):
                flat[i] = old + step
                loss.append(-network.log_probabilities(context, targets).astype(np.float64).mean())
            flat[i] = old
            assert abs((loss[0] - loss[1]) / 2e-2 - found[name].ravel()[i]) < 2e-3 * max(1, abs(found[name].ravel()[i]))


def slow_score(network, row):
    """One token at a time, in plain arithmetic."""
    p, total = {k: v.astype(np.float64) for k, v in network.parts.items()}, 0.0
    padded = [lm.EDGE, lm.EDGE, *row, lm.EDGE, lm.EDGE]
    for i, target in enumerate(row):
        x = np.concatenate([p["embedding"][padded[j]] for j in (i, i + 1, i + 3, i + 4)])
        hidden = np.tanh(x @ p["w1"] + p["b1"])
        for logits, choice in ((hidden @ p["w2"] + p["b2"], target // lm.PER_CLASS),
                               (hidden @ p["w3"][target // lm.PER_CLASS] + p["b3"][target // lm.PER_CLASS], target % lm.PER_CLASS)):
            total += logits[choice] - math.log(np.exp(logits).sum())
    return total


def test_query_matches_brute_force_and_prefers_sense(spark, tmp_path):
    rng = random.Random(2)
    texts = _texts(rng, 400) + ["", "word", "antidisestablishmentarianism " * 3]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000, None), (9001, texts[0]), (9001, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op10_lm_scoring(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    model, codes = lm.fit(frame)
    encode = lm.encoder(model.vocabulary)
    text_of = dict(rows)
    # The same model from another layout of the same rows, and the same scores token by token.
    for r in random.Random(3).sample(got, 60) + [r for r in got if r.doc_id >= 400]:
        row = encode(text_of[r.doc_id] or "")
        assert r.n_tokens == len(row)
        assert abs(r.log_likelihood - slow_score(model.network, row)) < 1e-3 * max(1, len(row))
        assert (r.mean_log_likelihood is None) == (len(row) == 0)
    scores = lm.score_rows(model.network, [encode(t) for t in _texts(random.Random(4), 40)])
    mixed = [" ".join(random.Random(5).sample(t.split(), len(t.split()))) for t in _texts(random.Random(4), 40)]
    assert sum(scores) > sum(lm.score_rows(model.network, [encode(t) for t in mixed])) + 100


def test_vocabulary_counts_all_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "COUNTED_WORDS", 3)
    docs = spark.createDataFrame([(1, "B a, a b"), (2, "a c d e f g h"), (3, None)], "doc_id long, text string")
    assert dict(lm.count_words(lm.tokenized(docs)).collect()) == {"a": 3, "b": 2, ",": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": 1, "h": 1}


def test_each_token_is_masked_in_one_round():
    for size in (0, 1, 7, 5000):
        row = np.random.default_rng(size).integers(0, lm.VOCABULARY, size).astype(np.int16)
        for rounds in (1, 2, 3):
            found = np.bincount(lm.turns(row, rounds), minlength=rounds)
            assert len(found) == rounds and found.sum() == size and (size < 5000 or found.min() > 0.9 * size / rounds)
    rows = [np.arange(300, dtype=np.int16), np.arange(50, dtype=np.int16)]
    assert sum(lm.train_shard(lm.Network.fresh(), iter(rows), 1, turn, 2)[1] for turn in (0, 1)) == 350


def test_words_outside_the_vocabulary_are_predicted(spark, monkeypatch):
    monkeypatch.setattr(lm, "LISTED", 110)
    rare = ["abba", "abab", "zqzq", "baab", "abaa", "bbab", "baba", "x" * 40, "y" * 32, "日本"]
    docs = [(0, " ".join(f"w{i}" for i in range(1100)))] * 3 + [(i + 1, w) for i, w in enumerate(rare)] + [(50, "abba")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model, _ = lm.fit(frame, rounds=1)
    spelt, coder = model.spelling, lm.encoder(model.vocabulary)
    assert not set(rare) & set(model.vocabulary) and len(spelt.listed) == 109 and spelt.listed["abba"] == 2
    # Words of a length share one: each step does, and so do the letters without a kind of their own.
    assert np.allclose(np.exp(spelt.steps).sum(axis=2), 1)
    unnamed = 0x110000 - len(spelt.kind) - len(spelt.other)
    assert abs(sum(map(math.exp, spelt.other.values())) + unnamed * math.exp(spelt.unlisted) - 1) < 1e-9
    assert abs(sum(spelt.listed[w] for w in spelt.listed if len(w) == 4) + math.exp(spelt.rest[4]) - spelt.all[4]) < 1e-6
    assert abs(sum(math.exp(spelt.ends + k * spelt.goes_on) for k in range(2_000)) - 1) < 1e-6
    # Words of a length differ, and each row has the word's own factor.
    assert spelt.log_probability("abba") > spelt.log_probability("abab") > spelt.log_probability("zqzq") > spelt.log_probability("кжзй")
    got = {r.doc_id: r.log_likelihood for r in lm.pseudo_likelihood(frame, rounds=1).collect()}
    for i, word in enumerate(rare):
        assert abs(got[i + 1] - lm.score_rows(model.network, [coder(word)])[0] - spelt.log_probability(word)) < 1e-4


def test_no_rows_and_clashes(spark):
    docs = spark.createDataFrame([(None, "a b", "x"), (None, "a b", "y")], "doc_id long, text string, codes string")
    assert [r.n_tokens for r in lm.pseudo_likelihood(docs).collect()] == [2, 2]
    assert lm.pseudo_likelihood(docs.where("false")).count() == 0
