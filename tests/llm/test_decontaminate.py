import itertools
import random

import numpy as np

from larder.llm import decontaminate as dc
from larder.llm import queries


def words(text):
    import re
    return re.findall(r"\w+", (text or "").lower())


def slow_overlap(doc, item, min_tokens=13, min_identity=0.8):
    """Length of the longest good stretch over all diagonals."""
    best = (0, 0)
    for diagonal in range(-len(item), len(doc)):
        low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
        agree = [doc[i + diagonal] == item[i] for i in range(low, high)]
        places = [i for i, a in enumerate(agree) if a]
        for x in places:
            for y in places:
                if y >= x and sum(agree[x:y + 1]) >= min_identity * (y + 1 - x) - 1e-9:
                    best = max(best, (y + 1 - x, sum(agree[x:y + 1])))
    return best if best[0] >= min(min_tokens, len(item)) and item else None


def test_masks_hit_every_pattern_the_rule_allows():
    """All ways in which a fifth of the tokens, never the first or last, may differ."""
    for n in range(1, 22):
        masks = [dc.MASKS[i] for i in dc.masks_for(n)]
        placed = [sum(1 << o for o in mask) << at for mask in masks for at in range(n - mask[-1])]
        for changed in itertools.combinations(range(1, n - 1), min(n // 5, max(0, n - 2))):
            pattern = sum(1 << i for i in changed)
            assert any(not place & pattern for place in placed), (n, changed)
    # Longer stretches hold a shorter one that the rule allows; a sample of them.
    rng = random.Random(1)
    placed = {n: [sum(1 << o for o in mask) << at for mask in dc.MASK_SETS[13] for at in range(n - mask[-1])] for n in range(22, 60)}
    for _ in range(100_000):
        n = rng.randrange(22, 60)
        pattern = sum(1 << i for i in rng.sample(range(1, n - 1), n // 5))
        assert any(not place & pattern for place in placed[n])


def test_longest_overlap_matches_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        agree = np.array([rng.random() < 0.7 for _ in range(rng.randint(0, 25))], bool)
        start, stop = dc.longest_overlap(agree, 0.8)
        sizes = [y + 1 - x for x in np.flatnonzero(agree) for y in np.flatnonzero(agree)
                 if y >= x and agree[x:y + 1].sum() >= 0.8 * (y + 1 - x) - 1e-9]
        assert stop - start == max(sizes, default=0)


def _tables(rng):
    vocabulary = [f"w{i}" for i in range(40)] + ["The", "Über"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([13, 14, 20, 30, 45, 60, 10, 5, 25])]
    items += [(20, items[3][1]), (21, None), (22, "")]
    docs = []
    for d in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 120))
        if d % 3 == 0:
            passage = words(items[rng.randrange(9)][1])
            for _ in range(len(passage) // 10):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() for w in passage]
        docs.append((d * 2, (", " if d % 2 else "\n").join(text)))
    return docs + [(999, None), (1000, "")], items


def test_query_matches_brute_force(spark, tmp_path):
    docs, items = _tables(random.Random(2))
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): (r.n_tokens, r.n_equal) for r in queries.op1_decontaminate(spark, str(tmp_path)).collect()}
    want = {}
    for doc, text in docs:
        for item, passage in items:
            # Item 20 repeats item 3.
            if item != 20 and len(words(passage)) >= 5 and (found := slow_overlap(words(text), words(passage))):
                want[doc, item] = found
    assert got == want
    assert len(got) >= 15


def test_short_items(spark):
    items = [(1, "What is the capital of France"), (2, "one two three four five"), (3, "a b"), (4, "solo"), (5, "x y z"), (6, "p q r s"),
             (7, " ".join(f"k{i}" for i in range(12)))]
    docs = [(1, "so: what is THE capital of france?"), (2, "what is a capital of france"), (3, "what is the capital city of france"),
            (4, "one two 3 four five"), (5, "a b x y z p q r s"), (6, "solo"), (7, "k0 k1 - k2 k3 n k5 k6 k7 n k9 k10 k11"), (8, "k0 k1 k2 k3 n k5 k6 n k8 n k10 k11")]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lambda least: {(r.doc_id, r.item_id) for r in dc.overlaps(docs, items, min_item_tokens=least).collect()}
    assert found(5) == {(1, 1), (2, 1), (4, 2), (7, 7)}
    assert found(1) == found(5) | {(5, 3), (5, 5), (5, 6), (6, 4)}


def test_long_passages_repeats_and_no_rows(spark):
    rng = random.Random(3)
    passage = " ".join(rng.choices([f"q{i}" for i in range(500)], k=700))
    docs = spark.createDataFrame([(1, "x y z " * 200 + passage, 7), (1, "other text", 7), (1, passage, 8), (None, passage, 9), (4, "plain " * 90, 1)],
                                 "doc_id long, text string, seed int")
    items = spark.createDataFrame([(5, passage), (6, passage.upper()), (None, passage)], "item_id long, text string")
    got = dc.overlaps(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.doc_start, r.item_start, r.n_tokens, r.n_equal) for r in got] == [(1, 5, 0, 0, 700, 700)]
    assert dc.overlaps(docs.where("false"), items).count() == 0
    assert dc.overlaps(docs, items.where("false")).count() == 0
