import math
import random

import numpy as np

from larder.llm import embedding_dedup, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def links_of(vectors, threshold=0.9):
    """Places linked to each place, by all pairs in double precision."""
    good = []
    for v in vectors:
        fine = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, np.float32).astype(float) if fine else None)
    near = [set() for _ in vectors]
    for i, a in enumerate(good):
        for j, b in enumerate(good[:i]):
            if a is not None and b is not None and len(a) == len(b):
                x, y = a / np.abs(a).max(), b / np.abs(b).max()
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    near[i].add(j)
                    near[j].add(i)
    return near


def brute_force(rows, threshold=0.9):
    near = links_of([r[1] for r in rows], threshold)
    seen, found = {}, []
    for start in range(len(rows)):
        if start not in seen:
            todo, group = [start], {start}
            while todo:
                fresh = near[todo.pop()] - group
                group |= fresh
                todo += fresh
            ids = [rows[i][0] for i in group if rows[i][0] is not None]
            seen |= dict.fromkeys(group, min(ids, default=None))
    for i, r in enumerate(rows):
        found.append((r[0], len(near[i]), seen[i], r[0] == seen[i]))
    return found


def key(row):
    return tuple((v is not None, v) for v in row)


def planted(rng, dim, groups, singles):
    """Unit vectors with groups around common centres, at cosines from 0.9 up."""
    vectors = [rng.normal(size=dim) for _ in range(singles)]
    for size, spread in groups:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        vectors += [centre + spread * rng.normal(size=dim) / math.sqrt(dim) for _ in range(size)]
    return [[float(np.float32(x)) for x in v / np.linalg.norm(v)] for v in vectors]


def test_query_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = planted(rng, 64, [(60, 0.2), (12, 0.1), (2, 0.05), (3, 0.15)], 150)
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    rows += [(500 - i, v, 0) for i, v in enumerate(vectors[-5:])]  # exact copies
    rows += [(600, [x * 3 for x in vectors[0]], 1)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 64, 1), (703, [float("nan")] * 64, 1), (704, [None] + [1.0] * 63, 1),
             (705, [float("inf")] + [0.0] * 63, 1), (706, [0.0] * 64, 1), (700, None, 2)]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_embedding_dedup(spark, str(tmp_path))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows))


def test_large_units_are_cut_into_parts(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v, 0) for i, v in enumerate(planted(rng, 64, [(150, 0.25), (40, 0.2)], 60))]
    frame, want = spark.createDataFrame(rows, SCHEMA), brute_force(rows)
    got = sorted(map(tuple, embedding_dedup.near_duplicates(frame, unit_rows=20).collect()))
    assert got == sorted(map(tuple, embedding_dedup.near_duplicates(frame).collect()))
    assert [r[2:] for r in got] == [r[2:] for r in sorted(want)]
    assert 0.999 * sum(r[1] for r in want) <= sum(r[1] for r in got) <= sum(r[1] for r in want)


def test_short_and_mixed_vectors_repeats_and_missing_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v, 0) for i, v in enumerate(planted(rng, 6, [(5, 0.05)], 20))]
    rows += [(100 + i, v, 0) for i, v in enumerate(planted(rng, 3, [(4, 0.02)], 0))]
    rows += [(None, rows[22][1], 0), (None, None, 0), (None, [1e30, -1e30], 0), (None, [1e30, -1e30], 0), (900, [1e-30, 0.0], 0),
             (22, [-x for x in rows[22][1]], 0), (901, [2.0], 0), (902, [5.0], 0), (903, [-5.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted(brute_force(rows), key=key)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(frame).collect()), key=key) == want
    wide = frame.selectExpr("vec_id as node", "cast(embedding as array<double>) as digest", "label as code")
    got = embedding_dedup.near_duplicates(wide, id_col="node", vector_col="digest")
    assert sorted(map(tuple, got.collect()), key=key) == want
    assert embedding_dedup.near_duplicates(frame.where("false")).count() == 0


def test_every_pair_is_taken_in_one_unit():
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 63, 12, np.uint64)
    codes = np.unique(np.concatenate([seeds] + [seeds ^ np.bitwise_or.reduce(
        [np.uint64(1) << rng.integers(0, 64, 12, np.uint64) for _ in range(k)]) for k in (1, 1, 2, 3, 5, 8, 9, 12, 14, 18)]))
    parts, found = np.zeros(len(codes), np.int64), []
    for slot in range(4):
        for region in range(256):
            near = np.flatnonzero(np.bitwise_count((codes >> np.uint64(16 * slot + 8) & np.uint64(255)) ^ np.uint64(region)) <= 1)
            for a, b in embedding_dedup.candidates(codes[near], None, parts[near], slot, region, False):
                found += [tuple(sorted(p)) for p in zip(near[a].tolist(), near[b].tolist())]

    def meet(x, y):
        keys = [(x ^ y) >> 16 * s & 0xFFFF for s in range(4)]
        return any(k.bit_count() <= 3 and (k >> 8).bit_count() <= 2 for k in keys)

    numbers = [int(c) for c in codes]
    want = [(i, j) for i, x in enumerate(numbers) for j, y in enumerate(numbers)
            if i < j and (x ^ y).bit_count() <= embedding_dedup.NEAR_CODE and meet(x, y)]
    assert sorted(found) == want


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.9 to 0.91, the hardest ones, in vectors without structure."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosines = rng.uniform(0.9001, 0.91, (1500, 1))
    vectors = np.concatenate([base, cosines * base + np.sqrt(1 - cosines ** 2) * away])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = sum(got[i] > 0 for i in range(1500)) / 1500
    assert 0.98 < found <= 1


def test_codes_are_balanced():
    rng = np.random.default_rng(6)
    sample = embedding_dedup.unit_vectors(rng.normal(size=(3000, 64)) * np.linspace(3, 0.3, 64) + 0.2)
    codes = embedding_dedup.codes_of(sample, *embedding_dedup.learn(sample, 64))
    ones = np.unpackbits(codes.astype(">u8").view(np.uint8).reshape(3000, -1), axis=1).mean(axis=0)
    assert len(ones) == 192
    assert ones.min() > 0.4 and ones.max() < 0.6
