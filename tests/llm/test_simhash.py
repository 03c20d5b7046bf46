import random

import xxhash

from larder.llm import queries, simhash
from larder.llm.graph import components


def slow_fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_fingerprint_matches_brute_force():
    texts = ["", None, " \t", "One", "one two", "One two three", "a b c d e", "é ü x y \x1c z", "A\x0bb\x0cc\rd " * 40]
    for text in texts:
        assert simhash.simhash(text or "") == slow_fingerprint(text)


def test_every_pair_within_the_distance_is_linked(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for fp in list(fps):
        for bits in (1, 2, 3):
            changed = fp
            for b in rng.sample(range(64), bits):
                changed ^= 1 << b
            fps.add(changed)
    fps = sorted(fps)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    classes = spark.createDataFrame(list(enumerate(signed)), "node long, fp long")
    for distance in (0, 1, 2, 3, 5):
        got = {tuple(sorted(r)) for r in simhash.links(classes, distance).collect()}
        want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
                if (fps[i] ^ fps[j]).bit_count() <= distance}
        assert got == want


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    got = dict(components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect())
    assert got == slow_components(chain + star, {n for e in chain + star for n in e})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_copies_edits_nulls_and_repeats(spark):
    long = " ".join(f"word{i}" for i in range(900))
    rows = [(5, long, 1), (3, long, 1), (9, None, 1), (8, "", 1), (7, " \n", 1), (11, "x", 1), (11, "x", 1),
            (None, long, 1), (None, "alone", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 7), (8, 7), (7, 7), (11, 11), (11, 11), (None, 3), (None, None)], key=str)
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(1)
    words = ["alpha", "beta", "Gamma", "delta", "eps"]
    base = [" ".join(rng.choices(words, k=rng.randint(0, 300))) for _ in range(20)]
    rows = []
    for i, text in enumerate(base * 3):
        tokens = text.split(" ")
        if i >= 20 and len(tokens) > 30:
            tokens[rng.randrange(len(tokens))] = "changed"
        rows.append((i, " ".join(tokens)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fps = {i: slow_fingerprint(t) for i, t in rows}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    want = slow_components(near, fps)
    got = queries.op5_simhash_near_dedup(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(got) == len(rows)
