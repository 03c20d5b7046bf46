import hashlib
import random
from collections import defaultdict

import numpy as np

from larder.llm import line_dedup, perfect_hash, queries


def key(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)


def slow(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(doc)
    out = set()
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == doc]
        out.add((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_perfect_hash_is_minimal_and_survives_bytes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 5000):
        high, low = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        table = perfect_hash.PerfectHash.from_bytes(perfect_hash.build(high, low).to_bytes())
        assert sorted(table.slots(high, low)) == list(range(n))
    strange = table.slots(high + np.uint64(1), low)
    assert ((strange >= -1) & (strange < 5000)).all()


def _run(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op2_line_dedup(spark, str(tmp_path)).collect()


def test_query_matches_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    shared = ["A repeated LINE here", "a repeated line here ", "\ta Repeated line here\r", "short", "éàüößéàüö", "éàüößéàüöx",
              "", "   ", "\x1ca repeated line here", "another shared line of text"]
    rows = []
    for i in range(150):
        lines = [rng.choice(shared) if rng.random() < 0.5 else f"own line number {rng.randrange(400)}" for _ in range(rng.randrange(30))]
        rows.append((i * 3, "\n".join(lines)))
    rows += [(1, None), (2, ""), (4, "\n\n"), (5, "A repeated LINE here\n" * 5000)]
    rng.shuffle(rows)
    want = slow(rows)
    # Small shards and few probes for a hot line, so that both ways of probing are taken.
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", 64)
    got = _run(spark, tmp_path, rows)
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == want
    assert len(got) == len(rows)


def test_hot_and_cold_shards_agree(spark, monkeypatch):
    rows = [(i, f"the one line that all share\nline of its own {i}\nline of a pair {i // 2}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = []
    for probes in (16, 10_000):
        monkeypatch.setattr(line_dedup, "SHARD_PROBES", probes)
        kept.append({(r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()})
    assert kept[0] == kept[1] and (3, "line of its own 3") in kept[0]


def test_nulls_repeats_clashes_and_no_rows(spark):
    rows = [(None, "a line long enough", "x"), (2, "a line long enough", "y"), (2, "a line long enough", "z"), (3, "a line long enough", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string").withColumnRenamed("n_lines", "h1")
    got = sorted((str(r.doc_id), r.kept_text, r.n_dropped, r.h1) for r in line_dedup.dedup_lines(docs).collect())
    line = "a line long enough"
    assert got == sorted([("None", line, 0, "x"), ("2", line, 0, "y"), ("2", line, 0, "z"), ("3", "", 1, None)], key=str)
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def test_columns_with_the_names_used_inside_survive(spark):
    docs = spark.createDataFrame([(1, "the same long line", "a", "b"), (2, "the same long line", "c", "d")], "doc_id long, text string, _lost string, _lost_by string")
    got = line_dedup.dedup_lines(docs).orderBy("doc_id").collect()
    assert [(r["_lost"], r["_lost_by"], r.n_dropped) for r in got] == [("a", "b", 0), ("c", "d", 1)]
