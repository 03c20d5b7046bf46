import hashlib
import random
import zlib

from pyspark.sql import functions as F

from larder.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn int, role string, text string"


def rebuilt(rows, base_of, taken_of):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in own.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
    plain = {c: [t[1:] for t in turns] for c, turns in own.items()}
    return {c: plain.get(base_of(c), [])[:taken_of(c)] + turns[taken_of(c):] for c, turns in plain.items()}


def brute_force(convs):
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        under = children.get(node, [])
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(totals[u][0] for u in under) or 1, saved + sum(totals[u][1] for u in under))
    for node, convs_here in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs_here if len(convs[c]) == len(node)))
        yield (min(convs_here), len(node), min(members[node[:-1]]) if node else None, len(convs_here), len(children.get(node, [])),
               *totals[node], hashlib.sha256(ends.encode()).hexdigest())


def key(row):
    return tuple((v is not None, v) for v in row)


def checked(got, want):
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def contract(conv):
    return zlib.crc32(str(conv).encode()) % 9


def below(conv):
    """conv - conv % 5 with the remainder of SQL, which has the sign of conv."""
    return int(conv / 5) * 5


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(1)
    texts = ["hi", "", "naïve 🙂", "long " * 50, None]
    rows = []
    for conv in [*range(0, 60), 77, 78, 93, 94, -3, -5, -12]:
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, turn, ["user", "assistant"][turn % 2], rng.choice(texts[:2]) if turn < 3 else rng.choice(texts)))
    rows += [(200 + i, t, "user", "same") for i in range(30) for t in range(20)]  # copies
    rows += [(None, 1, "user", "no conversation"), (300, None, None, None), (300, 1, "a", "b"), (300, 1, "ab", ""), (300, 1, "a", "b"), (300, -4, "", "b")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_prefix_trie(spark, str(tmp_path))
    checked(got, brute_force(rebuilt(rows, below, contract)))


def plain_trie(frame, band):
    return prefix_trie.rebuilt_trie(frame, F.col("conv_id"), F.lit(0), band)


def test_deep_shared_openings_take_several_levels(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)
    monkeypatch.setattr(prefix_trie, "ID_RUN", 3)
    rng = random.Random(2)
    rows = []
    for conv in range(40):
        part = rng.choice([0, 1, 5, 17, 40, 70])
        rows += [(conv, t, "r", f"common {t}" if t < part else f"own {conv % 7} {t}") for t in range(part + rng.randint(0, 12))]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = list(brute_force(rebuilt(rows, lambda c: c, lambda c: 0)))
    for band in (2, 3, 8, 100):
        checked(plain_trie(frame, band), want)


def test_one_conversation_no_conversation_and_other_columns(spark):
    rows = [(5, 0, "user", "a"), (5, 1, "user", "a")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as hi", "'x' as place", "2 as digest", "3 as row", "4 as first")
    checked(plain_trie(frame, 8), brute_force(rebuilt(rows, lambda c: c, lambda c: 0)))
    assert plain_trie(frame.where("false"), 8).count() == 0
    # All turns replaced by those of a conversation that is not there: a member of the root only.
    got = prefix_trie.rebuilt_trie(frame, F.lit(-1).cast("long"), F.lit(8)).collect()
    assert [tuple(r)[:7] for r in got] == [(5, 0, None, 1, 0, 1, 0)]
    assert got[0]["ends_sha256"] == hashlib.sha256(b"5").hexdigest()
