"""Operators on small frames: brute force, repartitioning, skew."""

import datetime
import itertools
import random

import numpy as np
import pandas as pd
import pytest
import slow_similarity
from pyspark.sql import functions as F

from larder.operators import calendar, filters, fuzzy, keys, nearest, ranking, shape, stats


def names(spark, values, column):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def misspelled(rng, word):
    letters = list(word)
    for _ in range(rng.randint(0, 3)):
        i = rng.randrange(len(letters) + 1)
        move = rng.random()
        if move < 0.4 and letters:
            letters.pop(min(i, len(letters) - 1))
        elif move < 0.7:
            letters.insert(i, rng.choice("abcdefgh "))
        elif letters:
            letters[min(i, len(letters) - 1)] = rng.choice("abcdefgh")
    return "".join(letters).strip()


def vocabulary(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(18)]
    texts = [" ".join(rng.sample(base, rng.randint(1, 4))) for _ in range(45)]
    texts += ["a", "b", "ab", "ba", "aaaaa", "aaaa", "aabb", "x y", "y x", "abcabcabcabc", "abcabcabcabd"]
    return texts, sorted({m for t in texts for m in (misspelled(rng, t), misspelled(rng, t)) if m})


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def slow_score(a, b, method):
    import re
    from math import floor
    if method == "levenshtein":
        return floor(100 * (1 - levenshtein(a, b) / max(len(a), len(b))) + 0.5)
    if method.startswith("partial_token"):
        cut = lambda t: sorted(w for w in re.sub(r"[^\w]+", " ", t.lower()).split())
        x, y = cut(a), cut(b)
        if method.endswith("set_ratio"):
            if set(x) & set(y):
                return 100
            x, y = sorted(set(x)), sorted(set(y))
        return slow_similarity.partial_ratio(" ".join(x), " ".join(y))
    return slow_similarity.partial_ratio(a, b) if method == "partial_ratio" else slow_similarity.ratio(a, b)


@pytest.mark.parametrize("method,threshold", [
    ("levenshtein", 80), ("levenshtein", 60), ("ratio", 80), ("ratio", 60), ("partial_ratio", 80),
    ("partial_token_sort_ratio", 80), ("partial_token_sort_ratio", 65), ("partial_token_set_ratio", 80), ("ratio", 95),
])
def test_best_match_equals_all_pairs(spark, method, threshold):
    left, right = vocabulary(threshold)
    want = {}
    for a in set(left):
        scored = sorted((-slow_score(a, b, method), b) for b in right)
        if scored and -scored[0][0] >= threshold:
            want[a] = (scored[0][1], -scored[0][0])
    got = fuzzy.best_match(names(spark, left, "l"), names(spark, right, "r"), "l", "r", method, threshold)
    assert {r.l: (r.r, r.score) for r in got.collect()} == want


@pytest.mark.parametrize("method,threshold", [("levenshtein", 80), ("ratio", 80), ("partial_ratio", 80), ("partial_token_set_ratio", 90)])
def test_few_candidates_besides_the_matches(spark, method, threshold):
    left, right = vocabulary(threshold)
    l, r = sorted(set(left)), sorted(set(right))
    pairs = fuzzy.candidate_pairs(names(spark, l, "text"), names(spark, r, "text").withColumn("r_name", F.col("text")), method, threshold)
    found = {(p.l, p.r) for p in pairs.collect()}
    slow = {"ratio": slow_similarity.ratio, "partial_ratio": slow_similarity.partial_ratio, "partial_token_set_ratio": slow_similarity.partial_ratio}
    score = slow.get(method, lambda a, b: slow_score(a, b, method))
    matches = {(a, b) for a in l for b in r if score(a, b) >= threshold}
    assert matches <= found
    assert len(found) < 2 * len(matches) + len(l) * len(r) / 10


def test_shared_word_ties_go_to_the_first_name(spark):
    left, right = names(spark, ["chocolate digestive b"], "l"), names(spark, ["oil b", "b rice", "digestive z"], "r")
    got = fuzzy.best_match(left, right, "l", "r", "partial_token_set_ratio", 80)
    assert [(r.r, r.score) for r in got.collect()] == [("b rice", 100)]


def test_best_match_rejects_unknown(spark):
    one = names(spark, ["a"], "l")
    with pytest.raises(ValueError):
        fuzzy.best_match(one, one, "l", "l", "soundex")
    with pytest.raises(ValueError):
        fuzzy.best_match(one, one, "l", "l", "levenshtein", 40)


def test_dense_key_survives_shuffling_and_hot_values(spark):
    rows = [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, v long")
    expected = {r: n for n, r in enumerate(sorted(rows), 7)}
    for parts in (1, 3, 16):
        got = keys.dense_key(df.repartition(parts), ["k", "v"], "id", 7).collect()
        assert {(r.k, r.v): r.id for r in got} == expected


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.createDataFrame([], "k string"), ["k"], "id").count() == 0


def test_content_key_tells_null_from_text(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", "a"), ("\\N", "a"), ("n", "a"), ("b\x1fc", "d"), ("b", "c\x1fd"), ("1:a", ""), ("1:", "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(keys.content_key("x", "y")).distinct().count() == len(rows)


def test_key_value_reads_a_column_back_from_its_text(spark):
    rows = [(None, None), ("", 0), ("n", -1), ("1:a", 2**63 - 1), (":", -2**63), ("é:😀", 7), ("12:3456789012", 10), (" x ", None)]
    df = spark.createDataFrame(rows, "x string, y long")
    texts = df.select("x", "y", keys.key_text("x").alias("a"), keys.key_text("y").alias("b"))
    back = texts.select("x", "y", keys.key_value("a", "string").alias("p"), keys.key_value("b", "bigint").alias("q"))
    assert [(r.p, r.q) for r in back.collect()] == [(r.x, r.y) for r in back.collect()] and dict(back.dtypes)["q"] == "bigint"


def test_salted_join_equals_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(200)] + [("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("hot", i) for i in range(7)] + [("a", 10), ("a", 11), ("c", 1), (None, 5)], "k string, y int")
    got = sorted(map(tuple, shape.salted_join(left, right, "k", hot_rows=30).select("k", "x", "y").collect()))
    assert got == sorted(map(tuple, left.join(right, "k").select("k", "x", "y").collect()))


def test_salted_join_splits_keys_hot_on_either_side(spark):
    few = spark.createDataFrame([("hot", i) for i in range(3)] + [("cold", 1)], "k string, x int")
    many = spark.createDataFrame([("hot", 5)] * 500 + [("cold", i) for i in range(4)], "k string, y int").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    try:
        for left, right in ((few, many), (many, few)):
            for hot_rows in (2, 10, 10_000):
                got = sorted(map(tuple, shape.salted_join(left, right, "k", hot_rows).select("k", "x", "y").collect()))
                assert got == sorted(map(tuple, left.join(right, "k").select("k", "x", "y").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_copies_no_more_than_its_slots_need(spark):
    counts = spark.createDataFrame([(k, 360_000, 2_400) for k in range(25)] + [(99, 1, 1)], "k int, _l long, _r long")
    copies = F.col("_l") * F.col("_rs") + F.col("_r") * F.col("_ls")
    found = counts.join(shape.hot_slots(counts, "k", 100), "k").agg(F.count("*"), F.sum(F.col("_ls") * F.col("_rs")), F.sum(copies)).first()
    assert found[0] == 25 and 1_000 < found[1] <= 4 * shape.MOST_SLOTS and found[2] <= 5 * 25 * 362_400
    # Ten billion slot pairs by the size of a slot alone: some 10 ** 10 copies of either side's rows.
    left, right = spark.range(10_000).select(F.lit(1).alias("k"), "id"), spark.range(1_000).select(F.lit(1).alias("k"), F.col("id").alias("y"))
    assert shape.salted_join(left, right, "k", hot_rows=1).count() == 10_000_000


def test_left_join_known_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 100), (2, 200)], "k int, x int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "never")], "k int, y string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(tuple, shape.left_join_known(left, right, "k").select("k", "x", "y").collect()), key=str)
        assert got == sorted(map(tuple, left.join(right, "k", "left").select("k", "x", "y").collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lowest_with_ties_equals_rank(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 1), ("b", None), ("b", 3), (None, 4), (None, 4), (None, 9)], "k string, v int")
    got = sorted(map(tuple, ranking.lowest_with_ties(df, ["k"], "v").collect()), key=str)
    assert got == sorted([("a", 1), ("a", 1), ("b", None), (None, 4), (None, 4)], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_summary_equals_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([np.full(500, 3.25), rng.normal(0, 5, 777).round(2), [1e6]])
    rows = [(float(v), i % 7) for i, v in enumerate(values)] + [(None, None), (None, 3)]
    df = spark.createDataFrame(rows, "v double, w int").repartition(5)
    got = {(r.column, r.statistic): r.value for r in stats.summary(df, ["v", "w"]).collect()}
    for column, k in (("v", 0), ("w", 1)):
        want = pd.Series([r[k] for r in rows if r[k] is not None], dtype=float).describe()
        assert {s for c, s in got if c == column} == set(want.index)
        assert all(abs(got[column, s] - want[s]) <= 1e-5 * max(1, abs(want[s])) for s in want.index)


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)] + [(None,)], "v double")
    got = {r.bin: r.n for r in stats.histogram(df, "v", 50).collect()}
    assert got == {b: (3 if b == 49 else 2) for b in range(50)}
    odd = df.union(spark.createDataFrame([(float("nan"),)], "v double"))
    assert {r.bin: r.n for r in stats.histogram(odd, "v", 50).collect()} == got
    assert {tuple(r) for r in stats.summary(odd, ["v"]).collect()} == {tuple(r) for r in stats.summary(df, ["v"]).collect()}
    same = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [(r.bin, r.n) for r in stats.histogram(same, "v").collect()] == [(0, 2)]


def test_profile_and_audit(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (2, None)], "k int, v string")
    assert stats.profile(df, "k").first().asDict() == {
        "n_rows": 4, "n_columns": 2, "n_keys": 2, "nulls_k": 1, "nulls_v": 2}
    other = spark.createDataFrame([(1,), (1,), (9,)], "j int")
    assert tuple(stats.match_audit(df, other, "k", "j").first()) == (2, 2)


def test_trend(spark):
    df = spark.createDataFrame([(x, 2.0 * x + 1) for x in range(10)] + [(None, 5.0)], "x int, y double")
    assert tuple(stats.trend_line(df, "x", "y").first()) == (10, 2.0, 1.0, 1.0)


def test_lags_and_gaps(spark):
    day = lambda n: datetime.date(2024, 1, n)
    daily = spark.createDataFrame([(day(1), 1.0), (day(4), 4.0)], "date date, v double")
    full = calendar.fill_gaps(daily, calendar.date_spine(spark, "2024-01-01", "2024-01-05"), "date", ["v"])
    assert [r.v for r in full.orderBy("date").collect()] == [1.0, 0.0, 0.0, 4.0, 0.0]
    lagged = calendar.add_lags(full, "date", ["v"], 2).orderBy("date").collect()
    assert [(r.v, r.v_lag_1, r.v_lag_2) for r in lagged] == [(0.0, 0.0, 1.0), (4.0, 0.0, 0.0), (0.0, 4.0, 0.0)]
    assert calendar.spine_of(daily, "date").count() == 4
    assert calendar.spine_of(daily.limit(0), "date").count() == 0


def test_a_daily_series_has_one_row_per_day(spark):
    day = datetime.date(2024, 1, 1)
    twice = spark.createDataFrame([("a", day, 1.0), ("b", day, 2.0)], "s string, date date, v double")
    assert calendar.add_lags(twice, "date", ["v"], 1, ["s"]).count() == 0
    with pytest.raises(Exception, match="more than one row of a day"):
        calendar.add_lags(twice, "date", ["v"], 1).collect()


def test_lags_per_series(spark):
    rows = [(s, datetime.date(2024, 1, n), float(n * (1 if s == "a" else 10))) for s in "ab" for n in (1, 2, 3)]
    df = spark.createDataFrame(rows, "s string, date date, v double")
    got = calendar.add_lags(df, "date", ["v"], 1, ["s"]).orderBy("s", "date").collect()
    assert [(r.s, r.v, r.v_lag_1) for r in got] == [("a", 2.0, 1.0), ("a", 3.0, 2.0), ("b", 20.0, 10.0), ("b", 30.0, 20.0)]


def test_nearest_equals_brute_force(spark):
    rng = random.Random(3)
    places = [(f"s{i:02}", rng.uniform(35, 45), rng.uniform(-5, 5)) for i in range(40)] + [("none", None, None)]
    df = spark.createDataFrame(places, "id string, latitude double, longitude double")
    places += [("pole", 89.9, 10.0), ("line", 10.0, 179.9)]
    df = spark.createDataFrame(places, "id string, latitude double, longitude double")
    places = [p for p in places if p[1] is not None] + [("none", None, None)]
    points = [("p", 40.0, 0.0), ("q", 36.0, 4.0), ("twin", 40.0, 0.0), ("far", 10.0, -179.9), ("north", 89.8, -170.0)]

    def km(a, b, c, d):
        from math import atan2, cos, radians, sin, sqrt
        h = sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2
        return 2 * 6371 * atan2(sqrt(h), sqrt(1 - h))

    asked = spark.createDataFrame([*points, ("lost", None, 1.0)], "point_id string, lat double, lon double")
    got = nearest.nearest(df, asked, 5, "id").orderBy("point_id", "distance_km").collect()
    want = [(name, p[0]) for name, lat, lon in sorted(points) for p in sorted(places[:-1], key=lambda p: km(lat, lon, p[1], p[2]))[:5]]
    assert [(r.point_id, r.id) for r in got] == want
    assert nearest.nearest(df, asked.where("false"), 5, "id").count() == 0
    assert nearest.nearest(df.where("false"), asked, 5, "id").count() == 0
    assert nearest.nearest(df, asked, 100, "id").where("point_id = 'far'").count() == 42


def test_nearest_in_a_dense_city(spark):
    """50,000 places and points within 10 km, others far from any, and places at the same spot."""
    rng = np.random.default_rng(5)

    def around(n, lat, lon, km):
        return np.column_stack([lat + rng.normal(size=n) * km / 111, lon + rng.normal(size=n) * km / 111])

    spots = np.concatenate([around(44_000, 41.4, 2.1, 3), around(5_000, 41.41, 2.11, 0.05), np.repeat([[41.4, 2.2]], 990, 0), around(10, -33, 151, 500)])
    asked = np.concatenate([around(49_000, 41.4, 2.1, 4), around(900, 41.9, 2.8, 1), around(50, -30, 100, 2000), np.repeat([[41.4, 2.2]], 50, 0)])
    places = spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(spots)], "id int, latitude double, longitude double")
    points = spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(asked)], "point_id int, lat double, lon double")
    got = nearest.nearest(places, points, 5, "id").select("point_id", "id", "distance_km").toPandas()
    assert len(got) == 5 * len(asked)
    measured = got.sort_values(["point_id", "distance_km", "id"])

    def unit(a):
        lat, lon = np.radians(a).T
        return np.column_stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])

    some = np.concatenate([np.arange(0, 49_000, 100), np.arange(49_000, 50_000, 10), np.arange(49_900, 50_000)])
    line = ((unit(asked[some])[:, None] - unit(spots)[None]) ** 2).sum(axis=2)
    want = 2 * 6371 * np.arcsin(np.sqrt(np.sort(line, axis=1)[:, :5]) / 2)
    answers = measured.set_index("point_id").loc[some, "distance_km"].to_numpy().reshape(-1, 5)
    assert np.abs(answers - want).max() < 1e-4
    same = measured.set_index("point_id").loc[49_950:, "id"].to_numpy().reshape(-1, 5)
    assert (same == np.arange(49_000, 49_005)).all()
    # What a point is compared with does not grow with the density around it.
    located = nearest._with_cells(places.withColumns(nearest._on_sphere(F.col("latitude"), F.col("longitude"))).where("id < 49000"))
    where = nearest._with_cells(points.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).distinct().withColumns(
        nearest._on_sphere(F.col("_lat"), F.col("_lon"))))
    cells = nearest.cells_to_search(located, where, 5).toPandas()
    assert cells[cells.level < nearest.LEVELS]["n"].max() <= nearest.most_places(5)
    per_point = cells.groupby(["_lat", "_lon"])["n"].sum()
    assert per_point.mean() < 10 * nearest.most_places(5) and per_point.max() < 50 * nearest.most_places(5)


def test_top_rows_do_not_depend_on_layout(spark):
    rows = list(itertools.product("abc", range(50)))
    df = spark.createDataFrame(rows, "k string, v int")
    seen = {tuple(sorted(map(tuple, ranking.top_per_key(df.repartition(n), ["k"], [F.col("v").desc()], 2).collect())))
            for n in (1, 4, 9)}
    assert seen == {tuple(sorted((k, v) for k in "abc" for v in (48, 49)))}
    orders = {tuple(r.v for r in ranking.seeded_shuffle(df.where("k = 'a'").repartition(n), ["v"], 5).collect()) for n in (1, 7)}
    assert len(orders) == 1


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert {r.v for r in filters.excluding(df, "k", ["a"]).collect()} == {2}
    assert filters.matching(df, {"k": "All"}).count() == 3
    assert {r.v for r in filters.within(df, {"v": (2, None)}).collect()} == {2, 3}
    assert {r.v for r in filters.searching(df, {"k": "A", "v": None}).collect()} == {1}


def test_unpivot_and_require(spark):
    df = spark.createDataFrame([(1, "x", None, 5)], "id int, `a/b` string, c string, d int")
    got = sorted(map(tuple, shape.unpivot_others(df, ["id"], "n", "v").collect()))
    assert got == [(1, "a/b", "x"), (1, "d", "5")]
    with pytest.raises(ValueError, match="zz"):
        shape.require(df, ["id", "zz"])
