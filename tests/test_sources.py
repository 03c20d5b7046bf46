"""Files, snapshots and staged replacement."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from larder import sources as io
from larder.catalog import files
from larder.session import materialize, scratch_path
from larder.sources import snapshots
from larder.sources.snapshots import snapshot_paths


def test_csv_skips_lock_files_and_other_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Postage_pick_up\n1,"007"\n2,"say ""hi"""\n')
    (tmp_path / ".~lock.a.csv").write_text("id,Postage_pick_up\n9,x\n")
    (tmp_path / "notes.txt").write_text("id,Postage_pick_up\n8,x\n")
    got = io.csv_to_parquet(spark, str(tmp_path), scratch_path(spark, "t"), "id int, Postage_pick_up string")
    assert sorted(map(tuple, got.collect())) == [(1, "007"), (2, 'say "hi"')]


def test_json_array(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"a": 1, "b": ["x", "y"]}, {"a": None}]))
    got = io.json_to_parquet(spark, str(tmp_path), scratch_path(spark, "t"), "a long, b array<string>")
    assert [tuple(r) for r in got.orderBy(F.col("a").desc_nulls_last()).collect()] == [(1, ["x", "y"]), (None, None)]


NASTY = ["", "}", "{", "]", '"', "\\", '\\"', "a}\n{b", "},{", '"}', "[{\"x\": 1}]", "é漢🙂", "\\\\", "tail\\"]


def test_json_arrays_in_small_splits(spark, tmp_path):
    """Brackets, quotes and backslashes in strings, nested records, all layouts, and splits of a few dozen bytes."""
    rng = random.Random(4)

    def record(i):
        note = "".join(rng.choices(NASTY, k=rng.randint(0, 6)))
        return {"a": i, "note": note, "in": {"deep": [{"x": note}, {"x": "}"}]}, "long": "y}" * rng.choice([0, 0, 100])}

    rows = [record(i) for i in range(60)]
    layouts = [{"indent": 2}, {"separators": (",", ":")}, {"indent": None}, {"ensure_ascii": False}]
    for i, layout in enumerate(layouts):
        (tmp_path / f"f{i}.json").write_text(json.dumps(rows[i * 10:(i + 1) * 10], **layout), encoding="utf-8")
    (tmp_path / "one.json").write_text(" \n " + json.dumps(rows[40], indent=1))
    (tmp_path / "mixed.json").write_text("[1, " + json.dumps(rows[41]) + ', "}", [], null, ' + json.dumps(rows[42]) + "]\n")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / ".~lock.f.json").write_text(json.dumps(rows[50:]))
    (tmp_path / "notes.txt").write_text(json.dumps(rows[50:]))
    schema = "a long, note string, `in` struct<deep: array<struct<x: string>>>, long string"
    for size in ("97", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = io.read_json_records(spark, str(tmp_path), schema).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        want = [(r["a"], r["note"], [d["x"] for d in r["in"]["deep"]], r["long"]) for r in rows[:43]]
        assert sorted((r["a"], r["note"], [d.x for d in r["in"].deep], r["long"]) for r in got) == want


def test_json_array_of_200_mb_is_read_by_several_tasks(spark, tmp_path):
    text = '{"k":%d,"v":"' + "x{[]} " + "plain words " * 19 + '"}'
    with open(tmp_path / "large.json", "w") as file:
        file.write("[")
        for i in range(800_000):
            file.write(("," if i else "") + text % i)
        file.write("]")
    assert (tmp_path / "large.json").stat().st_size > 200_000_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32m")
    try:
        rows = io.read_json_records(spark, str(tmp_path), "k long, v string")
        got = rows.agg(F.count("k").alias("n"), F.sum("k").alias("k"), F.min(F.length("v")).alias("low"), F.max(F.length("v")).alias("high")).first()
        tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(got) == (800_000, 800_000 * 799_999 // 2, 234, 234) and tasks >= 6


def test_a_record_that_does_not_fit_is_null(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"a": 1}, {"a": }, {"a": 3}]')
    assert sorted([r.a for r in io.read_json_records(spark, str(tmp_path), "a long").collect()], key=str) == [1, 3, None]


def test_file_date(spark, tmp_path):
    (tmp_path / "seen_20240524_1.csv").write_text("id\n1\n")
    (tmp_path / "seen_later.csv").write_text("id\n2\n")
    df = io.read_csv(spark, str(tmp_path), "id int").select("id", io.file_date("2024-06-01").alias("d"))
    assert {(r.id, str(r.d)) for r in df.collect()} == {(1, "2024-05-24"), (2, "2024-06-01")}
    io.write_parquet(df.select("id"), f"file:{tmp_path}/seen_20250101093000.parquet")
    stored = io.read_parquet(spark, f"file:{tmp_path}/seen_20250101093000.parquet").select(io.file_date("2024-06-01").alias("d"))
    assert {str(r.d) for r in stored.collect()} == {"2025-01-01"}
    audit = io.ingest_audit(io.read_csv(spark, str(tmp_path), "id int")).collect()
    assert {(r.file_name, r.n_rows) for r in audit} == {("seen_20240524_1.csv", 1), ("seen_later.csv", 1)}


def test_snapshots(spark, tmp_path):
    base = f"file:{tmp_path}/customers"
    for run, n in (("20240101000000", 1), ("20240301000000", 3), ("20240201000000", 2)):
        io.write_snapshot(spark.range(n), base, run)
    io.write_snapshot(spark.range(50), base + "_old", "20250101000000")
    (tmp_path / "customers_20260101000000.parquet").mkdir()  # an unfinished run
    assert [p[-22:-8] for p in snapshot_paths(spark, base)] == ["20240101000000", "20240201000000", "20240301000000"]
    assert io.read_snapshots(spark, base).count() == 3
    assert io.read_snapshots(spark, base, "all").count() == 6
    with pytest.raises(FileNotFoundError):
        io.read_snapshots(spark, base + "x")
    with pytest.raises(ValueError):
        io.write_snapshot(spark.range(1), base, "today")


def test_staged_replace_reads_its_own_target(spark, tmp_path):
    path = f"file:{tmp_path}/prices"
    io.write_parquet(spark.range(4), path)
    for _ in range(3):
        io.staged_replace(io.read_current(spark, path).withColumn("id", F.col("id") + 10), path)
    assert sorted(r.id for r in io.read_current(spark, path).collect()) == [30, 31, 32, 33]
    # The last version but one stays for readers; neither older ones nor the plain files do.
    names = sorted(p.name for p in (tmp_path / "prices").iterdir() if not p.name.startswith("."))
    assert [n.rsplit("-", 1)[0] for n in names] == ["_version-00000002", "_version-00000003", "_versions"]


@pytest.mark.parametrize("step", ["_write_version", "_point", "_clean"])
@pytest.mark.parametrize("done", [False, True])
def test_staged_replace_that_stops_at_a_step_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, done):
    path = f"file:{tmp_path}/t"
    io.write_parquet(spark.range(2), path)
    io.staged_replace(spark.range(3), path)
    real = getattr(snapshots, step)

    def lost(*args):
        if done:
            real(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, step, lost)
    with pytest.raises(KeyboardInterrupt):
        io.staged_replace(io.read_current(spark, path).withColumn("id", F.col("id") + 10), path)
    new = step == "_clean" or (step == "_point" and done)
    assert sorted(r.id for r in io.read_current(spark, path).collect()) == ([10, 11, 12] if new else [0, 1, 2])
    monkeypatch.undo()
    io.staged_replace(spark.range(5), path)
    assert io.read_current(spark, path).count() == 5
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_version-")]) == 2


def test_staged_replace_lost_while_naming_a_version(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    io.staged_replace(spark.range(3), path)
    (tmp_path / "t" / "_versions" / "00000002").write_text("")
    assert io.read_current(spark, path).count() == 3
    io.staged_replace(spark.range(4), path)
    assert io.read_current(spark, path).count() == 4


def test_one_of_two_replacing_runs_fails(spark, tmp_path, monkeypatch):
    path = f"file:{tmp_path}/t"
    io.staged_replace(spark.range(1), path)
    real = snapshots._write_version

    def overtaken(df, folder):
        real(df, folder)
        monkeypatch.undo()
        io.staged_replace(spark.range(2), path)

    monkeypatch.setattr(snapshots, "_write_version", overtaken)
    with pytest.raises(Exception, match="(?i)exist"):
        io.staged_replace(spark.range(9), path)
    assert io.read_current(spark, path).count() == 2


def test_materialize_keeps_schema(spark):
    df = spark.range(3).select("id", F.array(F.lit("a")).alias("l"))
    kept = materialize(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == 3


def test_materialize_leaves_no_shuffle_on_the_disk(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}

    before, settings = shuffles(), spark.conf.getAll
    kept = materialize(spark.range(1000).repartition(7, "id").groupBy(F.col("id") % 10).agg(F.count("*").alias("n")), codec="zstd")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.getAll == settings
    assert [r.n for r in kept.select("n").collect()] == [100] * 10


def test_single_file_and_csv_sink(spark, tmp_path):
    io.write_csv(io.single_file(spark.range(10)), f"file:{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1


def test_single_file_output_writes_a_table_of_bounded_size(spark, tmp_path, monkeypatch):
    handed, real = [], io.single_file
    monkeypatch.setattr(io, "single_file", lambda df: handed.append(df) or real(df))
    spark.range(1000).selectExpr("id as s_suppkey", "'n' as s_name", "0.0D as s_acctbal", "id % 25 as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    row = files.single_file_output(spark, str(tmp_path)).first()
    assert (row.n_files, row.n_rows) == (1, 1000) and handed[0].count() == 25


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("larder_left", "larder_right"):
        io.write_table(spark.range(100).withColumnRenamed("id", "k"), name, buckets=4, bucket_by=["k"],
                       options={"path": scratch_path(spark, name)})
    joined = spark.table("larder_left").hint("merge").join(spark.table("larder_right"), "k")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    for name in ("larder_left", "larder_right"):
        spark.sql(f"DROP TABLE {name}")


def test_a_run_leaves_nothing_behind(spark):
    import os

    import __spark_entry__ as driver
    from larder.session import scratch, shared_dir

    queries = driver.queries()
    with scratch(spark):
        for name in ("table_overwrite", "expiry_notifications", "snapshot_all", "closest_stores"):
            assert queries[name](spark, "/root/testdata/sf0.001").count() > 0
    own = f"{shared_dir(spark).removeprefix('file://')}/larder-{spark.sparkContext.applicationId}"
    assert not os.path.exists(own)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("larder_")]
