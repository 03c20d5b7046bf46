"""Writing tables to the shared scratch folder and reading them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder import sources as io
from larder.catalog.inputs import table
from larder.plans.reviews import BUSINESS_REVIEW
from larder.session import scratch_path


def _suppliers(s, d):
    return table(s, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")


def _days(s, d):
    return table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")


def csv_roundtrip(s, d):
    """The key is read back as text, as stated by the schema, not inferred as a number."""
    path = scratch_path(s, "csv")
    io.write_csv(_suppliers(s, d), path)
    return io.csv_to_parquet(s, path, scratch_path(s, "parquet"), "s_suppkey string, s_name string, s_acctbal double")


def json_roundtrip(s, d):
    path = scratch_path(s, "json")
    io.write_json(_suppliers(s, d), path)
    return io.json_to_parquet(s, path, scratch_path(s, "parquet"), "s_suppkey long, s_name string, s_acctbal double", lines=True)


def json_array(s, d):
    """A hundred suppliers to a file, each file one array of records over several lines."""
    path = scratch_path(s, "array")
    record = F.to_json(F.struct("s_suppkey", "s_name", "s_acctbal"))
    arrays = _suppliers(s, d).groupBy(F.floor(F.col("s_suppkey") / 100).alias("file")).agg(F.collect_list(record).alias("records"))
    # A text row is a line: one array per row, and a row per file.
    text = arrays.select(F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]")).alias("value"), "file")
    text.repartition("file").write.partitionBy("file").text(path)
    return io.json_to_parquet(s, path, scratch_path(s, "parquet"), "s_suppkey long, s_name string, s_acctbal double",
                              pathGlobFilter="*.txt", recursiveFileLookup=True)


def locked_files(s, d):
    """A folder in which one file is somebody's lock: its rows, were they read, would count twice."""
    path = scratch_path(s, "locked")
    io.write_csv(_suppliers(s, d), path)
    hadoop = s._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(s._jsc.hadoopConfiguration())
    data = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")]
    for file in data:
        lock = hadoop.Path(folder, ".~lock." + file.getName())
        hadoop.FileUtil.copy(files, file, files, lock, False, s._jsc.hadoopConfiguration())
    return io.read_csv(s, path, "s_suppkey long, s_name string, s_acctbal double")


def single_file_output(s, d):
    """Suppliers counted by nation, a table of bounded size, in one file."""
    path = scratch_path(s, "single")
    by_nation = table(s, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    io.write_parquet(io.single_file(by_nation), path)
    rows = io.read_parquet(s, path)
    return rows.agg(F.countDistinct("_metadata.file_name").cast("int").alias("n_files"),
                    F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"))


def _two_runs(s, d):
    base = scratch_path(s, "orders")
    io.write_snapshot(_days(s, d), base, "20240501000000")
    io.write_snapshot(_days(s, d).where("o_totalprice > 100000"), base, "20240601000000")
    return base


def replaced(s, d):
    path = scratch_path(s, "staged")
    io.write_parquet(_days(s, d), path)
    io.staged_replace(s.read.parquet(path).withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return io.read_current(s, path)


def audit(s, d):
    path = scratch_path(s, "audit")
    io.write_parquet(_days(s, d), path)
    per_file = io.ingest_audit(s.read.parquet(path))
    return per_file.agg(F.sum("n_rows").alias("n_rows"), F.min(F.col("n_rows") > 0).alias("no_empty_file"))


def seen_dates(s, d):
    """Every row takes the date in the name of the table it came from; one table has none."""
    base = scratch_path(s, "seen")
    orders = table(s, d, "orders")
    state = F.coalesce("o_orderstatus", F.lit(""))
    names = {"seen_20240524101500": state == "O", "seen_20240525101500": state == "F", "seen_undated": ~state.isin("O", "F")}
    for name, which in names.items():
        io.write_parquet(orders.where(which).select("o_orderkey"), f"{base}/{name}.parquet")
    files = io.read_parquet(s, [f"{base}/{name}.parquet" for name in names])
    return files.select("o_orderkey", io.file_date("2024-06-01").alias("seen_on"))


def stored_table(s, d):
    path = scratch_path(s, "warehouse")
    name = "larder_" + path[-12:]
    io.write_table(_suppliers(s, d), name, options={"path": path})
    stored = s.table(name)
    stored.schema  # resolved before the name goes; the files stay with the other scratch tables
    s.sql(f"DROP TABLE {name}")
    return stored


def partitioned(s, d):
    path = scratch_path(s, "months")
    rows = _days(s, d).withColumns({"year": F.year("day"), "month": F.month("day")})
    io.write_parquet(rows.repartition("year", "month"), path, ["year", "month"])
    return s.read.parquet(path).where("year = 1998 AND month <= 6").groupBy("month").agg(F.count("*").alias("n"))


def declared(s, d):
    """Reviews stored with the declared review schema and read through it."""
    path = scratch_path(s, "reviews")
    rows = table(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("business_id"), F.col("source").alias("business_name"),
        F.col("n_chars").cast("double").alias("time"), (F.col("doc_id") % 5 + 1).alias("rating"), "text",
        F.lit("Yes").alias("verified"), F.lit(20240501).cast("long").alias("date"))
    io.write_parquet(rows, path)
    return io.read_parquet(s, path, BUSINESS_REVIEW).groupBy("business_name").agg(
        F.count("*").alias("n"), F.sum("rating").alias("stars"))


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "json_array_roundtrip": json_array,
    "locked_files": locked_files,
    "single_file_output": single_file_output,
    "snapshot_latest": lambda s, d: io.read_snapshots(s, _two_runs(s, d)),
    "snapshot_all": lambda s, d: io.read_snapshots(s, _two_runs(s, d), "all"),
    "staged_replace": replaced,
    "ingest_audit": audit,
    "file_dates": seen_dates,
    "table_overwrite": stored_table,
    "partitioned_write": partitioned,
    "declared_schema_scan": declared,
}

_DAYS = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders"

ORACLES = {
    "csv_roundtrip": "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, s_acctbal FROM supplier",
    "json_roundtrip": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "snapshot_latest": f"{_DAYS} WHERE o_totalprice > 100000",
    "snapshot_all": f"{_DAYS} UNION ALL {_DAYS} WHERE o_totalprice > 100000",
    "staged_replace": f"SELECT o_orderkey, day, o_totalprice * 2 AS o_totalprice FROM ({_DAYS})",
    "ingest_audit": "SELECT count(*) AS n_rows, true AS no_empty_file FROM orders",
    "file_dates": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN DATE '2024-05-24' WHEN 'F' THEN DATE '2024-05-25' ELSE DATE '2024-06-01' END AS seen_on
        FROM orders""",
    "json_array_roundtrip": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "locked_files": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "single_file_output": "SELECT 1 AS n_files, count(*) AS n_rows FROM supplier",
    "table_overwrite": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "partitioned_write": """
        SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders
        WHERE year(o_orderdate) = 1998 AND month(o_orderdate) <= 6 GROUP BY 1""",
    "declared_schema_scan": """
        SELECT source AS business_name, count(*) AS n, CAST(sum(doc_id % 5 + 1) AS BIGINT) AS stars FROM documents GROUP BY 1""",
}
