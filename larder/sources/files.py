"""Parquet, CSV and JSON tables, always with a stated schema for text formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from larder.sources.json_arrays import read_json_array

# Office lock files sit next to the data they lock.
_LOCK_PREFIX = ".~lock."


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """Parquet by path, list of paths or glob; a stated schema skips footer inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def _discovered(df: DataFrame) -> DataFrame:
    return df.where(~F.startswith(F.col("_metadata.file_name"), F.lit(_LOCK_PREFIX)))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """CSV files under a path, one header line each, split between tasks.

    Pass ``multiLine=True`` when quoted cells span lines; files are then read whole.
    """
    settings = {"header": True, "multiLine": False, "escape": '"', "pathGlobFilter": "*.csv"} | options
    return _discovered(spark.read.options(**settings).schema(schema).csv(path))


def read_json_records(
    spark: SparkSession, path: str, schema: StructType | str, lines: bool = False, **options
) -> DataFrame:
    """JSON files holding one array of records each, or one record per line; both are split between tasks."""
    settings = {"pathGlobFilter": "*.json"} | options
    if not lines:
        return read_json_array(spark, path, schema, skip_prefix=_LOCK_PREFIX, **settings)
    return _discovered(spark.read.options(**settings).schema(schema).json(path))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_table(
    df: DataFrame, name: str, source: str = "parquet", options: Mapping[str, str] | None = None,
    buckets: int = 0, bucket_by: Sequence[str] = (),
) -> None:
    """Replace a catalog table, or a table of any warehouse connector on the class path.

    Facts that are joined on one key again and again can be bucketed by it: such
    joins then need no shuffle. Not for a key with hot values, whose bucket grows with them.
    """
    writer = df.write.format(source).options(**(options or {})).mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: StructType | str) -> DataFrame:
    write_parquet(read_csv(spark, source, schema), target)
    return spark.read.parquet(target)


def json_to_parquet(
    spark: SparkSession, source: str, target: str, schema: StructType | str, lines: bool = False, **options
) -> DataFrame:
    write_parquet(read_json_records(spark, source, schema, lines, **options), target)
    return spark.read.parquet(target)


def single_file(df: DataFrame) -> DataFrame:
    """One output file. Only for results known to be small; what computes them stays parallel, one task writes."""
    return df.repartition(1)


def file_date(as_of: str) -> Column:
    """Date from the first eight digits in the name of the row's own file, else ``as_of``.

    Inside a folder written by Spark the folder carries the name: part files are
    numbered by a random id whose digits mean nothing.
    """
    path = F.split(F.col("_metadata.file_path"), "/")
    own = F.element_at(path, -1)
    name = F.when(F.startswith(own, F.lit("part-")), F.element_at(path, -2)).otherwise(own)
    return F.coalesce(F.try_to_date(F.regexp_extract(name, r"(\d{8})", 1), "yyyyMMdd"), F.lit(as_of).cast("date"))


def ingest_audit(df: DataFrame) -> DataFrame:
    """Rows per input file."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows"))
