"""Session defaults for local runs, and the shared scratch folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "larder", folder: str | None = None) -> SparkSession:
    """A session for tests and benchmarks, storing its tables under ``folder`` (a new one by default).

    On a cluster the caller brings its own session.
    """
    return prepare(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="larder-"))
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Let Spark split a skewed join even where that costs one more shuffle.

    A key that holds a third of all rows is worth it: the split sides are
    re-aggregated from partial results instead of passing through one task.
    """
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    An unset value is an error: a folder of the driver's own would not be seen by executors.
    ``local_session`` names one, as all its tasks run on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return named.rstrip("/")


def _session_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/larder-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_session_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this session stored; frames built on them stop working."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_scratch(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[SparkSession]:
    """Owns the tables stored inside the block: they are deleted at its end, when the results have been used."""
    try:
        yield spark
    finally:
        clear_scratch(spark)


# Shuffle files go when the statement that wrote them ends, not when the driver collects its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str = "table", codec: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage so that values depending on the physical layout (partition
    numbers, row positions) cannot change when an executor is lost. Parquet is
    used rather than an RDD checkpoint because the reader keeps column pruning,
    vectorised decoding and size statistics for later join planning. What was
    shuffled to make the table leaves the disk as soon as it is stored: only the
    table is read from then on. ``codec`` is Parquet's, that of the session by default.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
