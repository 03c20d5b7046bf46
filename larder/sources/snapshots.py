"""Timestamped snapshots and staged replacement, through the Hadoop file API."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Spark's readers pass over names that begin like these.
_VERSION, _POINTERS = "_version-", "_versions"
_RUN = re.compile(r"_(\d{14})(?:\.parquet)?$")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def write_snapshot(df: DataFrame, base: str, run_ts: str) -> str:
    """Write ``<base>_<yyyyMMddHHmmss>.parquet``; earlier runs stay."""
    if not re.fullmatch(r"\d{14}", run_ts):
        raise ValueError("run_ts must be yyyyMMddHHmmss")
    target = f"{base}_{run_ts}.parquet"
    df.write.mode("overwrite").parquet(target)
    return target


def snapshot_paths(spark: SparkSession, base: str) -> list[str]:
    """Complete snapshots of a table, oldest first (one directory listing, no data)."""
    found = _fs(spark, base).globStatus(_path(spark, f"{base}_*")) or []
    runs = []
    for status in found:
        location = status.getPath().toString()
        run = _RUN.search(location)
        # The wildcard also meets tables whose name merely starts alike; a half-written
        # run has no success mark yet.
        stem = location[: run.start()] if run else ""
        if run and stem.endswith("/" + base.rstrip("/").rsplit("/", 1)[-1]):
            if _fs(spark, location).exists(_path(spark, location + "/_SUCCESS")):
                runs.append((run.group(1), location))
    return [location for _, location in sorted(runs)]


def read_snapshots(spark: SparkSession, base: str, mode: str = "latest") -> DataFrame:
    """The newest snapshot, or with ``mode="all"`` every run together (rows repeat)."""
    if mode not in ("latest", "all"):
        raise ValueError("mode must be latest or all")
    paths = snapshot_paths(spark, base)
    if not paths:
        raise FileNotFoundError(f"no snapshot of {base}")
    return spark.read.parquet(*(paths if mode == "all" else paths[-1:]))


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of every finished version of a replaced table, oldest first.

    Each has a small file that names its folder. A file without a name belongs to a writer that was
    lost just then; its version does not count.
    """
    found = _fs(spark, path).globStatus(_path(spark, f"{path}/{_POINTERS}/[0-9]*")) or []
    named = []
    for status in found:
        stream = _fs(spark, path).open(status.getPath())
        try:
            folder = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        named.append((int(status.getPath().getName()), folder))
    return sorted(named)


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are that ``staged_replace`` has replaced: its newest version, or the plain table."""
    named = [folder for _, folder in _versions(spark, path) if folder]
    return f"{path}/{named[-1]}" if named else path


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of a table."""
    return spark.read.parquet(current_path(spark, path))


def _write_version(df: DataFrame, folder: str) -> None:
    df.write.parquet(folder)


def _point(spark: SparkSession, pointer: str, folder: str) -> None:
    """Make a version the current one: fails if another writer has taken its number."""
    stream = _fs(spark, pointer).create(_path(spark, pointer), False)
    try:
        stream.write(bytearray(folder.encode()))
    finally:
        stream.close()


def _clean(spark: SparkSession, path: str, keep: int) -> None:
    """Delete what no version names any more: older versions, leftovers of lost writers, and the plain table of before."""
    fs, versions = _fs(spark, path), _versions(spark, path)
    kept = [v for v in versions if v[1]][-1 - keep:]
    names = {folder for _, folder in kept}
    for status in fs.listStatus(_path(spark, path)):
        name = status.getPath().getName()
        number = int(name[len(_VERSION):].split("-")[0]) if name.startswith(_VERSION) else 0
        # A higher number belongs to a writer at work.
        if name != _POINTERS and name not in names and number <= kept[-1][0]:
            fs.delete(status.getPath(), True)
    for number, _ in versions:
        if number < kept[0][0]:
            fs.delete(_path(spark, f"{path}/{_POINTERS}/{number:08d}"), False)


def staged_replace(df: DataFrame, path: str, keep: int = 1) -> None:
    """Replace the table at ``path`` by ``df``, which may read from that same path; read it with ``read_current``.

    The rows are written to a folder of their own inside ``path``, and a file that names the folder is created last.
    Until then the old rows are read, from then on the new ones; a run lost in between leaves only a folder that the
    next run deletes. Of two runs at a time one fails and changes nothing. ``keep`` earlier versions stay for
    readers at work.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    folder = f"{_VERSION}{number:08d}-{uuid.uuid4().hex}"
    _write_version(df, f"{path}/{folder}")
    _point(spark, f"{path}/{_POINTERS}/{number:08d}", folder)
    _clean(spark, path, keep)
    spark.catalog.refreshByPath(path)
