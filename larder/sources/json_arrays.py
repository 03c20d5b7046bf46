"""JSON files that hold one array of records, read in pieces by many tasks.

Spark's text reader can split a file at any character, so it is told to end lines at closing braces. A split then
begins right after one, and all that must be known to find records in it is whether that brace stood in a string,
and how many brackets are open. A first pass gets the change that each split makes to both, once for either case;
running sums over the splits of a file give where each begins; a second pass cuts out the records. A record that
spans splits leaves a piece in each, and only these pieces are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

_QUOTE, _BACKSLASH, _OPEN, _CLOSE = ord('"'), ord("\\"), (ord("["), ord("{")), (ord("]"), ord("}"))
#: Kinds of pieces: a whole record, or the first, a further, or the last piece of one.
_WHOLE, _HEAD, _MIDDLE, _TAIL = range(4)
_KINDS = "file string, start long"


def _marks(data: np.ndarray, in_string: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of all brackets, whether each stands in a string, and whether the data ends in one.

    Data must not begin behind a backslash, which it never does behind a brace that ends a line.
    """
    slashes = np.flatnonzero(data == _BACKSLASH)
    quotes = np.flatnonzero(data == _QUOTE)
    if len(slashes):
        # A quote is escaped by an odd number of backslashes right before it.
        first = np.flatnonzero(np.diff(slashes, prepend=-2) > 1)
        run_starts = slashes[first]
        run_ends = np.append(slashes[first[1:] - 1], slashes[-1])
        at = np.searchsorted(run_ends, quotes - 1)
        at_end = np.minimum(at, len(run_ends) - 1)
        escaped = (run_ends[at_end] == quotes - 1) & ((run_ends[at_end] - run_starts[at_end]) % 2 == 0)
        quotes = quotes[~escaped]
    brackets = np.flatnonzero(np.isin(data, [*_OPEN, *_CLOSE]))
    inside = (np.searchsorted(quotes, brackets) + in_string) % 2 == 1
    return brackets, inside, bool((len(quotes) + in_string) % 2)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list, np.ndarray, bool]]:
    """File, start, other columns' values and bytes of a run of lines of one split; the flag marks a split's first run."""
    before = None
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        lines = batch.column("value").cast(pa.binary()).to_pylist()
        others = [batch.column(i) for i in range(3, batch.num_columns)]
        low = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or (files[i], starts[i]) != (files[low], starts[low]):
                here = files[low], starts[low]
                data = np.frombuffer(b"}".join(lines[low:i]) + b"}", np.uint8)
                yield *here, [c[low].as_py() for c in others], data, here != before
                before, low = here, i


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: whether it holds an odd number of quotes, its change of depth if it begins outside or inside a
    string, and whether the file is a single record (known to the first split that has anything but blanks)."""
    found: list[list] = []
    for file, start, _, data, new in _splits(batches):
        if new:
            found.append([file, start, False, 0, 0, None])
        row = found[-1]
        brackets, inside, row_odd = _marks(data, row[2])
        step = np.where(np.isin(data[brackets], _OPEN), 1, -1)
        # Beginning in a string turns inside out.
        row[3] += int(step[~inside].sum())
        row[4] += int(step[inside].sum())
        row[2] = row_odd
        if row[5] is None:
            text = data[:4096].tobytes().lstrip(b"\xef\xbb\xbf \t\r\n")
            row[5] = text[:1] == b"{" if text else None
    columns = list(zip(*found)) or [[]] * 6
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                     names=["file", "start", "odd", "outside", "inside", "single"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and pieces of records that go on in the next split or began in an earlier one."""
    rows, state = [], None

    def finish() -> None:
        if state and state["held"] is not None:
            rows.append((state["file"], state["start"], _HEAD if state["began"] else _MIDDLE, b"".join(state["held"])))

    for file, start, (in_string, depth, base), data, new in _splits(batches):
        if new:
            finish()
            state = {"file": file, "start": start, "in_string": in_string, "depth": depth, "held": [] if depth > base else None, "began": False}
        brackets, inside, state["in_string"] = _marks(data, state["in_string"])
        brackets = brackets[~inside]
        opens = np.isin(data[brackets], _OPEN)
        depths = state["depth"] + np.cumsum(np.where(opens, 1, -1))
        begins = brackets[opens & (depths == base + 1) & (data[brackets] == _OPEN[1])]
        ends = brackets[~opens & (depths == base)] + 1
        if len(depths):
            state["depth"] = int(depths[-1])
        raw, at = data.tobytes(), 0
        for begin in (begins if state["held"] is None else [0, *begins]):
            if begin < at:
                continue
            place = np.searchsorted(ends, begin, "right")
            fresh = state["held"] is None
            if fresh:
                state["held"], state["began"] = [], True
            if place == len(ends):
                state["held"].append(raw[begin:])
                break
            at = int(ends[place])
            state["held"].append(raw[begin:at])
            rows.append((file, start, _WHOLE if state["began"] else _TAIL, b"".join(state["held"])))
            state["held"] = None
        if len(rows) >= 10_000:
            yield _piece_rows(rows)
            rows.clear()
    finish()
    yield _piece_rows(rows)


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([t.decode() for t in c] if k == pa.string() and i == 3 else c, k)
                                       for i, (c, k) in enumerate(zip(columns, kinds))], names=["file", "start", "kind", "text"])


def read_json_array(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, skip_prefix: str = "",
                    **options) -> DataFrame:
    """The records of files that hold one array of objects each (or a single object), UTF-8, read in splits.

    Of a record that does not fit the schema all fields are null. ``pathGlobFilter``, ``recursiveFileLookup`` and other
    reader options choose the files, the rest goes to ``from_json``. Files whose names begin with ``skip_prefix``, and
    elements of the array that are no objects, are left out. Compressed files are read by one task each.
    """
    places = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")}
    lines = spark.read.options(**places).option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.col("_metadata.file_name").alias("name"))
    if skip_prefix:
        lines = lines.where(~F.startswith("name", F.lit(skip_prefix)))
    lines = lines.drop("name")
    changes = lines.mapInArrow(_changes, f"{_KINDS}, odd boolean, outside long, inside long, single boolean")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    in_string = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = changes.withColumn("in_string", in_string).withColumn("step", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
    whole_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = known.select("file", "start", "in_string", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("depth"),
                          F.when(F.first("single", ignorenulls=True).over(whole_file), 0).otherwise(1).cast("long").alias("base"))
    # One row a split, as many as the scan has: the driver holds as much for the scan itself.
    told = lines.join(F.broadcast(starts), ["file", "start"]).select("file", "start", "value", "in_string", "depth", "base")
    pieces = told.mapInArrow(_pieces, f"{_KINDS}, kind int, text string")
    # At most two pieces a split take part; a head opens a new record, whose pieces follow in order.
    parts = pieces.where(F.col("kind") != _WHOLE).withColumn("head", F.when(F.col("kind") == _HEAD, F.col("start")))
    opened = Window.partitionBy("file").orderBy("start", "kind_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Within a split the end of an earlier record comes before the head of the next.
    parts = parts.withColumn("kind_order", F.when(F.col("kind") == _HEAD, 1).otherwise(0))
    parts = parts.withColumn("record", F.last("head", ignorenulls=True).over(opened))
    joined = parts.groupBy("file", "record").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "").alias("text"))
    records = pieces.where(F.col("kind") == _WHOLE).select("text").unionByName(joined.select("text"))
    fields = {k: str(v) for k, v in options.items() if k not in places}
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return records.select(F.from_json("text", wanted, fields).alias("r")).select(
        *[F.col("r").getField(f.name).alias(f.name) for f in wanted.fields])
