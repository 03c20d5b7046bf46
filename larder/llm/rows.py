"""Helpers for functions that see a partition as Arrow record batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A text batch is cut into pieces of about this many characters, so that working arrays stay small.
PIECE_CHARS = 2_000_000


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts (null becomes empty), each about ``most`` characters or one row."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()):
        if i > start and size + n > most:
            yield _piece(batch.slice(start, i - start), text)
            start, size = i, 0
        size += n
    if batch.num_rows:
        yield _piece(batch.slice(start), text)


def _piece(part: pa.RecordBatch, text: str) -> tuple[pa.RecordBatch, list[str]]:
    return part, ["" if t is None else t for t in part.column(text).to_pylist()]


def select_as(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra columns cannot clash.

    Names ending in ``_id`` become 64-bit numbers, the others text.
    """
    return df.select(*(df[source].cast("long" if name.endswith("_id") else "string").alias(name) for name, source in columns.items()))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append_columns(df: DataFrame, text: str, added: T.StructType,
                   compute: Callable[[list[str], pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with columns computed from its texts, piece by piece; an existing column of the same name is replaced."""
    names = added.fieldNames()
    kept_names = [c for c in df.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, text):
                yield pa.RecordBatch.from_arrays([part.column(n) for n in kept_names] + compute(texts, part),
                                                 names=kept_names + names)

    fields = [f for f in df.schema.fields if f.name not in names]
    return df.mapInArrow(run, T.StructType(fields + added.fields))


def int_lists(values: list[np.ndarray]) -> pa.Array:
    """One list of 32-bit integers for each array."""
    edges = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=edges[1:])
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate([np.zeros(0, np.int32), *values]).astype(np.int32)))
