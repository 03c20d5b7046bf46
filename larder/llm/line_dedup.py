"""Line deduplication through a sharded minimal perfect hash.

A line's key is the line with ASCII white space stripped at both ends and A-Z lower-cased. Every
distinct key of at least ``min_chars`` code points gets a 128-bit hash. The hashes are dealt to
shards; each shard is a minimal perfect hash whose slots index three arrays: a 64-bit fingerprint,
the number of documents that hold the line, and the smallest id among them. Documents send the hash
of each distinct line to its shard and read the answer from the arrays.

Shards are sized by the number of lines probing them. Lines in more documents than a whole shard
should be probed by, and in more than 1/4096 of all (document, line) pairs, are at most 4,096: they
form one more index, which every task holds, so no shard is probed by more than its share. A shard's
probes stream past its arrays in batches and are never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import perfect_hash
from larder.llm.rows import append_columns, fresh, pieces, select_as
from larder.session import materialize

MIN_CHARS = 10
#: Probes for which one shard is laid out.
SHARD_PROBES = 16_384
#: At most so many lines are held by every task.
HOT_LINES = 4_096

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK = b" \t\n\x0b\x0c\r"


def line_hashes(text: str, min_chars: int = MIN_CHARS) -> tuple[list[str], list[bytes]]:
    """The lines of a text, and for each the 16-byte hash of its key (empty where the key is too short)."""
    lines, hashes = text.split("\n"), []
    for raw in text.encode("utf-8", "replace").translate(_LOWER).split(b"\n"):
        key = raw.strip(_BLANK)
        enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        hashes.append(xxhash.xxh3_128_digest(key) if enough else b"")
    return lines, hashes


def _longs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(packed, "<i8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def document_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``doc_id``, ``h1``, ``h2``: the hash of each distinct long line of each document with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                ids, counts, packed = part.column("doc_id").to_numpy(zero_copy_only=False), [], []
                for text in texts:
                    distinct = dict.fromkeys(line_hashes(text, min_chars)[1])
                    distinct.pop(b"", None)
                    counts.append(len(distinct))
                    packed.extend(distinct)
                h1, h2 = _longs(b"".join(packed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, counts)), pa.array(h1), pa.array(h2)], names=["doc_id", "h1", "h2"])

    named = select_as(docs, doc_id=id_col, text=text_col).where("doc_id is not null")
    return named.mapInArrow(run, "doc_id long, h1 long, h2 long")


class LineIndex:
    """One shard: a perfect hash and the arrays its slots index."""

    def __init__(self, table: perfect_hash.PerfectHash, prints: np.ndarray, counts: np.ndarray, owners: np.ndarray):
        self.table, self.prints, self.counts, self.owners = table, prints, counts, owners

    @staticmethod
    def build(h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> LineIndex:
        high, low = h1.view(np.uint64), h2.view(np.uint64)
        table = perfect_hash.build(high, low)
        order = np.argsort(table.slots(high, low))
        return LineIndex(table, h2[order], counts[order], owners[order])

    def to_bytes(self) -> bytes:
        table = self.table.to_bytes()
        arrays = [a.astype("<i8").tobytes() for a in (self.prints, self.counts, self.owners)]
        return len(table).to_bytes(8, "little") + table + b"".join(arrays)

    @staticmethod
    def from_bytes(raw: bytes) -> LineIndex:
        end = 8 + int.from_bytes(raw[:8], "little")
        table = perfect_hash.PerfectHash.from_bytes(raw[8:end])
        return LineIndex(table, *np.frombuffer(raw, "<i8", 3 * table.size, end).reshape(3, -1))

    def repeated_elsewhere(self, ids: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per probe: whether the line is in the index, and whether the document must drop it."""
        slots = self.table.slots(h1.view(np.uint64), h2.view(np.uint64))
        known = slots >= 0
        if not self.table.size:
            return known, known
        slots = np.where(known, slots, 0)
        known &= self.prints[slots] == h2
        return known, known & (self.counts[slots] > 1) & (self.owners[slots] != ids)


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    h1, h2, n, owner = (rows.column(c).to_numpy() for c in ("h1", "h2", "n", "owner"))
    index = LineIndex.build(h1, h2, n, owner).to_bytes()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "arrays": pa.array([index], pa.binary())})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, its arrays first; what a document must drop goes out."""
    shard, index = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for start, stop in zip(edges, edges[1:]):
            part = batch.slice(start, stop - start)
            if shards[start] != shard:
                shard, index = shards[start], None
            given = part.column("arrays")
            heads = len(given) - given.null_count
            if heads:
                index = LineIndex.from_bytes(given[0].as_py())
                part = part.slice(heads)
            if index is None or not part.num_rows:
                continue
            ids, h1, h2 = (part.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
            _, drop = index.repeated_elsewhere(ids, h1, h2)
            yield pa.RecordBatch.from_arrays([pa.array(x[drop]) for x in (ids, h1, h2)], names=["doc_id", "h1", "h2"])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, ``h1``, ``h2``: the lines each document loses."""
    lines = materialize(document_lines(docs, id_col, text_col, min_chars), "lines")
    distinct = materialize(
        lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
        # Rows that repeat one id are one document.
        .withColumn("n", F.when(F.col("owner") == F.col("last"), 1).otherwise(F.col("n"))).drop("last"), "distinct-lines")
    probes = distinct.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-probes // SHARD_PROBES))
    least = max(SHARD_PROBES, probes // HOT_LINES)
    hot = distinct.where(F.col("n") > least).orderBy(F.desc("n"), "h1", "h2").limit(HOT_LINES).toPandas()
    hot_index = LineIndex.build(*(hot[c].to_numpy(np.int64) for c in ("h1", "h2", "n", "owner"))).to_bytes()

    def settle_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LineIndex.from_bytes(hot_index)
        for batch in batches:
            ids, h1, h2 = (batch.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
            known, drop = index.repeated_elsewhere(ids, h1, h2)
            left = ~known | drop
            yield pa.RecordBatch.from_arrays([*(pa.array(x[left]) for x in (ids, h1, h2)), pa.array(drop[left])],
                                             names=["doc_id", "h1", "h2", "settled"])

    shard = F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)).alias("shard")
    index = distinct.select(shard, "h1", "h2", "n", "owner").groupBy("shard").applyInArrow(
        _build_shard, "shard long, arrays binary")
    asked = materialize(lines.mapInArrow(settle_hot, "doc_id long, h1 long, h2 long, settled boolean"), "probes")
    none = F.lit(None)
    dealt = (index.select("shard", F.lit(0).alias("turn"), "arrays", *(none.cast("long").alias(c) for c in ("doc_id", "h1", "h2")))
             .unionByName(asked.where("not settled").select(shard, F.lit(1).alias("turn"), none.cast("binary").alias("arrays"),
                                                            "doc_id", "h1", "h2"))
             .repartition("shard").sortWithinPartitions("shard", "turn"))
    found = dealt.mapInArrow(_probe, "doc_id long, h1 long, h2 long")
    return found.unionByName(asked.where("settled").drop("settled"))


_ADDED = T.StructType([T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()),
                       T.StructField("n_dropped", T.LongType())])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and is found in two documents or more
    stays only in the document with the smallest id, there with all its repeats. Other lines stay;
    all are joined by one newline. Null and empty texts are one empty line. Rows with the same id
    are one document. A row without an id keeps all its lines and does not count for others.
    Columns of these three names are replaced. An empty table gives no rows.
    """
    lost_by, lost_lines_of = fresh(docs, "_lost_by"), fresh(docs, "_lost")
    lost = repeated_lines(docs, id_col, text_col, min_chars).groupBy(F.col("doc_id").alias(lost_by)).agg(
        F.collect_set(F.struct("h1", "h2")).alias(lost_lines_of))
    joined = docs.join(lost, docs[id_col] == lost[lost_by], "left").drop(lost_by)

    def rebuild(texts: list[str], part: pa.RecordBatch) -> list[pa.Array]:
        kept, n_lines, n_dropped = [], [], []
        for text, lost_lines in zip(texts, part.column(lost_lines_of)):
            lines, hashes = line_hashes(text, min_chars)
            stay = lines
            if lost_lines.is_valid and len(lost_lines):
                pairs = lost_lines.values
                packed = np.stack([pairs.field("h1").to_numpy(), pairs.field("h2").to_numpy()], axis=1)
                gone = {p.tobytes() for p in packed}
                stay = [line for line, h in zip(lines, hashes) if h not in gone]
            kept.append("\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        return [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]

    return append_columns(joined, text_col, _ADDED, rebuild).drop(lost_lines_of)
