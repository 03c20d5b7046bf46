"""SimHash near-duplicates: fingerprints linked at a small bit distance, found by pigeonring filtering.

A fingerprint of 64 bits is cut into ``d + 1`` segments on a ring, d being the largest distance
allowed. If two fingerprints differ in at most d bits, there is a segment from which every chain of
l consecutive segments differs in at most ``l * d / (d + 1)`` bits, rounded down: none in the first
segment, one in the first two, and so on. Candidates must agree in a first segment and, as the second
differs in one bit at most, in one half of it: these two parts are the join key. The longer chains and
then the full distance are checked inside the join.

Equal fingerprints are merged before the join, so a group of copies is one row however large it is.
A fingerprint has at most 2,080 others within two bits, which bounds the links of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.graph import components
from larder.llm.rows import pieces, select_as
from larder.session import materialize

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def simhash(text: str, shingle_words: int = 3) -> int:
    """Unsigned fingerprint of one text; 0 where it has no words."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    breaks = list(accumulate(map(len, words), lambda end, size: end + size + 1, initial=-1))
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a + 1:b], SEED) for a, b in zip(breaks, breaks[shingle_words:])])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)  # digests are big-endian: the highest bit comes first
    votes = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) for every row; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                fps = np.array([simhash(t, shingle_words) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return select_as(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id long, fp long")


def _mask(start: int, width: int) -> int:
    value = ((1 << width) - 1) << start
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def ring(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment, widths differing by one at most."""
    count = max_distance + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ring_keys(fp: Column, max_distance: int) -> Column:
    """The join keys of a fingerprint: per starting segment, itself with either half of the next one."""
    segments, keys = ring(max_distance), []
    for i, (start, width) in enumerate(segments):
        after, after_width = segments[(i + 1) % len(segments)]
        half = after_width // 2
        for h, mask in enumerate((_mask(after, half), _mask(after + half, after_width - half))):
            whole = fp.bitwiseAND(F.lit(_mask(start, width) | mask))
            keys.append(F.struct(F.lit(i * 2 + h).alias("slot"), whole.alias("key")))
    return F.array(*keys)


def within_ring(a: Column, b: Column, slot: Column, max_distance: int) -> Column:
    """Every chain from the starting segment of ``slot`` keeps its budget; the last chain is the whole distance."""
    segments, test = ring(max_distance), None
    differing = a.bitwiseXOR(b)
    for i in range(len(segments)):
        mask, chain = 0, F.lit(True)
        for length in range(1, len(segments) + 1):
            mask |= _mask(*segments[(i + length - 1) % len(segments)])
            budget = length * max_distance // (max_distance + 1)
            chain = chain & (F.bit_count(differing.bitwiseAND(F.lit(mask))) <= budget)
        test = F.when(F.floor(slot / 2) == i, chain) if test is None else test.when(F.floor(slot / 2) == i, chain)
    return test


def links(classes: DataFrame, max_distance: int = 2) -> DataFrame:
    """``a``, ``b``: pairs of class ids (``node``) whose fingerprints (``fp``) differ in at most ``max_distance`` bits.

    ``classes`` has each fingerprint once. Each link is listed once per key both ends share.
    """
    if max_distance < 1:
        return classes.select(F.col("node").alias("a"), F.col("node").alias("b")).where(F.lit(False))
    keyed = classes.select("node", "fp", F.explode(ring_keys(F.col("fp"), max_distance)).alias("k")).select(
        "node", "fp", "k.slot", "k.key")
    left = keyed.select(F.col("node").alias("a"), F.col("fp").alias("fa"), "slot", "key")
    right = keyed.select(F.col("node").alias("b"), F.col("fp").alias("fb"), F.col("slot").alias("slot_b"),
                         F.col("key").alias("key_b"))
    near = (F.col("fa") < F.col("fb")) & within_ring(F.col("fa"), F.col("fb"), F.col("slot"), max_distance)
    same = (F.col("slot") == F.col("slot_b")) & (F.col("key") == F.col("key_b"))
    return left.join(right, same & near).select("a", "b")


def _components(fps: DataFrame, max_distance: int) -> DataFrame:
    """``fp``, ``component`` for each different fingerprint, which itself is the node: rows may repeat an id."""
    classes = materialize(fps.select("fp").distinct(), "simhash-classes")
    found = links(classes.select(F.col("fp").alias("node"), "fp"), max_distance).distinct()
    reached = components(found)
    named = classes.join(reached.select(F.col("node").alias("member"), "component"), F.col("fp") == F.col("member"), "left")
    return materialize(named.select("fp", F.coalesce("component", "fp").alias("component")), "simhash-named")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_distance: int = 2) -> DataFrame:
    """``doc_id``, ``fp`` long, ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``max_distance`` differing bits.
    Null and empty texts have fingerprint 0 and link like any other. Rows repeating an id are each
    returned, with the component of their own text. A row with a null id belongs to the component of its
    fingerprint but never names it (``component_id`` is null where all rows of the component lack an id).
    An empty table gives no rows.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    named = _components(fps, max_distance)
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    ids = named.join(least, "fp").groupBy("component").agg(F.min("least").alias("component_id"))
    told = materialize(named.join(ids, "component").select("fp", "component_id"), "simhash-ids")
    return fps.join(told, "fp").select("doc_id", "fp", "component_id")


def one_of_each(rows: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                max_distance: int = 2) -> DataFrame:
    """The numbers (``row_col``) of the rows that stay if each component keeps one: that with the smallest id, a row
    with an id before one without, and of those with the same id the one with the smallest number."""
    kept = select_as(rows, doc_id=row_col, text=text_col)
    fps = materialize(fingerprints(kept, "doc_id", "text", shingle_words), "simhash").withColumnRenamed("doc_id", "row")
    own = rows.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("id"))
    ranked = fps.join(_components(fps, max_distance), "fp").join(own, "row")
    first = ranked.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first"))
    return first.select(F.col("first.row").alias(row_col))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
