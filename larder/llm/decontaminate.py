"""Benchmark decontamination by spaced-seed hashing.

A mask is a row of token offsets; the tokens between them are ignored, so a substituted token there
does not matter. Every mask is laid on every token position of the benchmark items and of the
documents, and the hashes of the tokens it selects are joined. Masks leave out different positions, and
there are as many as it takes: wherever substitutions fall, an overlap that counts has a place for one of
them (a test goes through all ways). Items too short for the common masks have shorter ones of their own,
which are laid on documents only if there are such items. Each hit names a diagonal, a document position
less an item position. On the diagonal, around the hit, the longest stretch that agrees in enough tokens
decides whether the document overlaps the item.

Documents look their hashes up in a bit map of fixed size first, filled from the benchmark; what the
map lets through by chance fails in the join. The map does not grow with the benchmark, and documents
send only the tokens around their hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.rows import pieces, select_as
from larder.session import materialize

#: Offsets of the tokens each mask selects, by the fewest tokens of the items it is for.
MASK_SETS = {
    1: ((0,),), 2: ((0, 1),), 3: ((0, 1, 2),), 4: ((0, 1, 2, 3),),
    5: ((0, 1, 4), (0, 2, 3)),
    6: ((0, 2, 3, 4), (0, 1, 2, 5)),
    13: ((0, 1, 2, 5, 7, 8), (0, 2, 3, 4, 6, 7), (0, 1, 2, 4, 8, 11), (0, 1, 5, 8, 10, 11)),
}
MASKS = tuple(mask for masks in MASK_SETS.values() for mask in masks)
#: Items with fewer tokens are so short that clean documents hold them too.
MIN_ITEM_TOKENS = 5
#: The shortest overlap that counts; items with fewer tokens must be found whole.
MIN_TOKENS = 13
#: The share of tokens that must agree in an overlap.
MIN_IDENTITY = 0.8
#: Tokens sent along on either side of a hit.
MARGIN = 64
#: Bits of the map documents look their hashes up in, a power of two.
MAP_BITS = 1 << 26

_WORD = re.compile(r"\w+")
_COEFFICIENTS = np.random.default_rng(20240607).integers(1, 2**63, (16, 8), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def masks_for(n_tokens: int) -> list[int]:
    """Numbers of the masks for an item of so many tokens."""
    least = max(least for least in MASK_SETS if least <= n_tokens)
    return [i for i, mask in enumerate(MASKS) if mask in MASK_SETS[least]]


def token_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, lower-cased."""
    words = _WORD.findall(text.lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def seed_hashes(tokens: np.ndarray, mask_no: int) -> np.ndarray:
    """The hash under one mask at every position it fits."""
    mask = MASKS[mask_no]
    count = max(0, len(tokens) - mask[-1])
    found = np.full(count, np.uint64(mask_no + 1))
    for j, offset in enumerate(mask):
        found += tokens[offset:offset + count] * _COEFFICIENTS[mask_no, j]
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def _probes(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(MAP_BITS - 1)
    return (seeds & low).astype(np.int64), (seeds >> np.uint64(38) & low).astype(np.int64)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in pieces(batch, "text"):
            tokens = [token_hashes(t).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(tokens, pa.list_(pa.int64()))], names=["item_id", "tokens"])


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, tokens in zip(batch.column("item_id").to_pylist(), batch.column("tokens")):
            row = tokens.values.to_numpy().view(np.uint64)
            for no in masks_for(len(row)):
                seeds = seed_hashes(row, no)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array([item] * len(seeds), pa.int64()), pa.array(np.arange(len(seeds), dtype=np.int32))],
                    names=["seed", "item_id", "item_at"])


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id``, ``tokens``: each different row of tokens once, under the smallest id that has it."""
    rows = select_as(benchmark, item_id=id_col, text=text_col).where("item_id is not null")
    return rows.mapInArrow(_item_rows, "item_id long, tokens array<long>").groupBy("tokens").agg(F.min("item_id").alias("item_id"))


def _bit_map(seeds: DataFrame) -> bytes:
    """The map as bytes: at most ``MAP_BITS / 64`` words come to the driver, however many seeds there are."""
    spread = seeds.select("seed").distinct()
    low = F.lit(MAP_BITS - 1)
    bits = spread.select(F.explode(F.array(F.col("seed").bitwiseAND(low),
                                           F.shiftrightunsigned("seed", 38).bitwiseAND(low))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask")).toPandas()
    found = np.zeros(MAP_BITS // 64, np.int64)
    found[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64)
    return found.tobytes()


_REGIONS = "doc_id long, region long, tokens array<long>, seeds array<long>, doc_at array<int>"


def _hit_regions(docs: DataFrame, bit_map: bytes, masks: list[int]) -> DataFrame:
    """Stretches of documents around hits: their tokens, and the seeds found with their places in the stretch."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_map)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                    rows.extend((doc_id, *r) for r in _regions_of(token_hashes(text), bits, masks))
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                     names=["doc_id", "region", "tokens", "seeds", "doc_at"])

    return docs.mapInArrow(run, _REGIONS)


def _regions_of(tokens: np.ndarray, bits: np.ndarray, masks: list[int]) -> list[tuple]:
    places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for no in masks:
        found = seed_hashes(tokens, no)
        first, second = _probes(found)
        hit = np.flatnonzero(bits[first >> 3] >> (first & 7).astype(np.uint8) & 1)
        hit = hit[(bits[second[hit] >> 3] >> (second[hit] & 7).astype(np.uint8) & 1).astype(bool)]
        places.append(hit)
        seeds.append(found[hit])
    at, seed = np.concatenate(places), np.concatenate(seeds)
    if not len(at):
        return []
    order = np.argsort(at, kind="stable")
    at, seed = at[order], seed[order]
    span = max(m[-1] for m in MASKS) + 1
    rows = []
    for group in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * MARGIN + span) + 1):
        start = max(0, int(at[group[0]]) - MARGIN)
        stop = int(at[group[-1]]) + span + MARGIN
        rows.append((start, tokens[start:stop].view(np.int64), seed[group].view(np.int64), (at[group] - start).astype(np.int32)))
    return rows


def longest_overlap(agree: np.ndarray, min_identity: float) -> tuple[int, int]:
    """The longest stretch of ``agree`` in which at least that share is true, both its ends true; the first of equals."""
    places = np.flatnonzero(agree)
    if not len(places):
        return 0, 0
    score = np.concatenate(([0.0], np.cumsum(agree - min_identity)))
    # For each end, the earliest start with no higher a score: running minima are met by binary search.
    starts, ends = score[places], score[places + 1]
    lowest = np.minimum.accumulate(starts)
    first = np.searchsorted(-lowest, -(ends + 1e-9), side="left")
    sizes = places + 1 - places[np.minimum(first, len(places) - 1)]
    best = int(np.argmax(sizes))
    return int(places[first[best]]), int(places[best]) + 1


def _verify(min_tokens: int, min_identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            named = [batch.column(c).to_pylist() for c in ("doc_id", "region", "item_id", "diagonal")]
            for doc_id, region, item_id, diagonal, near, item in zip(*named, batch.column("tokens"), batch.column("item_tokens")):
                here, there = near.values.to_numpy(), item.values.to_numpy()
                # Document position = item position + diagonal.
                low, high = max(0, -diagonal), min(len(there), len(here) - diagonal)
                agree = here[low + diagonal:high + diagonal] == there[low:high]
                start, stop = longest_overlap(agree, min_identity)
                if stop - start >= min(min_tokens, len(there)):
                    rows.append((doc_id, item_id, region + diagonal + low + start, low + start, stop - start, int(agree[start:stop].sum())))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"])

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", min_tokens: int = MIN_TOKENS, min_identity: float = MIN_IDENTITY,
             min_item_tokens: int = MIN_ITEM_TOKENS) -> DataFrame:
    """``doc_id``, ``item_id``, ``doc_start``, ``item_start``, ``n_tokens``, ``n_equal``: the longest overlap of each pair.

    Tokens are words, lower-cased; places are counted in tokens. An overlap has at least ``min_tokens``
    tokens (an item with fewer: all of them) of which ``min_identity`` agree. At the standard settings all
    of them are found, as masks have a place in each; with a lower identity or fewer tokens, those with one hit of
    a mask. Items of fewer than ``min_item_tokens`` tokens, null and empty texts and rows without an id are
    never found. Items with the same tokens are one, under their smallest id; documents that repeat an id are
    one document. Of equally long overlaps the one with more equal tokens counts, then the first in the
    document, then in the item.
    """
    items = benchmark_items(benchmark, item_col, item_text_col)
    items = materialize(items.where(F.size("tokens") >= max(1, min_item_tokens)), "items")
    # One row per set of masks.
    least = F.array_max(F.array(*[F.when(F.size("tokens") >= n, n) for n in MASK_SETS]))
    used = sorted({no for r in items.select(least.alias("n")).distinct().collect() for no in masks_for(r.n)})
    seeds = materialize(items.select("item_id", "tokens").mapInArrow(_seed_rows, "seed long, item_id long, item_at int"), "seeds")
    named = select_as(docs, doc_id=id_col, text=text_col).where("doc_id is not null and text is not null")
    # Rows that repeat an id may hold different texts, so a stretch is known by its tokens too.
    regions = materialize(_hit_regions(named, _bit_map(seeds), used).withColumn("content", F.xxhash64("tokens")), "regions")
    hits = regions.select("doc_id", "region", "content", F.explode(F.arrays_zip("seeds", "doc_at")).alias("hit")).select(
        "doc_id", "region", "content", F.col("hit.seeds").alias("seed"), F.col("hit.doc_at").alias("doc_at"))
    found = hits.join(seeds, "seed").select("doc_id", "region", "content", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal"))
    candidates = (found.distinct().join(items.select("item_id", F.col("tokens").alias("item_tokens")), "item_id")
                  .join(regions.select("doc_id", "region", "content", "tokens").distinct(), ["doc_id", "region", "content"]))
    checked = candidates.select("doc_id", "region", "item_id", "diagonal", "tokens", "item_tokens").mapInArrow(
        _verify(min_tokens, min_identity), "doc_id long, item_id long, doc_start long, item_start long, n_tokens long, n_equal long")
    best = F.max(F.struct("n_tokens", "n_equal", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"))).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.d")).alias("doc_start"), (-F.col("best.i")).alias("item_start"), "best.n_tokens", "best.n_equal")
