"""Embedding near-duplicates: binary codes from iterative quantisation, multi-index Hamming tables, cosines.

A rotation is learned on a bounded sample: principal components, then alternating between the signs of the
rotated vectors and the rotation that fits these signs best, so that no bit carries more than the others. Every
vector gets a code of 64 bits, and a longer one of 128 bits from two further rotations. Four tables index 16 bits of
the code each: a key is an upper and a lower half of 8 bits. Two vectors meet if some key differs in three places at
most, two of them in its upper half. Met pairs whose codes, then whose longer codes differ too much are let go, and
the others are linked if their cosine, in double precision and from the vectors themselves, reaches the threshold.

Both sides meet in the middle of the upper half: a vector goes to the unit of its own and to those one bit away, nine
a table, and the lower halves are looked up inside the unit. A pair is taken in one unit only: that of the first table
it meets in, and the smallest upper half between its two. Vectors themselves are sent only to units where they still
have a candidate, and no pair leaves a unit: it returns counts of links and one edge per vector. Units that are too
large are cut into parts, and every two parts meet.

Two vectors at a cosine of exactly 0.9 differ in a bit with probability acos(0.9) / pi = 0.144. Of 200,000 random pairs
at that cosine 99.86 % pass all steps, at 0.92 99.95 %, at 0.95 all but one; tests measure it against all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.graph import components
from larder.session import materialize

BITS, LONG_BITS, TABLES, HALF = 64, 128, 4, 8
KEY_BITS = BITS // TABLES
#: Most differing bits of a key, of its upper half, of a code, and of a code with the longer one.
NEAR, NEAR_HIGH, NEAR_CODE, NEAR_LONG = 3, 2, 18, 48
#: The rotation is learned on about this many different vectors, and fewer where they are long. Of sampled vectors
#: at this cosine one counts: a large group of near copies must not pull the mean and the axes towards itself.
SAMPLE_VECTORS, SAMPLE_VALUES = 8_000, 4_000_000
ALIKE = 0.8
ROUNDS = 50
SEED = 42
#: Entries of a unit, or of a part of one.
UNIT_ROWS = 20_000
#: Pairs looked at together.
PAIRS = 500_000
_UNIT = ["dim", "slot", "region", "part_a", "part_b"]


def thinned(sample: np.ndarray) -> np.ndarray:
    """Unit vectors of which no two are ``ALIKE``: each that is like none kept before."""
    kept = sample[:0]
    for start in range(0, len(sample), 500):
        block = sample[start:start + 500]
        block = block[((block @ kept.T) < ALIKE).all(axis=1)]
        fresh = np.ones(len(block), bool)
        for i, like in enumerate(block @ block.T >= ALIKE):
            fresh[i] = not (like[:i] & fresh[:i]).any()
        kept = np.concatenate([kept, block[fresh]])
    return kept


def learn(sample: np.ndarray, dim: int, bits: int = BITS + LONG_BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (``dim`` x ``bits``) whose signs are the code; a random rotation where the sample is too small.

    A rotation has as many bits as the vectors have values, 64 at most. Further ones come from other random starts.
    """
    rng = np.random.default_rng(SEED)
    width = min(dim, BITS)
    sample = thinned(sample)
    known = len(sample) > 2 * dim
    mean = sample.mean(axis=0) if known else np.zeros(dim)
    centred = sample - mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :width] if known else np.linalg.qr(rng.normal(size=(dim, width)))[0]
    projected, found = centred @ axes, []
    for _ in range(-(-bits // width)):
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(rounds if known else 0):
            left, _, right = np.linalg.svd(projected.T @ np.where(projected @ turn >= 0, 1.0, -1.0))
            turn = left @ right
        found.append(axes @ turn)
    return mean, np.concatenate(found, axis=1)[:, :bits]


def codes_of(units: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers, as many a row as the projection has bits for."""
    return np.packbits((units - mean) @ projection >= 0, axis=1).view(">u8").astype(np.uint64)


def unit_vectors(values: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that squares neither overflow nor vanish."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _rows(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``dim``, ``vec`` (bytes of its numbers, null where it cannot be compared), ``digest``."""
    element = frame.schema[vector_col].dataType
    single = isinstance(element, T.ArrayType) and isinstance(element.elementType, T.FloatType)
    kind = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, vectors, dims = batch.column("vec"), [], []
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)  # null numbers become NaN
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy())
            for end, size in zip(ends, np.diff(ends, prepend=0)):
                vector = flat[end - size:end] + kind(0)  # one zero only
                good = size > 0 and bool(np.isfinite(vector).all()) and bool(vector.any())
                vectors.append(vector.tobytes() if good else None)
                dims.append(size)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
                                             names=["vec_id", "dim", "vec"])

    wanted = frame.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast(f"array<{'float' if single else 'double'}>").alias("vec"))
    read = wanted.mapInArrow(run, "vec_id long, dim int, vec binary")
    return read.withColumn("digest", F.unhex(F.md5("vec")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a column of bytes that have the same number of values."""
    raw = b"".join(column.to_pylist())
    kind = np.float32 if len(raw) == 4 * dim * len(column) else np.float64
    return unit_vectors(np.frombuffer(raw, kind).reshape(len(column), dim))


def _models(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A rotation for each length of vectors in the sample, which has about ``SAMPLE_VECTORS`` of all different vectors."""
    found = classes.agg(F.count("*"), F.max("dim")).first()
    if not found[0]:
        return {}
    wanted = min(SAMPLE_VECTORS, max(1, SAMPLE_VALUES // found[1]))
    share = min(1.0, wanted / found[0])
    # Chosen by the content of the vectors, so alike however the table is stored; its size is bounded by the share.
    dealt = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = classes.where(dealt).select("dim", "vec").toArrow()
    dims, models = sample.column("dim").to_numpy(), {}
    order = sample.column("vec").combine_chunks() if len(dims) else None
    for dim in np.unique(dims).tolist():
        vectors = sorted(order.filter(pa.array(dims == dim)).to_pylist())
        models[dim] = learn(_matrix(pa.array(vectors, pa.binary()), dim), dim)
    return models


def _coded(classes: DataFrame) -> DataFrame:
    """``classes`` with their ``code`` and ``long_code``."""
    models = _models(classes)
    names = [*classes.columns, "code", "long_code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            codes = np.zeros((len(dims), (BITS + LONG_BITS) // 64), np.uint64)
            for dim in np.unique(dims).tolist():
                here = dims == dim
                model = models.get(dim) or learn(np.zeros((0, dim)), dim)
                codes[here] = codes_of(_matrix(batch.column("vec").filter(pa.array(here)), dim), *model)
            long = pa.array([row.tobytes() for row in codes[:, 1:]], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes[:, 0].view(np.int64)), long], names=names)

    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, T.StructField("code", T.LongType()),
                                                 T.StructField("long_code", T.BinaryType())]))


def _entries(coded: DataFrame, unit_rows: int) -> DataFrame:
    """``node``, ``code`` in every unit it belongs to: its own region of each table and those one bit away."""
    choice = F.col("choice")
    slot = F.floor(choice / (HALF + 1)).cast("int")
    flip = (choice % (HALF + 1)).cast("int")
    shift = (F.lit(KEY_BITS) * slot + HALF).cast("int")
    own = F.call_function("shiftrightunsigned", F.col("code"), shift).bitwiseAND(F.lit((1 << HALF) - 1))
    bit = F.when(flip == 0, F.lit(0)).otherwise(F.call_function("shiftleft", F.lit(1), flip - 1))
    spread = coded.select("dim", "node", "code", F.explode(F.sequence(F.lit(0), F.lit(TABLES * (HALF + 1) - 1))).alias("choice"))
    spread = spread.select("dim", "node", "code", slot.alias("slot"), own.bitwiseXOR(bit.cast("long")).cast("int").alias("region"))
    # At most 1,024 units a vector length, so the list of large ones can go to every task.
    large = spread.groupBy("dim", "slot", "region").agg(F.ceil(F.count("*") / unit_rows).alias("parts")).where("parts > 1")
    dealt = spread.join(F.broadcast(large), ["dim", "slot", "region"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = dealt.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.select("dim", "slot", "region", F.least("part", "other").cast("int").alias("part_a"),
                        F.greatest("part", "other").cast("int").alias("part_b"), F.col("part").cast("int"), "node", "code")


def _lookups(low: np.ndarray, xs: np.ndarray, ys: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y), some ``PAIRS`` at a time, whose lower halves differ in at most ``radius`` bits."""
    masks = [m for m in range(1 << HALF) if m.bit_count() <= radius]
    ys = ys[np.argsort(low[ys], kind="stable")]
    starts = np.searchsorted(low[ys], np.arange((1 << HALF) + 1))
    asked = (low[xs][:, None] ^ np.array(masks)[None, :]).ravel()
    sizes = starts[asked + 1] - starts[asked]
    upto = np.cumsum(sizes)
    done = 0
    while done < len(asked):
        before = upto[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(upto, before + PAIRS, "right")))
        some = sizes[done:stop]
        within = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield (np.repeat(xs[np.arange(done, stop) // len(masks)], some), ys[np.repeat(starts[asked[done:stop]], some) + within])
        done = stop


def _meet(keys_a: np.ndarray, keys_b: np.ndarray) -> np.ndarray:
    differing = keys_a ^ keys_b
    return (np.bitwise_count(differing) <= NEAR) & (np.bitwise_count(differing >> HALF) <= NEAR_HIGH)


def candidates(codes: np.ndarray, long_codes: np.ndarray | None, parts: np.ndarray, slot: int, region: int,
               crossing: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs that a unit compares; pairs of one part, or of two where the unit is ``crossing``."""
    keys = [((codes >> np.uint64(KEY_BITS * s)) & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64) for s in range(slot + 1)]
    high, low = keys[slot] >> HALF, keys[slot] & ((1 << HALF) - 1)
    own, away, above = (np.flatnonzero(w) for w in (high == region, high != region, high > region))
    # Upper halves that are equal, one bit apart (taken at the smaller one), and two apart with this region between them.
    for xs, ys, radius in ((own, own, NEAR), (own, above, NEAR - 1), (away, away, NEAR - 2)):
        for a, b in _lookups(low, xs, ys, radius):
            keep = np.bitwise_count(codes[a] ^ codes[b]) <= NEAR_CODE
            if xs is ys:
                keep &= a < b
            a, b = a[keep], b[keep]
            keep = (parts[a] != parts[b]) == crossing
            if xs is away:
                differing = high[a] ^ high[b]
                lowest = differing & -differing
                keep &= (differing > 0) & (np.minimum(high[a] ^ lowest, high[b] ^ lowest) == region)
            for earlier in keys[:slot]:
                keep &= ~_meet(earlier[a], earlier[b])
            if long_codes is not None:
                apart = np.bitwise_count(long_codes[a] ^ long_codes[b]).sum(axis=1)
                keep &= apart + np.bitwise_count(codes[a] ^ codes[b]) <= NEAR_LONG
            if keep.any():
                yield a[keep], b[keep]


def _candidates_of(key: tuple, rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    _, slot, region, part_a, part_b = (k.as_py() for k in key)
    codes, long_codes = rows.column("code").to_numpy().view(np.uint64), None
    if "long_code" in rows.column_names:
        long_codes = np.frombuffer(b"".join(rows.column("long_code").to_pylist()), np.uint64).reshape(len(rows), -1)
    return candidates(codes, long_codes, rows.column("part").to_numpy(), slot, region, part_a != part_b)


def _members(key: tuple, rows: pa.Table) -> pa.Table:
    """The rows of a unit that have a candidate in it."""
    met = np.zeros(len(rows), bool)
    for a, b in _candidates_of(key, rows):
        met[a] = met[b] = True
    return rows.filter(pa.array(met)).select([*_UNIT, "part", "node", "code"])


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place each place is linked to, directly or not."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linker(threshold: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Of each vector of a unit: the rows linked to it here, and one vector it is connected with."""
        vectors = _matrix(rows.column("vec").combine_chunks(), key[0].as_py())
        copies, counts = rows.column("copies").to_numpy(), np.zeros(len(rows), np.int64)
        ends_a, ends_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in _candidates_of(key, rows):
            step = max(1, SAMPLE_VALUES // vectors.shape[1])
            for i in range(0, len(a), step):
                x, y = a[i:i + step], b[i:i + step]
                near = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= threshold
                x, y = x[near], y[near]
                counts += np.bincount(x, copies[y], len(rows)).astype(np.int64) + np.bincount(y, copies[x], len(rows)).astype(np.int64)
                ends_a.append(x)
                ends_b.append(y)
        nodes = rows.column("node").to_numpy()
        label = _labels(len(rows), np.concatenate(ends_a), np.concatenate(ends_b))
        linked = counts > 0
        return pa.table({"node": nodes[linked], "to": nodes[label][linked], "n": counts[linked]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    unit_rows: int = UNIT_ROWS) -> DataFrame:
    """``vec_id``, ``n_links`` other rows at a cosine of ``threshold`` or more, ``component_id``, ``kept`` for every row.

    ``component_id`` is the smallest id reachable over links, itself included, and ``kept`` tells whether it is the row's
    own. A vector that is null, empty or zero, or holds nulls or numbers that are not finite, links with nothing, and
    vectors of different lengths do not link. Rows of equal vectors are one vector with copies while links are sought;
    each counts the others. Rows repeating an id are each returned. A row without an id counts and connects, but
    names no component: that is null where no row has an id, and such rows are kept.
    """
    rows = materialize(_rows(vectors, id_col, vector_col), "vectors")
    equal = rows.where("vec is not null").groupBy("digest", "dim", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    numbered = materialize(_coded(equal).withColumn("node", F.monotonically_increasing_id()), "codes")
    units = _entries(numbered.select("dim", "node", "code"), unit_rows).groupBy(*_UNIT)
    unit_schema = ", ".join(f"{c} int" for c in [*_UNIT, "part"]) + ", node long, code long"
    members = materialize(units.applyInArrow(_members, unit_schema), "members")
    closer = members.join(numbered.select("node", "long_code"), "node").groupBy(*_UNIT)
    members = materialize(closer.applyInArrow(_members, unit_schema), "members")
    told = members.join(numbered.select("node", "vec", "copies", "long_code"), "node")
    links = materialize(told.groupBy(*_UNIT).applyInArrow(_linker(threshold), "node long, to long, n long"), "links")
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    reached = components(links.select(F.col("node").alias("a"), F.col("to").alias("b")))
    joined = numbered.select("node", "digest", "copies", "least").join(counts, "node", "left").join(reached, "node", "left")
    joined = materialize(joined.withColumn("component", F.coalesce("component", "node")), "components")
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    found = joined.join(named, "component").select(
        "digest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    # Rows that cannot be compared have no digest and keep out of the join.
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    answers = rows.where("digest is not null").join(found, "digest").select("vec_id", "n_links", "component_id").unionByName(alone)
    return answers.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
