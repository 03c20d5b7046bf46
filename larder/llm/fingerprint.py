"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every i, the sum of ``(c[j] + 1) * B**j`` over j < i, modulo
2**31 - 1, for two bases. Any two spans, of one text or of two, are equal if their differences of
prefix values agree after shifting one by a power of B; the longest common extension of two
positions is found by binary search over its length.

A fingerprint holds the hashes of consecutive spans that cover the whole text. They are cut where the
hash of the code points before says so, so that the same passage gives the same spans at any offset,
and their number grows with the text. Besides, it is the prefix array at the multiples of a power of
two, at most ``CELLS`` of them, and the hashes of the suffixes of the same lengths, for texts that are
too short for spans: the coarser grid of two is part of the finer.

Likeness is the part of the longer text that two fingerprints show in common: spans and grid cells that
agree and, by binary search on the grid, the common prefix and suffix. With the texts at hand, these are
anchors, and a second figure extends each to the longest run that agrees on either side of it, as it does
both ends of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.rows import append_columns, pieces, select_as

PRIME = 2**31 - 1
BASES = (1_234_567_891, 987_654_323)
#: Grid positions of a fingerprint, at most.
CELLS = 32
#: Cells of fewer code points agree by chance too often to count between prefix and suffix.
LEAST_CELL = 16
#: Code points whose hash decides on a cut after them, and one cut in how many places.
CUT_WINDOW, CUT_EVERY = 16, 64
#: Code points of a span, at least (the last one of a text aside) and at most.
LEAST_SPAN, MOST_SPAN = 16, 256

_SHIFT = np.uint64(31)
_PRIME = np.uint64(PRIME)


def _reduce(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, for x below 2**62 + 2**33."""
    x = (x & _PRIME) + (x >> _SHIFT)
    x = (x & _PRIME) + (x >> _SHIFT)
    return np.where(x >= _PRIME, x - _PRIME, x)


class _Powers:
    """Powers of a base and of its inverse, as far as any text has needed."""

    def __init__(self, base: int):
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.bases = [base, pow(base, -1, PRIME)]

    def upto(self, size: int) -> list[np.ndarray]:
        while len(self.tables[0]) <= size:
            for k, (base, table) in enumerate(zip(self.bases, self.tables)):
                self.tables[k] = np.concatenate((table, _reduce(table * np.uint64(pow(base, len(table), PRIME)))))
        return self.tables


_POWERS = [_Powers(b) for b in BASES]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """The prefix arrays of one text, one for each base."""

    def __init__(self, points: np.ndarray, head: PrefixHashes | None = None, shared: int = 0):
        """``head``: another text's arrays that hold for the first ``shared`` code points of this one too."""
        self.size, self.arrays = len(points), []
        tail = points[shared:].astype(np.uint64) + np.uint64(1)
        for k, powers in enumerate(_POWERS):
            up, _ = powers.upto(self.size)
            start = head.arrays[k][shared] if head else np.uint64(0)
            terms = _reduce(tail * up[shared:self.size])
            terms[:1] += start
            sums = np.cumsum(terms)  # below 2**31 times the length
            before = head.arrays[k][:shared + 1] if head else np.zeros(1, np.uint64)
            self.arrays.append(np.concatenate((before, _reduce(sums))))

    def span(self, start: int, stop: int) -> tuple[int, ...]:
        """Hash of ``[start, stop)``, the same wherever those code points stand."""
        found = []
        for array, powers in zip(self.arrays, _POWERS):
            inverse = powers.upto(self.size)[1]
            found.append((int(array[stop]) - int(array[start])) * int(inverse[start]) % PRIME)
        return tuple(found)

    def common_extension(self, at: int, other: PrefixHashes, other_at: int, back: bool = False) -> int:
        """How many code points agree from ``at`` here and ``other_at`` there: binary search over span equality.

        With ``back``, how many agree before them.
        """
        low, high = 0, min(at, other_at) if back else min(self.size - at, other.size - other_at)
        while low < high:
            middle = (low + high + 1) // 2
            here, there = (at - middle, other_at - middle) if back else (at, other_at)
            if self.span(here, here + middle) == other.span(there, there + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def cuts(self) -> list[int]:
        """Bounds of the spans, from 0 to the length; where they are depends on the code points near them only."""
        array, inverse = self.arrays[0], _POWERS[0].upto(self.size)[1]
        count = max(0, self.size - CUT_WINDOW)
        before = _reduce(_reduce(array[CUT_WINDOW:CUT_WINDOW + count] + _PRIME - array[:count]) * inverse[:count])
        found = [0]
        for cut in [*(np.flatnonzero(before % np.uint64(CUT_EVERY) == 0) + CUT_WINDOW).tolist(), self.size]:
            if cut - found[-1] > MOST_SPAN:
                found += range(found[-1] + MOST_SPAN, cut, MOST_SPAN)
            if cut - found[-1] >= LEAST_SPAN or cut == self.size > found[-1]:
                found.append(cut)
        return found

    def fingerprint(self) -> Fingerprint:
        step = 1
        while self.size > step * CELLS:
            step *= 2
        marks = np.arange(0, self.size + 1, step)
        heads, tails = [], []
        for array, powers in zip(self.arrays, _POWERS):
            inverse, starts = powers.upto(self.size)[1], self.size - marks
            heads.append(array[marks])
            tails.append(_reduce(_reduce(array[self.size] + _PRIME - array[starts]) * inverse[starts]))
        whole = [int(a[self.size]) for a in self.arrays]
        cuts = np.array(self.cuts())
        spans = [_reduce(_reduce(array[cuts[1:]] + _PRIME - array[cuts[:-1]]) * powers.upto(self.size)[1][cuts[:-1]])
                 for array, powers in zip(self.arrays, _POWERS)]
        return Fingerprint(self.size, step, whole, np.array(heads), np.array(tails), np.array([*spans, np.diff(cuts).astype(np.uint64)]), self)


class Fingerprint:
    """``heads[k][i]``: hash of the first ``i * step`` code points under base k; ``tails``: of the last.

    ``spans``: a row of hashes for each base, and the lengths. ``hashes``: the arrays of the text, while at hand.
    """

    def __init__(self, size: int, step: int, whole: list[int], heads: np.ndarray, tails: np.ndarray, spans: np.ndarray,
                 hashes: PrefixHashes | None = None):
        self.size, self.step, self.whole, self.heads, self.tails = size, step, whole, heads, tails
        self.spans, self.hashes = spans, hashes

    def __str__(self) -> str:
        """Length, hash of the whole text, both grids, and spans, in hexadecimal; equal for equal texts."""
        grids = [g[:, 1:].T.astype(">u4").tobytes().hex() for g in (self.heads, self.tails)]
        spans = self.spans.T.astype(">u4").tobytes().hex()
        return f"{self.size:x}:{self.whole[0]:08x}{self.whole[1]:08x}:{grids[0]}:{grids[1]}:{spans}"

    @staticmethod
    def parse(text: str) -> Fingerprint:
        size, whole, *grids = text.split(":")
        step = 1
        while int(size, 16) > step * CELLS:
            step *= 2
        spans = np.frombuffer(bytes.fromhex(grids.pop()), ">u4").reshape(-1, 3).T.astype(np.uint64)
        read = [np.frombuffer(bytes.fromhex(g), ">u4").reshape(-1, 2).T.astype(np.uint64) for g in grids]
        first = np.zeros((2, 1), np.uint64)
        return Fingerprint(int(size, 16), step, [int(whole[:8], 16), int(whole[8:], 16)],
                           *(np.concatenate((first, g), axis=1) for g in read), spans)

    def likeness(self, other: Fingerprint) -> float:
        """Share of the longer text that both fingerprints show in common, as they are written; 1 for equal texts, two empty ones too."""
        return self.compare(other)[0]

    def compare(self, other: Fingerprint) -> tuple[float, float]:
        """Likeness, and the same with every part shown extended to the longest run that agrees, if both texts' arrays are at hand."""
        if self.size == other.size and self.whole == other.whole:
            return 1.0, 1.0
        common = self._same_cells(other) + self._same_spans(other)
        shown = self._share(other, common)
        if not (self.hashes and other.hashes):
            return shown, shown
        return shown, self._share(other, _extended(self.hashes, other.hashes, common))

    def _share(self, other: Fingerprint, common: list[tuple[int, int, int]]) -> float:
        return min(_covered([(c[side], c[side] + c[2]) for c in common]) for side in (0, 1)) / max(self.size, other.size)

    def _same_cells(self, other: Fingerprint) -> list[tuple[int, int, int]]:
        """Where a grid cell agrees with the one at the same offset from the front or the back: both places, and its size."""
        step = max(self.step, other.step)
        count = min(self.size, other.size) // step
        agree = []
        for a, b in ((self.heads, other.heads), (self.tails, other.tails)):
            agree.append((a[:, :: step // self.step][:, :count + 1] == b[:, :: step // other.step][:, :count + 1]).all(axis=0))
        prefix, suffix = (_last_true(a) for a in agree)
        cells = [np.arange(count) < prefix, np.arange(count) < suffix]
        if step >= LEAST_CELL:
            cells[0] |= self._cells(other, "heads", step, count)
            cells[1] |= self._cells(other, "tails", step, count)
        front, back = (np.flatnonzero(c).tolist() for c in cells)
        return ([(i * step, i * step, step) for i in front]
                + [(self.size - (i + 1) * step, other.size - (i + 1) * step, step) for i in back])

    def _same_spans(self, other: Fingerprint) -> list[tuple[int, int, int]]:
        """Spans that agree, wherever they stand, the first with the first and so on: both places, and their size."""
        places: dict[tuple, list[int]] = {}
        for key, at in reversed(other._placed()):
            places.setdefault(key, []).append(at)
        return [(at, places[key].pop(), key[2]) for key, at in self._placed() if places.get(key)]

    def _placed(self) -> list[tuple[tuple, int]]:
        """Each span of at least ``LEAST_SPAN`` with its start."""
        rows = list(zip(*self.spans.tolist()))
        starts = [0, *np.cumsum(self.spans[2].astype(np.int64)).tolist()]
        return [(r, a) for r, a in zip(rows, starts) if r[2] >= LEAST_SPAN]

    def _cells(self, other: Fingerprint, grid: str, step: int, count: int) -> np.ndarray:
        """Which cells of the common grid agree, whatever stands before them."""
        agree = np.ones(count, bool)
        for k, powers in enumerate(_POWERS):
            found = []
            for f in (self, other):
                marks = getattr(f, grid)[k][:: step // f.step][:count + 1]
                # The hash of a longer suffix is its new cell's, plus the shorter suffix moved on by one cell.
                moved = marks[:-1] if grid == "heads" else _reduce(marks[:-1] * powers.upto(step)[0][step])
                found.append(_reduce(marks[1:] + _PRIME - moved))
            agree &= found[0] == found[1]
        return agree


def _last_true(agree: np.ndarray) -> int:
    """Binary search: ``agree`` is true up to some index, from 0 on, and false after it."""
    low, high = 0, len(agree) - 1
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if agree[middle] else (low, middle - 1)
    return low


def _extended(here: PrefixHashes, there: PrefixHashes, anchors: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The longest runs that agree around each anchor, and at both ends of the texts."""
    head = here.common_extension(0, there, 0)
    tail = here.common_extension(here.size, there, there.size, back=True)
    found = [(0, 0, head), (here.size - tail, there.size - tail, tail)]
    upto = {0: head}  # how far the runs found reach, for each distance between the places
    for at, other_at, size in sorted(anchors):
        if at + size <= upto.get(at - other_at, 0):
            continue
        before = here.common_extension(at, there, other_at, back=True)
        after = here.common_extension(at, there, other_at)
        found.append((at - before, other_at - before, before + after))
        upto[at - other_at] = at + after
    return found


def _covered(spans: list[tuple[int, int]]) -> int:
    """Code points in any of the spans."""
    total, upto = 0, 0
    for start, stop in sorted(spans):
        total += max(0, stop - max(start, upto))
        upto = max(upto, stop)
    return total


_ADDED = T.StructType([T.StructField("fingerprint", T.StringType())])


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` (replaced if there); null texts count as empty."""
    return append_columns(docs, text_col, _ADDED, lambda texts, part: [
        pa.array([str(PrefixHashes(code_points(t)).fingerprint()) for t in texts], pa.string())])


@F.udf(T.DoubleType(), useArrow=True)
def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1; null if either is null."""
    return None if a is None or b is None else Fingerprint.parse(a).likeness(Fingerprint.parse(b))


def edited(points: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, int]:
    """The text with its last quarter replaced from the start of the following one, and how much of it is its own."""
    own = len(points) - len(points) // 4
    return np.concatenate((points[:own], following[:len(points) // 4])), own


_COMPARED = ("doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, "
             "near_next double, near_edited_extended double, near_next_extended double")


def _text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "replace")


class _Side:
    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.points = doc_id, code_points(text)
        self.hashes = PrefixHashes(self.points)
        self.fingerprint = self.hashes.fingerprint()


def _row(this: _Side, following: _Side | None) -> tuple:
    points, own = edited(this.points, following.points if following else this.points[:0])
    changed = PrefixHashes(points, this.hashes, own).fingerprint()
    to_edited = this.fingerprint.compare(changed)
    to_next = this.fingerprint.compare(following.fingerprint) if following else (None, None)
    return (this.doc_id, len(this.points), _text(points), str(this.fingerprint), str(changed), to_edited[0], to_next[0], to_edited[1], to_next[1])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part, own ones by id and then those borrowed from the next part; each own row meets the one after it."""
    held, part_of_held = None, None
    names = [c.split()[0] for c in _COMPARED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.float64()] * 4
    schema = pa.schema(list(zip(names, kinds)))
    for batch in batches:
        for piece, texts in pieces(batch, "text", 500_000):
            rows = []
            columns = (piece.column(c).to_pylist() for c in ("part", "borrowed", "doc_id"))
            for part, borrowed, doc_id, text in zip(*columns, texts):
                if doc_id is None:
                    rows.append(_row(_Side(None, text), None))
                    continue
                if held is None and borrowed:
                    continue
                side = _Side(doc_id, text)
                if held is not None:
                    if part != part_of_held:
                        raise RuntimeError("a part ended without the row that follows it")
                    rows.append(_row(held, side))
                held, part_of_held = (None, None) if borrowed else (side, part)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)


def _part(bounds: list[int]) -> Column:
    starts = np.array(bounds)

    @F.pandas_udf("int")
    def find(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.fillna(bounds[0]).to_numpy(np.int64), side="right") - 1).astype("int32")

    return find


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text, and both likenesses.

    ``near_edited`` and ``near_next`` are what the two fingerprints show; the columns ending in ``_extended`` count the
    longest runs of the texts that agree around what they show.

    The edited text replaces the last ``n_chars // 4`` code points by as many (or all) from the start
    of the next document in the order of ids, after the last one the first. Rows of one id follow
    one another in the order of their texts. Null texts are empty. A row without an id has no next
    document: its edited text only loses its end, and ``near_next`` is null. No rows give no rows.

    Rows are dealt by ranges of ids whose bounds are ids of the table, so the row after a range's last
    is known in advance: it is dealt to both ranges, and texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = select_as(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    low, middle = rows.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, 10_000)).first()
    bounds = sorted({low, *(middle or [])}) if low is not None else [0]
    part = _part(bounds)
    no_id = F.pmod(F.hash("text"), F.lit(len(bounds)))
    own = rows.select(F.when(F.col("doc_id").isNull(), no_id).otherwise(part("doc_id")).alias("part"), F.lit(False).alias("borrowed"), "doc_id", "text")
    first = rows.where(F.col("doc_id").isin(bounds))
    borrowed = first.select(F.pmod(part("doc_id") - 1, F.lit(len(bounds))).alias("part"), F.lit(True).alias("borrowed"),
                            "doc_id", "text")
    dealt = own.unionByName(borrowed).repartitionById(len(bounds), F.col("part"))
    return dealt.sortWithinPartitions("part", "borrowed", "doc_id", "text").mapInArrow(_compare, _COMPARED)
