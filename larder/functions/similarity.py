"""String similarity on a 0-100 scale.

``levenshtein_ratio`` and ``shared_tokens`` are built-in expressions. The ratios
based on the longest common subsequence have no built-in equivalent; they run on
whole Arrow batches in NumPy, and only on candidate pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: Strands of a part of a batch that are worked on together.
BRAID_CELLS = 400_000

METHODS = ("ratio", "partial_ratio", "partial_token_sort_ratio", "partial_token_set_ratio", "levenshtein")


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, F.round(100 * (1 - F.levenshtein(a, b) / longest)).cast("int")).otherwise(100)


def tokens(c: Column) -> Column:
    """Whitespace-separated tokens; blank text has none."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def shared_tokens(a: Column, b: Column) -> Column:
    return F.coalesce(F.size(F.array_intersect(tokens(a), tokens(b))), F.lit(0))


def sorted_words(c: Column) -> Column:
    """Lower-cased words in alphabetical order; punctuation separates words."""
    return F.sort_array(tokens(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " ")))


def comparable(c: Column, method: str) -> Column:
    """The form of a text on which ``method`` is computed."""
    if method == "partial_token_sort_ratio":
        return F.array_join(sorted_words(c), " ")
    if method == "partial_token_set_ratio":
        return F.array_join(F.array_distinct(sorted_words(c)), " ")
    return c


def keep_content_words(c: Column, ignore: tuple[str, ...]) -> Column:
    """Drop words that do not name a product (colours, sizes, ...)."""
    if not ignore:
        return c
    return F.array_join(F.filter(tokens(c), lambda t: ~F.lower(t).isin(*ignore)), " ")


def _codes(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points, one text a column, filled up with ``pad``; and the lengths."""
    sizes = np.array([len(t) for t in texts], np.int64)
    table = np.full((int(sizes.max(initial=0)), len(texts)), pad, np.int32)
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[place, np.repeat(np.arange(len(texts)), sizes)] = letters
    return table, sizes


def _braids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every column pair of ``a`` and ``b``: where the strand that ends below each place of ``b`` began.

    One sweep over the diagonals of the comparison matrix serves all stretches of ``b``: the longest common
    subsequence of ``a`` with ``b[i:j]`` is j - i less the strands that begin at i or later and end before j.
    Strands entering beside ``a`` have negative numbers. Two strands that met before do not cross again, nor
    do they where letters are equal.
    """
    rows, kind = len(a), np.int16 if len(a) + len(b) < 1 << 15 else np.int32
    across = np.repeat(np.arange(-rows, 0, dtype=kind)[:, None], a.shape[1], axis=1)
    down = np.repeat(np.arange(len(b), dtype=kind)[:, None], a.shape[1], axis=1)
    upward = a[::-1]
    for shift in range(1 - rows, len(b)):
        first, last = max(0, -shift), min(rows, len(b) - shift)
        h, v = across[first:last], down[first + shift:last + shift]
        turn = (upward[first:last] == b[first + shift:last + shift]) | (h > v)
        h[:], v[:] = np.where(turn, v, h), np.where(turn, h, v)
    return down


def _whole(began: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Scores of whole texts, the braids' side having ``other`` letters."""
    inside = np.arange(len(began))[:, None] < other
    common = other - ((began >= 0) & inside).sum(axis=0)
    return np.rint(200 * common / (size + other))


def _best_window(began: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Scores of the best stretch of ``size`` letters."""
    ends, pairs = np.nonzero((began >= 0) & (np.arange(len(began))[:, None] < other))
    # A strand is missing in the windows that begin after its end less the width, and not after its own beginning.
    first, last = np.maximum(0, ends - size[pairs] + 1), began[ends, pairs].astype(np.int64)
    held = first <= last
    shape = (len(began) + 1, began.shape[1])
    change = (np.bincount(first[held] * shape[1] + pairs[held], minlength=shape[0] * shape[1])
              - np.bincount((last[held] + 1) * shape[1] + pairs[held], minlength=shape[0] * shape[1])).reshape(shape)
    missing = np.where(np.arange(shape[0])[:, None] <= other - size, np.cumsum(change, axis=0), shape[0])
    return np.rint(100 * (size - missing.min(axis=0)) / size)


def _scored(left: np.ndarray, right: np.ndarray, windows: bool) -> np.ndarray:
    """Scores of pairs of texts, pairs of like lengths together so that little is filled up."""
    sizes = np.array([(len(a), len(b)) for a, b in zip(left, right)], np.int64).reshape(-1, 2)
    found = np.where(sizes.max(axis=1, initial=0) == 0, 100, 0).astype(np.int32)
    some = np.flatnonzero(sizes.min(axis=1, initial=1 << 62) > 0)
    swap = sizes[some, 0] > sizes[some, 1]
    short, long = np.where(swap, right[some], left[some]), np.where(swap, left[some], right[some])
    sizes = np.sort(sizes[some], axis=1)
    order, start = np.lexsort((sizes[:, 0], sizes[:, 1])), 0
    while start < len(order):
        widest = sizes[order[start:], 1]
        # At most about BRAID_CELLS strands; lengths ascend, so the last pair of a part is its longest.
        fits = np.arange(1, len(widest) + 1) * 2 * widest <= BRAID_CELLS
        part = order[start:start + max(1, int(np.argmin(fits)) if not fits.all() else len(fits))]
        a, size = _codes(short[part].tolist(), -1)
        b, other = _codes(long[part].tolist(), -2)
        found[some[part]] = (_best_window if windows else _whole)(_braids(a, b), size, other)
        start += len(part)
    return found


def _share_word(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the texts of a pair have a word in common."""
    sides = []
    words: dict[str, int] = {}
    for texts in (left, right):
        codes, distinct = pd.factorize(texts)
        numbers = [[words.setdefault(w, len(words)) for w in t.split()] for t in distinct]
        sizes = np.array([len(n) for n in numbers], np.int64)
        flat, starts = np.array([i for n in numbers for i in n], np.int64), np.cumsum(sizes) - sizes
        each = sizes[codes]
        place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        sides.append((np.repeat(np.arange(len(texts)), each), flat[np.repeat(starts[codes], each) + place]))
    (pair_a, word_a), (pair_b, word_b) = sides
    width = max(1, len(words))
    both = np.isin(pair_a * width + word_a, pair_b * width + word_b)
    return np.bincount(pair_a[both], minlength=len(left)) > 0


def _letter_counts(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each text in a table of letter counts of the distinct texts; letters share 64 columns."""
    codes, distinct = pd.factorize(texts)
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) & 63 for t in distinct]
    return codes, np.array([np.bincount(p, minlength=64) for p in points]).reshape(-1, 64)


def _score_limits(left: np.ndarray, right: np.ndarray, windows: bool) -> np.ndarray:
    """No pair can score more: letters in common, whatever their order, over the letters compared."""
    (a_row, a), (b_row, b) = _letter_counts(left), _letter_counts(right)
    common = np.minimum(a[a_row], b[b_row]).sum(axis=1)
    a_size, b_size = a.sum(axis=1)[a_row], b.sum(axis=1)[b_row]
    compared = np.minimum(a_size, b_size) if windows else (a_size + b_size) / 2
    return np.where(compared > 0, 100 * common / np.maximum(compared, 0.5), 100)


def _sorted_words(texts: np.ndarray) -> np.ndarray:
    codes, distinct = pd.factorize(texts)
    return np.array([" ".join(sorted(set(t.split()))) for t in distinct], object)[codes]


def batch_scores(left: Sequence[str], right: Sequence[str], method: str, threshold: int = 0) -> np.ndarray:
    """Scores of pairs of texts in ``comparable`` form; one below the threshold may be given as 0.

    ``ratio`` is twice the longest common subsequence over both lengths. The other methods take the best stretch
    of the longer text that is as long as the shorter, in the token set method after a check for a shared
    word, which scores 100. Whole batches are settled by letter counts first; no step works pair by pair.
    """
    left, right = np.array(left, object), np.array(right, object)
    windows = method != "ratio"
    found = np.zeros(len(left), np.int32)
    if method == "partial_token_set_ratio":
        found[_share_word(left, right)] = 100
        left, right = _sorted_words(left), _sorted_words(right)
    todo = np.flatnonzero((found == 0) & (_score_limits(left, right, windows) >= threshold - 0.5))
    found[todo] = _scored(left[todo], right[todo], windows)
    return found


def score(a: Column, b: Column, method: str, threshold: int = 0) -> Column:
    """Score two texts already in ``comparable`` form; a score below the threshold may be given as 0."""
    if method == "levenshtein":
        return levenshtein_ratio(a, b)

    @F.pandas_udf("int")
    def batched(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in parts:
            yield pd.Series(batch_scores(left.to_numpy(), right.to_numpy(), method, threshold))

    return batched(a, b)


def match_score(a: Column, b: Column, method: str = "partial_token_sort_ratio", threshold: int = 80) -> Column:
    """Score of two texts, 0 when below the threshold or when either is missing."""
    value = score(comparable(F.coalesce(a, F.lit("")), method), comparable(F.coalesce(b, F.lit("")), method), method, threshold)
    return F.when(a.isNotNull() & b.isNotNull() & (value >= threshold), value).otherwise(0)
