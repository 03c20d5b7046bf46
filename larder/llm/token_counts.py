"""Exact token counts at every prefix of a text, for byte-level BPE with word ends.

A byte-pair encoding is fixed by its neighbours: a row of tokens is the encoding of its text exactly
if every two side by side are the encoding of theirs. So the last token of a prefix is the one that
ends there and gets on with the last token of the prefix before it, and a prefix has one token more
than that shorter prefix. Two rows are kept for each word: prefixes inside a word, and prefixes cut
off there, whose last token carries the word-end mark. Each distinct word of a task is worked out
once; a text's counts are the running sums over its words.

Text is cut into words as the tokenizer file says: NFC, lower case letter by letter, white space
dropped, runs of letters, single digits, runs of anything else, and the English contractions.
Strings of special tokens found in a text count as one token each.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.rows import append_columns, fresh, int_lists

#: Words a task remembers at least; beyond it those in use are carried over to a new memory.
REMEMBERED = 120_000
#: Pairs of tokens whose agreement a task remembers.
REMEMBERED_PAIRS = 400_000

# White space, contractions and word classes of the tokenizer file.
WHITE = "\t-\r \x85\xa0  -     　"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"

#: Below this code point, classes are spelt out for the faster of the two pattern libraries.
_PLAIN = 0x250


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN) if unicodedata.category(chr(c))[0] == kind)


_PLAIN_WORDS = re.compile(f"{CONTRACTIONS}|[{_class('L')}]+|[{_class('N')}]|[^{WHITE}{_class('L')}{_class('N')}]+")
_ASCII_WORDS = re.compile(f"{CONTRACTIONS}|[a-z]+|[0-9]|[^{WHITE}a-z0-9]+")
_BEYOND_PLAIN = re.compile(f"[^\0-{chr(_PLAIN - 1)}]")
_ANY_WORDS = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
_WHITE_POINTS = np.array([c for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c))])


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    strangers = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(strangers)) for b in range(256)]


def normalise(text: str) -> str:
    """NFC and lower case, each letter by itself; white space stays where it is."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def words(normal: str) -> list[str]:
    if normal.isascii():
        return _ASCII_WORDS.findall(normal)
    return (_ANY_WORDS if _BEYOND_PLAIN.search(normal) else _PLAIN_WORDS).findall(normal)


class PrefixCounter:
    """Token counts of all prefixes of words, from the vocabulary and merges of a tokenizer file."""

    def __init__(self, raw: str):
        spec = json.loads(raw)
        model = spec["model"]
        if spec["normalizer"].get("normalizers") != NORMALISERS or model["end_of_word_suffix"] != END \
                or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": SPLIT}:
            raise ValueError("this tokenizer file cuts text in another way than this counter")
        self.letters = byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.agree: dict[tuple[str, str], bool] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        for a, b in merges:
            self.halves.setdefault(a + b, (a, b))
        self.inner, self.last = {}, {}
        for token in [*self.letters, *(c + END for c in self.letters), *self.halves]:
            if self._stands(token):
                self._file(token)
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only plain special tokens are supported")
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, int] = {}
        self.former: dict[str, int] = {}

    @staticmethod
    def _symbols(token: str) -> list[str]:
        if not token.endswith(END):
            return list(token)
        body = token[:-len(END)]
        return [*body[:-1], body[-1] + END]

    def _stands(self, token: str) -> bool:
        """Whether the encoding of what a token spells is that token: its halves stand, and agree until they merge."""
        return token not in self.halves or self.merge(self._symbols(token)) == [token]

    def _file(self, token: str) -> None:
        """Keep a token where walking back from its end finds it; the empty key of a node holds the token."""
        node = self.last if token.endswith(END) else self.inner
        for letter in reversed(token.removesuffix(END)):
            node = node.setdefault(letter, {})
        node[""] = token

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging: the pair of the lowest rank first, leftmost of equals."""
        while len(symbols) > 1:
            ranked = [self.ranks.get(p) for p in zip(symbols, symbols[1:])]
            best = min((r for r in ranked if r is not None), default=None)
            if best is None:
                break
            i = ranked.index(best)
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2:]]
        return symbols

    def _edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """What stands at an edge of a token while it is merged, first to last, each with the rank of the merge that ends it."""
        chain, gone = [], float("inf")
        while True:
            chain.append((token, gone))
            halves = self.halves.get(token)
            if halves is None:
                return chain[::-1]
            gone, token = self.ranks[halves], halves[side]

    def side_by_side(self, a: str, b: str) -> bool:
        """Whether the two tokens are the encoding of what they spell together.

        They are unless, while both are merged, what stands at the right edge of ``a`` would merge with
        what stands at the left edge of ``b`` before either is used up on its own side.
        """
        known = self.agree.get((a, b))
        if known is not None:
            return known
        if len(self.agree) >= REMEMBERED_PAIRS:
            self.agree.clear()
        left, right, i, j, known = self._edge(a, 1), self._edge(b, 0), 0, 0, True
        while True:
            (x, x_gone), (y, y_gone) = left[i], right[j]
            rank = self.ranks.get((x, y))
            if rank is not None and rank < x_gone and rank <= y_gone:
                known = False
                break
            if i == len(left) - 1 and j == len(right) - 1:
                break
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1
        self.agree[a, b] = known
        return known

    def word(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, cut after 1, 2, ... code points."""
        if word[0] == "'" and len(word) == 3 and word[1:] in ("re", "ve", "ll"):
            # Cut short, a contraction is an apostrophe and a letter.
            mark, letter = self.whole("'"), self.whole(word[1])
            return [mark, mark + letter, self.whole(word)]
        spelt, counts, tails = self._inside(word)
        cuts = np.cumsum([len(c.encode()) for c in word]).tolist()
        return [self._last(spelt, end, tails, self.last, counts)[0] for end in cuts]

    def whole(self, word: str) -> int:
        spelt, counts, tails = self._inside(word)
        return self._last(spelt, len(spelt), tails, self.last, counts)[0]

    def _inside(self, word: str) -> tuple[str, list[int], list[str]]:
        """The word as the vocabulary spells it; tokens and last token of each prefix short of the word's end."""
        spelt = word if word.isascii() and word.isalnum() else "".join([self.letters[b] for b in word.encode()])
        counts, tails, inner = [0], [""], self.inner
        for end in range(1, len(spelt)):
            count, tail = self._last(spelt, end, tails, inner, counts)
            counts.append(count)
            tails.append(tail)
        return spelt, counts, tails

    def _last(self, spelt: str, end: int, tails: list[str], node: dict, counts: list[int]) -> tuple[int, str]:
        """Tokens of a prefix, and the last of them: it ends there and agrees with the one before."""
        agree, start = self.agree, end
        while True:
            start -= 1
            node = node[spelt[start]]
            token = node.get("")
            if token is None:
                continue
            if not start:
                return 1, token
            known = agree.get((tails[start], token))
            if known or known is None and self.side_by_side(tails[start], token):
                return counts[start] + 1, token

    def counts(self, found: list[str]) -> list[int]:
        """Tokens of each word of a text."""
        known, former = self.known, self.former
        if len(known) > REMEMBERED:
            self.former, self.known = known, {}
            known, former = self.known, self.former
        for word in set(found).difference(known):
            known[word] = former[word] if word in former else self.whole(word)
        return [known[w] for w in found]

    def prefixes(self, text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """For each word: where it ends (code points of the normalised text), tokens up to there, and the word."""
        ends, sizes, cut, shift, at = [np.zeros(0, np.int64)], [], [], 0, 0
        specials = list(self.special.finditer(text)) if self.special and "<|" in text else []
        for match in [*specials, None]:
            normal = normalise(text[at:match.start() if match else len(text)])
            found = words(normal)
            if found:
                ends.append(_ends(normal, found) + shift)
                sizes.extend(self.counts(found))
                cut.extend(found)
            shift += len(normal)
            if match:
                at = match.end()
                shift += len(match.group())
                ends.append(np.array([shift]))
                sizes.append(1)
                cut.append("")  # a special string is never cut
        return np.concatenate(ends), np.cumsum(np.array(sizes, np.int64)), cut

    def normal_form(self, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The normalised text, in which special strings stay as they are, and where these stand."""
        parts, spans, at, size = [], [], 0, 0
        specials = list(self.special.finditer(text)) if self.special and "<|" in text else []
        for match in [*specials, None]:
            parts.append(normalise(text[at:match.start() if match else len(text)]))
            size += len(parts[-1])
            if match:
                at = match.end()
                parts.append(match.group())
                spans.append((size, size + len(match.group())))
                size += len(match.group())
        return "".join(parts), spans

    def fit(self, text: str, budget: int, ends: np.ndarray, totals: np.ndarray) -> tuple[int, int]:
        """Code points and tokens of the longest prefix of the normalised text with at most ``budget`` tokens.

        ``ends`` and ``totals`` are those of ``prefixes``; only the word at the edge is encoded. White space after
        the last word that fits is left out; a special string is never cut.
        """
        fits = int(np.searchsorted(totals, budget, side="right"))
        at, used = (int(ends[fits - 1]), int(totals[fits - 1])) if fits else (0, 0)
        if fits < len(ends) and used < budget:
            normal, specials = self.normal_form(text)
            stop = int(ends[fits])
            left = words(normal[at:stop])
            if left and all(stop != end for _, end in specials):
                row = self.word(left[-1])
                cut = max((i + 1 for i, n in enumerate(row) if used + n <= budget), default=0)
                if cut:
                    return stop - len(row) + cut, used + row[cut - 1]
        return at, used


def _ends(normal: str, found: list[str]) -> np.ndarray:
    sizes = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    points = np.frombuffer(normal.encode("utf-32-le", "surrogatepass"), np.uint32)
    inked = np.flatnonzero(~(_IS_WHITE[np.minimum(points, len(_IS_WHITE) - 1)]))
    return inked[sizes - 1] + 1


_IS_WHITE = np.zeros(0x3002, bool)
_IS_WHITE[_WHITE_POINTS] = True


@lru_cache(maxsize=2)
def _counter(raw: str) -> PrefixCounter:
    return PrefixCounter(raw)


_COUNTED = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ends", T.ArrayType(T.IntegerType(), False)), T.StructField("counts", T.ArrayType(T.IntegerType(), False))])
_FITTED = T.StructType([T.StructField("fit_chars", T.LongType()), T.StructField("fit_tokens", T.LongType())])


def prefix_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and, per word, ``ends`` and ``counts``.

    ``counts[i]`` is the number of tokens of the text cut at code point ``ends[i]`` of its normalised
    form. ``tokenizer`` is the content of a tokenizer file. Null and empty texts have no words.
    Columns of these names are replaced.
    """

    def run(texts: list[str], part: pa.RecordBatch) -> list[pa.Array]:
        counter = _counter(tokenizer)
        sizes = [len(t.encode("utf-8", "replace")) for t in texts]
        found = [counter.prefixes(t)[:2] for t in texts]
        whole = [int(totals[-1]) if len(totals) else 0 for _, totals in found]
        return [pa.array(sizes, pa.int64()), pa.array(whole, pa.int64()), int_lists([e for e, _ in found]),
                int_lists([t for _, t in found])]

    return append_columns(docs, text_col, _COUNTED, run)


def fit_budget(docs: DataFrame, tokenizer: str, budget: int, text_col: str = "text", counted: bool = False) -> DataFrame:
    """``docs`` with ``fit_chars`` and ``fit_tokens`` of the longest prefix of at most ``budget`` tokens.

    Code points are those of the normalised text. The answer comes from the stored counts of ``prefix_counts``: with
    ``counted``, ``docs`` is what that returned and is not counted again for any further budget; otherwise it is
    counted here once. The words that fit are found by binary search, and of the text only the word at the edge is encoded.
    """
    ends, counts = ("ends", "counts") if counted else (fresh(docs, "_ends"), fresh(docs, "_counts"))
    if not counted:
        plain = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
        found = prefix_counts(plain, tokenizer)
        docs = found.select("row.*", F.col("ends").alias(ends), F.col("counts").alias(counts))

    def run(texts: list[str], part: pa.RecordBatch) -> list[pa.Array]:
        counter, rows = _counter(tokenizer), zip(texts, part.column(ends), part.column(counts))
        found = [counter.fit(t, budget, e.values.to_numpy(), n.values.to_numpy()) for t, e, n in rows]
        return [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]

    answered = append_columns(docs, text_col, _FITTED, run)
    return answered if counted else answered.drop(ends, counts)
