"""Alignment of two tokenizers over the same bytes: groups, overlaps and how often two ids overlap.

Tokenizer A is byte-level (a ``.json`` of the tokenizers library) and reads a space and the text; B is a
SentencePiece model, which adds that space itself. The tokens of both then cover the same bytes. In a batch
each token start finds the token of the other side that covers it, by ``pandas.merge_asof`` keyed by document;
the union of both directions is every overlapping pair, as the later of two overlapping tokens starts inside
the other. Equal ends cut the tokens into groups.

Counts over the corpus are gathered without a row per link. A batch of about four million characters is one
stored row: the id pairs that occur in it with their counts, and for every link the place of its pair in that
list. Pairs are added up over the corpus, joined back to the batches' lists, and each batch is finished from
its own list.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.rows import int_lists, pieces, select_as
from larder.session import materialize

#: Texts are aligned in parts of about this many characters, and merged in runs of about this many tokens.
PART_CHARS = 500_000
RUN_TOKENS = 500_000
#: Characters of one stored batch.
BATCH_CHARS = 4_000_000
_BATCH_BITS = 33
_EMPTY = np.zeros(0, np.int64)


class Aligned(NamedTuple):
    """Tokens of a part, documents one after the other; documents without tokens have none in any array."""

    n_a: np.ndarray  # tokens of each document
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray
    group_a: np.ndarray  # running number of each token's group in the part
    group_b: np.ndarray
    link_a: np.ndarray  # places of linked tokens in ids_a and ids_b, by the first byte they share
    link_b: np.ndarray


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: The split that byte-level tokenizer files mean by ``use_regex``. Fixed value.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranked(a_json: str, table: list[bytes]):
    """The encoder of tiktoken for a plain byte-level file whose ids ascend in the order of its merges; None for others.

    It gives the same ids in a quarter of the time. Special tokens are left out, so their strings are plain text.
    """
    file = json.loads(a_json)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not file.get("normalizer") and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    merged = ["".join(m.split(" ")) if isinstance(m, str) else "".join(m) for m in model["merges"]] if plain else []
    ids = [model["vocab"][m] for m in merged]
    ranks = {token: i for i, token in enumerate(table) if token}
    singles = [ranks.get(bytes([b])) for b in range(256)]
    if not plain or None in singles or sorted(ids) != ids or min(ids, default=256) <= max(singles) or len(ranks) != 256 + len(set(ids)):
        return None
    import tiktoken

    return tiktoken.Encoding("byte-level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers, and the bytes each of their ids stands for."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        letters, words = _byte_letters(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            # Special tokens, which plain text never becomes, stand for nothing.
            self.bytes_a[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else b""
        for i in self.a.get_added_tokens_decoder():
            self.bytes_a[i] = b""
        self.ranked = _ranked(a_json, self.bytes_a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        piece = self.b.id_to_piece
        self.bytes_b = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none for a text that is empty or that either side does not give back byte by byte."""
        asked = [" " + t for t in texts]
        if self.ranked:
            left = [self.ranked.encode_ordinary(t) for t in asked]
        else:
            left = [e.ids for e in self.a.encode_batch_fast(asked, add_special_tokens=False)]
        right = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(asked):
            want = text.encode()
            # The ranked encoder only ever joins the bytes of the text.
            same = bool(texts[i]) and (self.ranked is not None or want == b"".join(map(self.bytes_a.__getitem__, left[i])))
            if not same or want != b"".join(map(self.bytes_b.__getitem__, right[i])):
                left[i], right[i] = [], []
        return left, right

    def align(self, texts: list[str]) -> Aligned:
        left, right = self._encode(texts)
        n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in (left, right))
        ids_a, ids_b = (np.array([i for ids in side for i in ids], np.int64) for side in (left, right))
        # Bytes are counted through the part, so both sides of every document start and end at the same byte.
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        docs = np.arange(len(texts))
        doc_a, doc_b = np.repeat(docs, n_a), np.repeat(docs, n_b)
        link_a, link_b = self._overlaps(ends_a - self.sizes_a[ids_a], ends_b - self.sizes_b[ids_b], doc_a, doc_b, ends_a, ends_b, shared)
        n_groups = np.bincount(doc_a[np.searchsorted(ends_a, shared)], minlength=len(texts))
        return Aligned(n_a, n_b, n_groups, np.bincount(doc_a[link_a], minlength=len(texts)), ids_a, ids_b, group_a, group_b, link_a, link_b)

    @staticmethod
    def _overlaps(start_a, start_b, doc_a, doc_b, ends_a, ends_b, shared) -> tuple[np.ndarray, np.ndarray]:
        """Places of overlapping tokens, merged in runs that end at a shared end."""
        found_a, found_b, low_a, low_b = [_EMPTY], [_EMPTY], 0, 0
        while low_a < len(start_a):
            wanted = ends_a[min(low_a + RUN_TOKENS, len(ends_a)) - 1]
            cut = shared[np.searchsorted(shared, wanted)]
            high_a, high_b = np.searchsorted(ends_a, cut) + 1, np.searchsorted(ends_b, cut) + 1
            a = pd.DataFrame({"start": start_a[low_a:high_a], "doc": doc_a[low_a:high_a]})
            b = pd.DataFrame({"start": start_b[low_b:high_b], "doc": doc_b[low_b:high_b]})
            cover_a = pd.merge_asof(a, b.assign(token=np.arange(low_b, high_b)), on="start", by="doc")["token"].to_numpy(np.int64)
            cover_b = pd.merge_asof(b, a.assign(token=np.arange(low_a, high_a)), on="start", by="doc")["token"].to_numpy(np.int64)
            # Tokens that start together find each other from both sides.
            new = start_a[cover_b] != start_b[low_b:high_b]
            # Both directions are in order of the first shared byte: merge them.
            after_a = np.arange(low_a, high_a) - low_a + np.searchsorted(start_b[low_b:high_b][new], start_a[low_a:high_a])
            after_b = np.ones(len(after_a) + np.count_nonzero(new), bool)
            after_b[after_a] = False
            for found, direct, reverse in ((found_a, np.arange(low_a, high_a), cover_b[new]), (found_b, cover_a, np.arange(low_b, high_b)[new])):
                merged = np.empty(len(after_b), np.int64)
                merged[after_a], merged[after_b] = direct, reverse
                found.append(merged)
            low_a, low_b = high_a, high_b
        return np.concatenate(found_a), np.concatenate(found_b)

    @property
    def written(self) -> tuple[list[bytes], int]:
        """Ids as text with what may follow them, and where those of B begin: A's before ``,`` or ``|``, B's before ``,`` or ``;``."""
        table = [b"%d%s" % (i, end) for i in range(len(self.bytes_a)) for end in (b",", b"|")]
        return table + [b"%d%s" % (i, end) for i in range(len(self.bytes_b)) for end in (b",", b";")], len(table)


@lru_cache(maxsize=2)
def _aligner(a_json: str, b_model: bytes) -> tuple[Aligner, list[bytes], int]:
    aligner = Aligner(a_json, b_model)
    return aligner, *aligner.written


def _edges(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([_EMPTY, [0], np.cumsum(counts)])


def _last_of_run(groups: np.ndarray) -> np.ndarray:
    return np.append(groups[1:] != groups[:-1], True)[:len(groups)]


def _group_digests(found: Aligned, table: list[bytes], first_b: int) -> list[str]:
    """Of each document, the SHA-256 of its groups written as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    codes = np.zeros(len(found.ids_a) + len(found.ids_b), np.int64)
    # In the written order a token comes after those of earlier groups, and one of B after A's of its own group.
    at_a = np.arange(len(found.ids_a)) + np.searchsorted(found.group_b, found.group_a, "left")
    at_b = np.arange(len(found.ids_b)) + np.searchsorted(found.group_a, found.group_b, "right")
    codes[at_a] = 2 * found.ids_a + _last_of_run(found.group_a)
    codes[at_b] = first_b + 2 * found.ids_b + _last_of_run(found.group_b)
    edges = _edges(found.n_a + found.n_b)
    texts = (b"".join(map(table.__getitem__, codes[a:b].tolist()))[:-1] for a, b in zip(edges, edges[1:]))
    return [hashlib.sha256(t).hexdigest() if t else "" for t in texts]


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the ids ``a_ids`` and ``b_ids``, the group number of every token (``a_groups``, ``b_groups``) and the
    places of linked tokens (``a_links[i]`` overlaps ``b_links[i]``), counted from 0 in each document.

    Every row is returned. Texts that are null, empty, or that the tokens of A or B do not give back byte by byte
    have no tokens. Special tokens written in a text are plain text.
    """
    names = ["a_ids", "b_ids", "a_groups", "b_groups", "a_links", "b_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_json, b_model)[0]
        for batch in batches:
            for part, texts in pieces(batch, "text", PART_CHARS):
                found = aligner.align(texts)
                by = [_edges(n) for n in (found.n_a, found.n_b, found.n_groups, found.n_links)]

                def cut(values: np.ndarray, edges: np.ndarray, base: np.ndarray | None = None) -> pa.Array:
                    return int_lists([values[a:b] - (0 if base is None else base[i]) for i, (a, b) in enumerate(zip(edges, edges[1:]))])

                a, b, groups, links = by
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), cut(found.ids_a, a), cut(found.ids_b, b), cut(found.group_a, a, groups),
                     cut(found.group_b, b, groups), cut(found.link_a, links, a), cut(found.link_b, links, b)],
                    names=["doc_id", *names])

    return select_as(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{name} array<int>" for name in names))


_PER_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
_BATCH_SCHEMA = ("batch long, " + ", ".join(f"{c} array<long>" for c in _PER_DOC)
                 + ", groups_sha256 array<string>, pair array<long>, n array<long>, links binary")


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers, all their lowest bytes first, compressed: most numbers are small."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _stored_batch(batch: int, rows: list[list], pairs: list[np.ndarray]) -> pa.RecordBatch:
    """One row: the pairs of a batch, the commonest first, and of every link the place of its pair."""
    distinct, places, counts = np.unique(np.concatenate([_EMPTY, *pairs]), return_inverse=True, return_counts=True)
    by_count = np.argsort(-counts, kind="stable")
    rank = np.empty(len(distinct), np.uint32)
    rank[by_count] = np.arange(len(distinct))
    cells = [[batch], *([[v for row in rows for v in row[k]]] for k in range(6)),
             [distinct[by_count]], [counts[by_count]], [_packed(rank[places])]]
    kinds = [pa.int64()] + [pa.list_(pa.int64())] * 5 + [pa.list_(pa.string())] + [pa.list_(pa.int64())] * 2 + [pa.binary()]
    names = ["batch", *_PER_DOC, "groups_sha256", "pair", "n", "links"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=names)


def _stored(docs: DataFrame, a_json: str, b_model: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, table, first_b = _aligner(a_json, b_model)
        width = len(aligner.bytes_b)
        number, rows, pairs, size = TaskContext.get().partitionId() << _BATCH_BITS, [], [], 0
        for batch in batches:
            for part, texts in pieces(batch, "text", PART_CHARS):
                found = aligner.align(texts)
                rows.append([part.column("doc_id").to_pylist(), found.n_a, found.n_b, found.n_groups, found.n_links,
                             _group_digests(found, table, first_b)])
                pairs.append(found.ids_a[found.link_a] * width + found.ids_b[found.link_b])
                size += sum(map(len, texts)) + len(texts)
                if size >= BATCH_CHARS:
                    yield _stored_batch(number, rows, pairs)
                    number, rows, pairs, size = number + 1, [], [], 0
        if rows:
            yield _stored_batch(number, rows, pairs)

    return materialize(docs.mapInArrow(run, _BATCH_SCHEMA), "aligned")


def _finish(key: tuple, batch: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one batch, from its links and the corpus counts of its pairs."""
    listed = batch.column("pair")[0].values.to_numpy(zero_copy_only=False)
    links = _unpacked(batch.column("links")[0].as_py())
    codes = pairs.column("pair").to_numpy()
    order = np.argsort(codes)
    places = order[np.searchsorted(codes, listed, sorter=order)] if len(listed) else order
    count = pairs.column("total").to_numpy()[places][links]
    best = pairs.column("best").to_numpy()[places][links]
    edges = _edges(batch.column("n_links")[0].values.to_numpy(zero_copy_only=False))
    sums = [np.diff(np.concatenate([_EMPTY, [0], np.cumsum(v, dtype=np.int64)])[edges]) for v in (best, count)]
    plain = [batch.column(c)[0].values for c in _PER_DOC]
    return pa.Table.from_arrays([*plain, *map(pa.array, sums), batch.column("groups_sha256")[0].values],
                                names=[*_PER_DOC, "n_best", "count_sum", "groups_sha256"])


def pair_counts(stored: DataFrame, width: int) -> DataFrame:
    """``pair`` (A's id times ``width`` plus B's id), ``total`` links over the corpus, ``best`` 1 where no pair of that B id has more."""
    listed = stored.select(F.explode(F.arrays_zip("pair", "n")).alias("p"))
    totals = listed.groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.n").alias("total"))
    # One window partition has the A ids seen with a B id: at most A's vocabulary.
    most = F.max("total").over(Window.partitionBy(F.col("pair") % width))
    return totals.withColumn("best", (F.col("total") == most).cast("long"))


def statistics(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_a``, ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``count_sum`` adds, over the links, how many links of the whole table join the same two ids; ``n_best`` counts the
    links whose ids no other A id beats with that B id (ties are best too). Texts without tokens (null, empty, or not
    given back byte by byte) have zeros and an empty digest. Rows repeating an id are each returned, null ids too;
    an empty table gives no rows.
    """
    aligner = _aligner(a_json, b_model)[0]
    stored = _stored(select_as(docs, doc_id=id_col, text=text_col), a_json, b_model)
    totals = pair_counts(stored, len(aligner.bytes_b))
    asked = stored.select(F.col("batch").alias("of"), F.explode("pair").alias("pair")).join(totals, "pair")
    return stored.drop("n").groupBy("batch").cogroup(asked.groupBy("of")).applyInArrow(
        _finish, ", ".join(f"{c} long" for c in [*_PER_DOC, "n_best", "count_sum"]) + ", groups_sha256 string")
