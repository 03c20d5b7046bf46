"""SentencePiece encoding and decoding that keeps track of where every piece came from.

The model file is read here: pieces with scores, the normaliser's switches and its compiled
character map. Normalising takes the longest prefix the map knows, replaces it and records for each
byte written the source byte it stands for; blanks become U+2581, which maps to the one byte of the
blank. Merging then works on chunks that no piece crosses, best score first and leftmost on ties, as
the model's byte-pair rule asks; each distinct chunk of a task is merged once and remembered. A
piece's span runs from the source of its first byte to that of the next piece's first byte.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.llm.rows import append_columns, int_lists

#: The mark that stands for a blank in pieces.
BLANK = "▁"
#: Chunks a task remembers at least; beyond it those in use are carried over to a new memory.
REMEMBERED = 250_000
#: What a pair costs that is no piece.
NEVER = float("inf")

# Piece types and model kind of the model file's format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message; sub-messages and floats as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, raw[at:at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes, then the replacements, each ended by a zero byte."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = compiled[4 + size:]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest_prefix(self, source: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest prefix of ``source[at:]`` in the map, and that prefix's bytes."""
        units, found = self.units, None
        node = self._offset(units[0])
        for end in range(at, len(source)):
            byte = source[end]
            node ^= byte
            unit = units[node]
            # A unit is reached only if it carries the byte that led to it.
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        value, length = found
        return self.replacements[value:self.replacements.index(b"\0", value)], length

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)


class PieceModel:
    """A byte-pair model with the normaliser it was made with."""

    def __init__(self, raw: bytes):
        self.texts: list[str] = []
        self.types: list[int] = []
        scores, self.kind, self.byte_fallback, self.unknown = [], 1, False, " ⁇ "
        self.dummy_prefix = self.remove_extra = self.escape = True
        compiled, suffix = b"", False
        for number, value in _fields(raw):
            if number == 1:
                entry = dict(_fields(value))
                self.texts.append(entry.get(1, b"").decode())
                scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                self.types.append(entry.get(3, NORMAL))
            elif number == 2:
                settings = dict(_fields(value))
                self.kind, self.byte_fallback, suffix = settings.get(3, 1), bool(settings.get(35, 0)), bool(settings.get(24, 0))
                self.unknown = settings[44].decode() if 44 in settings else self.unknown
            elif number == 3:
                settings = dict(_fields(value))
                compiled = settings.get(2, b"")
                self.dummy_prefix, self.remove_extra, self.escape = (bool(settings.get(n, 1)) for n in (3, 4, 5))
        if self.kind != BPE or suffix or not self.escape or {UNUSED, USER_DEFINED} & set(self.types):
            raise ValueError("only byte-pair models of normal pieces with escaped, leading blanks are supported")
        self.map = CharacterMap(compiled)
        self.ids = {t: i for i, t in enumerate(self.texts) if self.types[i] == NORMAL}
        self.costs = {t: -scores[i] for t, i in self.ids.items()}
        self.unknown_id = self.types.index(UNKNOWN)
        self.byte_ids = {int(t[3:5], 16): i for i, t in enumerate(self.texts) if self.types[i] == BYTE}
        # A blank starts a chunk unless some piece holds one after another character.
        if any(BLANK in t.lstrip(BLANK) for t in self.ids):
            raise ValueError("pieces with an inner blank are not supported")
        self.chunks = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        # Letters stand apart from all else where, as is usual, no piece mixes them.
        odd = "".join(sorted({c for t in self.ids if len(t) > 1 for c in t if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
        letters, others = rf"[^\W\d_{odd}]+", rf"(?:[^\w{BLANK}]|[\d_{odd}])+"
        apart = re.compile(f"{BLANK}*{letters}|{BLANK}*{others}|{BLANK}+")
        if all(apart.fullmatch(t) for t in self.ids):
            self.chunks = apart
        self.widths = np.array([1 if k == BYTE else len(t.encode()) for t, k in zip(self.texts, self.types)], np.int64)
        self.surfaces = [t.replace(BLANK, " ").encode() if k == NORMAL else b"" for t, k in zip(self.texts, self.types)]
        self.surfaces[self.unknown_id] = self.unknown.encode()
        for byte, i in self.byte_ids.items():
            self.surfaces[i] = bytes([byte])
        self.is_byte = [t == BYTE for t in self.types]
        self.plain_decoding = self.dummy_prefix and not self.remove_extra
        self.remembered: dict[str, tuple[int, ...]] = {}
        self.former: dict[str, tuple[int, ...]] = {}

    # Normalising

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its UTF-8 bytes, the source byte it stands for; one more entry ends it."""
        source = text.encode("utf-8", "replace")
        if not self.map and not self.remove_extra:
            return self._escape_only(text, source)
        return self._by_prefixes(source)

    def _escape_only(self, text: str, source: bytes) -> tuple[str, np.ndarray]:
        if not text:
            return "", np.zeros(1, np.int64)
        raw = np.frombuffer(source, np.uint8)
        origin = np.repeat(np.arange(len(raw)), np.where(raw == 32, 3, 1))
        head = np.zeros(3 if self.dummy_prefix else 0, np.int64)
        return (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK), np.concatenate((head, origin, [len(raw)]))

    def _by_prefixes(self, source: bytes) -> tuple[str, np.ndarray]:
        written, origin = bytearray(), []
        blank, at, end = BLANK.encode(), 0, len(source)

        def take(i: int) -> tuple[bytes, int]:
            known = self.map.longest_prefix(source, i) if self.map else None
            if known:
                return known
            size = 1 + sum(source[i] >= least for least in (0xC0, 0xE0, 0xF0))
            return source[i:i + size], size

        if self.remove_extra:
            while at < end and not take(at)[0].strip(b" "):
                at += take(at)[1]
        if at >= end:
            return "", np.array([end])
        if self.dummy_prefix:
            written += blank
            origin += [at] * 3
        after_blank = self.remove_extra
        while at < end:
            piece, size = take(at)
            if after_blank:
                piece = piece.lstrip(b" ")
            for byte in piece:
                unit = blank if byte == 32 else bytes([byte])
                written += unit
                origin += [at] * len(unit)
            after_blank = self.remove_extra and (piece.endswith(b" ") if piece else after_blank)
            at += size
        ends = end
        if self.remove_extra:
            while written.endswith(blank):
                ends = origin[-1]
                del written[-3:], origin[-3:]
        return written.decode(), np.array([*origin, ends])

    # Merging

    def merge(self, chunk: str) -> tuple[int, ...]:
        """Ids of one chunk: the pair with the best score merges first, the leftmost of equals."""
        symbols, ids = self._merge_symbols(list(chunk)), self.ids
        try:
            return tuple([ids[s] for s in symbols])
        except KeyError:
            return tuple(chain.from_iterable([(ids[s],) if s in ids else self._unknown(s) for s in symbols]))

    def _unknown(self, symbol: str) -> list[int]:
        return [self.byte_ids[b] for b in symbol.encode()] if self.byte_fallback else [self.unknown_id]

    def _merge_symbols(self, symbols: list) -> list[str]:
        costs, count = self.costs, len(symbols)
        if count < 24:
            return self._merge_short(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        agenda = [(costs[symbols[i] + symbols[i + 1]], i, symbols[i] + symbols[i + 1])
                  for i in range(count - 1) if symbols[i] + symbols[i + 1] in costs]
        heapq.heapify(agenda)
        while agenda:
            _, i, joined = heapq.heappop(agenda)
            if symbols[i] is None or after[i] >= count or symbols[i] + symbols[after[i]] != joined:
                continue
            j = after[i]
            symbols[i], symbols[j], after[i] = joined, None, after[j]
            if after[i] < count:
                before[after[i]] = i
                pair = joined + symbols[after[i]]
                if pair in costs:
                    heapq.heappush(agenda, (costs[pair], i, pair))
            if before[i] >= 0:
                pair = symbols[before[i]] + joined
                if pair in costs:
                    heapq.heappush(agenda, (costs[pair], before[i], pair))
        return [s for s in symbols if s is not None]

    def _merge_short(self, symbols: list) -> list[str]:
        cost = self.costs.get
        pairs = [cost(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            joined = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = cost(joined + symbols[i + 1], NEVER)
            if i:
                pairs[i - 1] = cost(symbols[i - 1] + joined, NEVER)
        return symbols

    def ids_of(self, normalised: str) -> list[int]:
        """Ids of a normalised text, each unknown character by itself."""
        parts = self.chunks.findall(normalised)
        known = self.remembered
        if len(known) > REMEMBERED:  # only what is in use is carried over
            self.former, self.remembered = known, {}
            known = self.remembered
        former = self.former
        for part in set(parts).difference(known):
            known[part] = former[part] if part in former else self.merge(part)
        return list(chain.from_iterable([known[p] for p in parts]))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the source byte at which each piece starts with the end of the last one added."""
        normalised, origin = self.normalise(text)
        ids = np.array(self.ids_of(normalised), np.int32)
        widths = self.widths[ids]
        if (ids == self.unknown_id).any():
            ids, widths = self._unknown_runs(normalised, ids)
        return ids, origin[np.concatenate(([0], np.cumsum(widths)))] if len(ids) else origin[-1:]

    def _unknown_runs(self, normalised: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept, widths, at = [], [], 0
        for i in ids.tolist():
            piece = normalised[at] if i == self.unknown_id else self.texts[i]
            at += len(piece)
            if i == self.unknown_id and kept and kept[-1] == i:
                widths[-1] += len(piece.encode())
            else:
                kept.append(i)
                widths.append(len(piece.encode()))
        return np.array(kept, np.int32), np.array(widths, np.int64)

    # Decoding

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces in a row are read as UTF-8, each byte that is no part of it as U+FFFD."""
        if ids and self.plain_decoding and self.types[ids[0]] == NORMAL:
            try:
                # Text pieces are whole characters, so all is valid only if each run of bytes is.
                return b"".join([self.surfaces[i] for i in ids]).decode().removeprefix(" ")
            except UnicodeDecodeError:
                pass
        surfaces, byte = self.surfaces, self.is_byte
        drop = self.dummy_prefix or self.remove_extra
        raw, texts, start = [], [], True
        for i in ids:
            if byte[i]:
                raw.append(surfaces[i])
                start = False
                continue
            surface = surfaces[i]
            if start and self.types[i] == NORMAL:
                if drop and surface.startswith(b" "):
                    surface = surface[1:] if not self.remove_extra else surface.lstrip(b" ")
                start = self.remove_extra and not surface
            if raw:
                texts.append(_utf8(b"".join(raw)))
                raw = []
            texts.append(surface)
        if raw:
            texts.append(_utf8(b"".join(raw)))
        return b"".join(texts).decode("utf-8", "replace")


def _utf8(raw: bytes) -> bytes:
    """Bytes with every one that belongs to no character replaced by U+FFFD."""
    return raw.decode("utf-8", "one-by-one").encode()


codecs.register_error("one-by-one", lambda wrong: ("\ufffd", wrong.start + 1))


@lru_cache(maxsize=2)
def _model(raw: bytes) -> PieceModel:
    return PieceModel(raw)


_ENCODED = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("starts", T.ArrayType(T.IntegerType(), False)), T.StructField("n_bytes", T.LongType())]
_DECODED = T.StructField("decoded", T.StringType())


def encode(docs: DataFrame, model: bytes, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, ``starts`` and ``n_bytes``; ``model`` is the content of a model file.

    Piece i covers the UTF-8 bytes ``starts[i]`` to ``starts[i + 1]`` of the source text, the last
    one up to ``n_bytes``. Null and empty texts have no pieces. With ``decoded``, the ids' text is
    added in the same pass, as ``decode`` gives it. Columns of these names are replaced.
    """

    def run(texts: list[str], part: pa.RecordBatch) -> list[pa.Array]:
        known = _model(model)
        found = [known.encode(t) for t in texts]
        sizes = pa.array([int(edges[-1]) for _, edges in found], pa.int64())
        arrays = [int_lists([ids for ids, _ in found]), int_lists([edges[:-1] for _, edges in found]), sizes]
        if decoded:
            arrays.append(pa.array([known.decode(ids.tolist()) for ids, _ in found], pa.string()))
        return arrays

    return append_columns(docs, text_col, T.StructType(_ENCODED + [_DECODED] * decoded), run)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids; null ids are null, no ids an empty text."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _model(model)
        for batch in batches:
            texts = [known.decode(ids.values.to_pylist()) if ids.is_valid else None for ids in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())],
                                             names=[*kept, "decoded"])

    fields = [f for f in encoded.schema.fields if f.name != "decoded"]
    return encoded.mapInArrow(run, T.StructType([*fields, _DECODED]))
