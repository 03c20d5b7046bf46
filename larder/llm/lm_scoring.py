"""Masked pseudo-likelihood from a bidirectional window network.

Every token is predicted from the two tokens on either side of it, itself hidden. The network looks
the four neighbours up in one embedding table, passes them through a tanh layer and gives the token's
probability in two steps: its class, then the word within the class. A document's score is the sum of
the logarithms over all its tokens.

The network's vocabulary is the most frequent words of all documents; other words stand for their
length. These have a third step, from the length to the word, counted over all documents: by its own
frequency if it is among the listed words, and otherwise letter by letter, each after the two before.

Training is spread over shards: in each round every shard starts from the same weights, learns from
the tokens whose turn it is, the masked ones, and the shards' weights are averaged by their number of
masked tokens. Every token has its turn in one of the rounds. The number of shards follows the number of tokens; which documents share a shard
follows from their ids, so the result does not depend on how the table is stored or split. Sums are
taken over whole numbers, so that their order does not matter either.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.rows import pieces, select_as
from larder.session import materialize

CLASSES = 32
#: Words of each class; the last class holds the lengths that stand for all other words.
PER_CLASS = 32
VOCABULARY = CLASSES * PER_CLASS
#: Tokens on either side that predict the one between.
WINDOW = 2
EMBEDDING = 12
HIDDEN = 24
#: Passes over the documents; each token is masked for training in one of them.
ROUNDS = 2
BATCH = 4_096
RATE = 0.08
#: Tokens of a shard, on average.
SHARD_TOKENS = 4_000_000
#: Different words, and words in all, of a row in which texts are stored as numbers.
COUNTED_WORDS, COUNTED_TOKENS = 400_000, 6_000_000
#: Words beyond the vocabulary with a frequency of their own, at most; the least frequent of them sets the floor.
LISTED = 50_000
#: Kinds of letters in the spelling of other words: none, the most frequent, and all others.
LETTERS = 64
#: Weight of a letter's frequency, in counts, beside its frequency after two others.
PRIOR = 4.0
#: Weights are averaged in whole units of this size.
UNIT = 2.0**-24

#: The neighbour of the first and last tokens.
EDGE = VOCABULARY
_WORD = re.compile(r"\w+|[^\w\s]")
_SHAPES = {
    "embedding": (VOCABULARY + 1, EMBEDDING), "w1": (2 * WINDOW * EMBEDDING, HIDDEN), "b1": (HIDDEN,),
    "w2": (HIDDEN, CLASSES), "b2": (CLASSES,), "w3": (CLASSES, HIDDEN, PER_CLASS), "b3": (CLASSES, PER_CLASS),
}


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Network:
    parts: dict[str, np.ndarray]

    @staticmethod
    def fresh() -> Network:
        rng = np.random.default_rng(7)
        parts = {k: rng.normal(0, 0.1 if k == "embedding" else 1 / np.sqrt(s[-2]), s) if len(s) > 1 and k != "b3" else np.zeros(s)
                 for k, s in _SHAPES.items()}
        return Network({k: v.astype(np.float32) for k, v in parts.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.parts[k].ravel() for k in _SHAPES])

    @staticmethod
    def from_flat(values: np.ndarray) -> Network:
        parts, at = {}, 0
        for k, shape in _SHAPES.items():
            size = int(np.prod(shape))
            parts[k] = values[at:at + size].reshape(shape).astype(np.float32)
            at += size
        return Network(parts)

    def _forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Embedded neighbours, hidden layer, class logits."""
        p = self.parts
        x = np.take(p["embedding"], context.ravel(), axis=0).reshape(len(context), -1)
        hidden = np.tanh(x @ p["w1"] + p["b1"])
        return x, hidden, hidden @ p["w2"] + p["b2"]

    def _small(self) -> bool:
        """Whether no logit can be beyond 30 either way: the hidden layer lies between -1 and 1."""
        return all((np.abs(self.parts[w]).sum(axis=-2) + np.abs(self.parts[b])).max() < 30 for w, b in (("w2", "b2"), ("w3", "b3")))

    def log_probabilities(self, context: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Of each target, given the tokens around it."""
        order, classes = _by_class(targets)
        targets, out, small = targets[order], np.empty(len(targets), np.float32), self._small()
        _, hidden, logits = self._forward(context[order])
        found = _log_probability(logits, targets // PER_CLASS, small)
        for k, rows in classes:
            found[rows] += _log_probability(hidden[rows] @ self.parts["w3"][k] + self.parts["b3"][k], targets[rows] % PER_CLASS, small)
        out[order] = found
        return out

    def gradients(self, context: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability."""
        p, n, small = self.parts, np.float32(1 / len(targets)), self._small()
        order, classes = _by_class(targets)
        context, targets = context[order], targets[order]
        x, hidden, logits = self._forward(context)
        wrong = _softmax(logits, small)
        wrong[np.arange(len(targets)), targets // PER_CLASS] -= 1
        wrong *= n
        found = {"w2": hidden.T @ wrong, "b2": wrong.sum(0), "w3": np.zeros_like(p["w3"]), "b3": np.zeros_like(p["b3"])}
        back = wrong @ p["w2"].T
        for k, rows in classes:
            own = hidden[rows]
            inside = _softmax(own @ p["w3"][k] + p["b3"][k], small)
            inside[np.arange(len(inside)), targets[rows] % PER_CLASS] -= 1
            inside *= n
            found["w3"][k], found["b3"][k] = own.T @ inside, inside.sum(0)
            back[rows] += inside @ p["w3"][k].T
        back *= 1 - hidden * hidden
        found["w1"], found["b1"] = x.T @ back, back.sum(0)
        pulled = np.ascontiguousarray((back @ p["w1"].T).reshape(-1, EMBEDDING).T, np.float64)
        flat = context.ravel()
        found["embedding"] = np.stack([np.bincount(flat, row, VOCABULARY + 1) for row in pulled], axis=1).astype(np.float32)
        return found


def _exponentials(logits: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """Powers of e of the logits less a shift, their sums by row, and the shift; small logits need none."""
    shift: np.ndarray | float = 0.0 if small else logits.max(axis=1, keepdims=True)
    powers = np.exp(logits if small else logits - shift)
    return powers, powers @ np.ones(logits.shape[1], logits.dtype), shift


def _softmax(logits: np.ndarray, small: bool = False) -> np.ndarray:
    powers, sums, _ = _exponentials(logits, small)
    powers /= sums[:, None]
    return powers


def _log_probability(logits: np.ndarray, choice: np.ndarray, small: bool = False) -> np.ndarray:
    """Logarithm of the softmax of each row at one column."""
    _, sums, shift = _exponentials(logits, small)
    return logits[np.arange(len(choice)), choice] - np.ravel(shift).astype(logits.dtype) - np.log(sums)


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order that brings targets of a class together, and where each class found is in it."""
    classes = (targets // PER_CLASS).astype(np.int16)
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(CLASSES + 1)).tolist()
    return order, [(k, slice(a, b)) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents end to end with edge tokens between them, and the places of their own tokens."""
    gap = np.full(WINDOW, EDGE, np.int16)
    parts, places, at = [gap], [], WINDOW
    for row in rows:
        parts += [row, gap]
        places.append(np.arange(at, at + len(row)))
        at += len(row) + WINDOW
    return np.concatenate(parts).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *places])


def _context(tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
    around = [o for o in range(-WINDOW, WINDOW + 1) if o]
    return tokens[places[:, None] + np.array(around)]


def turns(row: np.ndarray, rounds: int) -> np.ndarray:
    """The round in which each token of a document is masked, drawn by its place and the document's tokens."""
    mixed = (np.arange(len(row), dtype=np.uint64) + np.uint64(row.sum(dtype=np.int64) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(rounds)).astype(np.int64)


def train_shard(network: Network, rows: Iterator[np.ndarray], seed: int, turn: int = 0, rounds: int = 1) -> tuple[Network, int]:
    """The network after one pass over the masked tokens of a shard's documents, and their number."""
    own = Network({k: v.copy() for k, v in network.parts.items()})
    past = {k: np.full_like(v, 1e-6) for k, v in own.parts.items()}
    rng, seen = np.random.default_rng(seed), 0
    for group in _groups(rows, 200_000):
        tokens, places = padded(group)
        masked = rng.permutation(places[np.concatenate([turns(row, rounds) for row in group]) == turn])
        for at in range(0, len(masked), BATCH):
            chosen = masked[at:at + BATCH]
            share = np.float32(len(chosen) / BATCH)
            for k, g in own.gradients(_context(tokens, chosen), tokens[chosen]).items():
                past[k] += g * g
                own.parts[k] -= np.float32(RATE) * share * g / np.sqrt(past[k])
        seen += len(masked)
    return own, seen


def _groups(rows: Iterator[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """Documents in turn until about so many tokens are together; a longer one is by itself."""
    group, size = [], 0
    for row in rows:
        if group and size + len(row) > most:
            yield group
            group, size = [], 0
        group.append(row)
        size += len(row)
    if group:
        yield group


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


_TOKENS = "doc_ids array<long>, sizes array<long>, words array<string>, n array<long>, numbers binary"


def tokenized(docs: DataFrame) -> DataFrame:
    """Texts split into words once: a row holds some documents, their different ``words`` with their counts ``n``, and the
    ``numbers`` of all their words in that list (32 bits each, compressed), ``sizes`` of them a document."""

    def stored(ids: list, sizes: list[int], numbers: list[np.ndarray], known: _Numbers) -> pa.RecordBatch:
        flat = np.concatenate([np.zeros(0, np.int32), *numbers])
        # All lowest bytes first: most numbers are small.
        planes = np.ascontiguousarray(flat.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        cells = [ids, sizes, list(known), np.bincount(flat, minlength=len(known)), zstandard.compress(planes, 1)]
        kinds = [pa.list_(pa.int64())] * 2 + [pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=["doc_ids", "sizes", "words", "n", "numbers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, numbers, known = [], [], [], _Numbers()
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                    found = words(text)
                    ids.append(doc_id)
                    sizes.append(len(found))
                    numbers.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                if len(known) >= COUNTED_WORDS or sum(sizes) >= COUNTED_TOKENS:
                    yield stored(ids, sizes, numbers, known)
                    ids, sizes, numbers, known = [], [], [], _Numbers()
        if ids:
            yield stored(ids, sizes, numbers, known)

    return docs.mapInArrow(run, _TOKENS)


def count_words(tokens: DataFrame) -> DataFrame:
    """``word``, ``n``: how often each word occurs in all texts."""
    return tokens.select(F.explode(F.arrays_zip("words", "n")).alias("w")).groupBy(F.col("w.words").alias("word")).agg(F.sum("w.n").alias("n"))


def encoder(vocabulary: list[str]):
    """Text, or its words, to token numbers: a known word by its rank, another by its length."""
    rank = {w: i for i, w in enumerate(vocabulary)}.get
    lengths = VOCABULARY - PER_CLASS

    def encode(text: str | list[str]) -> np.ndarray:
        found = np.array([rank(w, -len(w)) for w in (words(text) if isinstance(text, str) else text)], np.int64)
        return np.where(found < 0, lengths - 1 + np.minimum(-found, PER_CLASS), found).astype(np.int16)

    return encode


class Spelling:
    """Probability of a word outside the vocabulary, given its length code.

    Over the words of a code, probabilities sum to one: listed words share their part of the counts by
    frequency, and the other part is shared letter by letter among all words.
    """

    def __init__(self, listed: dict[str, int], letters: dict[int, int], rest: np.ndarray, long: tuple[int, int], triples: np.ndarray):
        """``rest``: occurrences of other words by length code; ``long``: number and letters of those as long as the last one or longer."""
        self.listed = listed
        self.all = rest + 1.0
        for word, n in listed.items():
            self.all[min(len(word), PER_CLASS)] += n
        self.rest = np.log(rest + 1.0)
        known = sorted(letters, key=lambda c: (-letters[c], c))[:LETTERS - 2]
        self.kind = {c: i + 1 for i, c in enumerate(known)}
        others = {c: n for c, n in letters.items() if c not in self.kind}
        self.unlisted = -math.log(sum(others.values()) + 0x110000 - len(known))
        self.other = {c: math.log(n + 1) + self.unlisted for c, n in others.items()}
        alone = triples.sum(axis=(0, 1))[1:] + 1.0
        alone /= alone.sum()
        self.steps = np.log((triples[:, :, 1:] + PRIOR * alone) / (triples[:, :, 1:].sum(axis=2, keepdims=True) + PRIOR))
        self.flat = self.steps.ravel().tolist()
        # Each further letter of a word of the last code follows with the same probability.
        excess = long[1] - PER_CLASS * long[0]
        self.ends, self.goes_on = math.log((long[0] + 1) / (long[0] + excess + 2)), math.log((excess + 1) / (long[0] + excess + 2))

    def log_letters(self, word: str) -> float:
        """Of the word's letters, given its length code."""
        total, pair, kind, flat = 0.0, 0, self.kind.get, self.flat
        for c in map(ord, word):
            three = kind(c, LETTERS - 1)
            total += flat[pair * (LETTERS - 1) + three - 1]
            if three == LETTERS - 1:
                total += self.other.get(c, self.unlisted)
            pair = pair % LETTERS * LETTERS + three
        if len(word) >= PER_CLASS:
            total += self.ends + (len(word) - PER_CLASS) * self.goes_on
        return total

    def log_probability(self, word: str) -> float:
        code = min(len(word), PER_CLASS)
        spelt = float(self.rest[code]) + self.log_letters(word)
        n = self.listed.get(word, 0)
        return (math.log(n + math.exp(spelt)) if n else spelt) - math.log(self.all[code])


def _rare_counts(counts: DataFrame, known: set[str], kind: dict[int, int] | None) -> DataFrame:
    """``key``, ``n``, ``letters``: counted over the words not ``known``, letters by code point or, if ``kind`` is given, in threes.

    Without ``kind``, lengths are counted too, under -1 less the length code, with the letters they sum to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        sizes: Counter[int] = Counter()
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if word in known:
                    continue
                if kind is None:
                    code = -1 - min(len(word), PER_CLASS)
                    found[code] += n
                    sizes[code] += n * len(word)
                    for letter in word:
                        found[ord(letter)] += n
                    continue
                key = 0
                for letter in word:
                    key = (key * LETTERS + kind.get(ord(letter), LETTERS - 1)) % LETTERS**3
                    found[key] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64()),
                                          pa.array([sizes[k] for k in found], pa.int64())], names=["key", "n", "letters"])

    return counts.mapInArrow(run, "key int, n long, letters long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("letters").alias("letters"))


def spelling(counts: DataFrame, vocabulary: list[str]) -> Spelling:
    """Counted over all words outside the vocabulary; the driver holds the listed words and the letters' counts."""
    room, floor = LISTED + len(vocabulary), 1
    for row in sorted(counts.groupBy("n").count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            floor = row.n + 1
            break
    own = set(vocabulary)
    listed = {r.word: r.n for r in counts.where(F.col("n") >= floor).collect() if r.word not in own}
    below = counts.where(F.col("n") < floor)
    single = {r.key: (r.n, r.letters) for r in _rare_counts(below, own, None).collect()}
    letters = {k: n for k, (n, _) in single.items() if k >= 0}
    rest = np.array([single.get(-1 - code, (0, 0))[0] for code in range(PER_CLASS + 1)], np.float64)
    triples = np.zeros(LETTERS**3)
    found = Spelling(listed, letters, rest, single.get(-1 - PER_CLASS, (0, 0)), triples.reshape(LETTERS, LETTERS, LETTERS))
    for r in _rare_counts(below, own, found.kind).collect():
        triples[r.key] = r.n
    return Spelling(listed, letters, rest, single.get(-1 - PER_CLASS, (0, 0)), triples.reshape(LETTERS, LETTERS, LETTERS))


@dataclass
class LanguageModel:
    vocabulary: list[str]
    network: Network
    spelling: Spelling


def encode(tokens: DataFrame, vocabulary: list[str], spelt: Spelling) -> DataFrame:
    """``doc_id``, ``codes`` (16-bit token numbers as bytes), ``n_tokens``, ``log_words`` for the documents of ``tokenized``.

    The last is the sum of the logarithms of words outside the vocabulary, given their lengths. Both are worked out
    once for each word of a stored row, and looked up by its number.
    """
    rank = {w: i for i, w in enumerate(vocabulary)}
    shared = tokens.sparkSession.sparkContext.broadcast(spelt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, coder = shared.value, encoder(vocabulary)
        for batch in batches:
            for row in batch.to_pylist():
                code_of = coder(row["words"]).astype("<i2")
                log_of = np.array([0.0 if w in rank else own.log_probability(w) for w in row["words"]], np.float64)
                planes = np.frombuffer(zstandard.decompress(row["numbers"]), np.uint8).reshape(4, -1)
                numbers = np.ascontiguousarray(planes.T).view("<u4").ravel()
                codes, logs, edges = code_of[numbers], log_of[numbers], np.concatenate(([0], np.cumsum(row["sizes"], dtype=np.int64)))
                spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                for some in (slice(i, i + 2_000) for i in range(0, len(spans), 2_000)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][some], pa.int64()), pa.array([codes[a:b].tobytes() for a, b in spans[some]], pa.binary()),
                         pa.array(row["sizes"][some], pa.int64()), pa.array([float(logs[a:b].sum()) for a, b in spans[some]], pa.float64())],
                        names=["doc_id", "codes", "n_tokens", "log_words"])

    return tokens.select("doc_ids", "sizes", "words", "numbers").mapInArrow(run, "doc_id long, codes binary, n_tokens long, log_words double")


def _rows_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(c.as_buffer(), "<i2") for c in batch.column("codes")]


def _round(codes: DataFrame, network: Network, shards: int, number: int, rounds: int) -> Network:
    """All shards learn from the same weights; their means, by number of masked tokens, are the new ones."""
    # Other documents meet in each round.
    dealt = (codes.select("doc_id", "codes", F.pmod(F.xxhash64("doc_id", F.lit(number)), F.lit(shards)).cast("int").alias("shard"))
             .repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "codes"))
    start = network.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shard = next(batches, None), 0
        if first is None or not first.num_rows:
            return
        shard = first.column("shard")[0].as_py()  # a partition is one shard

        def rows() -> Iterator[np.ndarray]:
            yield from _rows_of(first)
            for batch in batches:
                yield from _rows_of(batch)

        learnt, seen = train_shard(Network.from_flat(start), rows(), number * 1_000_003 + shard, number, rounds)
        units = np.round(learnt.flat().astype(np.float64) / UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(units), dtype=np.int32)), pa.array(units), pa.array(np.full(len(units), seen))],
                                         names=["at", "units", "seen"])

    learnt = dealt.mapInArrow(run, "at int, units long, seen long")
    exact = F.sum(F.col("units").cast("decimal(19,0)") * F.col("seen").cast("decimal(19,0)"))
    means = learnt.groupBy("at").agg((exact.cast("double") / F.greatest(F.sum("seen"), F.lit(1))).alias("mean"),
                                     F.sum("seen").alias("seen")).toPandas().sort_values("at")
    if not len(means) or means["seen"].iloc[0] == 0:
        return network
    return Network.from_flat(means["mean"].to_numpy() * UNIT)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> tuple[LanguageModel, DataFrame]:
    """A model of all texts of ``docs``, and the documents in its token numbers (``doc_id``, ``codes``, ``n_tokens``, ``log_words``).

    The driver holds the vocabulary, the spelling of other words and one set of weights. Words equally frequent are ranked by their
    letters. Documents without tokens teach nothing; without any tokens the network stays as it began.
    """
    named = select_as(docs, doc_id=id_col, text=text_col)
    tokens = materialize(tokenized(named), "tokens")
    counts = materialize(count_words(tokens), "counts")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - PER_CLASS).collect()
    vocabulary = [r.word for r in top]
    spelt = spelling(counts, vocabulary)
    codes = materialize(encode(tokens, vocabulary, spelt), "codes")
    n_tokens = codes.agg(F.sum("n_tokens")).first()[0] or 0
    shards, network = max(1, -(-n_tokens // SHARD_TOKENS)), Network.fresh()
    for number in range(rounds):
        network = _round(codes, network, shards, number, rounds)
    return LanguageModel(vocabulary, network, spelt), codes


def score_codes(codes: DataFrame, network: Network) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood``, ``mean_log_likelihood`` (null without tokens)."""
    weights = network.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.from_flat(weights)
        for batch in batches:
            sums = []
            for group in _groups(iter(_rows_of(batch)), 50_000):
                sums += score_rows(own, group)
            total = np.round(np.array(sums, np.float64) + batch.column("log_words").to_numpy(), 6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(total, pa.float64())],
                                             names=["doc_id", "n_tokens", "log_likelihood"])

    found = codes.select("doc_id", "codes", "n_tokens", "log_words").mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double")
    return found.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def score_rows(network: Network, rows: list[np.ndarray], block: int = 8_192) -> list[float]:
    """The summed log-probabilities of each document, rounded to six decimals."""
    tokens, places = padded(rows)
    logs = [network.log_probabilities(_context(tokens, places[i:i + block]), tokens[places[i:i + block]]) for i in range(0, len(places), block)]
    ends = np.cumsum([len(r) for r in rows])
    total = np.concatenate(([0.0], np.cumsum(np.concatenate([np.zeros(0, np.float32), *logs]).astype(np.float64))))
    return np.round(total[ends] - total[ends - [len(r) for r in rows]], 6).tolist()


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on all texts of ``docs`` and score each of them.

    One row per row: ``doc_id``, ``n_tokens``, ``log_likelihood``, ``mean_log_likelihood``. Null and
    empty texts have no tokens, a sum of 0 and no mean. Rows repeating an id, and rows without one,
    are each scored and each learnt from. No rows give no rows.
    """
    model, codes = fit(docs, id_col, text_col, rounds)
    return score_codes(codes, model.network)
