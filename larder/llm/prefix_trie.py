"""Prefix trie of conversations: one node per distinct opening, with totals of what lies beneath.

A node is named by a 128-bit digest of its turns: the exclusive or of digests of (place, role, text), so that the
names of all openings of a conversation are running sums and a long conversation can be summed in blocks, side by side.

Totals are rolled up in bands of ``BAND`` depths. Each node sends its own figures to its ancestors inside its band,
which completes every band but for what hangs below it. The top nodes of the bands are then a trie themselves, one
``BAND`` times less deep, and are completed the same way; their totals go to the nodes of the band above that lead to
them. A node is sent to fewer than twice ``BAND`` others a level, and there are as many levels as the depth has digits in
base ``BAND``. Only nodes that two conversations share take part: below the others there is one leaf and nothing saved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.keys import dense_key
from larder.session import materialize

BAND = 8
#: Turns of a conversation that are summed by one task, and ids that are joined into one text.
BLOCK = 1024
ID_RUN = 4096
_NAME = ["hi", "lo"]


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv_id``, ``place`` from 0, ``digest`` of role and text (null as empty), ``size`` in UTF-8 bytes of the text.

    Turns are in the order of their numbers, null first; equal numbers in the order of their digests. Rows without an
    id belong to no conversation. Rows are numbered in a range-partitioned order, so a conversation may span partitions.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    kept = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"))
    numbered = dense_key(kept, ["conv_id", "turn", "digest"], "row", start=0)
    first = numbered.groupBy(F.col("conv_id").alias("of")).agg(F.min("row").alias("first"))
    return numbered.join(first, F.col("conv_id") == F.col("of")).select(
        "conv_id", (F.col("row") - F.col("first")).alias("place"), "digest", "size")


def rebuilt_turns(turns: DataFrame, lengths: DataFrame, base: Column, taken: Column) -> DataFrame:
    """Each conversation with its first ``taken`` turns replaced by the first as many of conversation ``base``.

    ``lengths`` has ``conv_id``, ``n``; ``base`` and ``taken`` are expressions of ``conv_id``. A base that has fewer
    turns gives all it has, one that is not there gives none; own turns follow without a gap. ``taken`` must be small.
    """
    plan = lengths.select("conv_id", base.alias("base"), taken.cast("long").alias("taken"))
    counts = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = plan.join(counts, "base", "left").withColumn("given", F.least("taken", F.coalesce("n_base", F.lit(0))))
    own = turns.join(plan.select("conv_id", "taken", "given"), "conv_id").where("place >= taken").select(
        "conv_id", (F.col("place") - F.col("taken") + F.col("given")).alias("place"), "digest", "size")
    # Only the openings of bases are copied, so a long base is no larger a key than a short one.
    wanted = plan.where("given > 0").select("conv_id", "base", "given")
    heads = turns.join(wanted.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
    longest = wanted.agg(F.max("given")).first()[0] or 0
    heads = heads.where(F.col("place") < longest).withColumnRenamed("conv_id", "base")
    given = heads.join(wanted, "base").where("place < given").select("conv_id", "place", "digest", "size")
    return own.unionByName(given)


def openings(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth`` from 1, ``hi``, ``lo`` (the name of the opening), ``up_hi``, ``up_lo`` (of the one before), ``size``."""
    at = F.col("place")
    marked = turns.select("conv_id", "place", "size", F.floor(at / BLOCK).alias("block"),
                          *[F.xxhash64(F.lit(i), at, F.col("digest")).alias(c) for i, c in enumerate(_NAME)])
    inside = Window.partitionBy("conv_id", "block").orderBy("place")
    summed = marked.select("conv_id", "place", "block", "size", *_NAME, *[F.bit_xor(c).over(inside).alias(f"run_{c}") for c in _NAME])
    # One row a block; blocks after the first exist in long conversations only.
    totals = marked.groupBy("conv_id", "block").agg(*[F.bit_xor(c).alias(c) for c in _NAME])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv_id", "block", *[F.bit_xor(c).over(earlier).alias(f"before_{c}") for c in _NAME]).where("block > 0")
    whole = summed.join(before, ["conv_id", "block"], "left")
    names = {c: F.col(f"run_{c}").bitwiseXOR(F.coalesce(f"before_{c}", F.lit(0))) for c in _NAME}
    return whole.select("conv_id", (F.col("place") + 1).alias("depth"), *[names[c].alias(c) for c in _NAME],
                        *[names[c].bitwiseXOR(F.col(c)).alias(f"up_{c}") for c in _NAME], "size")


def _with_root(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """Openings of every conversation from the empty one on."""
    root = lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in _NAME],
                          *[F.lit(None).cast("long").alias(f"up_{c}") for c in _NAME], F.lit(0).cast("long").alias("size"))
    return root.unionByName(paths)


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """``hi``, ``lo`` and ``values`` summed over each node's subtree.

    ``nodes`` has the name, ``conv_id`` (a conversation through the node), ``depth`` and ``values``; all ancestors of a
    node are nodes. ``paths`` has the names of the openings of these conversations by ``conv_id`` and ``depth``.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    at = F.floor(F.col("depth") / band)
    path = paths.select(F.col("conv_id").alias("through"), at.alias("path_band"), F.col("depth").alias("path_depth"), *_NAME)
    figures = [F.sum(v).alias(v) for v in values]
    sent = nodes.select(F.col("conv_id").alias("through"), at.alias("path_band"), "depth", *values)
    inside = sent.join(path, ["through", "path_band"]).where("path_depth <= depth").groupBy(*_NAME).agg(*figures)
    if deepest < band:
        return inside
    inside = materialize(inside, "bands")
    # Nodes on top of a band, a depth being a band of theirs.
    tops = nodes.where(F.col("depth") % band == 0).select(*_NAME, "conv_id", at.alias("depth")).join(inside, _NAME)
    steps = paths.where(F.col("depth") % band == 0).select("conv_id", at.alias("depth"), *_NAME)
    tops = materialize(tops, "tops")
    whole = rollup(tops, steps, values, band).join(tops.select(*_NAME, "conv_id", "depth"), _NAME)
    below = whole.where("depth > 0").select(F.col("conv_id").alias("through"), (F.col("depth") - 1).alias("path_band"), *values)
    passed = below.join(path, ["through", "path_band"]).select(*_NAME, *values)
    return inside.unionByName(passed).groupBy(*_NAME).agg(*figures)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a sorted partition, joined node by node."""
    node, first, ids, rows = None, None, [], []

    def flush() -> None:
        if ids:
            rows.append((*node, first, ",".join(map(str, ids))))

    for batch in batches:
        for hi, lo, conv in zip(*(batch.column(c).to_pylist() for c in (*_NAME, "conv_id"))):
            if (hi, lo) != node or len(ids) >= ID_RUN:
                flush()
                node, first, ids = (hi, lo), conv, []
            ids.append(conv)
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip((*_NAME, "first", "ids"), r)) for r in rows], _RUN_SCHEMA)
            rows = []
    flush()
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip((*_NAME, "first", "ids"), r)) for r in rows], _RUN_SCHEMA)


_RUN_SCHEMA = pa.schema([*[(c, pa.int64()) for c in (*_NAME, "first")], ("ids", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each node, fed run by run."""
    node, state = None, None
    for batch in batches:
        found = []
        for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in (*_NAME, "ids"))):
            if (hi, lo) != node:
                if node:
                    found.append((*node, state.hexdigest()))
                node, state = (hi, lo), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield _digest_rows(found)
    if node:
        yield _digest_rows([(*node, state.hexdigest())])


def _digest_rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                      names=[*_NAME, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``hi``, ``lo``, ``ends_sha256`` of the ids (``conv_id``) that end at a node, ascending and joined by commas.

    Ids are joined in ranges by many tasks; the task that has a node reads its few long runs one after the other.
    """
    runs = ends.repartitionByRange(*_NAME, "conv_id").sortWithinPartitions(*_NAME, "conv_id").mapInArrow(
        _runs, "hi long, lo long, first long, ids string")
    return runs.repartition(*_NAME).sortWithinPartitions(*_NAME, "first").mapInArrow(_digests, "hi long, lo long, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the conversations' openings, the empty one (depth 0) included.

    ``turns`` has ``conv_id``, ``place`` (from 0, without gaps), ``digest``, ``size``; ``lengths`` every ``conv_id``, also
    those without turns. Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``,
    null for the root), ``n_convs`` members, ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself included),
    ``saved_tokens`` ((n_convs - 1) times the size of the last turn, summed over the subtree), ``ends_sha256`` (of the ids
    of members that end here). Without conversations there are no nodes.
    """
    lengths = lengths.select("conv_id")
    paths = materialize(_with_root(openings(turns), lengths), "openings")
    grouped = paths.groupBy(*_NAME, "depth").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("size").alias("size"),
                                                 F.min("up_hi").alias("up_hi"), F.min("up_lo").alias("up_lo"))
    nodes = materialize(grouped, "nodes")
    up = [F.col(f"up_{c}").alias(c) for c in _NAME]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"), F.sum(F.expr("int(n_convs = 1)")).alias("n_single"))
    shared = nodes.where("n_convs > 1").join(children, _NAME, "left").na.fill(0, ["n_children", "n_single"])
    shared = materialize(shared.select(
        *_NAME, "conv_id", "depth", "n_children",
        (F.col("n_single") + F.expr("int(n_children = 0)")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "shared")
    # Every ancestor of a shared node is shared, so paths end where conversations part.
    reach = shared.groupBy("conv_id").agg(F.max("depth").alias("reach"))
    kept = paths.select("conv_id", "depth", *_NAME).join(reach, "conv_id").where("depth <= reach").drop("reach")
    totals = rollup(shared.drop("n_children"), kept, ["n_leaves", "saved_tokens"], band)
    totals = totals.join(shared.select(*_NAME, "n_children"), _NAME)
    single = nodes.where("n_convs = 1").select(*_NAME).join(children.select(*_NAME, "n_children"), _NAME, "left").select(
        *_NAME, F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.coalesce("n_children", F.lit(0)).alias("n_children"))
    figures = totals.unionByName(single)
    # A node whose member is alone has its parent in the same conversation or in one that is smaller.
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    last = paths.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = end_digests(paths.join(last, ["conv_id", "depth"]).select(*_NAME, "conv_id"))
    found = nodes.join(figures, _NAME).join(parents, ["up_hi", "up_lo"], "left").join(ends, _NAME, "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, base: Column, taken: Column, band: int = BAND) -> DataFrame:
    """``trie`` of the conversations of a table after ``rebuilt_turns``; ``base`` and ``taken`` are expressions of ``conv_id``."""
    turns = materialize(ordered_turns(conversations), "turns")
    lengths = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "lengths")
    return trie(rebuilt_turns(turns, lengths, base, taken), lengths, band)
