"""Prefix trie of conversations, from adaptive radix trees over turn ids.

Conversations are rebuilt first: some leading turns of a block's first conversation, then
what is left of their own. A turn's id is 128 bits of hash of its role, text and depth, in
fixed width and big-endian; the XOR of the ids from the root names a node, so the same
prefix has the same name in every task. Texts are read once, for ids and word counts.

Sequences are cut into segments of ``SEGMENT`` turns, equal segments of a node are one row
with a count, and rows are dealt by ranges of their bytes, so neither a conversation of
any length, nor copies, nor a first turn that all share come together in one task. Every
task builds radix trees of bounded size (``radix``) and gives their nodes at whole turns;
parts of a node from several trees are added up.

This is done twice, as what a subtree holds counts each node once. The first pass counts
members and finds the smallest, which owns the node: a conversation owns its nodes from
some depth on, or none. In the second pass each conversation brings what its own nodes
cost and its own leaf, which then add up like the counts do: a subtree saves its members'
words less the words of the nodes that they own.

The conversations that end in a node are hashed in order by one task each, as SHA-256
asks for, which reads them in text pieces from tasks that sorted a range of them each.

Nulls and odd rows: rows with a null conv_id take no part; null role or text is the empty
text; a null turn comes first; rows of one turn follow each other by a hash of role and
text, all of them; a conversation that is rebuilt without turns is a member of the root;
for an id below zero the remainder has its sign; an empty table gives no rows; other
columns are not read. Runs jobs when called; the result is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.llm.numbering import numbered
from tagtide.llm.radix import NOWHERE, Row, Tree
from tagtide.workspace import Scratch, stored

BLANKS = r"[^\x20\x09-\x0D]+"
#: Conversations of one block begin with its first one's turns, up to three of them.
BLOCK, LEADS = 20, 4
SEGMENT = 1024
#: Bytes of turn ids in one tree.
TREE_BYTES = 16_000_000
#: Characters of a piece of conv_ids.
PIECE = 100_000
NODE, FROM = ["i1", "i2"], ["p1", "p2"]
FOLDED = "i1 long, i2 long, p1 long, p2 long, depth long, words long, n long, least long, saved long, leaves long"


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, two hashes of role and text, and the text's words."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *[F.xxhash64(F.lit(seed), role, text).alias(f"h{seed}") for seed in (1, 2)],
        F.regexp_count(text, F.lit(BLANKS)).cast("long").alias("words"),
    )


def _rebuilt(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns with their depth, and (conv_id, size) of every conversation."""
    lead = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LEADS).cast("int")
    own = scratch.stored(turns.groupBy("conv_id").agg(F.max("pos").alias("own")), "sizes")
    heads = own.select("conv_id", "own", lead.alias("lead"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("source"))
    there = own.select(F.col("conv_id").alias("source"), F.col("own").alias("there"))
    taken = F.least("lead", F.coalesce("there", F.lit(0)))
    heads = scratch.stored(heads.join(there, "source", "left").withColumn("taken", taken), "heads")

    leading = turns.where(F.col("pos") < LEADS).withColumnRenamed("conv_id", "source")
    first = heads.where("taken > 0").select("conv_id", "source", "taken").join(leading, "source").where("pos <= taken")
    first = first.select("conv_id", F.col("pos").alias("depth"), "h1", "h2", "words")
    # only behind a source with too few turns do own turns move up
    short = heads.where("taken < lead").select("conv_id", (F.col("lead") - F.col("taken")).alias("less"))
    rest = turns.where(F.col("pos") > lead).join(short, "conv_id", "left")
    rest = rest.select("conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("depth"), "h1", "h2", "words")
    size = F.col("taken") + F.greatest(F.col("own") - F.col("lead"), F.lit(0))
    return first.unionAll(rest), heads.select("conv_id", size.alias("size"))


def _segments(rebuilt: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Segments of every conversation, and the distinct ones with their turns.

    s1, s2 is the node that a segment starts at, e1, e2 the one that it ends at.
    """
    ids = [F.xxhash64(F.lit(seed), "depth", "h1", "h2").alias(f"t{seed}") for seed in (1, 2)]
    turns = rebuilt.select("conv_id", F.floor((F.col("depth") - 1) / SEGMENT).alias("seg"), "depth", "words", *ids)
    key = F.concat(*[F.lpad(F.hex(name), 16, "0") for name in ("t1", "t2")])
    cut = turns.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("depth", key.alias("key"), F.lpad(F.hex("words"), 16, "0").alias("words")))).alias("all"),
        F.sum("words").alias("sum"),
        F.bit_xor("t1").alias("x1"),
        F.bit_xor("t2").alias("x2"),
    )
    packed = [F.unhex(F.array_join(F.col(f"all.{name}"), "")).alias(name) for name in ("key", "words")]
    cut = scratch.stored(cut.select("conv_id", "seg", "x1", "x2", "sum", *packed), "cut")
    by_seg = Window.partitionBy("conv_id").orderBy("seg")
    before, after = by_seg.rowsBetween(Window.unboundedPreceding, -1), by_seg.rowsBetween(1, Window.unboundedFollowing)
    starts = [F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"s{i}") for i in (1, 2)]
    later = F.coalesce(F.sum("sum").over(after), F.lit(0)).alias("later")
    narrow = cut.select("conv_id", "seg", "x1", "x2", "sum").select("*", *starts, later)
    ends = [F.col(f"s{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"e{i}") for i in (1, 2)]
    narrow = scratch.stored(narrow.select("conv_id", "seg", "s1", "s2", *ends, "later"), "segments")
    group = ["seg", "s1", "s2", "e1", "e2"]
    rows = cut.select("conv_id", "seg", "key", "words").join(narrow, ["conv_id", "seg"])
    distinct = rows.groupBy(*group, "key", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    return narrow, scratch.stored(distinct, "distinct")


def _folded(rows: DataFrame) -> DataFrame:
    """Nodes of the radix trees of every task.

    ``rows``: seg, s1, s2, key, words, n, least, owns, rest, leaves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, here = None, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for seg, s1, s2, key, words, *sums in zip(*columns, strict=True):
                if (seg, s1, s2) != here or tree.bytes > TREE_BYTES:
                    yield from _batches(tree)
                    here, tree = (seg, s1, s2), Tree((s1, s2), seg * SEGMENT)
                tree.insert(Row(key, np.frombuffer(words, dtype=">i8"), *sums))
        yield from _batches(tree)

    columns = ["seg", "s1", "s2", "key", "words", "n", "least", "owns", "rest", "leaves"]
    dealt = rows.repartitionByRange("seg", "s1", "s2", "key").sortWithinPartitions("seg", "s1", "s2", "key")
    return dealt.select(*columns).mapInArrow(run, FOLDED)


def _batches(tree: Tree | None) -> Iterator[pa.RecordBatch]:
    """A tree's nodes in batches."""
    names = [field.split()[0] for field in FOLDED.split(", ")]
    paths: list[list[np.ndarray]] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*paths, strict=True)], names)

    size = 0
    for path in tree.fold() if tree else ():
        paths.append(path)
        size += len(path[0])
        if size > 10_000:
            yield batch()
            paths, size = [], 0
    if paths:
        yield batch()


def _nodes(distinct: DataFrame, turnless: DataFrame, scratch: Scratch) -> DataFrame:
    """First pass: every node with its members; the parent's conv_id and the children."""
    plain = distinct.select("*", F.lit(NOWHERE).alias("owns"), F.lit(0).alias("rest"), F.lit(0).alias("leaves"))
    root = [F.lit(0).cast("long").alias(name) for name in (*NODE, *FROM, "depth", "words")]
    alone = turnless.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).where("n > 0").select(*root, "n", "least")
    parts = _folded(plain).select(*NODE, *FROM, "depth", "words", "n", "least").unionAll(alone)
    whole = parts.groupBy(*NODE).agg(
        *[F.max(name).alias(name) for name in (*FROM, "depth", "words")],
        F.sum("n").alias("n_convs"),
        F.min("least").alias("conv_id"),
    )
    nodes = scratch.stored(whole, "nodes")
    below = nodes.where("depth > 0").groupBy(*[F.col(p).alias(i) for p, i in zip(FROM, NODE, strict=True)])
    below = below.agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(*[F.col(i).alias(p) for p, i in zip(FROM, NODE, strict=True)], F.col("conv_id").alias("parent"))
    joined = nodes.join(below, NODE, "left").join(above, FROM, "left")
    parent = F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id")
    return scratch.stored(
        joined.select(*NODE, "depth", "words", "n_convs", "conv_id", parent, F.coalesce("n_children", F.lit(0)).alias("n_children")),
        "nodes",
    )


def _subtrees(narrow: DataFrame, distinct: DataFrame, nodes: DataFrame) -> DataFrame:
    """Second pass: what every node's subtree saves, and its leaves."""
    owners = nodes.where("depth > 0").groupBy("conv_id").agg(
        F.min("depth").alias("entry"),
        F.sum("words").alias("owned"),
        F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"),
    )
    end = (F.col("seg") + 1) * SEGMENT
    own = F.when(F.col("entry").isNotNull(), F.greatest(F.col("entry") - F.col("seg") * SEGMENT, F.lit(1)))
    later_own = F.when(F.col("entry") <= end, F.col("later")).otherwise(F.coalesce("owned", F.lit(0)))
    rows = narrow.join(owners, "conv_id", "left")
    group = ["seg", "s1", "s2", "e1", "e2"]
    sums = rows.groupBy(*group).agg(
        F.coalesce(F.min(own), F.lit(NOWHERE)).alias("owns"),
        F.sum(F.col("later") - later_own).alias("rest"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("leaves"),
    )
    return _folded(distinct.join(sums, group)).groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the conv_ids that end in a node. ``ends``: i1, i2, conv_id, stored."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, str]] = []
        here, first, ids, size = None, 0, [], 0
        for batch in batches:
            for i1, i2, conv in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (i1, i2) != here or size > PIECE:
                    if ids:
                        out.append((*here, first, ",".join(ids)))
                    here, first, ids, size = (i1, i2), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1])
            yield _table(out, "i1 i2 first ids")
            out = []
        yield _table([(*here, first, ",".join(ids))] if ids else [], "i1 i2 first ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, digest = None, None
        for batch in batches:
            out = []
            for i1, i2, ids in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (i1, i2) == here:
                    digest.update(b"," + ids.encode())
                    continue
                if here:
                    out.append((*here, digest.hexdigest()))
                here, digest = (i1, i2), hashlib.sha256(ids.encode())
            yield _table(out, "i1 i2 ends_sha256")
        yield _table([(*here, digest.hexdigest())] if here else [], "i1 i2 ends_sha256")

    ranged = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    texts = ranged.mapInArrow(pieces, "i1 long, i2 long, first long, ids string")
    dealt = texts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.select(*NODE, "ids").mapInArrow(hashed, "i1 long, i2 long, ends_sha256 string")


def _table(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = [pa.string() if name in ("ids", "ends_sha256") else pa.int64() for name in names.split()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names.split())


def trie(conversations: DataFrame) -> DataFrame:
    """One row for every node of the trie of rebuilt conversations."""
    with Scratch(conversations.sparkSession, "trie") as scratch:
        turns = scratch.stored(_turns(conversations.select("conv_id", "turn", "role", "text")), "turns")
        turns = scratch.stored(numbered(turns, "conv_id", ["turn", "h1", "h2"], "pos", scratch), "numbered")
        rebuilt, sizes = _rebuilt(turns, scratch)
        narrow, distinct = _segments(rebuilt, scratch)
        turnless = sizes.where("size = 0")
        nodes = _nodes(distinct, turnless, scratch)
        sums = scratch.stored(_subtrees(narrow, distinct, nodes), "sums")
        # the last segment's end is where a conversation ends
        ends = narrow.groupBy("conv_id").agg(F.max(F.struct("seg", "e1", "e2")).alias("last"))
        ends = ends.select(F.col("last.e1").alias("i1"), F.col("last.e2").alias("i2"), "conv_id")
        zero = F.lit(0).cast("long")
        ends = ends.unionAll(turnless.select(zero.alias("i1"), zero.alias("i2"), "conv_id"))
        hashes = _end_hashes(scratch.stored(ends, "ends"))
        rows = nodes.join(sums, NODE, "left").join(hashes, NODE, "left")
        leaf = F.col("n_children") == 0
        return stored(
            rows.select(
                "conv_id",
                "depth",
                "parent_conv_id",
                "n_convs",
                "n_children",
                F.when(leaf, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
                F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
            ),
            "trie",
        )
