"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full sets decide.

A document is the set of its five-word shingles. Documents with the same set are one
class, stood for by the smallest doc_id. Classes that agree in a band of MinHash values
share a bucket. What a bucket proposes is compared in two rounds:

1. every member with the bucket's smallest member, its hub: as many pairs as members;
2. members whose component is not the hub's, with all members of the bucket that are in
   another component. These come in blocks: every class has one home, its smallest hub; a
   class left over visits the homes that its buckets hold. A block of a home is bounded by
   its shingles, and visitors stream past it, so no group is ever in memory and no list of
   pairs is made, however large a group of near copies is.

In both rounds an odd sketch comes first: the MinHash values of a set flip bits of a
bitmap, so shared values cancel in the XOR of two bitmaps, whose ones tell how many
differ. Pairs that could reach the threshold, five standard errors allowed, are decided
by the intersection of the full sets. Links make components.

With 24 bands of 5 values a pair at the threshold of 0.85 shares no band with a chance of
8 in ten million.

Nulls and odd rows: null text is the empty text; texts without words have an empty set,
are linked with nothing and kept; rows with a null doc_id are not linked, have a null
component and are kept; rows of one doc_id are one document; an empty table gives no
rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.llm.graph import components
from tagtide.llm.shingles import shingles
from tagtide.workspace import Scratch, stored

BANDS, ROWS = 24, 5
SAMPLES = BANDS * ROWS
BITS = 512
PERCENT = 85
#: Shingles in a block, and of the visitors that one task compares with it.
BLOCK_SHINGLES = 200_000

_random = np.random.default_rng(85)
MULTIPLIERS = _random.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)
ADDENDS = _random.integers(0, 2**32, SAMPLES, dtype=np.uint32)
PLACES = _random.integers(0, 2**63, SAMPLES, dtype=np.uint64) | np.uint64(1)


def minhash(found: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set that isn't empty."""
    values = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for cut in range(0, len(values), 256):
        hashed = MULTIPLIERS[:, None] * values[None, cut : cut + 256] + ADDENDS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of (function, value) pairs, as 64-bit words."""
    places = ((samples.astype(np.uint64) + np.uint64(1)) * PLACES) >> np.uint64(64 - int(math.log2(BITS)))
    odd = np.bincount(places.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def most_ones(percent: int) -> int:
    """Ones in the XOR of two sketches that a pair at the threshold has at most.

    As many values differ as a sample's mean plus five standard errors allows; each
    differing pair of values can set two bits.
    """
    share = 1 - percent / 100
    differ = SAMPLES * share + 5 * math.sqrt(SAMPLES * share * (1 - share))
    return min(BITS, math.ceil(2 * differ))


def signatures(docs: DataFrame) -> DataFrame:
    """One pass over the texts: set size, 128-bit hash of the set, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1024):
                few = batch.slice(cut, 1024)
                sizes, sets, bands = [], [], []
                for text in few.column(1).to_pylist():
                    found = shingles(text)
                    sizes.append(len(found))
                    sets.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    if len(found):
                        rows = minhash(found).reshape(BANDS, ROWS)
                        bands.append([xxhash.xxh3_64_intdigest(r.tobytes(), seed=i) - 2**63 for i, r in enumerate(rows)])
                    else:
                        bands.append([])
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(sets, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "set", "bands"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n long, set binary, bands array<long>")


class Block:
    """Sets that visitors are compared with."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.labels: list[int] = []
        self.sets: list[np.ndarray] = []
        self.seen: set[tuple[int, bytes]] = set()
        self.ready = False

    def add(self, id_: int, label: int, found: np.ndarray) -> None:
        key = (id_, xxhash.xxh3_128_digest(found.tobytes()))
        if key not in self.seen:
            self.seen.add(key)
            self.ids.append(id_)
            self.labels.append(label)
            self.sets.append(found)

    def prepare(self) -> None:
        self.sketches = np.array([odd_sketch(minhash(x)) for x in self.sets]).reshape(len(self.sets), -1)
        self.sizes = np.array([len(x) for x in self.sets], dtype=np.int64)
        owners = np.repeat(np.arange(len(self.sets)), self.sizes)
        values = np.concatenate([*self.sets, np.zeros(0, dtype=np.uint64)])
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]
        self.of, self.named = np.array(self.labels), np.array(self.ids)
        self.ready = True

    def links(self, id_: int, label: int, found: np.ndarray, percent: int, ones: int) -> list[tuple[int, int]]:
        """One link to each other component that the set reaches."""
        if not self.ready:
            self.prepare()
        apart = np.bitwise_count(self.sketches ^ odd_sketch(minhash(found))).sum(axis=1)
        near = np.flatnonzero((apart <= ones) & (self.of != label))
        if not len(near):
            return []
        low = np.searchsorted(self.values, found, "left")
        count = np.searchsorted(self.values, found, "right") - low
        low, count = low[count > 0], count[count > 0]
        at = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(low) else low
        shared = np.bincount(self.owners[at], minlength=len(self.sizes))[near]
        both = self.sizes[near] + len(found) - shared
        near = near[100 * shared >= percent * both]
        _, first = np.unique(self.of[near], return_index=True)
        return [(id_, int(self.named[i])) for i in near[first]]


def compared(work: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between the visitors (role 1) and the block (role 0) of each key.

    ``work``: key, slice, part, role, id, label, text. Rows come sorted, the block first.
    """
    ones = most_ones(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block = None, Block()
        for batch in batches:
            links: list[tuple[int, int]] = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for row in range(batch.num_rows):
                key = (columns[0][row], columns[1][row], columns[2][row])
                if key != here:
                    here, block = key, Block()
                id_, label = columns[4][row], columns[5][row]
                found = shingles(batch.column(6)[row].as_py())
                if columns[3][row] == 0:
                    block.add(id_, label, found)
                elif block.ids:
                    links += block.links(id_, label, found, percent, ones)
            u, v = zip(*links, strict=True) if links else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    keys = ["key", "slice", "part"]
    dealt = work.repartition(*keys).sortWithinPartitions(*keys, "role")
    return dealt.select(*keys, "role", "id", "label", "text").mapInArrow(run, "u long, v long")


def _pieces(column: str) -> Column:
    return F.ceil(F.sum(column) / BLOCK_SHINGLES).cast("int")


def _home_blocks(visits: DataFrame, nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks of the visited homes and their visitors: ``visits`` has id, label, n, home."""
    slices = nodes.groupBy("home").agg(_pieces("n").alias("slices"))
    parts = visits.groupBy("home").agg(_pieces("n").alias("parts"))
    plan = scratch.stored(parts.join(slices, "home"), "plan")
    own = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")
    block = nodes.select("home", F.col("node").alias("id"), "label").join(plan, "home")
    block = block.select(
        F.col("home").alias("key"),
        own.alias("slice"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("role"),
        "id",
        "label",
    )
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    come = visits.join(plan, "home").select(
        F.col("home").alias("key"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        part.alias("part"),
        F.lit(1).alias("role"),
        "id",
        "label",
    )
    rows = scratch.stored(block.unionAll(come), "rows")
    return rows.join(texts.select(F.col("node").alias("id"), "text"), "id")


def group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``. Runs jobs when called."""
    signed = stored(signatures(docs), "signatures")
    with Scratch(docs.sparkSession, "near-dedup") as scratch:
        whole = stored(_components(docs, signed, percent, scratch), "whole")
    rows = signed.select("doc_id", "n", "set").join(whole, "set", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _components(docs: DataFrame, signed: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The component of every set."""
    classes = signed.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("doc_id").alias("rep"))
    classes = scratch.stored(classes, "classes")
    reps = signed.join(
        classes.select(F.col("set").alias("_set"), "rep"),
        (F.col("doc_id") == F.col("rep")) & (F.col("set") == F.col("_set")),
        "left_semi",
    )
    reps = scratch.stored(reps.select(F.col("doc_id").alias("node"), "n", "bands"), "reps")
    banded = reps.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("_last"))
    shared = scratch.stored(shared.where("hub < _last").drop("_last"), "buckets")
    members = scratch.stored(banded.join(shared, "bucket"), "members")
    nodes = members.groupBy("node").agg(F.min("hub").alias("home"))
    sizes = reps.groupBy("node").agg(F.max("n").alias("n"))
    nodes = scratch.stored(nodes.join(sizes, "node"), "nodes")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    texts = scratch.stored(texts.join(nodes.select("node"), "node", "left_semi"), "texts")

    # Round 1: members with their hub.
    pairs = members.where("node != hub").select("hub", "node").distinct().join(nodes.select("node", "n"), "node")
    alone = nodes.select("node", F.col("node").alias("home"), F.col("node").alias("label"), "n")
    visits = pairs.select(F.col("node").alias("id"), F.col("node").alias("label"), "n", F.col("hub").alias("home"))
    work = _home_blocks(scratch.stored(visits, "visits"), alone, texts, scratch)
    links = scratch.stored(compared(work, percent), "links")

    # Round 2: who is in another component than its bucket's hub.
    nodes = nodes.join(components(links), "node", "left")
    nodes = nodes.withColumn("label", F.coalesce("component", "node")).drop("component")
    nodes = scratch.stored(nodes, "nodes")
    known = members.select("bucket", "node", "hub").join(nodes, "node")
    hubs = nodes.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    known = scratch.stored(known.join(hubs, "hub"), "known")
    left = known.where("label != hub_label").select("bucket", F.col("node").alias("id"), "label", "n")
    homes = known.join(left.select("bucket").distinct(), "bucket", "left_semi")
    homes = homes.groupBy("bucket", "home").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    visits = left.join(scratch.stored(homes, "homes"), "bucket").where("least != label OR most != label")
    visits = scratch.stored(visits.select("id", "label", "n", "home").distinct(), "visits")
    more = scratch.stored(compared(_home_blocks(visits, nodes, texts, scratch), percent), "links")
    found = components(links.unionAll(more))
    whole = classes.join(found, F.col("rep") == F.col("node"), "left")
    return whole.select("set", F.coalesce("component", "rep").alias("component_id"))


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with all its columns.

    The ids that go are held against ``docs``: they are fewer than those that stay.
    """
    found = group(docs.select("doc_id", "text"), percent).where("doc_id IS NOT NULL")
    # rows of an id are one document, though their texts may be in several classes
    ids = found.groupBy(F.col("doc_id").alias("_id")).agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
    ids = stored(ids.where("NOT _kept OR _rows > 1"), "going")
    gone = ids.where("NOT _kept").select("_id").alias("g")
    first = docs.alias("d").join(gone, F.col("d.doc_id") == F.col("g._id"), "left_anti")
    if ids.where("_kept").isEmpty():  # texts are shuffled only if there is a row to drop
        return first
    return first.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).unionAll(docs.where(F.col("doc_id").isNull()))
