"""Approximate nearest neighbours by a hierarchical k-means tree, best bin first.

The tree is fitted on a bounded sample (``SAMPLE`` vectors); every vector is then filed in
one of its leaves. A query walks the tree with a priority queue: the most promising node
comes off, its children go on, until enough leaves have been visited. How many are enough
is calibrated: visits widen until sample queries, held against brute force on the sample,
reach the wanted recall. The sample is thinner than the table, so its neighbours lie
further out and the calibration errs on the safe side.

Of equal vectors only as many with the smallest ids are filed as a result can hold, one
more for the query itself: the others could not be in any result. Leaves lie on shelves of
a bounded number of vectors, a large leaf on several; a task searches one shelf for a
bounded part of the queries, and gives the k best of each.

Nulls and odd rows: vectors null, empty, zero, or with null or non-finite components take
no part, nor do rows with a null id, nor vectors of another length than the most frequent
in the sample; ties go to the smaller id; fewer candidates than k give what is there; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.llm.vectors import packed
from tagtide.workspace import stored

SAMPLE = 20_000
BRANCHES = 8
LEAF_ROWS = 256
MOST_LEAVES = 4_096
RECALL = 0.95
CALIBRATION_QUERIES = 300
#: Vectors on a shelf, and queries that meet them in one task.
CELL_ROWS = 16_384
QUERY_ROWS = 4_096
SEED = 64


def kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of at most k clusters; copies give fewer."""
    generator = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    if len(points) <= k:
        return points
    centres = points[generator.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        label = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, points)
        counts = np.bincount(label, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ (-2.0 * centres.T) + (centres**2).sum(axis=1)).argmin(axis=1)


class Tree:
    """Nodes with centres and spreads; a leaf has no children."""

    def __init__(self, sample: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = SEED):
        self.centres = [sample.mean(axis=0)]
        self.spread = [0.0]
        self.children: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
        groups = [(-len(sample), 0, np.arange(len(sample)))]
        done = 1
        while groups and done < leaves:
            size, node, rows = heapq.heappop(groups)
            if -size < 2:
                break
            centres = kmeans(sample[rows], min(branches, leaves - done + 1), seed + node)
            if len(centres) < 2:
                continue
            label = nearest(sample[rows], centres)
            first = len(self.centres)
            for i, centre in enumerate(centres):
                own = rows[label == i]
                apart = np.sqrt(((sample[own] - centre) ** 2).sum(axis=1)) if len(own) else np.zeros(1)
                self.centres.append(centre)
                self.spread.append(float(apart.mean()))
                self.children.append(np.zeros(0, dtype=np.int64))
                heapq.heappush(groups, (-len(own), first + i, own))
            self.children[node] = np.arange(first, first + len(centres))
            done += len(centres) - 1
        self.matrix, self.spreads = np.array(self.centres), np.array(self.spread)

    def file(self, points: np.ndarray) -> np.ndarray:
        """The leaf of every point: the nearest child, down from the root."""
        leaf = np.zeros(len(points), dtype=np.int64)
        queue = [(0, np.arange(len(points)))]
        while queue:
            node, rows = queue.pop()
            leaf[rows] = node
            if len(self.children[node]) and len(rows):
                label = nearest(points[rows], self.matrix[self.children[node]])
                queue += [(int(child), rows[label == i]) for i, child in enumerate(self.children[node])]
        return leaf

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """Leaves in the order in which the priority queue gives them.

        A node promises the product with its centre and what its spread can add.
        """
        promise = self.matrix @ query + self.spreads * np.sqrt(query @ query)
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if len(self.children[node]):
                for child in self.children[node]:
                    heapq.heappush(queue, (-promise[child], int(child)))
            else:
                found.append(node)
        return found

    @property
    def leaves(self) -> int:
        return sum(not len(c) for c in self.children)


def calibrate(tree: Tree, sample: np.ndarray, k: int, recall: float, queries: int = CALIBRATION_QUERIES) -> int:
    """Leaves to visit, widened until the k best of the sample are found as often as wanted."""
    filed = tree.file(sample)
    step = max(1, len(sample) // queries)
    needed = []
    for i in range(0, len(sample), step):
        scores = sample @ sample[i]
        scores[i] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(k, len(sample) - 1)]
        place = {leaf: n for n, leaf in enumerate(tree.visit(sample[i], tree.leaves))}
        needed += [place[leaf] for leaf in filed[best]]
    if not needed:
        return tree.leaves
    visits, needed = 1, np.array(needed)
    while (needed < visits).mean() < recall and visits < tree.leaves:
        visits += max(1, visits // 4)
    return min(visits, tree.leaves)


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component on, so equal vectors score alike."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def shelves(counts: dict[int, int], nodes: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First shelf and number of shelves of every node: small leaves share one, large ones get several."""
    first, number = np.zeros(nodes, dtype=np.int64), np.ones(nodes, dtype=np.int64)
    shelf, room = 0, most
    for leaf in sorted(counts):
        if counts[leaf] > room:
            shelf, room = shelf + (room < most), most
        first[leaf] = shelf
        if counts[leaf] > most:
            number[leaf] = ceil(counts[leaf] / most)
            shelf, room = shelf + number[leaf], most
        else:
            room -= counts[leaf]
    return first, number


def cell(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of a shelf's vectors for each query, of the leaves that the query visits."""
    own = rows[rows["role"] == 0].sort_values("leaf", kind="stable")
    asked = rows[rows["role"] == 1]
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(own) and len(asked):
        ids, vectors = own["vec_id"].to_numpy(), np.array([np.frombuffer(x, "<f8") for x in own["x"]])
        leaves, starts = np.unique(own["leaf"].to_numpy(), return_index=True)
        ends = np.append(starts[1:], len(ids))
        place = {leaf: i for i, leaf in enumerate(leaves)}
        longest = np.sqrt((vectors**2).sum(axis=1).max())
        for low in range(0, len(asked), 256):
            few = asked.iloc[low : low + 256]
            queries = np.array([np.frombuffer(x, "<f8") for x in few["x"]])
            visits = np.zeros((len(few), len(leaves)), dtype=bool)
            for i, wanted in enumerate(few["leaves"]):
                visits[i, [place[leaf] for leaf in wanted if leaf in place]] = True
            rough = np.full((len(few), len(ids)), -np.inf)
            for j, (start, end) in enumerate(zip(starts, ends, strict=True)):
                some = np.flatnonzero(visits[:, j])
                if len(some):
                    rough[some, start:end] = queries[some] @ vectors[start:end].T
            for query, query_id, scores in zip(queries, few["vec_id"].to_numpy(), rough, strict=True):
                scores[ids == query_id] = -np.inf
                least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else -np.inf
                near = np.flatnonzero(scores >= least - 1e-9 * longest * np.sqrt(query @ query))
                near = near[np.isfinite(scores[near])]
                if len(near):
                    sure = exact(vectors[near], query)
                    top = np.lexsort((ids[near], -sure))[:k]
                    out["query_id"] += [query_id] * len(top)
                    out["vec_id"] += ids[near][top].tolist()
                    out["score"] += sure[top].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(
    vectors: DataFrame,
    is_query: str,
    k: int,
    recall: float = RECALL,
    sample: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
    cell_rows: int = CELL_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found for every query row."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    whole = stored(packed(vectors, lambda v: v if v.any() else None), "vectors")
    n = whole.count()
    share = min(1_000_000, ceil(1_000_000 * sample / max(1, n)))
    picked = F.pmod(F.xxhash64("x", "vec_id"), F.lit(1_000_000)) < share
    # Bounded by ``sample``, but for the luck of the hash.
    drawn = [np.frombuffer(r["x"], "<f8") for r in whole.where(picked).select("x", "vec_id").orderBy("vec_id", "x").collect()]
    if not drawn:
        return spark.createDataFrame([], result)
    width = int(np.bincount([len(x) for x in drawn]).argmax())
    fitted = np.array([x for x in drawn if len(x) == width])
    tree = Tree(fitted, max(1, min(MOST_LEAVES, n // leaf_rows)))
    visits = calibrate(tree, fitted, k, recall)
    shared = spark.sparkContext.broadcast(tree)  # MOST_LEAVES centres and their parents at most

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            leaf = shared.value.file(np.array([np.frombuffer(x, "<f8") for x in rows]).reshape(len(rows), width))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *batch.columns], ["leaf", "vec_id", "x"])

    fit = whole.where(F.octet_length("x") == 8 * width)
    alike = Window.partitionBy("x").orderBy("vec_id")  # limited map-side
    needed = fit.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1).select("vec_id", "x")
    filed = stored(needed.mapInArrow(file, "leaf long, vec_id long, x binary"), "filed")
    counts = {r["leaf"]: r["n"] for r in filed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(shelves(counts, len(tree.centres), cell_rows))  # two numbers a node
    parts = max(1, ceil(fit.where(is_query).count() / query_rows))

    def shelve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every part of the queries meets every vector's shelf once."""
        first, number = plan.value
        for batch in batches:
            leaf = batch.column(0).to_numpy()
            own = np.array([xxhash.xxh3_64_intdigest(x) for x in batch.column(2).to_pylist()], dtype=np.uint64)
            own = (own + batch.column(1).to_numpy().astype(np.uint64)) % number[leaf].astype(np.uint64)
            shelf = first[leaf] + own.astype(np.int64)
            for part in range(parts):
                yield rows_of(shelf, part, 0, leaf, [[]] * len(leaf), batch.column(1), batch.column(2))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query goes to the shelves of the leaves that it visits."""
        first, number = plan.value
        for batch in batches:
            for cut in range(0, batch.num_rows, 512):
                few = batch.slice(cut, 512)
                shelf, wanted, at = [], [], []
                for i, x in enumerate(few.column(1).to_pylist()):
                    by: dict[int, list[int]] = {}
                    for leaf in shared.value.visit(np.frombuffer(x, "<f8"), visits):
                        for n in range(number[leaf]):
                            by.setdefault(int(first[leaf]) + n, []).append(leaf)
                    shelf += list(by)
                    wanted += list(by.values())
                    at += [i] * len(by)
                ids = few.column(0).take(pa.array(at, pa.int64()))
                part = np.array([xxhash.xxh3_64_intdigest(str(i)) % parts for i in ids.to_pylist()], dtype=np.int64)
                yield rows_of(shelf, part, 1, [0] * len(at), wanted, ids, few.column(1).take(pa.array(at, pa.int64())))

    def rows_of(shelf, part, role, leaf, leaves, ids, x) -> pa.RecordBatch:
        n = len(ids)
        columns = [
            pa.array(shelf, pa.int64()),
            pa.array(np.broadcast_to(part, n), pa.int64()),
            pa.array(np.broadcast_to(role, n), pa.int32()),
            pa.array(leaf, pa.int64()),
            pa.array(leaves, pa.list_(pa.int64())),
            ids,
            x,
        ]
        return pa.RecordBatch.from_arrays(columns, ["shelf", "part", "role", "leaf", "leaves", "vec_id", "x"])

    kind = "shelf long, part long, role int, leaf long, leaves array<long>, vec_id long, x binary"
    both = filed.mapInArrow(shelve, kind).unionAll(fit.where(is_query).mapInArrow(route, kind))
    found = both.groupBy("shelf", "part").applyInPandas(
        lambda rows: cell(rows, k), "query_id long, vec_id long, score double"
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
