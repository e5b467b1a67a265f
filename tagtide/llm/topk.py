"""Exact top-k by inner product: columnar branch and bound.

Vectors lie dimension by dimension. Scores grow by blocks of dimensions, those with most
mass first. After each block a candidate's score so far plus the product of the lengths
of both vectors' remaining parts bounds its score; candidates below the k-th best score
known are compacted away, so later blocks touch few of them. Candidates come by falling
length, so the first ones give good k-th scores, and scoring stops where the lengths alone
rule out the rest.

Work is dealt in cells of a bounded block of queries and a bounded block of candidates;
each cell gives its k best per query, and the k best of these are the answer. Every pair
is covered by one cell, and nothing is broadcast.

Sums are exact for components of any size. The largest components of a cell and its width
bound its sums: below 2**53 they are doubles, below 2**63 they are 64-bit integers, with a
margin for rounding in the bounds, and else integers of any size, all of which are worked
out. A score beyond a long is the nearest long, also for ranks, so such scores are ties.

Nulls and odd rows: vectors null, empty, or with null or non-finite components take no
part, nor do rows with a null id; queries meet the candidates of their own length; rows of
one id are candidates each, but never of a query of that id; ties go to the smaller id;
fewer candidates than k give all; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from heapq import nsmallest
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.llm.vectors import packed
from tagtide.workspace import stored

SCALE = 256
QUERY_BLOCK = 4_096
CANDIDATE_BLOCK = 16_384
DIMENSIONS = 16
CHUNK = 2_048


LONG = 2**63 - 1
DOUBLES, LONGS = 2**53, 2**63
#: Share of the sums that rounding may take from a bound on 64-bit sums.
MARGIN = 1e-12


def whole(rows: list[np.ndarray], scale: int) -> np.ndarray:
    """floor(scale * component): doubles where that is exact, else integers of any size."""
    values = np.array(rows)
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values)
    if np.isfinite(scaled).all():
        return scaled
    exact = [[scale * int(x) if abs(x) >= DOUBLES else floor(scale * x) for x in row] for row in values.tolist()]
    return np.array(exact, dtype=object)


def as_kind(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in the narrowest kind of number that holds every sum exactly."""
    bound = int(max(1, np.abs(queries).max())) * int(max(1, np.abs(vectors).max())) * queries.shape[1]
    if bound < DOUBLES:
        return queries, vectors
    kind = np.int64 if bound < LONGS else object
    if kind is object:
        return tuple(np.array([[int(x) for x in row] for row in side], dtype=object) for side in (queries, vectors))
    return queries.astype(kind), vectors.astype(kind)


def search_all(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[list[int], list[int]]]:
    """The same for integers of any size, by all sums; scores are cut to a long."""
    found = []
    for query, own in zip(queries, query_ids, strict=True):
        scores = vectors @ query
        cut = (max(-LONG - 1, min(LONG, int(score))) for score in scores)
        best = nsmallest(k, ((-score, int(i)) for score, i in zip(cut, ids, strict=True) if i != own))
        found.append(([-less for less, _ in best], [i for _, i in best]))
    return found


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, step: int = DIMENSIONS
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scores and ids of the k best per query.

    Values are whole numbers, as doubles whose sums stay below 2**53, or as 64-bit integers.
    """
    sizes = vectors.astype(np.float64)
    dims = np.argsort(-(sizes**2).sum(axis=0), kind="stable")
    cuts = list(range(0, len(dims), step))
    order = np.argsort(-(sizes**2).sum(axis=1), kind="stable")
    vectors, ids = vectors[order][:, dims], ids[order]
    queries = queries[:, dims]
    margin = MARGIN if queries.dtype == np.int64 else 0.0
    # lengths of the parts from each cut on; a little more, for rounding
    rest_v = [np.sqrt((vectors[:, c:].astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9) for c in cuts]
    rest_q = [np.sqrt((queries[:, c:].astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9) for c in cuts]
    found = [(np.zeros(0, dtype=queries.dtype), np.zeros(0, dtype=np.int64)) for _ in range(len(queries))]
    # the k-th best score so far, for bounds and, in the kind of the scores, for the end
    bar = np.full(len(queries), -np.inf)
    known = bar.copy() if margin == 0.0 else np.full(len(queries), -LONG)
    for low in range(0, len(vectors), CHUNK):
        high = min(len(vectors), low + CHUNK)
        live = np.flatnonzero(rest_q[0] * rest_v[0][low] >= (bar - margin * np.abs(bar) if margin else bar))
        if not len(live):
            break
        columns = np.ascontiguousarray(vectors[low:high].T)  # dimension by dimension
        first = queries[np.ix_(live, range(0, min(step, len(dims))))] @ columns[:step]
        for i, q in enumerate(live):
            some, score = np.arange(high - low), first[i]
            for c in cuts[1:]:
                place = c // step
                most = score + rest_q[place][q] * rest_v[place][low:high][some]
                keep = most >= bar[q] - (margin * (np.abs(score) + abs(bar[q])) if margin else 0.0)
                some, score = some[keep], score[keep]
                if not len(some):
                    break
                score = score + queries[q, c : c + step] @ columns[c : c + step][:, some]
            keep = (score >= known[q]) & (ids[low:high][some] != query_ids[q])
            some, score = some[keep], score[keep]
            if not len(some):
                continue
            scores = np.concatenate([found[q][0], score])
            named = np.concatenate([found[q][1], ids[low:high][some]])
            top = best(scores, named, k)
            found[q] = (scores[top], named[top])
            if len(top) == k:
                known[q] = bar[q] = scores[top[-1]]
    return found


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query row."""
    rows = stored(packed(vectors), "vectors")
    asked = rows.where(is_query)
    counts = rows.agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.expr(is_query), 1)).alias("asked")).first()
    q_blocks, c_blocks = max(1, ceil(counts["asked"] / query_block)), max(1, ceil(counts["all"] / candidate_block))
    hashed, zero = F.xxhash64("vec_id", "x"), F.lit(0).cast("long")
    cells = asked.select(
        F.pmod(hashed, F.lit(q_blocks)).alias("q"),
        F.explode(F.sequence(zero, F.lit(c_blocks - 1).cast("long"))).alias("c"),
        F.lit(0).alias("role"),
        "vec_id",
        "x",
    ).unionAll(
        rows.select(
            F.explode(F.sequence(zero, F.lit(q_blocks - 1).cast("long"))).alias("q"),
            # rows alike in everything are dealt out by a number of their own
            F.pmod(F.xxhash64("vec_id", "x", F.monotonically_increasing_id()), F.lit(c_blocks)).alias("c"),
            F.lit(1).alias("role"),
            "vec_id",
            "x",
        )
    )

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for role in (0, 1):
            side = rows[rows["role"] == role].sort_values("vec_id", kind="stable")
            sides += [side["vec_id"].to_numpy(), [np.frombuffer(x, "<f8") for x in side["x"]]]
        query_ids, queries, ids, candidates = sides
        out = {"query_id": [], "vec_id": [], "score": []}
        for width in sorted({len(x) for x in queries}):
            at = np.array([i for i, x in enumerate(queries) if len(x) == width])
            to = np.array([i for i, x in enumerate(candidates) if len(x) == width], dtype=np.int64)
            if not len(to):
                continue
            matrix, others = as_kind(whole([queries[i] for i in at], scale), whole([candidates[i] for i in to], scale))
            by = search_all if matrix.dtype == object else search
            for i, (scores, named) in zip(at, by(matrix, query_ids[at], others, ids[to], k), strict=True):
                out["query_id"] += [query_ids[i]] * len(named)
                out["vec_id"] += list(map(int, named))
                out["score"] += list(map(int, scores))
        return pd.DataFrame(out).astype("int64")

    found = cells.groupBy("q", "c").applyInPandas(cell, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
