import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from tagtide.llm import queries, topk, tree_search

VECTOR = "vec_id long, embedding array<float>, label int, x string, leaf int, rank int"


def odd_vectors(n=400, width=8, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [rng.gauss(0, 1) for _ in range(width)]
        if i % 3 == 0:
            vector = [0.5] * width  # a third are the same
        rows.append((i, vector))
    rows += [(1000, None), (1050, []), (1100, [1.0, None] * 4), (1150, [math.nan] * width), (1200, [math.inf] * width)]
    rows += [(1250, [0.0] * width), (None, [1.0] * width), (100, [2.0] * width), (100, [2.0] * width)]
    return [(i, v, 0, "x", 1, 2) for i, v in rows]


def valid(rows, zero):
    kept = []
    for i, vector, *_ in rows:
        if i is not None and vector and None not in vector:
            x = np.array(vector, dtype=np.float32).astype(np.float64)
            if np.isfinite(x).all() and (zero or x.any()):
                kept.append((i, x))
    return kept


def brute(rows, step, k, change, zero):
    kept = [(i, change(x)) for i, x in valid(rows, zero)]
    out = []
    for q, x in kept:
        if q % step == 0:
            scores = sorted((-float(np.cumsum(x * y)[-1]), i) for i, y in kept if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def by_query(rows):
    """Queries of a repeated id share a list: compare what an id has found."""
    return sorted({(r[0], r[2], float(r[3])) for r in rows})


@pytest.mark.parametrize("blocks", [(4096, 16384), (3, 50)])
def test_exact_top_k(spark, blocks):
    rows = [r for r in odd_vectors() if r[0] != 100 or r[1] != [2.0] * 8]
    frame = spark.createDataFrame(rows, VECTOR).repartition(5)
    found = topk.top_k(frame, "vec_id % 50 = 0", 5, query_block=blocks[0], candidate_block=blocks[1])
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    wanted = brute(rows, 50, 5, lambda x: np.floor(256 * x), True)
    assert sorted((r[0], r[1], r[2], float(r[3])) for r in found.collect()) == wanted


def test_branch_and_bound_prunes_nothing_it_needs():
    rng = np.random.default_rng(4)
    vectors = np.floor(256 * rng.normal(size=(9_000, 40)) * np.linspace(3, 0.1, 40))
    queries_ = vectors[::900]
    ids = np.arange(9_000)
    found = topk.search(queries_, ids[::900], vectors, ids, 5, step=8)
    for q, (scores, named) in zip(ids[::900], found, strict=True):
        exact = vectors @ vectors[q]
        exact[q] = -np.inf
        top = np.lexsort((ids, -exact))[:5]
        assert named.tolist() == top.tolist() and scores.tolist() == exact[top].tolist()


def test_top_k_sql(spark, tmp_path):
    rows = [r for r in odd_vectors(150) if r[0] is not None and r[0] < 1000 and r[1] != [2.0] * 8]
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [np.array(r[1], np.float32) for r in rows]}))
    theirs = sorted(map(tuple, con.execute(queries.OP9_SQL).fetchall()))
    ours = topk.top_k(spark.createDataFrame(rows, VECTOR), "vec_id % 50 = 0", 5).collect()
    assert sorted(map(tuple, ours)) == theirs


def test_fewer_candidates_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (50, [1.0])], "vec_id long, embedding array<double>")
    found = sorted(map(tuple, topk.top_k(few, "vec_id % 50 = 0", 5).collect()))
    assert found == [(0, 1, 1, (256 * 3 + 2 * 256 * 4) * 256)]
    assert topk.top_k(few.limit(0), "vec_id % 50 = 0", 5).collect() == []
    near = tree_search.search(few, "vec_id % 20 = 0", 20)
    assert [tuple(r) for r in near.collect()] == [(0, 1, 1, 11.0)]
    assert tree_search.search(few.limit(0), "vec_id % 20 = 0", 20).collect() == []


def test_tree_search_of_odd_vectors(spark):
    rows = odd_vectors()
    frame = spark.createDataFrame(rows, VECTOR).repartition(5)
    found = [tuple(r) for r in tree_search.search(frame, "vec_id % 20 = 0", 20, recall=1.0, leaf_rows=40, cell_rows=30, query_rows=7).collect()]
    wanted = brute([r for r in rows if r[0] != 100], 20, 20, lambda x: x, False)
    mine = [r for r in found if r[0] != 100]
    hits = {(q, i) for q, _, i, _ in wanted} & {(q, i) for q, _, i, _ in mine}
    assert len(hits) >= 0.9 * len(wanted)
    exact = {(q, i): s for q, _, i, s in brute([r for r in rows if r[0] != 100], 20, 500, lambda x: x, False)}
    for q, _, i, score in mine:
        if i != 100:
            assert score == exact[q, i]
    for q in {r[0] for r in mine}:
        own = sorted((n, -s, i) for p, n, i, s in mine if p == q)
        assert [n for n, *_ in own] == list(range(1, len(own) + 1))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)
        assert q not in {i for *_, i in own}


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 24))
    points = centres[rng.integers(60, size=6_000)] + 0.35 * rng.normal(size=(6_000, 24))
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = tree_search.search(frame, "vec_id % 20 = 0", 20, sample=3_000, leaf_rows=60).collect()
    mine = {}
    for r in found:
        mine.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(0, 6_000, 20):
        scores = points @ points[q]
        scores[q] = -np.inf
        hit += len(set(np.argsort(-scores)[:20].tolist()) & mine[q])
    assert hit >= 0.9 * 300 * 20


def test_best_bin_first_visits_every_leaf_once():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(800, 6))
    tree = tree_search.Tree(sample, 30)
    order = tree.visit(sample[0], 10_000)
    assert len(order) == len(set(order)) == tree.leaves <= 30
    assert set(tree.file(sample)) <= set(order)
    assert tree_search.calibrate(tree, sample, 10, 1.0) <= tree.leaves
    assert tree_search.calibrate(tree, sample, 10, 0.5) <= tree_search.calibrate(tree, sample, 10, 0.95)


def test_shelves_hold_every_leaf_within_bounds():
    rng = random.Random(3)
    counts = {leaf: rng.choice([1, 5, 30, 99, 100, 101, 250]) for leaf in rng.sample(range(300), 120)}
    first, number = tree_search.shelves(counts, 300, 100)
    load, owners = {}, {}
    for leaf, n in counts.items():
        for s in range(first[leaf], first[leaf] + number[leaf]):
            load[s] = load.get(s, 0) + n / number[leaf]
            owners.setdefault(s, []).append(leaf)
    assert all(x <= 100 for x in load.values()) and sorted(load) == list(range(len(load)))
    assert all(len(o) == 1 for o in owners.values() if number[o[0]] > 1)


@pytest.mark.parametrize(("size", "kind"), [(1.0, np.float64), (1e6, np.int64), (2.9e6, np.int64), (1e12, object), (1e300, object), (1.7e308, object)])
def test_exact_top_k_of_large_components(spark, size, kind):
    """Sums of integers of any size rank the candidates; those beyond a long are cut to it, and ties."""
    from math import floor

    rng = np.random.default_rng(9)
    frame = [(i, [float(x) for x in rng.uniform(-1, 1, 16) * size], 0) for i in range(120)]
    frame += [(200, frame[1][1], 0), (201, [0.0] * 16, 0)]

    def scaled(x):
        return 256 * int(x) if abs(x) >= 2**53 else floor(256 * x)

    exact = {i: [scaled(x) for x in v] for i, v, _ in frame}
    wanted = []
    for q in (i for i in exact if i % 50 == 0):
        sums = {i: sum(a * b for a, b in zip(exact[q], exact[i], strict=True)) for i in exact if i != q}
        cut = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for i, s in sums.items())
        wanted += [(q, n, i, -less) for n, (less, i) in enumerate(cut[:5], 1)]
    whole = topk.whole([np.array(v) for _, v, _ in frame], 256)
    assert topk.as_kind(whole, whole)[0].dtype == kind
    found = topk.top_k(spark.createDataFrame(frame, "vec_id long, embedding array<double>, label int"), "vec_id % 50 = 0", 5)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
