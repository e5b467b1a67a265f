import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import DOCUMENT, row, words

from tagtide.llm import mixing as M


def size(text):
    return len((text or "").encode().split())


def filled(sizes):
    """Targets by the contract, one source over its limit at a time."""
    weights, caps = [(3, 1, 2)[i % 3] for i in range(len(sizes))], [2 * n for n in sizes]
    fixed = {}
    while True:
        left = 1.5 * sum(sizes) - sum(fixed.values())
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        want = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if want[i] > caps[i]]
        if not over:
            return [fixed.get(i, want.get(i)) for i in range(len(sizes))]
        fixed[over[0]] = caps[over[0]]


def sums(rows):
    found = defaultdict(int)
    for _, text, _, source, _ in rows:
        found[source] += size(text)
    order = sorted(found, key=lambda s: (s is None, s or ""))
    return dict(zip(order, zip([found[s] for s in order], filled([found[s] for s in order]), strict=True), strict=True))


def plan_checked(rows, found):
    wanted = sums(rows)
    taken = defaultdict(int)
    for r in found:
        assert r["size"] == size(r["text"]) and r["source_size"] == wanted[r["source"]][0]
        assert r["target"] == pytest.approx(wanted[r["source"]][1])
        words_ = sum(d["words"] for d in r["draws"])
        assert words_ <= 2 * r["size"] and all(0 < d["words"] <= r["size"] for d in r["draws"])
        assert len({d["copy"] for d in r["draws"]}) == len(r["draws"])
        taken[r["source"]] += words_
    return taken, wanted


def test_odd_rows(odd, odd_rows):
    found = M.plan(odd.select("doc_id", "text", "lang", "source", "n_chars")).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in odd_rows)
    taken, wanted = plan_checked(odd_rows, found)
    for source, (_, target) in wanted.items():
        # rows that are alike share what is left of a cut block, in whole words
        assert abs(taken[source] - target) <= 31


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    return [
        row(i, " ".join(words(rng, rng.randint(0, 60))), "hot" if rng.random() < 1 / 3 else f"s{rng.randrange(6)}")
        for i in range(900)
    ]


def test_targets_are_met_and_reruns_agree(spark, corpus):
    options = {"block_words": 300, "shard_blocks": 5}
    runs = []
    for parts in (3, 7):
        docs = spark.createDataFrame(corpus, DOCUMENT).repartition(parts)
        found = M.plan(docs, **options).collect()
        taken, wanted = plan_checked(corpus, found)
        for source, (_, target) in wanted.items():
            assert abs(taken[source] - target) <= 1
        runs.append({r.doc_id: r.draws for r in found})
    assert runs[0] == runs[1]
    # without texts the plan is the same
    narrow = M.plan(spark.createDataFrame(corpus, DOCUMENT), texts=False, **options).collect()
    assert {r.doc_id: r.draws for r in narrow} == runs[0]


def test_mix_gives_the_planned_copies(spark, corpus, odd, odd_rows):
    options = {"block_words": 300, "shard_blocks": 5}
    docs = spark.createDataFrame(corpus, DOCUMENT).repartition(4)
    planned = {r.doc_id: r for r in M.plan(docs, **options).collect()}
    rows = M.mix(docs, **options).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
        assert r.n_chars == len(r.text)
    texts = {r[0]: r[1] for r in corpus}
    for doc_id, r in planned.items():
        got = sorted((x["copy"], x.shard, size(x.text)) for x in found.get(doc_id, []))
        assert got == sorted((d["copy"], d.shard, d.words) for d in r.draws)
        assert all(texts[doc_id].startswith(x.text) for x in found.get(doc_id, []))
    # shuffled in its shard: neighbours don't come in order of their ids
    one = [r.doc_id for r in rows if r.shard == 0]
    assert len(one) > 20 and one != sorted(one)
    mixed = M.mix(odd, more=())
    assert mixed.columns == odd.columns
    row_ = mixed.first()
    assert row_["size"] == "size" and row_["_c0"] == "_c0"


def test_quotas_split_exactly():
    quotas = [1000, 0, 3, 57, 1]
    parts = [M.quota(i, 37, quotas, 1) for i in range(37)]
    assert np.array_equal(sum(here for _, here in parts), quotas)
    reached = np.zeros(5, dtype=int)
    for before, here in parts:
        assert np.array_equal(before, reached)
        reached += here
    sizes = [int(here.sum()) for _, here in parts]
    assert max(sizes) - min(sizes) <= 2
    assert [p[1].tolist() for p in parts] == [M.quota(i, 37, quotas, 1)[1].tolist() for i in range(37)]


def test_targets():
    assert M.targets([0, 0], (3, 1), 1.5, 2) == [0.0, 0.0]
    assert M.targets([100], (3,), 1.5, 2) == [150.0]
    for sizes in ([10, 1000, 10], [5, 5, 5, 5], [1, 0, 7, 300, 2, 9]):
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        assert M.targets(sizes, weights, 1.5, 2) == pytest.approx(filled(sizes))


def test_empty_table(none):
    assert M.plan(none).collect() == [] and M.mix(none).collect() == []


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([row(1, None), row(2, " ")], DOCUMENT)
    assert [(r["size"], r.target, r.draws) for r in M.plan(docs).collect()] == [(0, 0.0, [])] * 2


def test_the_tree_deals_the_draws_of_the_query(spark, tmp_path, monkeypatch):
    """The query gives the copies and shards that were drawn; another tree gives other shards."""
    from tagtide.llm import queries

    rng = random.Random(4)
    rows = [row(i, " ".join(words(rng, 40)), rng.choice("abc")) for i in range(300)]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(M.plan, "__defaults__", tuple(400 if d == M.BLOCK_WORDS else 4 if d == M.SHARD_BLOCKS else d for d in M.plan.__defaults__))

    def drawn():
        found = {r.doc_id: r for r in queries.op5_mix_sources(spark, str(tmp_path)).collect()}
        assert all(r.taken == sum(d.words for d in r.draws) for r in found.values())
        return {i: r.taken for i, r in found.items()}, {i: sorted(d.shard for d in r.draws) for i, r in found.items()}

    (taken, shards), again = drawn(), drawn()
    assert (taken, shards) == again and len({s for each in shards.values() for s in each}) > 3
    monkeypatch.setattr(M.plan, "__defaults__", tuple(7 if d == M.SEED else d for d in M.plan.__defaults__))
    assert drawn()[1] != shards
