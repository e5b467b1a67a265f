import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from tagtide.llm import near_dedup, packing, quality, queries
from tagtide.workspace import stored

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage gets and gives, on the smallest tables."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in C.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        found[name] = (before, docs)
    return found


def test_stages_keep_the_columns(stages):
    assert list(stages) == ["quality", "near_dedup", "secrets", "mixing", "packing"]
    for name, (_, after) in stages.items():
        if name != "packing":
            assert after.columns == COLUMNS


def test_rejected_documents_go(spark, stages):
    before, after = stages["quality"]
    scored = quality.report(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scored.where("predicted = 1").collect()}


def test_one_of_each_group_stays(stages):
    from llm.test_near_dedup import brute

    before, after = stages["near_dedup"]
    kept = {r[0] for r in brute([(r.doc_id, r.text) for r in before.collect()]) if r[3]}
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)
    assert near_dedup.group(after).where("NOT kept").isEmpty()


def test_no_secret_stays_and_nothing_else_changes(stages):
    from llm.test_secrets import plain

    before, after = (frame.toPandas().set_index("doc_id") for frame in stages["secrets"])
    assert sorted(before.index) == sorted(after.index)
    for doc_id, old in before.text.items():
        new = after.text[doc_id]
        assert not plain(new) and after.n_chars[doc_id] == len(new)
        assert new == old or plain(old)


def test_mix_meets_its_targets(stages):
    from llm.test_mixing import size, sums

    before, after = stages["mixing"]
    wanted = sums([(r.doc_id, r.text, r.lang, r.source, 0) for r in before.collect()])
    taken = after.toPandas()
    taken["size"] = taken.text.map(size)
    for source, (_, target) in wanted.items():
        assert abs(taken[taken.source == source]["size"].sum() - target) <= 1


def test_everything_is_packed(stages):
    before, after = stages["packing"]
    ids = sum(len(packing.encoder(*_paths())(r.text)) + 1 for r in before.collect())
    assert after.agg({"length": "sum"}).first()[0] == ids


def _paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.queries()) | {"pipeline"} <= names
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


def test_exact_search_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    theirs = con.execute(queries.OP9_SQL).df()
    ours = queries.op9_exact_topk(spark, SF).toPandas()
    columns = sorted(ours.columns)
    sort = lambda f: f[columns].sort_values(columns).reset_index(drop=True).astype("int64")
    pd.testing.assert_frame_equal(sort(ours), sort(theirs))
