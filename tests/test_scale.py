"""Steps that have to grow no faster than their input."""

import pytest
from conftest import plan_of
from posts import CREATED
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagtide.operators import dedup, explode
from tagtide.plans import driver_feed, oracles
from tagtide.schemas import BASE
from tagtide.streaming.batches import BatchTable
from tagtide.streaming.landing import start_text


def test_collected_posts_are_all_accepted_ones():
    found = oracles.oracle_sql()
    assert found["stream_collect"] == found["stream_filter"]


def test_feed_tasks_follow_the_bytes_of_the_texts(spark, monkeypatch):
    texts = spark.createDataFrame([(i, "x" * 100) for i in range(10)], "doc_id long, text string")
    assert driver_feed.tasks_for(0, texts) == driver_feed.tasks_for(5, texts.limit(0)) == 8
    monkeypatch.setattr(driver_feed, "TASK_BYTES", 1000)
    assert driver_feed.tasks_for(1000, texts) == 100


@pytest.fixture
def table(spark, tmp_path):
    return BatchTable(spark, str(tmp_path / "t"), T.StructType.fromDDL("value string, kind string, day int"), ["kind", "day"])


def test_batches_are_written_and_merged_without_a_shuffle(spark, table, tmp_path):
    rows = spark.range(30).select(F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("kind"), F.lit(1).alias("day"))
    for batch in range(2):
        table.append(rows.repartition(3), "s", batch)
    first = tmp_path / "t" / f"folder={table.newest()['folders'][0]}"
    assert len(list(first.rglob("part-*.orc"))) == 3, "every task wrote its own rows"
    before = sorted(map(str, table.read().collect()))
    assert table.compact(2) == 2
    merged = tmp_path / "t" / f"folder={table.newest()['folders'][0]}"
    assert len(list(merged.rglob("part-*.orc"))) == 1
    assert sorted(map(str, table.read().collect())) == before and len(before) == 60


def test_accepted_documents_are_compressed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("one\ntwo\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    start_text(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [p.suffix for p in (tmp_path / "out").glob("part-*")] == [".gz"]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["one", "two"]


def test_winners_are_scored_once_and_stay_the_same(spark):
    rows = [
        (CREATED, str(i % 3), f"good {i % 5}. bad", [f"t{i % 4}"], 7, "u", f"n{i % 2}", 2024, 1, 1 + i % 2) for i in range(40)
    ]
    base = spark.createDataFrame(rows, BASE)
    found = explode.scored_winners(base)
    same = dedup.latest_posts(explode.scored_rows(base))
    assert sorted(map(str, found.select(*same.columns).collect())) == sorted(map(str, same.collect()))
    scored = explode.scored_winners(base, lambda text: F.length(text) + F.lit(1234567))
    plan = plan_of(scored)
    assert plan.index("1234567") < plan.index("Exchange"), "scored above the shuffle"
