"""Micro-batches written once, compaction, dead letters, the listener, several topics."""

import pytest
from posts import post
from pyspark.sql import functions as F
from test_streaming import FILTER, write_feed

from tagtide.functions import posts
from tagtide.schemas import LANDING
from tagtide.sources import feeds
from tagtide.streaming import batches
from tagtide.streaming.landing import ROWS, accepted_stream, start_landing
from tagtide.streaming.supervise import Watch, run_until_collected
from tagtide.streaming.topics import Topics


def stamp():
    return F.to_timestamp(F.lit("2019-12-31 23:00:00"))



def documents(n):
    bad = ['{"lang":', "", "  ", "no json", '{"delete":{"status":{"id":1}}}', '["a"]', "{}"]
    return [post(tweet_id=str(i), count=90 + i, lang="en") if i % 3 else bad[i // 3 % len(bad)] for i in range(n)]


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    for i in range(4):
        write_feed(folder, f"part{i}.json", documents(40)[i * 10 : (i + 1) * 10])
    return folder


def land(spark, feed, tmp_path, fan=2):
    records = feeds.as_records(feeds.document_stream(spark, str(feed), 1), "t", stamp())
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "cp")
    batches.start_landing_batches(records, path, checkpoint, landed_at=F.col("timestamp"), fan=fan).awaitTermination()
    return batches.letters(spark, path), checkpoint


def content(table):
    return sorted(map(str, table.read().collect()))


def test_kinds(spark):
    rows = [(d,) for d in ['{"lang":"en"}', "{}", '{"a"', "", None, " \n", "[1]", '{"delete":{"x":1}}', '{"delete":null}', '{"lang":"en"} x']]
    found = posts.with_kind(spark.createDataFrame(rows, "value string"))
    kinds = [r.kind for r in found.collect()]
    assert kinds[:6] == ["post", "post", "malformed", "malformed", "malformed", "malformed"]
    assert kinds[7:9] == ["notice", "post"]
    assert found.columns == ["value", "kind"]


def test_dead_letters_are_counted_and_kept(spark, feed, tmp_path):
    table, _ = land(spark, feed, tmp_path)
    rows = batches.landed_posts(spark, table.path)
    assert rows.dtypes == [(f.name, f.dataType.simpleString()) for f in LANDING]
    dead = batches.dead_letters(spark, table.path).groupBy("kind").count().collect()
    counts = {r.kind: r["count"] for r in dead} | {"post": rows.count()}
    assert counts["notice"] == 2 and sum(counts.values()) == table.rows()["rows"]
    assert {k: v for k, v in table.rows().items() if k != "rows"} == counts
    whole = {r.full_tweet for r in batches.dead_letters(spark, table.path).collect()}
    assert '{"lang":' in whole and "no json" in whole


def test_a_batch_that_comes_again_changes_nothing(spark, feed, tmp_path):
    table, checkpoint = land(spark, feed, tmp_path)
    before, entry = content(table), table.newest()
    for batch in range(entry["batches"][checkpoint] + 1):
        table.append(table.read(), checkpoint, batch)
    assert content(table) == before and table.newest() == entry
    table.append(table.read(), "another stream", 0)
    assert len(content(table)) == 2 * len(before)


def test_a_lost_write_is_not_there(spark, feed, tmp_path, monkeypatch):
    table, checkpoint = land(spark, feed, tmp_path)
    before = content(table)
    with monkeypatch.context() as broken:
        broken.setattr(table.log, "create", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        for write in (lambda: table.append(table.read(), checkpoint, 99), lambda: table.compact(1)):
            with pytest.raises(RuntimeError):
                write()
    assert content(table) == before
    assert table.sweep() == 2 and content(table) == before
    table.append(table.read(), checkpoint, 99)
    assert len(content(table)) == 2 * len(before)


def test_compaction_under_readers(spark, feed, tmp_path, monkeypatch):
    table, checkpoint = land(spark, feed, tmp_path, fan=100)
    assert len(table.newest()["folders"]) == 4
    reader, before = table.read(), content(table)
    assert table.compact(2) == 4 and table.compact(2) == 0
    assert [name[:2] for name in table.newest()["folders"]] == ["T1"]
    assert content(table) == before
    assert sorted(map(str, reader.collect())) == before, "who read before the merge goes on"
    monkeypatch.setattr(batches, "READERS", 2)
    nothing = table.read().limit(0)
    for batch in range(50, 53):
        table.append(nothing, checkpoint, batch)
    assert not table.newest()["gone"] and content(table) == before
    assert not [n for n in table.data.names() if n.startswith("folder=T0")], "merged folders went, empty batches have none"


def test_collects_the_same_whenever_it_is_stopped(spark, feed, tmp_path):
    stream = accepted_stream(feeds.document_stream(spark, str(feed), 1), FILTER)
    path = str(tmp_path / "out")
    query = batches.start_collecting(stream, path, str(tmp_path / "cp"), 8, 0)
    query.processAllAvailable()
    rows = run_until_collected(query, 8)
    found = batches.collected(spark, path).read().count()
    assert 8 <= found < rows, "batches after the one that reached it wrote nothing"


def test_listener_counts_more_batches_than_are_kept(spark):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 3).load()
    query = stream.observe(ROWS, F.count(F.lit(1)).alias(ROWS)).writeStream.format("noop").start()
    with Watch(query) as watch:
        watch.wait(300, rows=3 * 110)
        query.stop()
        total = watch.finish()
    assert total >= 3 * 110 and total % 3 == 0
    assert len(query.recentProgress) <= 100
    assert total == 3 * (max(p.batchId for p in query.recentProgress) + 1)


def test_one_topic_fails_and_the_others_go_on(spark, feed, tmp_path):
    good = feeds.as_records(feeds.document_stream(spark, str(feed), 1), "good", stamp())
    bad = good.withColumn("value", F.raise_error(F.lit("lost")).cast("string"))

    def start(topic, rows, checkpoint):
        return start_landing(rows, str(tmp_path / topic), checkpoint, landed_at=F.col("timestamp"))

    topics = Topics({"bad": bad, "good": good, "more": good}, str(tmp_path / "cps"), start)
    found = topics.wait()
    assert {t: o.rows for t, o in found.items()} == {"bad": 0, "good": 40, "more": 40} == topics.rows()
    assert "lost" in found["bad"].error and found["good"].error is None
    assert topics.running() == []


def test_land_job_in_batches(spark, feed, tmp_path):
    """The jobs land, keep dead letters apart and load the posts of the batches."""
    import datetime as dt

    from tagtide import catalog
    from tagtide.config import Settings, TableSettings
    from tagtide.plans import jobs

    paths = {n: str(tmp_path / n) for n in vars(TableSettings()) if n.endswith(("_path", "_checkpoint"))}
    names = {n: f"batches_{abs(hash(str(tmp_path)))}.{n}" for n in vars(TableSettings()) if n.endswith(("_table", "_view"))}
    settings = Settings(tables=TableSettings(**paths, **names, time_zone="UTC", landing_sink="batches", winner_buckets=2))
    catalog.create_all(spark, settings.tables)
    try:
        settings = settings.override({"spark": {"batch_seconds": 1}})
        query = jobs.land(feeds.as_records(feeds.document_stream(spark, str(feed), 1), "t"), settings)
        query.processAllAvailable()
        query.stop()
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        posts_there = batches.landed_posts(spark, settings.tables.landing_path).count()
        assert 0 < posts_there < 40
        # documents without the fields of a repost are posts, but no base rows
        assert jobs.land_to_base(spark, settings, now) == sum(i % 3 > 0 for i in range(40))
    finally:
        spark.sql(f"DROP DATABASE {settings.tables.base_table.split('.')[0]} CASCADE")
