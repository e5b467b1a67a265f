"""What jobs keep on the disks, and what a repeated load leaves alone."""

import datetime as dt
import random
import string
from pathlib import Path

import pytest
from posts import post
from pyspark.sql import functions as F
from test_jobs import FIRST, SECOND, land, posts_of
from test_jobs import settings as job_settings  # noqa: F401

from tagtide.plans import driver_feed, job_queries, jobs
from tagtide.schemas import BASE
from tagtide.sinks import tables as sink
from tagtide.sources import feeds
from tagtide.streaming.landing import start_landing
from tagtide.workspace import drop_shuffles, moved


@pytest.fixture
def settings(job_settings):  # noqa: F811
    return job_settings.override({"tables": {"days_back": 10}})


def days_of(spark, table):
    return sorted(tuple(r) for r in spark.table(table).groupBy("year", "month", "day").count().collect())


@pytest.fixture
def static(spark):
    """A session as it comes, in which an overwrite replaces whole tables."""
    before = spark.conf.get(sink.OVERWRITE_MODE)
    spark.conf.set(sink.OVERWRITE_MODE, "static")
    yield
    assert spark.conf.get(sink.OVERWRITE_MODE) == "static"
    spark.conf.set(sink.OVERWRITE_MODE, before)


def test_a_repeated_load_leaves_other_days_alone(spark, settings, static):
    land(spark, settings, FIRST, *posts_of(0))
    assert jobs.land_to_base(spark, settings, FIRST, load="replace") == 3
    sink.drop_days_before(spark, settings.tables.landing_path, SECOND.date())
    land(spark, settings, SECOND, *posts_of(1), post(tweet_id="9", plain=["Sea"]))
    for _ in range(2):
        assert jobs.land_to_base(spark, settings, SECOND, load="replace") == 4
    assert days_of(spark, settings.tables.base_table) == [(2019, 12, 31, 3), (2020, 1, 1, 4)]


def test_a_repeated_load_replaces_some_days_at_a_time(spark, settings, static, monkeypatch):
    for day in range(4):
        land(spark, settings, FIRST + dt.timedelta(days=day), *posts_of(day))
    whole = []
    for most in (1 << 30, 1):
        monkeypatch.setattr(jobs, "LOAD_BYTES", most)
        writes = []
        overwrite = sink.overwrite_table_partitions
        monkeypatch.setattr(sink, "overwrite_table_partitions", lambda *a, f=overwrite, w=writes: w.append(f(*a)) or w[-1])
        assert jobs.land_to_base(spark, settings, SECOND, load="replace") == 12
        monkeypatch.setattr(sink, "overwrite_table_partitions", overwrite)
        assert writes == ([12] if most > 1 else [3] * 4)
        whole.append(sorted(map(str, spark.table(settings.tables.base_table).collect())))
    assert whole[0] == whole[1] and len(whole[0]) == 12


def test_day_groups_hold_every_day_once(spark, settings):
    for day in range(5):
        land(spark, settings, FIRST + dt.timedelta(days=day), *posts_of(day))
    scan = spark.read.orc(settings.tables.landing_path)
    size = scan.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
    for most in (0, size // 2, size):
        counts = [scan.where(group).count() for group in sink.day_groups(scan, most)]
        assert sum(counts) == 20 and len(counts) == {0: 5, size: 1}.get(most, len(counts)) and len(counts) in (1, 2, 3, 5)
    assert sink.day_groups(scan.where("day = 99"), size) == []
    assert len(sink.day_groups(spark.createDataFrame([], BASE), size)) == 1, "rows of no file are one group"


def test_only_days_before_are_dropped(spark, tmp_path):
    path = str(tmp_path / "landing")
    days = [(1, 2023, 12, 30), (2, 2023, 12, 31), (3, 2024, 1, 1), (4, None, None, None)]
    rows = spark.createDataFrame(days, "v long, year short, month byte, day byte")
    sink.append_path(rows, path)
    sink.drop_days_before(spark, str(tmp_path / "none"), dt.date.max)
    sink.drop_days_before(spark, path, dt.date(2023, 12, 31))
    assert sorted(r.v for r in spark.read.orc(path).collect()) == [2, 3, 4]
    sink.drop_days_before(spark, path, dt.date.max)
    assert [r.v for r in spark.read.schema(rows.schema).orc(path).collect()] == [4]


def test_moved_rows_outlive_their_table(spark, settings):
    land(spark, settings, FIRST, *posts_of(0))
    tables = settings.tables
    assert moved(spark, tables.staging_path + "/none", BASE, "empty").count() == 0
    jobs.land_to_base(spark, settings, FIRST)
    before = sorted(map(str, spark.table(tables.base_table).collect()))
    found = moved(spark, tables.base_path, BASE, "base")
    assert not Path(tables.base_path).exists() and found.schema == spark.table(tables.base_table).schema
    assert sorted(map(str, found.collect())) == before and len(before) == 3


def test_shuffle_files_go(spark, tmp_path):
    held = spark.range(1000).repartition(4).withColumn("x", F.rand(1))
    held.write.parquet(str(tmp_path / "out"))
    status = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    before = status.shuffleStatuses().size()
    assert before > 0
    del held
    for _ in range(50):
        drop_shuffles(spark)
        if status.shuffleStatuses().size() < before:
            return
    raise AssertionError("shuffles stay")


def test_landed_texts_are_packed_closer(spark, tmp_path):
    """Texts come again further apart than 256 KB, within the 1 MB of a block."""
    texts = ["".join(random.Random(i).choices(string.ascii_letters, k=3000)) for i in range(100)]
    rows = spark.createDataFrame([(f"{n} {text}", 2020, 1, 1) for n in range(6) for text in texts], "value string, year short, month byte, day byte").coalesce(1)
    rows.select("value").write.text(str(tmp_path / "in"))
    records = feeds.as_records(feeds.document_stream(spark, str(tmp_path / "in")), "t", F.lit("2020-01-01").cast("timestamp"))
    start_landing(records, str(tmp_path / "out"), str(tmp_path / "cp"), landed_at=F.col("timestamp")).awaitTermination()
    sink.append_path(rows, str(tmp_path / "batch"))
    rows.write.partitionBy("year", "month", "day").orc(str(tmp_path / "plain"))
    size = {n: sum(p.stat().st_size for p in (tmp_path / n).rglob("*.orc")) for n in ("out", "batch", "plain")}
    assert size["out"] < 0.8 * size["plain"] and size["batch"] < 0.8 * size["plain"]
    assert spark.read.orc(str(tmp_path / "out")).count() == 600 and spark.conf.get("orc.compress.size", None) is None


@pytest.fixture
def sf(spark, tmp_path):
    """Events of both years of landing, one without a time, on a few texts."""
    texts = [(i, f"good text {i}", "en", f"s{i % 2}") for i in range(5)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    stamps = [dt.datetime(2024, 1, day) for day in (1, 5, 8, 12, 15, 16, 18, 22, 28, 30)] + [None]
    events = [(i, at, i % 7, "click", 1.0, f'{{"k": {i}}}') for i, at in enumerate(stamps)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, kinds).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_landing_days_go_once_no_later_load_reads_them(spark, sf, monkeypatch):
    """Every row is loaded from landing that holds a part of the days; base has them all."""
    seen = []
    load = jobs.land_to_base

    def watched(spark, settings, *args, **options):
        landed = spark.read.orc(settings.tables.landing_path).where("year IS NOT NULL")
        loaded = load(spark, settings, *args, **options)
        seen.append((landed.select("year", "month", "day").distinct().count(), spark.table(settings.tables.base_table).count()))
        return loaded

    monkeypatch.setattr(jobs, "land_to_base", watched)
    whole = jobs.to_base(job_queries._landed(spark, sf)).count()
    assert job_queries.job_land_to_base(spark, sf).count() == whole > 5
    assert job_queries.load_twice(spark, sf).count() == whole
    assert [days for days, _ in seen] == [5] * 6
    assert [rows for _, rows in seen][1::2] == [whole, seen[2][1], whole]
    seen.clear()
    assert job_queries.dedup_incremental(spark, sf).count() == 5
    assert [days for days, _ in seen] == [3, 6, 6] and seen[-1][1] == whole
    assert driver_feed.feed(spark, sf).count() == 11
