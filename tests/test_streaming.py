import threading
import time
from pathlib import Path

import pytest
from posts import post
from pyspark.sql import functions as F

from tagtide.config import FeedSettings
from tagtide.operators.filters import ingest_filter
from tagtide.schemas import LANDING
from tagtide.sinks.kafka import flush_and_close
from tagtide.sinks.markers import marker_exists, write_marker
from tagtide.sources import feeds, tables
from tagtide.streaming.landing import accepted_stream, start_landing, start_text
from tagtide.streaming.supervise import run_until_collected, run_until_stopped

FILTER = FeedSettings(language="en", min_reposts=100)


def write_feed(folder: Path, name: str, documents) -> None:
    folder.mkdir(exist_ok=True)
    partial = folder.parent / f"{name}.partial"
    partial.write_text("\n".join(documents) + "\n")
    partial.rename(folder / name)


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    documents = [
        post(tweet_id=str(i), count=90 + i, lang="en" if i % 3 else "fr", text=f"text {i}") for i in range(60)
    ]
    for i in range(3):
        write_feed(folder, f"part{i}.json", documents[i * 20 : (i + 1) * 20])
    return folder


def test_stream_filter_equals_batch(spark, feed, tmp_path):
    stream = accepted_stream(feeds.document_stream(spark, str(feed), 1), FILTER)
    start_text(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = ingest_filter(feeds.documents(spark, str(feed)), FILTER)
    found = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(found) == sorted(r.value for r in batch.collect())
    assert len(found) == 34


def test_landing_is_partitioned_by_landing_time_and_repeats_nothing(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "landing"), str(tmp_path / "cp")

    def land():
        records = feeds.as_records(feeds.document_stream(spark, str(feed)), "reposts")
        query = start_landing(records, out, checkpoint, "Europe/Amsterdam")
        query.awaitTermination()
        return tables.orc_path(spark, out, LANDING)

    landed = land()
    assert landed.dtypes == [(f.name, f.dataType.simpleString()) for f in LANDING]
    assert landed.count() == 60
    assert landed.select("topic").distinct().count() == 1
    matches = F.make_date("year", "month", "day").between(
        F.date_sub(F.current_date(), 2), F.date_add(F.current_date(), 2)
    )
    assert landed.where(matches).count() == 60
    assert land().count() == 60  # nothing new
    write_feed(feed, "late.json", [post(tweet_id="late")])
    assert land().count() == 61


def test_given_landing_time(spark, feed, tmp_path):
    stamp = F.to_timestamp(F.lit("2019-12-31 23:00:00"))
    records = feeds.as_records(feeds.document_stream(spark, str(feed)), "t", stamp)
    query = start_landing(
        records, str(tmp_path / "l"), str(tmp_path / "cp"), landed_at=F.col("timestamp"), name="given"
    )
    query.awaitTermination()
    rows = tables.orc_path(spark, str(tmp_path / "l"), LANDING)
    assert rows.select("time_id", "year", "month", "day").distinct().first()[:] == (
        1577833200000,
        2019,
        12,
        31,
    )


def endless(spark, feed, tmp_path):
    records = feeds.as_records(feeds.document_stream(spark, str(feed), 1), "reposts")
    return start_landing(records, str(tmp_path / "landing"), str(tmp_path / "cp"), batch_seconds=1)


def test_idle_stream_writes_the_marker_and_stops(spark, feed, tmp_path):
    marker = str(tmp_path / "marker")
    write_marker(spark, marker, "left over")
    query = endless(spark, feed, tmp_path)
    rows = run_until_stopped(spark, query, marker, "shutdown", poll_seconds=1, idle_batches=5)
    assert rows == 60 and not query.isActive
    assert [r.value for r in spark.read.text(marker).collect()] == ["shutdown"]


def test_marker_stops_a_stream(spark, feed, tmp_path):
    marker = str(tmp_path / "marker")
    query = endless(spark, feed, tmp_path)

    def ask():
        time.sleep(4)
        write_marker(spark, marker, "stop")

    asking = threading.Thread(target=ask)
    asking.start()
    run_until_stopped(spark, query, marker, poll_seconds=0.5, idle_batches=1000)
    asking.join()
    assert not query.isActive and marker_exists(spark, marker)


def test_stops_after_enough_rows(spark, feed, tmp_path):
    stream = accepted_stream(feeds.document_stream(spark, str(feed), 1), FILTER)
    query = start_text(stream, str(tmp_path / "out"), str(tmp_path / "cp"), batch_seconds=2)
    rows = run_until_collected(query, 10, poll_seconds=0.2)
    assert not query.isActive and 10 <= rows <= 34


def test_flush_and_close(spark, feed, tmp_path):
    query = endless(spark, feed, tmp_path)
    flush_and_close(query)
    assert not query.isActive
    assert tables.orc_path(spark, str(tmp_path / "landing"), LANDING).count() == 60


def test_several_streams_in_one_session(spark, feed, tmp_path):
    started = []
    for topic in ("one", "two"):
        records = feeds.as_records(feeds.document_stream(spark, str(feed)), topic)
        folder = str(tmp_path / topic)
        started.append(start_landing(records, folder, f"{folder}-cp", name=topic))
    for query in started:
        query.awaitTermination()
    both = [tables.orc_path(spark, str(tmp_path / t), LANDING).first().topic for t in ("one", "two")]
    assert both == ["one", "two"]
