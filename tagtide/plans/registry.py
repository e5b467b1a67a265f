"""Registered queries: each runs an operator over the whole driver tables.

Results are flattened for comparison only: arrays to text, dates and times to
text, small integers to long.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagtide import catalog
from tagtide.config import FeedSettings
from tagtide.functions import dates, posts, sentiment, text
from tagtide.operators import aggregate, dedup, explode, filters, ranking, sentence_model
from tagtide.operators.base import to_base
from tagtide.plans import driver_feed as source
from tagtide.plans import job_queries
from tagtide.plans.driver_feed import FILES
from tagtide.plans.jobs import staging_status, updated_on
from tagtide.schemas import BASE, LANDING
from tagtide.sinks import tables as sink
from tagtide.sinks.kafka import flush_and_close
from tagtide.sources import tables
from tagtide.sources.feeds import to_landing
from tagtide.streaming import batches
from tagtide.streaming.landing import accepted_stream, start_landing, start_text
from tagtide.streaming.supervise import run_until_collected, run_until_stopped
from tagtide.streaming.topics import Topics
from tagtide.workspace import drop_shuffles, new_path, stored

Query = Callable[[SparkSession, str], DataFrame]

FEED = FeedSettings(language="en", min_reposts=100)
SINCE = dt.date(2023, 12, 20)
NOW = dt.datetime(2024, 1, 15, 12, 30)
ZONE = "Europe/Amsterdam"
FIRST = 100


def flat(df: DataFrame) -> DataFrame:
    columns = []
    for entry in df.schema.fields:
        column = F.col(f"`{entry.name}`")
        if isinstance(entry.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        elif isinstance(entry.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(entry.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(entry.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("long")
        columns.append(column.alias(entry.name))
    return df.select(*columns)


# Stages that several queries start from.


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return posts.parse_posts(source.feed(spark, sf))


def landing(spark: SparkSession, sf: str) -> DataFrame:
    return to_landing(source.records_of(source.feed(spark, sf)), F.col("timestamp"))


def base(spark: SparkSession, sf: str) -> DataFrame:
    return to_base(landing(spark, sf))


def exploded(spark: SparkSession, sf: str) -> DataFrame:
    return explode.explode_posts(base(spark, sf), before_dedup=False)


def aggregated(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.aggregate_hashtags(exploded(spark, sf))


def two_years(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Measures per hashtag and name of what landed before and after the turn of the year."""
    rows = base(spark, sf)
    return tuple(
        stored(aggregate.name_measures(explode.explode_posts(rows.where(F.col("year") == year), before_dedup=False)), "names")
        for year in (2023, 2024)
    )


def two_days(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Their aggregates, without names."""
    rows = base(spark, sf)
    return tuple(
        aggregate.aggregate_hashtags(explode.explode_posts(rows.where(F.col("year") == year), before_dedup=False))
        for year in (2023, 2024)
    )


def staging(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.fresh_staging(aggregated(spark, sf), ZONE, NOW)


def published(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges are sampled before rows are sent to them, so staging is stored, as the table is."""
    return ranking.publish(stored(staging(spark, sf), "staging"))


# The queries.


def lang_class(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select("event_id", posts.lang_class("en").alias("lang_class"))


def repost_status(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select("event_id", posts.repost_status().alias("repost_status"))


def repost_count(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select("event_id", posts.repost_count().alias("repost_count"))


def has_hashtags(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select("event_id", posts.has_hashtags().cast("int").alias("has_hashtags"))


def ingest_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.ingest_filter(source.feed(spark, sf), FEED).select("event_id", "ts")


def first_n(spark: SparkSession, sf: str) -> DataFrame:
    accepted = filters.ingest_filter(source.feed(spark, sf), FEED).select("event_id")
    return filters.first_n(accepted, FIRST, "event_id")


def _dated(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    return filters.scan_since(landing(spark, sf), SINCE, mode).select(
        "topic", "time_id", "year", "month", "day"
    )


def date_filter_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf, "calendar")


def date_filter_componentwise(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf, "componentwise")


def drop_any_null(spark: SparkSession, sf: str) -> DataFrame:
    fields = parsed(spark, sf).select(
        "event_id",
        "lang",
        F.col("retweeted_status.id_str").alias("tweet_id"),
        posts.count().alias("rt_count"),
    )
    return filters.drop_any_null(fields)


def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    repost = F.col("retweeted_status")
    return parsed(spark, sf).select(
        "event_id",
        repost["created_at"].alias("created"),
        repost["id_str"].alias("tweet_id"),
        posts.count().alias("rt_count"),
        repost["user"]["id_str"].alias("user_id"),
        posts.json_path("value", "$.retweeted_status.user.screen_name").alias("user_name"),
        posts.post_text().alias("post_text"),
    )


def json_wildcard(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select("event_id", posts.tag_texts().alias("tags"))


def hashtag_clean(spark: SparkSession, sf: str) -> DataFrame:
    tags = text.clean_tags(posts.tag_texts())
    return parsed(spark, sf).select("event_id", tags.alias("hashtags"), F.size(tags).alias("n_tags"))


def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select("event_id", text.clean_text(posts.post_text()).alias("tweet_txt"))


def text_clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    raw = F.concat_ws(" ", "url", "html")
    return pages.select("page_id", text.clean_text(raw).alias("tweet_txt"))


def text_clean_conversations(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return turns.select("conv_id", "turn", text.clean_text(F.col("text")).alias("tweet_txt"))


def date_parse(spark: SparkSession, sf: str) -> DataFrame:
    created = parsed(spark, sf).select(
        "event_id", F.col("retweeted_status.created_at").alias("created")
    )
    return created.select(
        "event_id", dates.posted_at().alias("posted_at"), dates.date_posted().alias("date_posted")
    )


def date_format_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = landing(spark, sf).withColumn("date_recorded", dates.date_recorded())
    return rows.groupBy("date_recorded").agg(F.count(F.lit(1)).alias("rows")).select(
        "date_recorded",
        dates.compact_date().alias("compact"),
        F.concat_ws("-", dates.compact_date(), "rows").alias("day_id"),
    )


def tz_shift(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    shifted = dates.to_zone(F.col("ts").cast("timestamp"), ZONE, "UTC")
    day, hour = dates.day_and_hour(shifted)
    return events.select(
        "event_id", shifted.alias("shifted"), day.alias("day"), hour.alias("hour")
    )


def land_to_base(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf)


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_posts(base(spark, sf))


def explode_tags(spark: SparkSession, sf: str) -> DataFrame:
    return explode.explode_tags(base(spark, sf))


def sentiment_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    pieces = parsed(spark, sf).select(
        "event_id", sentiment.sentences(posts.post_text()).alias("pieces")
    )
    return pieces.select(
        "event_id",
        F.size("pieces").alias("sentences"),
        sentiment.lexicon_mean(F.col("pieces")).alias("score"),
    )


def _load_polarity_model() -> Callable[[list[str]], list[int]]:
    """A stand-in for a trained model, loaded once per task."""
    import re

    weights = dict.fromkeys(sentiment.POSITIVE, 1) | dict.fromkeys(sentiment.NEGATIVE, -1)
    word = re.compile(r"[a-z0-9_]+")

    def classify(sentences: list[str]) -> list[int]:
        sums = [sum(weights.get(w, 0) for w in word.findall(s.lower())) for s in sentences]
        return [min(sentiment.TOP_CLASS, max(0, sentiment.NEUTRAL + s)) for s in sums]

    return classify


def sentiment_model(spark: SparkSession, sf: str) -> DataFrame:
    score = sentiment.model_score(_load_polarity_model)
    scored = explode.score_posts(base(spark, sf), score, before_dedup=False)
    return scored.select("tweet_id", "rt_count", "sentiment")


def sentiment_trained(spark: SparkSession, sf: str) -> DataFrame:
    """Posts scored by a model that learnt the word list's classes from four fifths of the posts.

    ``held_out`` posts took no part in the training; ``lexicon`` is what the word list says.
    """
    latest = stored(dedup.latest_posts(base(spark, sf)), "posts")
    held = F.crc32(F.col("tweet_id").cast("binary")) % 5 == 0
    pieces = latest.where(~held).select(F.explode(sentiment.sentences(F.col("tweet_txt"))).alias("sentence"))
    model = sentence_model.train(pieces.withColumn("label", sentiment.lexicon_class(F.col("sentence"))))
    path = new_path(spark, "sentence-model")
    model.save(spark, path)
    score = sentence_model.scorer(spark, sentence_model.SentenceModel.load(spark, path))
    return latest.select(
        "tweet_id",
        held.alias("held_out"),
        score(F.col("tweet_txt")).alias("sentiment"),
        sentiment.lexicon_score(F.col("tweet_txt")).alias("lexicon"),
    )


def exploded_posts(spark: SparkSession, sf: str) -> DataFrame:
    return exploded(spark, sf)


def hashtag_agg(spark: SparkSession, sf: str) -> DataFrame:
    return aggregated(spark, sf)


def hashtag_names(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.hashtag_names(exploded(spark, sf))


def staging_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return staging(spark, sf)


def _merge(spark: SparkSession, sf: str, **options) -> DataFrame:
    old, new = two_days(spark, sf)
    return aggregate.merge_staging(
        new, aggregate.stamped(old, ZONE, NOW - dt.timedelta(hours=6)), ZONE, NOW, **options
    )


def staging_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf)


def staging_merge_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf, mode="replace")


def staging_merge_nodedup(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf, dedup_counts=False, stamp="day_hour")


def union_all(spark: SparkSession, sf: str) -> DataFrame:
    old, new = two_days(spark, sf)
    return dedup.union_all(old, new)


def _merged_names(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    old, new = two_years(spark, sf)
    pairs = stored(aggregate.paired(aggregate.aggregate_names(new), aggregate.aggregate_names(old)), "pairs")
    return aggregate.merge_names(aggregate.names_of(new), aggregate.names_of(old), pairs, mode)


def staging_names(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_names(spark, sf, "reference")


def staging_names_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_names(spark, sf, "replace")


def published_names(spark: SparkSession, sf: str) -> DataFrame:
    measures = stored(aggregate.name_measures(exploded(spark, sf)), "names")
    rows = aggregate.fresh_staging(aggregate.aggregate_names(measures), ZONE, NOW)
    return aggregate.published_names(aggregate.names_of(measures), rows)


def max_update(spark: SparkSession, sf: str) -> DataFrame:
    landed = landing(spark, sf).select(F.timestamp_millis("time_id").alias("last_update"))
    return aggregate.last_update(landed)


def status(spark: SparkSession, sf: str) -> DataFrame:
    """Of rows that were updated when they landed."""
    landed = landing(spark, sf).select(F.timestamp_millis("time_id").alias("last_update"))
    found = staging_status(landed, ZONE, NOW)
    return found.withColumn("local_zone", F.regexp_replace("local_zone", "^Etc/", ""))


def updated_today(spark: SparkSession, sf: str) -> DataFrame:
    """The gate, per day of landing, held against the day before and its own."""
    rows = landing(spark, sf).select(
        F.timestamp_millis("time_id").alias("last_update"), dates.date_recorded().alias("day")
    )
    last = rows.agg(F.max("day")).first()[0]
    marked = [
        updated_on(rows.select("last_update"), last - dt.timedelta(days=back)).withColumn("days_back", F.lit(back))
        for back in (0, 1)
    ]
    return marked[0].unionAll(marked[1]).withColumn("updated", F.col("updated").cast("int"))


def publish(spark: SparkSession, sf: str) -> DataFrame:
    return published(spark, sf)


def rank_per_day(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored(aggregated(spark, sf).select("date_recorded", "hashtag", "rt_count"), "counts")
    return ranking.rank_rows(rows)


def top10_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.top_view(stored(published(spark, sf), "published"))


def top10_direct(spark: SparkSession, sf: str) -> DataFrame:
    """Raw documents to the ten strongest hashtags per day.

    The view reads its rows twice, so they are worked out once, as a table is.
    """
    return catalog.top_view(stored(aggregated(spark, sf), "aggregated"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return flat(top10_direct(spark, sf))


def sorted_tags(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.sorted_by_count(aggregated(spark, sf).select("hashtag", "rt_count", "tweet_count"))


def stream_land(spark: SparkSession, sf: str) -> DataFrame:
    """Land the feed as a stream, then read the landed documents back."""
    records = source.records_of(source.feed_stream(spark, sf))
    path = new_path(spark, "landing")
    start_landing(
        records, path, new_path(spark, "landing-offsets"), landed_at=F.col("timestamp")
    ).awaitTermination()
    drop_shuffles(spark)
    rows = posts.parse_posts(tables.orc_path(spark, path, LANDING), "full_tweet")
    return rows.select(
        "topic",
        "time_id",
        "lang",
        F.col("retweeted_status.id_str").alias("tweet_id"),
        F.col("retweeted_status.text").alias("text"),
        "year",
        "month",
        "day",
    )


def stream_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The ingest filter as a stream; accepted documents read back from its sink."""
    path = new_path(spark, "accepted")
    stream = accepted_stream(source.feed_stream(spark, sf).select("value"), FEED)
    start_text(stream, path, new_path(spark, "accepted-offsets")).awaitTermination()
    accepted = spark.read.text(path)
    return accepted.select(posts.json_path("value", "$.id").cast("long").alias("event_id"))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "events")
    source.split_events(spark, sf, path)
    return source.split_stream(spark, sf, path)


def stream_collect(spark: SparkSession, sf: str) -> DataFrame:
    """All accepted posts, collected batch by batch: the stream stops after the one that brings the last of them."""
    path = new_path(spark, "collected")
    accepted = filters.ingest_filter(source.feed(spark, sf), FEED).count()
    stream = accepted_stream(_split(spark, sf).select("value"), FEED)
    query = batches.start_collecting(stream, path, new_path(spark, "collected-offsets"), accepted, 0)
    run_until_collected(query, accepted)
    rows = batches.collected(spark, path).read()
    return rows.select(posts.json_path("value", "$.id").cast("long").alias("event_id"))


def _landed_in_batches(spark: SparkSession, sf: str) -> str:
    """Many small batches; the last ones come again, as after a lost commit of the stream."""
    path, checkpoint = new_path(spark, "landing"), new_path(spark, "landing-offsets")
    records = source.records_of(_split(spark, sf))
    batches.start_landing_batches(records, path, checkpoint, landed_at=F.col("timestamp"), fan=3).awaitTermination()
    table = batches.letters(spark, path)
    for batch in range(FILES):
        table.append(table.read(), checkpoint, batch)
    drop_shuffles(spark)
    return path


def stream_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Landed posts by day, from folders that were merged while the stream went on."""
    return batches.landed_posts(spark, _landed_in_batches(spark, sf)).select("topic", "time_id", "year", "month", "day")


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """What the landing stream put aside, with the documents as they came."""
    rows = batches.dead_letters(spark, _landed_in_batches(spark, sf))
    return rows.select("kind", "topic", "time_id", F.col("full_tweet").alias("document"), "year", "month", "day")


def stream_idle_stop(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by the engine's events, of a stream that stops itself when nothing comes any more."""
    key = "spark.sql.streaming.noDataProgressEventInterval"
    before = spark.conf.get(key)
    spark.conf.set(key, "300")
    try:
        path = new_path(spark, "accepted")
        stream = accepted_stream(_split(spark, sf).select("value"), FEED)
        query = start_text(stream, path, new_path(spark, "accepted-offsets"), 0)
        rows = run_until_stopped(spark, query, new_path(spark, "marker"), poll_seconds=1, idle_batches=3)
    finally:
        spark.conf.set(key, before)
    written = spark.read.text(path).agg(F.count(F.lit(1)).alias("written"))
    return written.select(F.lit(rows).cast("long").alias("counted"), "written")


def stream_topics(spark: SparkSession, sf: str) -> DataFrame:
    """A topic for each kind of event, a stream for each topic; the one of errors fails."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    events = spark.read.parquet(f"{sf}/events.parquet")
    rows = dict(events.groupBy("event_type").count().collect())
    kinds = sorted(rows)
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    records = {
        kind: source.records_of(
            source.feed_of(stream.where(F.col("event_type") == kind), documents, rows[kind])
        ).withColumn("topic", F.lit(kind))
        for kind in kinds
    }
    records["error"] = records["error"].withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
    path = new_path(spark, "topics")

    def start(topic: str, rows: DataFrame, checkpoint: str):
        return start_landing(rows, f"{path}/{topic}", checkpoint, landed_at=F.col("timestamp"))

    outcomes = Topics(records, new_path(spark, "topics-offsets"), start).wait()
    counted = [(topic, found.rows, int(found.error is not None)) for topic, found in sorted(outcomes.items())]
    rows = spark.createDataFrame(counted, "topic string, counted long, failed int")
    landed = [tables.orc_path(spark, f"{path}/{topic}", LANDING) for topic, _, failed in counted if not failed]
    landed = reduce(DataFrame.unionAll, landed).groupBy("topic").agg(F.count(F.lit(1)).alias("landed"))
    return rows.join(landed, "topic", "left").na.fill(0)


def stream_processing_time(spark: SparkSession, sf: str) -> DataFrame:
    """Landing with an interval, flushed and closed; rows by the day they landed."""
    records = source.records_of(source.feed_stream(spark, sf))
    path = new_path(spark, "landing")
    query = start_landing(
        records, path, new_path(spark, "landing-offsets"), landed_at=F.col("timestamp"), batch_seconds=1
    )
    flush_and_close(query)
    return tables.orc_path(spark, path, LANDING).select("topic", "time_id", "year", "month", "day")


def part_prune_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "base")
    sink.append_path(base(spark, sf), path)
    recent = tables.orc_path_since(spark, path, BASE, SINCE)
    return recent.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("rt_count").alias("rt_count")
    )


def orc_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "base")
    sink.append_path(base(spark, sf), path)
    return tables.orc_path(spark, path, BASE)


def load_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per load as measured by the writes: first load, and one day done again.

    Both loads take the same base rows, so the documents are parsed once.
    """
    path = new_path(spark, "base")
    rows = stored(base(spark, sf), "base-rows")
    loaded = sink.append_path(rows, path)
    again = sink.overwrite_partitions(filters.scan_since(rows, SINCE), path)
    kept = tables.orc_path(spark, path, BASE).agg(F.count(F.lit(1)).alias("kept"))
    return kept.select(F.lit(loaded).alias("loaded"), F.lit(again).alias("again"), "kept")


def queries() -> dict[str, Query]:
    listed: list[Query] = [
        lang_class,
        repost_status,
        repost_count,
        has_hashtags,
        ingest_filter,
        first_n,
        date_filter_calendar,
        date_filter_componentwise,
        drop_any_null,
        json_extract,
        json_wildcard,
        hashtag_clean,
        text_clean,
        text_clean_pages,
        text_clean_conversations,
        date_parse,
        date_format_id,
        tz_shift,
        land_to_base,
        dedup_latest,
        explode_tags,
        sentiment_lexicon,
        sentiment_model,
        exploded_posts,
        hashtag_agg,
        hashtag_names,
        staging_fresh,
        staging_merge,
        staging_merge_replace,
        staging_merge_nodedup,
        staging_names,
        staging_names_replace,
        published_names,
        union_all,
        max_update,
        updated_today,
        status,
        publish,
        rank_per_day,
        top10_per_day,
        top10_direct,
        sorted_tags,
        stream_land,
        stream_filter,
        stream_collect,
        stream_compacted,
        dead_letters,
        stream_idle_stop,
        stream_topics,
        stream_processing_time,
        part_prune_scan,
        orc_roundtrip,
        load_report,
        *job_queries.QUERIES,
    ]
    return {query.__name__: _flattened(query) for query in listed}


def without_sql() -> dict[str, Query]:
    """Queries that train: tests hold them against brute force and held-out rows."""
    return {query.__name__: _flattened(query) for query in [sentiment_trained]}


def _flattened(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(query(spark, sf_dir))

    run.__name__ = query.__name__
    return run
