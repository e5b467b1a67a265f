"""Feeds of raw JSON documents, as batches or streams with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.config import KafkaSettings
from tagtide.functions import dates
from tagtide.schemas import LANDING, POST, conform


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line."""
    return spark.read.text(path)


def whole_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per file, whatever its line breaks, already parsed."""
    text = spark.read.text(path, wholetext=True)
    return text.select("value", F.inline(F.array(F.from_json("value", POST))))


def document_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files of a folder, one document per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_source_options(
    settings: KafkaSettings, topics: list[str] | None = None, pattern: str | None = None
) -> dict[str, str]:
    """Options of a Kafka source: one topic, several, or a pattern."""
    chosen = (
        {"subscribePattern": pattern}
        if pattern
        else {"subscribe": ",".join(topics or [settings.raw_topic])}
    )
    limit = {"maxOffsetsPerTrigger": str(settings.records_per_batch)} if settings.records_per_batch else {}
    return {
        "kafka.bootstrap.servers": settings.brokers,
        "kafka.group.id": settings.group_id,
        "startingOffsets": settings.offset_reset,
        **limit,
        **chosen,
    }


def kafka_stream(
    spark: SparkSession,
    settings: KafkaSettings,
    topics: list[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Kafka records; their offsets live in the query's checkpoint."""
    options = kafka_source_options(settings, topics, pattern)
    return spark.readStream.format("kafka").options(**options).load()


def as_records(feed: DataFrame, topic: str, timestamp: Column | None = None) -> DataFrame:
    """Give a file feed the columns of a Kafka source."""
    stamp = F.current_timestamp() if timestamp is None else timestamp
    return feed.select(F.lit(topic).alias("topic"), stamp.alias("timestamp"), "value")


def to_landing(records: DataFrame, landed_at: Column) -> DataFrame:
    """Kafka-shaped records as landing rows, partitioned by the time they land."""
    rows = records.select(
        "topic",
        F.unix_millis("timestamp").alias("time_id"),
        F.col("value").cast("string").alias("full_tweet"),
        *[part.alias(name) for name, part in dates.partition_parts(landed_at).items()],
    )
    return conform(rows, LANDING)
