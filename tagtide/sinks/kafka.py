"""Kafka sink: null key, document as value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tagtide.config import KafkaSettings


def kafka_sink_options(settings: KafkaSettings, topic: str | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.brokers,
        "kafka.acks": settings.acks,
        "topic": topic or settings.raw_topic,
    }


def write_kafka(df: DataFrame, settings: KafkaSettings) -> None:
    options = kafka_sink_options(settings)
    df.select("value").write.format("kafka").options(**options).save()


def start_kafka(
    df: DataFrame, settings: KafkaSettings, checkpoint: str, batch_seconds: int | None = None
) -> StreamingQuery:
    """Records to the topic every ``batch_seconds``, as soon as they come when None."""
    options = {**kafka_sink_options(settings), "checkpointLocation": checkpoint}
    writer = df.select("value").writeStream.format("kafka").options(**options)
    if batch_seconds is not None:
        writer = writer.trigger(processingTime=f"{batch_seconds} seconds")
    return writer.start()


def flush_and_close(query: StreamingQuery) -> None:
    """Write out what the source holds now, then stop."""
    query.processAllAvailable()
    query.stop()
