"""A feed of raw post documents derived from the ``events`` and ``documents`` tables.

Every event is a repost of one document, so the feed grows with both tables and
holds their whole texts. The shapes below cover what real feeds contain: unknown
languages, posts that are no reposts, missing counts, empty and non-ASCII
hashtags, leading and later URLs, emoji, line breaks, delete notices and
malformed documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "reposts"
MALFORMED = '{"lang":"en","retweeted_status":{'
DELETE_NOTICE = '{"delete":{"status":{"id":1}}}'
MOODS = [
    "\nWe love this great news.",
    "\nBad day! So sad, terrible loss",
    "\nGood. Awful! Nice? wrong",
    "",
    "\nThe worst fraud: evil, ugly, sick",
]
LANDED_DAYS_AGO = 15
POSTED_DAYS_AGO = 16
#: Files of a feed of many micro-batches.
FILES = 8
#: Bytes of texts that a task puts into documents: what it writes is sorted by day in memory.
TASK_BYTES = 128 << 20


def _each(remainder: int, of: int) -> Column:
    return F.col("event_id") % of == remainder


def days_before(stamp: str, days: int) -> Column:
    return F.col(stamp) - F.expr(f"INTERVAL {days} DAYS")


def _tags(*texts: Column) -> Column:
    return F.array(*[F.struct(text.alias("text")) for text in texts])


def _document() -> Column:
    """The JSON document of one event."""
    mood = F.element_at(F.array(*[F.lit(m) for m in MOODS]), (F.col("doc_id") % 5 + 1).cast("int"))
    text = F.concat("text", mood)
    link = F.concat(F.lit("https://example.org/p?id="), "event_id", F.lit(" "))
    long_text = F.concat(
        F.when(_each(0, 4), link).otherwise(F.lit("")),
        text,
        F.lit(" 🎉\nsee https://t.co/x"),
        "event_id",
        F.lit(" now\nlast line"),
    )
    long_tags = (
        F.when(_each(4, 10), F.array().cast("array<struct<text:string>>"))
        .when(_each(6, 22), _tags(F.lit("é"), F.lit("日本")))
        .otherwise(
            _tags(
                F.col("event_type"),
                F.concat_ws(",", "source", "event_type"),
                F.concat(F.lit("Topic"), "doc_id"),
                F.concat("lang", F.lit("é!")),
                F.lit("Two Words"),
            )
        )
    )
    reposts = F.get_json_object("props", "$.k").cast("long") * 3
    repost = F.struct(
        F.date_format(days_before("ts", POSTED_DAYS_AGO), "EEE MMM dd HH:mm:ss +0000 yyyy").alias(
            "created_at"
        ),
        F.col("doc_id").cast("string").alias("id_str"),
        text.alias("text"),
        F.when(~_each(11, 53) & ~_each(5, 7), reposts).alias("retweet_count"),
        F.struct(
            F.col("user_id").cast("string").alias("id_str"),
            F.concat(F.lit("u"), "user_id").alias("screen_name"),
        ).alias("user"),
        F.struct(_tags(F.col("event_type"), F.col("source")).alias("hashtags")).alias("entities"),
        F.when(
            _each(0, 2),
            F.struct(
                long_text.alias("full_text"), F.struct(long_tags.alias("hashtags")).alias("entities")
            ),
        ).alias("extended_tweet"),
    )
    whole = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.when(~_each(3, 29), F.col("lang")).alias("lang"),
            F.lit(0).alias("retweet_count"),
            F.when(F.col("event_type") != "error", repost).alias("retweeted_status"),
        )
    )
    # every seventh count arrives as text; the document stands once in the plan
    plain = F.lit('"retweeted_status":{')
    quoted = F.concat(F.lit('"retweeted_status":{"retweet_count":"'), reposts.cast("string"), F.lit('",'))
    as_text = _each(5, 7) & ~_each(11, 53) & reposts.isNotNull()
    whole = F.replace(whole, plain, F.when(as_text, quoted).otherwise(plain))
    return F.when(_each(13, 97), MALFORMED).when(_each(7, 89), DELETE_NOTICE).otherwise(whole)


def tasks_for(rows: int, documents: DataFrame) -> int:
    """Tasks that make ``rows`` documents of ``TASK_BYTES`` each, by the mean length of the texts.

    The engine would deal the join by the events' few bytes, and so whole days to a task.
    """
    mean = documents.agg(F.avg(F.octet_length("text")).alias("mean")).first()["mean"] or 0
    return max(documents.sparkSession.sparkContext.defaultParallelism, math.ceil(rows * mean / TASK_BYTES))


def feed_of(events: DataFrame, documents: DataFrame, rows: int) -> DataFrame:
    """``event_id, ts, value`` for a batch or streaming ``events`` of about ``rows`` rows at once.

    The tables are single files, so both are spread by the join key first.
    """
    total, tasks = documents.count(), tasks_for(rows, documents)  # from the file footers, and a look at the texts
    numbered = events.withColumn("_doc", F.col("event_id") % F.lit(total)).repartition(tasks, "_doc")
    joined = numbered.join(documents.repartition(tasks, "doc_id"), F.col("_doc") == F.col("doc_id"))
    return joined.select("event_id", "ts", _document().alias("value"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return feed_of(events, spark.read.parquet(f"{sf_dir}/documents.parquet"), events.count())


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with ``events`` read as a stream."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    reader = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet")
    events = reader.parquet(sf_dir)
    return feed_of(events, spark.read.parquet(f"{sf_dir}/documents.parquet"), table.count())


def split_events(spark: SparkSession, sf_dir: str, path: str, files: int = FILES) -> None:
    """``events`` in files by falling age, of equal ranges of ids, for streams of many batches.

    The file source takes the oldest files first, so their times are set apart.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    bounds = events.agg(F.min("event_id"), F.max("event_id")).first()
    low, step = bounds[0], (bounds[1] - bounds[0]) // files + 1
    numbered = events.withColumn("_file", F.floor((F.col("event_id") - low) / step))
    numbered.repartition(files, "_file").write.partitionBy("_file").parquet(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in system.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith("_file="):
            for file in system.listStatus(folder.getPath()):
                system.setTimes(file.getPath(), 1_000_000 + 10_000 * int(name.removeprefix("_file=")), -1)


def split_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The feed from ``split_events``, a file for each micro-batch."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return feed_of(reader.parquet(path), spark.read.parquet(f"{sf_dir}/documents.parquet"), table.count() // FILES)


def records_of(posts: DataFrame) -> DataFrame:
    """The feed in the shape of a Kafka source; records arrive when they land."""
    landed = days_before("ts", LANDED_DAYS_AGO).cast("timestamp")
    return posts.select(F.lit(TOPIC).alias("topic"), landed.alias("timestamp"), "value")
