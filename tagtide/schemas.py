"""Declared schemas of every layer; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

_TAGS = T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))
_ENTITIES = T.StructType([T.StructField("hashtags", _TAGS)])

# Only the fields that are read, so the JSON reader skips the rest of the document.
POST = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField(
            "retweeted_status",
            T.StructType(
                [
                    T.StructField("created_at", T.StringType()),
                    T.StructField("id_str", T.StringType()),
                    T.StructField("text", T.StringType()),
                    # a number or a number as text; read it with ``posts.count``
                    T.StructField("retweet_count", T.StringType()),
                    T.StructField(
                        "user",
                        T.StructType(
                            [
                                T.StructField("id_str", T.StringType()),
                                T.StructField("screen_name", T.StringType()),
                            ]
                        ),
                    ),
                    T.StructField("entities", _ENTITIES),
                    T.StructField(
                        "extended_tweet",
                        T.StructType(
                            [
                                T.StructField("full_text", T.StringType()),
                                T.StructField("entities", _ENTITIES),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)

# What tells posts from notices and from documents that can't be read.
DOCUMENT = T.StructType(
    [*POST.fields, T.StructField("delete", T.StringType()), T.StructField("_corrupt", T.StringType())]
)

PARTITIONS = ["year", "month", "day"]
_PARTITION_FIELDS = [
    T.StructField("year", T.ShortType()),
    T.StructField("month", T.ByteType()),
    T.StructField("day", T.ByteType()),
]

LANDING = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("time_id", T.LongType()),
        T.StructField("full_tweet", T.StringType()),
        *_PARTITION_FIELDS,
    ]
)

BASE = T.StructType(
    [
        T.StructField("created", T.StringType()),
        T.StructField("tweet_id", T.StringType()),
        T.StructField("tweet_txt", T.StringType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("rt_count", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        *_PARTITION_FIELDS,
    ]
)

EXPLODED = T.StructType(
    [
        T.StructField("hashtag", T.StringType()),
        T.StructField("rt_count", T.LongType()),
        T.StructField("tweet_id", T.StringType()),
        T.StructField("sentiment_%", T.DoubleType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("date_posted", T.DateType()),
        T.StructField("date_recorded", T.DateType()),
        *_PARTITION_FIELDS,
    ]
)

_MEASURES = [
    T.StructField("hashtag", T.StringType()),
    T.StructField("rt_count", T.LongType()),
    T.StructField("tweet_count", T.LongType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("date_posted", T.DateType()),
    T.StructField("date_recorded", T.DateType()),
]

AGGREGATED = T.StructType([*_MEASURES, *_PARTITION_FIELDS])
STAGING = T.StructType(
    [*_MEASURES, T.StructField("last_update", T.TimestampType()), *_PARTITION_FIELDS]
)
ANALYTIC = T.StructType(
    [T.StructField("hashtag_id", T.StringType()), *_MEASURES, *_PARTITION_FIELDS]
)
TOP_VIEW = ["date_recorded", "rank", "hashtag", "rt_count", "avg_sentiment", "date_posted"]

# Every name that used a hashtag, a row each, whether there is one or a hundred million.
NAMES = T.StructType(
    [T.StructField("hashtag", T.StringType()), T.StructField("user_name", T.StringType())]
)
PUBLISHED_NAMES = T.StructType([*NAMES.fields, *_PARTITION_FIELDS])

# The scored row that counts for a post, without its text.
WINNERS = T.StructType(
    [
        *[f for f in BASE.fields if f.name not in ("tweet_txt", *PARTITIONS)],
        *_PARTITION_FIELDS,
        T.StructField("_text", T.LongType()),
        T.StructField("sentiment", T.IntegerType()),
    ]
)
# Sums of the posts of a hashtag by all that its measures and names are made of.
LEDGER = T.StructType(
    [
        T.StructField("hashtag", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("date_posted", T.DateType()),
        T.StructField("date_recorded", T.DateType()),
        T.StructField("rt_count", T.LongType()),
        T.StructField("tweet_count", T.LongType()),
        T.StructField("sentiment_sum", T.DoubleType()),
        T.StructField("sentiment_count", T.LongType()),
    ]
)


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def conform(df, schema: T.StructType):
    """Select the schema's columns in order, cast to its types."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
