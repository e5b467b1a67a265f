from posts import post

from tagtide.operators.base import to_base
from tagtide.schemas import BASE


def landing(spark, *documents):
    rows = [("reposts", 1, d, 2019, 11, 28) for d in documents]
    schema = "topic string, time_id long, full_tweet string, year short, month byte, day byte"
    return spark.createDataFrame(rows, schema)


def test_schema_and_row(spark):
    document = post(
        tweet_id="42",
        text="short",
        full_text="https://t.co/a Hello, world \U0001f389",
        extended=["One", "one", "One", "é"],
        count=131,
        user="ann",
    )
    base = to_base(landing(spark, document))
    assert base.dtypes == [(f.name, f.dataType.simpleString()) for f in BASE]
    assert base.first()[:] == (
        "Wed Nov 27 09:24:39 +0000 2019",
        "42",
        " Hello world ",
        ["One", "one"],
        131,
        "id-ann",
        "ann",
        2019,
        11,
        28,
    )


def test_rows_with_any_null_drop(spark):
    rows = landing(
        spark,
        post(extended=[]),
        post(count=None),
        post(created=None),
        post(repost=None),
        "broken {",
        '{"delete":{}}',
        None,
        post(tweet_id="kept", plain=["é"]),
    )
    kept = to_base(rows).collect()
    assert [(row.tweet_id, row.hashtags) for row in kept] == [("kept", [])]


def test_unknown_partition_drops(spark):
    rows = landing(spark, post()).selectExpr("topic", "time_id", "full_tweet", "year", "month", "CAST(NULL AS BYTE) AS day")
    assert to_base(rows).count() == 0


def test_counts_that_are_no_numbers_drop(spark):
    assert to_base(landing(spark, post(count="many"))).count() == 0


def test_counts_as_text_are_numbers(spark):
    documents = [post(tweet_id=str(i), count=c) for i, c in enumerate([136, "137", 138.5, "many", None])]
    found = to_base(landing(spark, *documents)).collect()
    assert {(r.tweet_id, r.rt_count) for r in found} == {("0", 136), ("1", 137)}
