import datetime as dt

from pyspark.sql import functions as F

from tagtide.functions import sentiment
from tagtide.operators import dedup, explode
from tagtide.schemas import BASE, EXPLODED


def base_row(tweet_id, tags, count, user="ann", text="a good day", second=0, day=28):
    created = f"Wed Nov 27 09:24:{second:02d} +0000 2019"
    return (created, tweet_id, text, tags, count, f"id-{user}", user, 2019, 11, day)


def base(spark, *rows):
    return spark.createDataFrame(rows, BASE)


def test_latest_posts_keeps_the_greatest_count(spark):
    rows = [base_row("1", ["A"], n) for n in (5, 90, 7)] + [base_row("2", ["B"], 1)]
    kept = dedup.latest_posts(base(spark, *rows)).collect()
    assert {(r.tweet_id, r.rt_count) for r in kept} == {("1", 90), ("2", 1)}


def test_latest_posts_breaks_ties_by_time_then_user(spark):
    rows = [
        base_row("1", ["A"], 5, "zoe", second=1),
        base_row("1", ["A"], 5, "ann", second=2),
        base_row("1", ["A"], 5, "bob", second=2),
    ]
    for order in (rows, rows[::-1]):
        kept = dedup.latest_posts(base(spark, *order)).collect()
        assert [r.user_name for r in kept] == ["bob"]


def test_explode_posts(spark):
    rows = [
        base_row("1", ["A", "B"], 131),
        base_row("1", ["A", "B"], 130),
        base_row("2", [], 7),
        base_row("3", ["A"], 9, text="", day=5),
    ]
    exploded = explode.explode_posts(base(spark, *rows))
    assert exploded.dtypes == [(f.name, f.dataType.simpleString()) for f in EXPLODED]
    posted = dt.date(2019, 11, 27)
    assert sorted(r[:] for r in exploded.collect()) == [
        ("A", 9, "3", 50.0, "ann", posted, dt.date(2019, 11, 5), 2019, 11, 5),
        ("A", 131, "1", 75.0, "ann", posted, dt.date(2019, 11, 28), 2019, 11, 28),
        ("B", 131, "1", 75.0, "ann", posted, dt.date(2019, 11, 28), 2019, 11, 28),
    ]


def test_scoring_before_and_after_dedup_agree(spark):
    rows = [
        base_row(str(i % 20), ["A", f"T{i % 7}"], i % 3, text="good " * (i % 4) + "bad " * (i % 3))
        for i in range(200)
    ]
    frame = base(spark, *rows)
    before = explode.explode_posts(frame).collect()
    after = explode.explode_posts(frame, before_dedup=False).collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))


def test_model_scorer(spark):
    score = sentiment.model_score(lambda: lambda sentences: [4 for _ in sentences])
    exploded = explode.explode_posts(base(spark, base_row("1", ["A"], 1)), score, before_dedup=False)
    assert exploded.select("sentiment_%").first()[0] == 100.0


def test_null_tags_explode_to_nothing(spark):
    assert explode.explode_tags(base(spark, base_row("1", None, 1))).count() == 0


def test_union_all_keeps_duplicates_and_goes_by_name(spark):
    one = spark.createDataFrame([(1, "a")], "n int, s string")
    two = spark.createDataFrame([("a", 1)], "s string, n int")
    assert [tuple(r) for r in dedup.union_all(one, two).collect()] == [(1, "a"), (1, "a")]


def test_hot_post_reaches_the_shuffle_once_per_task(spark):
    """One post holds most rows: the map side sends one row per task for it."""
    hot = spark.range(20_000, numPartitions=4).select(
        F.lit("Wed Nov 27 09:24:39 +0000 2019").alias("created"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("tweet_id"),
        F.lit("text").alias("tweet_txt"),
        F.array(F.lit("A")).alias("hashtags"),
        F.col("id").alias("rt_count"),
        F.lit("u").alias("user_id"),
        F.lit("u").alias("user_name"),
        *[F.lit(1).cast(t).alias(n) for n, t in (("year", "short"), ("month", "byte"), ("day", "byte"))],
    )
    kept = dedup.latest_posts(hot)
    assert kept.where("tweet_id = 'hot'").first().rt_count == 19_999
    assert "partial_max" in kept._jdf.queryExecution().executedPlan().toString()
