"""What the physical plans must and must not contain."""

import datetime as dt

from conftest import plan_of
from posts import post
from pyspark.sql import functions as F

from tagtide.config import FeedSettings
from tagtide.operators import aggregate, explode, filters, ranking
from tagtide.operators.base import to_base
from tagtide.schemas import AGGREGATED, BASE, LANDING, STAGING
from tagtide.sinks import tables as sink
from tagtide.sources import tables


def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = [("reposts", 1, post(tweet_id=str(d)), 2019, 12, d) for d in range(1, 31)]
    sink.append_path(spark.createDataFrame(rows, LANDING), path)
    return path


def test_scan_prunes_partitions(spark, tmp_path):
    path = landing(spark, tmp_path)
    for mode in ("calendar", "componentwise"):
        recent = tables.orc_path_since(spark, path, LANDING, dt.date(2019, 12, 29), mode)
        plan = plan_of(recent)
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        assert "DataFilters: []" in plan
        assert len(recent.inputFiles()) == 30 and recent.count() == 2
    narrow = tables.orc_path(spark, path, LANDING).select("topic")
    assert "ReadSchema: struct<topic:string>" in plan_of(narrow)


def test_one_parse_no_shuffle_to_base(spark, tmp_path):
    plan = plan_of(to_base(tables.orc_path(spark, landing(spark, tmp_path), LANDING)))
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan and "Python" not in plan


def test_ingest_filter_parses_once(spark):
    feed = spark.createDataFrame([(post(),)], "value string")
    plan = plan_of(filters.ingest_filter(feed, FeedSettings()))
    assert plan.count("from_json") == 1 and "Exchange" not in plan


def exploded(spark):
    rows = spark.createDataFrame([("c", "1", "t", ["A"], 1, "i", "u", 2019, 1, 1)], BASE)
    return explode.explode_posts(rows)


def test_text_is_not_shuffled(spark):
    plan = plan_of(exploded(spark))
    sent = plan[: plan.index("Exchange")]
    assert "tweet_txt" not in sent and "Python" not in plan


def test_aggregation_combines_before_every_shuffle(spark):
    plan = plan_of(aggregate.aggregate_hashtags(exploded(spark)))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("partial_sum(rt_count") == 1
    pairs = plan_of(aggregate.name_measures(exploded(spark)))
    assert pairs.count("Exchange hashpartitioning") == 2 and pairs.count("partial_sum(rt_count") == 1


def test_merge_takes_one_shuffle(spark):
    old, new = spark.createDataFrame([], STAGING), spark.createDataFrame([], AGGREGATED)
    plan = plan_of(aggregate.merge_staging(new.repartition(3), old.repartition(3)))
    assert plan.count("Exchange hashpartitioning(hashtag") == 1 and "SortAggregate" not in plan


def test_fresh_staging_moves_nothing(spark):
    plan = plan_of(aggregate.fresh_staging(spark.createDataFrame([], AGGREGATED)))
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_ranks_are_not_joined_by_count(spark):
    rows = spark.range(100).selectExpr("DATE'2019-01-01' AS date_recorded", "7L AS rt_count", "string(id) AS hashtag")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ranking.rank_rows(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("_range" in line and "rt_count" not in line for line in joins)


def test_top_n_limits_before_its_shuffle(spark):
    rows = spark.createDataFrame([(dt.date(2019, 1, 1), 1, "A")], "date_recorded date, rt_count long, hashtag string")
    plan = plan_of(ranking.top_n_per_day(rows))
    assert plan.count("WindowGroupLimit") == 2 and "SinglePartition" not in plan


def test_row_numbers_window_within_ranges(spark):
    rows = spark.range(1000).select(
        F.lit(dt.date(2019, 1, 1)).alias("date_recorded"),
        F.col("id").alias("rt_count"),
        F.col("id").cast("string").alias("hashtag"),
    )
    numbered = ranking.number_rows(rows)
    plan = plan_of(numbered)
    assert "SinglePartition" not in plan and "_range" in plan
    assert numbered.agg(F.max("rank"), F.count_distinct("rank")).first()[:] == (1000, 1000)
