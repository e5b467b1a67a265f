"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
computes all rows and columns of its result once; one small query runs first to
warm the session up. The queries make the JSON feed anew each time, so ``stages`` times
the operators apart, each on the stored result of the one before.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tagtide.operators import aggregate, explode, ranking
from tagtide.operators.base import to_base
from tagtide.plans import registry
from tagtide.workspace import stored

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "ingest_filter",
    "json_extract",
    "hashtag_clean",
    "text_clean",
    "text_clean_pages",
    "land_to_base",
    "dedup_latest",
    "sentiment_lexicon",
    "sentiment_model",
    "exploded_posts",
    "hashtag_agg",
    "staging_merge",
    "publish",
    "rank_per_day",
    "top10_per_day",
    "top10_direct",
    "stream_land",
    "stream_filter",
    "part_prune_scan",
    "orc_roundtrip",
]


def stages(spark: SparkSession) -> dict[str, float]:
    """Seconds per operator on stored input."""
    times: dict[str, float] = {}

    def timed(name: str, run):
        started = time.perf_counter()
        found = stored(run(), name)
        times[name] = round(time.perf_counter() - started, 3)
        return found

    landing = timed("feed_to_landing", lambda: registry.landing(spark, SF_DIR))
    base = timed("landing_to_base", lambda: to_base(landing))
    exploded = timed("base_to_exploded", lambda: explode.explode_posts(base))
    names = timed("exploded_to_names", lambda: aggregate.name_measures(exploded))
    rows = timed("names_to_aggregate", lambda: aggregate.aggregate_names(names))
    staging = timed("aggregate_to_staging", lambda: aggregate.fresh_staging(rows, registry.ZONE, registry.NOW))
    timed("merge", lambda: aggregate.merge_staging(rows, staging, registry.ZONE, registry.NOW))
    analytic = timed("publish", lambda: ranking.publish(staging))
    timed("rank", lambda: ranking.rank_rows(rows.select("date_recorded", "hashtag", "rt_count")))
    timed("top10", lambda: ranking.top_n_per_day(analytic))
    timed("exploded_scored_after_dedup", lambda: explode.explode_posts(base, before_dedup=False))
    return times


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def seconds(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    seconds("lang_class")
    times = {name: seconds(name) for name in HEADLINE}
    total = round(sum(times.values()), 3)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "stages": stages(spark),
                "posts_per_sec": {name: round(events / t) for name, t in times.items()},
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": CPUS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
