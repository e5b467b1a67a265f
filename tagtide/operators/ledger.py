"""Posts counted once across overlapping runs.

The winners table holds, for each run, the rows that became the one that counts for their
post. The ledger sums these rows by hashtag, user and dates. A run takes what a post
contributed so far out of the ledger and puts its new row in. Sums and counts go down as
well as up, and as the dates and names are keys, they go with the last post that has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions import dates
from tagtide.operators import dedup
from tagtide.operators.explode import explode_scored
from tagtide.schemas import LEDGER, WINNERS, conform

KEYS = ["hashtag", "user_name", "date_posted", "date_recorded"]
SUMS = ["rt_count", "tweet_count", "sentiment_sum", "sentiment_count"]


def winners(rows: DataFrame) -> DataFrame:
    """The scored row that counts for each post, of one run or of several runs' winners."""
    return dedup.latest_posts(rows.select(*WINNERS.names))


def _order(rows: str) -> Column:
    """What ``winners`` compares rows by."""
    first = ["rt_count", "user_id"]
    rest = [name for name in WINNERS.names if name not in (*first, "tweet_id")]
    posted = dates.posted_at(f"{rows}.created")
    return F.struct(F.col(f"{rows}.rt_count"), posted, F.col(f"{rows}.user_id"), *[F.col(f"{rows}.{n}") for n in rest])


def changes(fresh: DataFrame, history: DataFrame, buckets: int) -> DataFrame:
    """old and new (structs) of the posts of ``fresh`` whose winner changes.

    Both hold one row per post. The fresh ones are dealt like the buckets of the
    history, so that the history stays where it is.
    """
    new = conform(fresh, WINNERS).repartition(buckets, "tweet_id").alias("new")
    old = history.select(*WINNERS.names).alias("old")
    both = new.join(old, F.col("new.tweet_id") == F.col("old.tweet_id"), "left")
    known = F.col("old.tweet_id").isNotNull()
    changed = both.where(~known | (_order("new") > _order("old")))

    def row(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{name}").alias(name) for name in WINNERS.names])

    return changed.select(F.when(known, row("old")).alias("old"), row("new").alias("new"))


def contributions(changed: DataFrame) -> DataFrame:
    """What changed winners add to the ledger, and, below zero, what they take out."""
    gone = changed.where("old IS NOT NULL").select("old.*", F.lit(-1).alias("sign"))
    rows = explode_scored(changed.select("new.*", F.lit(1).alias("sign")).unionByName(gone), "sign")
    percent = F.col("`sentiment_%`")
    sums = [
        F.sum(F.col("rt_count") * F.col("sign")),
        F.sum(F.col("sign").cast("long")),
        F.sum(F.coalesce(percent, F.lit(0.0)) * F.col("sign")),
        F.sum(F.when(percent.isNotNull(), F.col("sign")).otherwise(0).cast("long")),
    ]
    named = [total.alias(name) for total, name in zip(sums, SUMS, strict=True)]
    return conform(rows.groupBy(*KEYS).agg(*named), LEDGER)


def merged(ledger: DataFrame, delta: DataFrame) -> DataFrame:
    """The ledger after a run; keys that no post has any more go."""
    rows = ledger.unionByName(delta).groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in SUMS])
    return conform(rows.where("tweet_count != 0"), LEDGER)
