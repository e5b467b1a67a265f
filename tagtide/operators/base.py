"""Landing rows to base rows: one JSON parse, cleaning, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.functions import posts, text
from tagtide.schemas import BASE, PARTITIONS


def to_base(landing: DataFrame, value: str = "full_tweet") -> DataFrame:
    """One row per repost event whose ten base columns are all known.

    The null test runs on the parsed fields. Cleaning never turns a value into
    null, so rows drop before the regular expressions run, not after.
    """
    repost = F.col("retweeted_status")
    fields = {
        "created": repost["created_at"],
        "tweet_id": repost["id_str"],
        "tweet_txt": posts.post_text(),
        "hashtags": posts.tag_texts(),
        "rt_count": posts.count(),
        "user_id": repost["user"]["id_str"],
        "user_name": repost["user"]["screen_name"],
    }
    known = [F.col(part).isNotNull() for part in PARTITIONS]
    known += [column.isNotNull() for column in fields.values()]
    condition = known[0]
    for test in known[1:]:
        condition = condition & test
    fields["tweet_txt"] = text.clean_text(fields["tweet_txt"])
    fields["hashtags"] = text.clean_tags(fields["hashtags"])
    return (
        posts.parse_posts(landing, value)
        .where(condition)
        .select(*[column.alias(name) for name, column in fields.items()], *PARTITIONS)
        .select(*BASE.names)
    )
