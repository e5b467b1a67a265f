"""Reading post events out of raw JSON and classifying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.schemas import DOCUMENT, POST

_REPOST = "retweeted_status"


def parse_posts(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``lang`` and ``retweeted_status``, parsed once per row.

    The one-element ``inline`` keeps filters above the parse: as a plain
    projection the optimizer would copy ``from_json`` into every predicate.
    Malformed documents give nulls.
    """
    return df.select("*", F.inline(F.array(F.from_json(value, POST))))


def with_kind(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``kind``: ``malformed`` documents, ``notice`` of a deleted post, or ``post``.

    The parser keeps the text of what it can't read in a column of its own.
    """
    parsed = df.select("*", F.inline(F.array(F.from_json(value, DOCUMENT, {"columnNameOfCorruptRecord": "_corrupt"}))))
    blank = ~F.coalesce(F.col(value).rlike(r"\S"), F.lit(False))
    kind = (
        F.when(blank | F.col("_corrupt").isNotNull(), "malformed")
        .when(F.col("delete").isNotNull(), "notice")
        .otherwise("post")
    )
    return parsed.select(*[F.col(f"`{name}`") for name in df.columns], kind.alias("kind"))


def json_path(document: str, path: str) -> Column:
    """Ad-hoc path extract, as text."""
    return F.get_json_object(document, path)


def tag_entities() -> Column:
    """Extended hashtags win over plain ones, even when empty."""
    return F.coalesce(
        F.col(f"{_REPOST}.extended_tweet.entities.hashtags"),
        F.col(f"{_REPOST}.entities.hashtags"),
    )


def tag_texts() -> Column:
    """The ``text`` of every hashtag; NULL when there is none."""
    texts = F.filter(F.transform(tag_entities(), lambda t: t["text"]), lambda t: t.isNotNull())
    return F.when(F.size(texts) > 0, texts)


def post_text() -> Column:
    return F.coalesce(F.col(f"{_REPOST}.extended_tweet.full_text"), F.col(f"{_REPOST}.text"))


def lang_class(language: str, lang: str = "lang") -> Column:
    """The language itself, ``"null"`` when unknown, else ``"other"``."""
    return (
        F.when(F.col(lang).isNull(), "null").when(F.col(lang) == language, language).otherwise("other")
    )


def repost_status() -> Column:
    return F.when(F.col(_REPOST).isNotNull(), "yes").otherwise("no")


def count() -> Column:
    """The repost's count, also if it arrives as text; NULL if it is no whole number."""
    return F.col(f"{_REPOST}.retweet_count").try_cast("long")


def repost_count() -> Column:
    """Reposts of the original post, -1 when it is not a repost."""
    return F.coalesce(count(), F.lit(-1).cast("long"))


def has_hashtags() -> Column:
    """Looks at the extended part when there is one, else at the plain entities."""
    tags = F.when(
        F.col(f"{_REPOST}.extended_tweet").isNotNull(),
        F.col(f"{_REPOST}.extended_tweet.entities.hashtags"),
    ).otherwise(F.col(f"{_REPOST}.entities.hashtags"))
    return F.coalesce(F.size(tags) > 0, F.lit(False))


def accepted(language: str, min_reposts: int) -> Column:
    """Language, repost, count and hashtag conditions together."""
    return (
        (lang_class(language) == language)
        & (repost_status() == "yes")
        & (repost_count() >= min_reposts)
        & has_hashtags()
    )
