"""SQL that works the registered queries out from the source columns.

Nothing here reads JSON: the post fields come straight from ``events`` and
``documents``, so the SQL is independent of the parsing under test.
"""

from __future__ import annotations

from tagtide.functions.sentiment import NEGATIVE, POSITIVE
from tagtide.plans.driver_feed import DELETE_NOTICE, LANDED_DAYS_AGO, MALFORMED, MOODS, POSTED_DAYS_AGO


def _text(value: str) -> str:
    escaped = value.replace("'", "''").replace("\n", "' || chr(10) || '")
    return f"('{escaped}')"


def _count(text: str, words: list[str]) -> str:
    return f"len(regexp_extract_all({text}, '\\b(?:{'|'.join(words)})\\b'))"


_MOOD = "CASE d.doc_id % 5 " + " ".join(f"WHEN {i} THEN {_text(m)}" for i, m in enumerate(MOODS)) + " END"

FEED = f"""
feed AS (
  SELECT e.event_id, e.ts, e.ts - INTERVAL {LANDED_DAYS_AGO} DAY AS landed,
    NOT broken AND e.event_type <> 'error' AS is_repost,
    CASE WHEN NOT broken AND e.event_id % 29 <> 3 THEN d.lang END AS lang,
    CASE WHEN is_repost THEN strftime(e.ts - INTERVAL {POSTED_DAYS_AGO} DAY, '%a %b %d %H:%M:%S +0000 %Y') END AS created,
    CASE WHEN is_repost THEN date_trunc('second', e.ts - INTERVAL {POSTED_DAYS_AGO} DAY) END AS posted_at,
    CASE WHEN is_repost THEN CAST(d.doc_id AS VARCHAR) END AS tweet_id,
    CASE WHEN is_repost AND e.event_id % 53 <> 11
      THEN CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) * 3 END AS rt_count,
    CASE WHEN is_repost THEN CAST(e.user_id AS VARCHAR) END AS user_id,
    CASE WHEN is_repost THEN 'u' || e.user_id END AS user_name,
    CASE WHEN is_repost THEN d.text || {_MOOD} END AS plain_text,
    CASE WHEN NOT is_repost THEN NULL WHEN e.event_id % 2 = 1 THEN plain_text ELSE
      CASE WHEN e.event_id % 4 = 0 THEN 'https://example.org/p?id=' || e.event_id || ' ' ELSE '' END
      || plain_text || ' 🎉' || chr(10) || 'see https://t.co/x' || e.event_id || ' now' || chr(10) || 'last line'
      END AS post_text,
    CASE WHEN NOT is_repost OR (e.event_id % 10 = 4) THEN NULL
      WHEN e.event_id % 2 = 1 THEN [e.event_type, d.source]
      WHEN e.event_id % 22 = 6 THEN ['é', '日本']
      ELSE [e.event_type, d.source || ',' || e.event_type, 'Topic' || d.doc_id, d.lang || 'é!', 'Two Words']
      END AS tags,
    CASE WHEN NOT is_repost OR (e.event_id % 10 = 4) THEN NULL
      WHEN e.event_id % 2 = 1 THEN [e.event_type, d.source]
      WHEN e.event_id % 22 = 6 THEN CAST([] AS VARCHAR[])
      ELSE [e.event_type, d.source, 'Topic' || d.doc_id, d.lang, 'TwoWords']
      END AS hashtags
  FROM (SELECT *, event_id % 97 = 13 OR event_id % 89 = 7 AS broken FROM events) e
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
)"""


def _clean(text: str) -> str:
    """Five replacements; the classes spell out where RE2 differs (VT, CR)."""
    leading = r"^(https?|ftp|file)://[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*[-a-zA-Z0-9+&@#/%=~_|]"
    no_link = f"regexp_replace({text}, '{leading}', '')"
    basic = f"regexp_replace({no_link}, '[^\\x{{0000}}-\\x{{FFFF}}]', '', 'g')"
    words = f"regexp_replace({basic}, '[^\\w\\s\\x0B]+', '', 'g')"
    no_links = f"regexp_replace({words}, '\\bhttp[^\\n\\r]*', '', 'g')"
    return f"replace({no_links}, chr(10), '')"


def _class(sentence: str) -> str:
    words = f"regexp_replace(lower({sentence}), '[^a-z0-9_]+', ' ', 'g')"
    return f"greatest(0, least(4, 2 + {_count(words, POSITIVE)} - {_count(words, NEGATIVE)}))"


def _sentences(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[.!?]+'), lambda s: regexp_matches(s, '\\S'))"


def _score(text: str) -> str:
    classes = f"list_transform({_sentences(text)}, lambda s: {_class('s')})"
    return f"CAST(coalesce(floor(list_avg({classes})), 2) AS BIGINT)"


def _day(stamp: str) -> str:
    return f"year({stamp}) AS year, month({stamp}) AS month, day({stamp}) AS day"


BASE = f"""
base AS (
  SELECT created, posted_at, tweet_id, {_clean("post_text")} AS tweet_txt, hashtags, rt_count,
    user_id, user_name, CAST(landed AS DATE) AS landed_on, {_day("landed")}
  FROM feed
  WHERE is_repost AND hashtags IS NOT NULL AND rt_count IS NOT NULL
)"""


def _latest(source: str = "base", where: str = "true", name: str = "latest") -> str:
    return f"""
{name} AS (
  SELECT * FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY rt_count DESC, posted_at DESC, user_id DESC,
    created DESC, tweet_txt DESC, user_name DESC) = 1
)"""


def _exploded(source: str = "latest", name: str = "exploded") -> str:
    return f"""
{name} AS (
  SELECT unnest(hashtags) AS hashtag, rt_count, tweet_id, {_score("tweet_txt")} / 4 * 100.0 AS "sentiment_%",
    user_name, CAST(posted_at AS DATE) AS date_posted, landed_on AS date_recorded
  FROM {source}
)"""


def _aggregated(source: str = "exploded", name: str = "aggregated") -> str:
    """Rounds half up in whole numbers: the sum of percents is one."""
    return f"""
{name} AS (
  SELECT hashtag, CAST(sum(rt_count) AS BIGINT) AS rt_count, count(tweet_id) AS tweet_count,
    ((CAST(sum("sentiment_%") AS BIGINT) * 200 + count(*)) // (2 * count(*))) / 100.0 AS avg_sentiment,
    min(date_posted) AS date_posted, max(date_recorded) AS date_recorded
  FROM {source} GROUP BY hashtag
)"""


_ALL = [FEED, BASE, _latest(), _exploded(), _aggregated()]
_HALVES = [
    FEED,
    BASE,
    _latest(where="year = 2023", name="latest_old"),
    _exploded("latest_old", "exploded_old"),
    _aggregated("exploded_old", "old"),
    _latest(where="year = 2024", name="latest_new"),
    _exploded("latest_new", "exploded_new"),
    _aggregated("exploded_new", "new"),
    "both_days AS (SELECT *, false AS is_new FROM old UNION ALL SELECT *, true FROM new)",
]
_DATES = (
    "strftime(date_posted, '%Y-%m-%d') AS date_posted, "
    "strftime(date_recorded, '%Y-%m-%d') AS date_recorded, " + _day("date_recorded")
)
_MEASURES = (
    "hashtag, rt_count, tweet_count, avg_sentiment, " + _DATES
)
_NOW = "'2024-01-15 12:30:00' AS last_update"


def _merged(rows: str) -> str:
    return f"""
merged AS (
  SELECT hashtag, CAST(sum(rt_count) AS BIGINT) AS rt_count, CAST(sum(tweet_count) AS BIGINT) AS tweet_count,
    ((sum(CAST(round(avg_sentiment * 100) AS BIGINT)) * 2 + count(*)) // (2 * count(*))) / 100.0 AS avg_sentiment,
    min(date_posted) AS date_posted, max(date_recorded) AS date_recorded
  FROM {rows} GROUP BY hashtag
)"""


_DISTINCT_COUNTS = """
kept AS (
  SELECT * FROM both_days
  QUALIFY row_number() OVER (PARTITION BY hashtag, rt_count ORDER BY date_recorded DESC, tweet_count DESC,
    avg_sentiment DESC, date_posted DESC, is_new DESC) = 1
)"""

_NAMES = """
names AS (
  SELECT DISTINCT hashtag, user_name, false AS is_new FROM exploded_old WHERE user_name IS NOT NULL
  UNION ALL SELECT DISTINCT hashtag, user_name, true FROM exploded_new WHERE user_name IS NOT NULL
)"""


def _with(parts: list[str], select: str) -> str:
    return f"WITH {', '.join(part.strip() for part in parts)}\n{select.strip()}"


def _feed(select: str) -> str:
    return _with([FEED], select)


def _ranked(rank: str, extra: str, rows: str = "aggregated") -> str:
    return f"SELECT *, {rank} OVER (PARTITION BY date_recorded ORDER BY rt_count DESC{extra}) AS rank FROM {rows}"


_TOP = f"""
SELECT strftime(date_recorded, '%Y-%m-%d') AS date_recorded, rank, hashtag, rt_count, avg_sentiment,
  strftime(date_posted, '%Y-%m-%d') AS date_posted
FROM ({_ranked("rank()", "")}) WHERE rank < 11
"""
_ACCEPTED = "lang = 'en' AND is_repost AND rt_count >= 100 AND tags IS NOT NULL"
#: Events whose document is malformed or a notice.
_BROKEN = "event_id % 97 = 13 OR event_id % 89 = 7"
_BASE_ROW = (
    "created, tweet_id, tweet_txt, array_to_string(hashtags, '|') AS hashtags, rt_count, user_id, user_name, "
    "year, month, day"
)
_LANDED = "SELECT 'reposts' AS topic, epoch_us(landed) // 1000 AS time_id, {day} FROM feed WHERE {test}"


def oracle_sql() -> dict[str, str]:
    return {
        "lang_class": _feed(
            "SELECT event_id, CASE WHEN lang IS NULL THEN 'null' WHEN lang = 'en' THEN 'en' ELSE 'other' END "
            "AS lang_class FROM feed"
        ),
        "repost_status": _feed(
            "SELECT event_id, CASE WHEN is_repost THEN 'yes' ELSE 'no' END AS repost_status FROM feed"
        ),
        "repost_count": _feed("SELECT event_id, coalesce(rt_count, -1) AS repost_count FROM feed"),
        "has_hashtags": _feed(
            "SELECT event_id, CAST(tags IS NOT NULL AS BIGINT) AS has_hashtags FROM feed"
        ),
        "ingest_filter": _feed(
            f"SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM feed WHERE {_ACCEPTED}"
        ),
        "first_n": _feed(f"SELECT event_id FROM feed WHERE {_ACCEPTED} ORDER BY event_id LIMIT 100"),
        "date_filter_calendar": _feed(
            _LANDED.format(day=_day("landed"), test="CAST(landed AS DATE) >= DATE '2023-12-20'")
        ),
        "date_filter_componentwise": _feed(
            _LANDED.format(
                day=_day("landed"), test="year(landed) >= 2023 AND month(landed) >= 12 AND day(landed) >= 20"
            )
        ),
        "drop_any_null": _feed(
            "SELECT event_id, lang, tweet_id, rt_count FROM feed "
            "WHERE lang IS NOT NULL AND tweet_id IS NOT NULL AND rt_count IS NOT NULL"
        ),
        "json_extract": _feed(
            "SELECT event_id, created, tweet_id, rt_count, user_id, user_name, post_text FROM feed"
        ),
        "json_wildcard": _feed("SELECT event_id, array_to_string(tags, '|') AS tags FROM feed"),
        "hashtag_clean": _feed(
            "SELECT event_id, array_to_string(hashtags, '|') AS hashtags, len(hashtags) AS n_tags FROM feed"
        ),
        "text_clean": _feed(f"SELECT event_id, {_clean('post_text')} AS tweet_txt FROM feed"),
        "text_clean_pages": f"SELECT page_id, {_clean("concat_ws(' ', url, html)")} AS tweet_txt FROM pages",
        "text_clean_conversations": f"SELECT conv_id, turn, {_clean('text')} AS tweet_txt FROM conversations",
        "date_parse": _feed(
            "SELECT event_id, strftime(posted_at, '%Y-%m-%d %H:%M:%S') AS posted_at, "
            "strftime(posted_at, '%Y-%m-%d') AS date_posted FROM feed"
        ),
        "date_format_id": _feed(
            "SELECT strftime(CAST(landed AS DATE), '%Y-%m-%d') AS date_recorded, "
            "strftime(CAST(landed AS DATE), '%Y%m%d') AS compact, "
            "strftime(CAST(landed AS DATE), '%Y%m%d') || '-' || count(*) AS day_id "
            "FROM feed GROUP BY CAST(landed AS DATE)"
        ),
        # All of the events are in winter, one hour ahead of UTC.
        "tz_shift": "SELECT event_id, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted, "
        "day(ts + INTERVAL 1 HOUR) AS day, hour(ts + INTERVAL 1 HOUR) AS hour FROM events",
        "land_to_base": _with([FEED, BASE], f"SELECT {_BASE_ROW} FROM base"),
        "dedup_latest": _with(
            [FEED, BASE, _latest()], f"SELECT {_BASE_ROW} FROM latest"
        ),
        "explode_tags": _with(
            [FEED, BASE],
            "SELECT created, tweet_id, tweet_txt, unnest(hashtags) AS hashtag, rt_count, user_id, user_name, "
            "year, month, day FROM base",
        ),
        "sentiment_lexicon": _feed(
            f"SELECT event_id, len({_sentences('post_text')}) AS sentences, {_score('post_text')} AS score "
            "FROM feed"
        ),
        "sentiment_model": _with(
            [FEED, BASE, _latest()],
            f"SELECT tweet_id, rt_count, {_score('tweet_txt')} AS sentiment FROM latest",
        ),
        "exploded_posts": _with(
            _ALL[:4], f'SELECT hashtag, rt_count, tweet_id, "sentiment_%", user_name, {_DATES} FROM exploded'
        ),
        "hashtag_agg": _with(_ALL, f"SELECT {_MEASURES} FROM aggregated"),
        "hashtag_names": _with(_ALL[:4], "SELECT DISTINCT hashtag, user_name FROM exploded"),
        "staging_fresh": _with(_ALL, f"SELECT {_MEASURES}, {_NOW} FROM aggregated"),
        "staging_merge": _with(
            [*_HALVES, _DISTINCT_COUNTS, _merged("kept")], f"SELECT {_MEASURES}, {_NOW} FROM merged"
        ),
        "staging_merge_replace": _with(
            _HALVES,
            f"SELECT {_MEASURES}, {_NOW} FROM (SELECT * FROM new UNION ALL "
            "SELECT * FROM old WHERE hashtag NOT IN (SELECT hashtag FROM new))",
        ),
        "staging_merge_nodedup": _with(
            [*_HALVES, _merged("both_days")],
            f"SELECT {_MEASURES}, 15 AS last_update1, 12 AS last_update2 FROM merged",
        ),
        "staging_names": _with(
            [*_HALVES, _DISTINCT_COUNTS, _NAMES],
            "SELECT DISTINCT hashtag, user_name FROM names JOIN kept USING (hashtag, is_new)",
        ),
        "staging_names_replace": _with(
            [*_HALVES, _NAMES],
            "SELECT hashtag, user_name FROM names WHERE is_new OR hashtag NOT IN (SELECT hashtag FROM new)",
        ),
        "published_names": _with(
            _ALL,
            f"SELECT hashtag, user_name, {_day('a.date_recorded')} FROM aggregated a JOIN "
            "(SELECT DISTINCT hashtag, user_name FROM exploded WHERE user_name IS NOT NULL) USING (hashtag)",
        ),
        "union_all": _with(
            _HALVES, f"SELECT hashtag, rt_count, tweet_count, avg_sentiment, {_DATES} FROM both_days"
        ),
        "max_update": _feed(
            "SELECT strftime(max(landed), '%Y-%m-%d %H:%M:%S') AS last_update FROM feed"
        ),
        "status": _feed(
            "SELECT strftime(max(landed), '%Y-%m-%d %H:%M:%S') AS last_update, day(max(landed)) AS last_day, "
            "12 AS hour_now, 15 AS day_now, 'UTC' AS local_zone FROM feed"
        ),
        "updated_today": _feed(
            "SELECT days_back, CAST(CAST(max(landed) AS DATE) = CAST(max(landed) AS DATE) - days_back AS BIGINT) "
            "AS updated FROM feed, (VALUES (0), (1)) AS back(days_back) GROUP BY days_back"
        ),
        "publish": _with(
            _ALL,
            f"SELECT strftime(date_recorded, '%Y%m%d') || '-' || rank AS hashtag_id, {_MEASURES} "
            f"FROM ({_ranked('row_number()', ', hashtag')})",
        ),
        "rank_per_day": _with(
            _ALL,
            "SELECT strftime(date_recorded, '%Y-%m-%d') AS date_recorded, hashtag, rt_count, rank "
            f"FROM ({_ranked('rank()', '')})",
        ),
        "top10_per_day": _with(_ALL, _TOP),
        "top10_direct": _with(_ALL, _TOP),
        "sorted_tags": _with(
            _ALL, "SELECT hashtag, rt_count, tweet_count FROM aggregated ORDER BY rt_count DESC, hashtag"
        ),
        "stream_land": _feed(
            "SELECT 'reposts' AS topic, epoch_us(landed) // 1000 AS time_id, lang, tweet_id, plain_text AS text, "
            f"{_day('landed')} FROM feed"
        ),
        "stream_filter": _feed(f"SELECT event_id FROM feed WHERE {_ACCEPTED}"),
        "stream_collect": _feed(f"SELECT event_id FROM feed WHERE {_ACCEPTED}"),
        "stream_compacted": _feed(_LANDED.format(day=_day("landed"), test=f"NOT ({_BROKEN})")),
        "dead_letters": _feed(
            "SELECT CASE WHEN event_id % 97 = 13 THEN 'malformed' ELSE 'notice' END AS kind, 'reposts' AS topic, "
            f"epoch_us(landed) // 1000 AS time_id, CASE WHEN event_id % 97 = 13 THEN {_text(MALFORMED)} "
            f"ELSE {_text(DELETE_NOTICE)} END AS document, {_day('landed')} FROM feed WHERE {_BROKEN}"
        ),
        "stream_idle_stop": _feed(
            f"SELECT count(*) AS counted, count(*) AS written FROM feed WHERE {_ACCEPTED}"
        ),
        "stream_topics": "SELECT event_type AS topic, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS counted, "
        "CAST(event_type = 'error' AS BIGINT) AS failed, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS landed "
        "FROM events GROUP BY event_type",
        "stream_processing_time": _feed(_LANDED.format(day=_day("landed"), test="true")),
        "job_land_to_base": _with([FEED, BASE], f"SELECT {_BASE_ROW} FROM base"),
        "load_twice": _with([FEED, BASE], f"SELECT {_BASE_ROW} FROM base"),
        "job_same_day": _with(
            [*_HALVES, _DISTINCT_COUNTS, _merged("kept")], f"SELECT {_MEASURES}, {_NOW} FROM merged"
        ),
        "job_same_day_names": _with(
            [*_HALVES, _DISTINCT_COUNTS, _NAMES],
            "SELECT DISTINCT hashtag, user_name FROM names JOIN kept USING (hashtag, is_new)",
        ),
        "job_new_day": _with(
            _HALVES,
            f"SELECT strftime(date_recorded, '%Y%m%d') || '-' || rank AS hashtag_id, {_MEASURES} "
            f"FROM ({_ranked('row_number()', ', hashtag', 'old')})",
        ),
        "job_new_day_staging": _with(_HALVES, f"SELECT {_MEASURES}, {_NOW} FROM new"),
        "job_rerun_after_failure": _with(
            _HALVES,
            f"SELECT hashtag, user_name, {_day('o.date_recorded')} FROM old o JOIN "
            "(SELECT DISTINCT hashtag, user_name FROM exploded_old WHERE user_name IS NOT NULL) USING (hashtag)",
        ),
        "job_rerun_staging": _with(
            _HALVES,
            f"SELECT {_MEASURES}, {_NOW}, names FROM new LEFT JOIN "
            "(SELECT hashtag, count(DISTINCT user_name) AS names FROM exploded_new GROUP BY hashtag) USING (hashtag)",
        ),
        "staging_merge_delta": _with(_ALL, f"SELECT {_MEASURES}, {_NOW} FROM aggregated"),
        "staging_names_delta": _with(_ALL[:4], "SELECT DISTINCT hashtag, user_name FROM exploded"),
        "dedup_incremental": _with(
            [FEED, BASE, _latest()], f"SELECT {_BASE_ROW.replace(' tweet_txt,', '')} FROM latest"
        ),
        "replace_table": _with(
            _ALL, f"SELECT {_MEASURES.replace(', rt_count,', ', rt_count * 2 AS rt_count,')}, {_NOW} FROM aggregated"
        ),
        "truncate": _with(_ALL, 'SELECT count(*) AS "before", 0 AS "left" FROM aggregated'),
        "sql_view": _with(_ALL, _TOP),
        "part_prune_scan": _with(
            [FEED, BASE],
            "SELECT year, month, day, count(*) AS rows, CAST(sum(rt_count) AS BIGINT) AS rt_count FROM base "
            "WHERE landed_on >= DATE '2023-12-20' GROUP BY year, month, day",
        ),
        "orc_roundtrip": _with([FEED, BASE], f"SELECT {_BASE_ROW} FROM base"),
        "load_report": _with(
            [FEED, BASE],
            "SELECT count(*) AS loaded, count(*) FILTER (landed_on >= DATE '2023-12-20') AS again, "
            "count(*) AS kept FROM base",
        ),
    }
