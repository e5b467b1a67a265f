import datetime as dt
from dataclasses import replace

import pytest
from posts import post
from pyspark.sql import functions as F

from tagtide import catalog
from tagtide.config import Settings, TableSettings
from tagtide.operators.base import to_base
from tagtide.plans import jobs
from tagtide.schemas import ANALYTIC, BASE, NAMES, STAGING
from tagtide.sinks import tables as sink
from tagtide.sources import feeds

ZONE = "UTC"
FIRST = dt.datetime(2019, 12, 31, 12)
SECOND = dt.datetime(2020, 1, 1, 9)


@pytest.fixture
def settings(spark, tmp_path):
    def named(name, value):
        if name.endswith(("_path", "_checkpoint")):
            return str(tmp_path / name)
        if name.endswith(("_table", "_view")):
            return f"d{abs(hash(str(tmp_path)))}.{name}"
        return value

    defaults = TableSettings()
    values = {name: named(name, value) for name, value in vars(defaults).items()}
    tables = replace(defaults, **{**values, "time_zone": ZONE})
    catalog.create_all(spark, tables)
    yield Settings(tables=tables)
    spark.sql(f"DROP DATABASE {tables.base_table.split('.')[0]} CASCADE")


def land(spark, settings, at, *documents):
    rows = spark.createDataFrame([(d,) for d in documents], "value string")
    records = feeds.as_records(rows, "reposts", F.lit(at.isoformat(" ")).cast("timestamp"))
    return sink.append_path(feeds.to_landing(records, F.col("timestamp")), settings.tables.landing_path)


def empty_base(spark, tables):
    """Clear the base table, which the jobs themselves only append to."""
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    spark.createDataFrame([], BASE).write.insertInto(tables.base_table, overwrite=True)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def posts_of(day):
    return [
        post(tweet_id="1", plain=["Sea", "Sky"], count=100 + day, user="ann", text="good sea"),
        post(tweet_id="1", plain=["Sea", "Sky"], count=90, user="ann", text="good sea"),
        post(tweet_id="2", plain=["Sea"], count=50 + day, user="bob", text="bad sea"),
        post(tweet_id="3", plain=["Sky"], extended=[], count=50, user="cat"),
    ]


def test_land_to_base_reads_since_the_day_before(spark, settings):
    for days in (3, 1, 0):
        at = SECOND - dt.timedelta(days=days)
        assert land(spark, settings, at, *posts_of(days)) == 4
    assert jobs.land_to_base(spark, settings, SECOND) == 6
    base = spark.table(settings.tables.base_table)
    assert base.dtypes == [(f.name, f.dataType.simpleString()) for f in BASE]
    assert {(r.year, r.month, r.day) for r in base.collect()} == {(2019, 12, 31), (2020, 1, 1)}


def test_land_to_base_componentwise_misses_the_new_year(spark, settings):
    for days in (1, 0):
        land(spark, settings, SECOND - dt.timedelta(days=days), *posts_of(days))
    assert jobs.land_to_base(spark, settings, SECOND, "componentwise") == 3


def test_two_days(spark, settings):
    tables = settings.tables
    land(spark, settings, FIRST, *posts_of(0))
    jobs.land_to_base(spark, settings, FIRST)
    first = jobs.base_to_analytic(spark, settings, FIRST)
    assert first == {"staged": 2, "new": 2, "published": 0}
    staging = {r.hashtag: r for r in spark.table(tables.staging_table).collect()}
    assert staging["Sea"][1:4] == (150, 2, 50.0)
    assert staging["Sky"][1:4] == (100, 1, 75.0)
    names = sorted(map(tuple, spark.table(tables.staging_names_table).collect()))
    assert names == [("Sea", "ann"), ("Sea", "bob"), ("Sky", "ann")]
    assert {r.last_update for r in staging.values()} == {FIRST}

    # Same day again, one more tag: equal rows are not added up.
    land(spark, settings, FIRST, post(tweet_id="9", plain=["New"], count=7, user="dan"))
    empty_base(spark, tables)
    jobs.land_to_base(spark, settings, FIRST)
    again = jobs.base_to_analytic(spark, settings, FIRST + dt.timedelta(hours=1))
    assert again == {"staged": 3, "new": 1, "published": 0}
    counts = {r.hashtag: r.rt_count for r in spark.table(tables.staging_table).collect()}
    assert counts == {"Sea": 150, "Sky": 100, "New": 7}

    # A new day publishes what was staged, then starts over.
    land(spark, settings, SECOND, *posts_of(1))
    empty_base(spark, tables)
    jobs.land_to_base(spark, settings, SECOND)
    rolled = jobs.base_to_analytic(spark, settings, SECOND)
    assert rolled == {"staged": 3, "new": 3, "published": 3}
    published = spark.table(tables.analytic_table)
    assert published.dtypes == [(f.name, f.dataType.simpleString()) for f in ANALYTIC]
    ids = {r.hashtag: r.hashtag_id for r in published.collect()}
    assert ids == {"Sea": "20191231-1", "Sky": "20191231-2", "New": "20191231-3"}
    staged = spark.table(tables.staging_table)
    assert staged.dtypes == [(f.name, f.dataType.simpleString()) for f in STAGING]
    assert {r.hashtag: r.rt_count for r in staged.collect()} == {"Sea": 152, "Sky": 101, "New": 7}
    assert {r.last_update for r in staged.collect()} == {SECOND}

    catalog.create_top_view(spark, tables.analytic_table, tables.analytic_view)
    catalog.register_top_view(spark, tables.analytic_table, "top_now")
    for view in (tables.analytic_view, "top_now"):
        rows = spark.table(view)
        assert rows.columns == ["date_recorded", "rank", "hashtag", "rt_count", "avg_sentiment", "date_posted"]
        assert [(r.rank, r.hashtag) for r in rows.orderBy("rank").collect()] == [(1, "Sea"), (2, "Sky"), (3, "New")]


def test_replace_mode_may_run_again(spark, settings):
    land(spark, settings, FIRST, *posts_of(0))
    jobs.land_to_base(spark, settings, FIRST)
    seen = []
    for hour in range(3):
        now = FIRST + dt.timedelta(hours=hour)
        jobs.base_to_analytic(spark, settings, now, merge_mode="replace")
        rows = spark.table(settings.tables.staging_table).drop("last_update").orderBy("hashtag")
        seen.append(rows.collect())
    assert seen[0] == seen[1] == seen[2]


def test_names_follow_through_all_tables(spark, settings):
    """Staging, merge and publishing keep every name."""
    tables = settings.tables

    def run(now, *users):
        documents = [
            post(tweet_id=f"{u}", plain=["Hot"], count=10 + i, user=u) for i, u in enumerate(users)
        ]
        documents.append(post(tweet_id="c", plain=["Cold"], count=5, user="zed"))
        empty_base(spark, tables)
        land(spark, settings, now, *documents)
        jobs.land_to_base(spark, settings, now)
        jobs.base_to_analytic(spark, settings, now)

    def names(table, tag="Hot"):
        return sorted(r.user_name for r in spark.table(table).where(f"hashtag = '{tag}'").collect())

    run(FIRST, "a")
    assert names(tables.staging_names_table) == ["a"]
    run(FIRST + dt.timedelta(hours=1), "b", "c")
    assert names(tables.staging_names_table) == ["a", "b", "c"]
    run(FIRST + dt.timedelta(hours=2), "d")
    assert names(tables.staging_names_table) == ["a", "b", "c", "d"]
    run(SECOND + dt.timedelta(days=4), "e")
    assert names(tables.analytic_names_table) == ["a", "b", "c", "d"]
    assert names(tables.analytic_names_table, "Cold") == ["zed"]
    assert names(tables.staging_names_table) == ["e"]


def test_names_in_replace_mode(spark, settings):
    """A replaced hashtag has the names of its new row only; others keep theirs."""
    tables = settings.tables
    for hour, (tag, users) in enumerate([("Hot", "ab"), ("Old", "xy"), ("Hot", "cd")]):
        now = FIRST + dt.timedelta(hours=hour)
        documents = [post(tweet_id=f"{tag}{u}", plain=[tag], user=u) for u in users]
        base = spark.createDataFrame([(d,) for d in documents], "value string")
        records = feeds.as_records(base, "reposts", F.lit(now.isoformat(" ")).cast("timestamp"))
        empty_base(spark, tables)
        rows = to_base(feeds.to_landing(records, F.col("timestamp")))
        sink.append_table(rows, tables.base_table, tables.base_path)
        jobs.base_to_analytic(spark, settings, now, merge_mode="replace")
    found = sorted(map(tuple, spark.table(tables.staging_names_table).collect()))
    assert found == [("Hot", "c"), ("Hot", "d"), ("Old", "x"), ("Old", "y")]


def test_load_in_replace_mode_may_run_again(spark, settings):
    land(spark, settings, FIRST, *posts_of(0))
    seen = []
    for _ in range(2):
        assert jobs.land_to_base(spark, settings, FIRST, load="replace") == 3
        seen.append(sorted(map(str, spark.table(settings.tables.base_table).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 3
    with pytest.raises(ValueError):
        jobs.land_to_base(spark, settings, FIRST, load="other")


def test_publishing_again_adds_nothing(spark, settings, monkeypatch):
    """A run that fails between publishing and the new staging may be done again."""
    tables = settings.tables
    land(spark, settings, FIRST, *posts_of(0))
    jobs.land_to_base(spark, settings, FIRST)
    jobs.base_to_analytic(spark, settings, FIRST)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(sink, "replace_table", lost)
        with pytest.raises(RuntimeError):
            jobs.base_to_analytic(spark, settings, SECOND)
    assert spark.table(tables.analytic_table).count() == 2
    assert jobs.base_to_analytic(spark, settings, SECOND)["published"] == 0
    assert spark.table(tables.analytic_table).count() == 2


def test_only_two_versions_stay(spark, settings, tmp_path):
    tables = settings.tables
    for n in range(4):
        rows = spark.table(tables.staging_names_table).unionAll(spark.createDataFrame([("t", str(n))], NAMES))
        assert sink.replace_table(rows, tables.staging_names_table, tables.staging_names_path) == n + 1
    assert len(list((tmp_path / "staging_names_path").glob("v-*"))) == 2


def test_failed_replacement_changes_nothing(spark, settings):
    tables = settings.tables
    land(spark, settings, FIRST, *posts_of(0))
    jobs.land_to_base(spark, settings, FIRST)
    jobs.base_to_analytic(spark, settings, FIRST)
    staging = spark.table(tables.staging_table)
    before = sorted(map(str, staging.collect()))
    broken = staging.withColumn("rt_count", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        sink.replace_table(broken, tables.staging_table, tables.staging_path)
    assert sorted(map(str, spark.table(tables.staging_table).collect())) == before


def test_truncate_and_self_overwrite(spark, settings):
    tables = settings.tables
    land(spark, settings, FIRST, *posts_of(0))
    jobs.land_to_base(spark, settings, FIRST)
    jobs.base_to_analytic(spark, settings, FIRST)
    doubled = spark.table(tables.staging_table).withColumn("rt_count", F.col("rt_count") * 2)
    assert sink.replace_table(doubled, tables.staging_table, tables.staging_path) == 2
    assert spark.table(tables.staging_table).agg(F.sum("rt_count")).first()[0] == 500
    sink.truncate_table(spark, tables.staging_table, tables.staging_path)
    assert spark.table(tables.staging_table).count() == 0
    assert spark.table(tables.staging_table).columns == STAGING.names


def test_updated_today(spark):
    def staging(*stamps):
        return spark.createDataFrame([(s,) for s in stamps], "last_update timestamp")

    assert jobs.updated_today(staging(), ZONE, FIRST)
    assert jobs.updated_today(staging(FIRST), ZONE, FIRST + dt.timedelta(hours=3))
    assert not jobs.updated_today(staging(FIRST), ZONE, SECOND)
    # The same day of another month is another day.
    assert not jobs.updated_today(staging(dt.datetime(2019, 11, 30)), ZONE, dt.datetime(2019, 12, 30))


@pytest.mark.parametrize("zone", ["Europe/Amsterdam", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("hour", [(0, 30), (12, 0), (23, 30)])
def test_the_gate_keeps_to_the_session_zone(spark, zone, hour):
    """The times are local to the zone; the machine's own zone has no say."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = dt.datetime(2024, 1, 15, *hour)
        staging = spark.sql(f"SELECT TIMESTAMP '{now}' AS last_update")
        assert jobs.updated_today(staging, zone, now)
        assert not jobs.updated_today(staging, zone, now - dt.timedelta(days=1))
        assert not jobs.updated_today(staging, zone, now + dt.timedelta(days=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_staging_status(spark):
    staging = spark.createDataFrame([(FIRST,), (None,)], "last_update timestamp")
    row = jobs.staging_status(staging, ZONE, SECOND).first()
    assert row[:4] == (FIRST, 31, 9, 1) and row.local_zone == "UTC"


def test_overwrite_partitions_touches_only_its_own(spark, tmp_path):
    path = str(tmp_path / "base")
    rows = spark.range(10).selectExpr(
        "id", "CAST(2019 AS SHORT) AS year", "CAST(12 AS BYTE) AS month", "CAST(id % 2 AS BYTE) AS day"
    )
    assert sink.append_path(rows, path) == 10
    assert sink.overwrite_partitions(rows.where("day = 1"), path) == 5
    assert spark.read.orc(path).count() == 10


def test_preview(spark, capsys):
    sink.preview(spark.range(2))
    assert "id" in capsys.readouterr().out


def test_command_line_jobs(spark, settings, tmp_path, capsys):
    """Feed folder to top ten through the commands."""
    from tagtide.__main__ import arguments, run

    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "posts.json").write_text("\n".join(posts_of(0)) + "\n")
    settings = settings.override(
        {
            "spark": {"poll_seconds": 1, "batch_seconds": 1, "idle_batches": 2},
            "kafka": {"stop_marker": str(tmp_path / "marker")},
            "feed": {"posts_to_collect": 2, "min_reposts": 80},
        }
    )
    today = dt.datetime.now(dt.UTC).replace(tzinfo=None)

    def job(*argv):
        run(spark, settings, arguments(list(argv)))
        return capsys.readouterr().out

    job("create-tables")
    out, checkpoint = str(tmp_path / "accepted"), str(tmp_path / "cp")
    assert "2 posts collected" in job("ingest", "--feed", str(feed), "--out", out, "--checkpoint", checkpoint)
    assert "4 posts landed" in job("land", "--feed", str(feed))
    catalog.add_partitions(spark, settings.tables.landing_table)
    assert spark.table(settings.tables.landing_table).count() == 4
    assert "3 posts" in job("land-to-base", "--now", today.isoformat())
    assert "'staged': 2" in job("base-to-analytic", "--now", today.isoformat(), "--merge", "replace")
    assert str(today.day) in job("status", "--now", today.isoformat())
    later = (today + dt.timedelta(days=9)).isoformat()
    assert "'published': 2" in job("base-to-analytic", "--now", later)
    assert "Sea" in job("top")
