import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagtide.functions import dates


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("created", "day"),
    [
        ("Wed Nov 27 09:24:39 +0000 2019", dt.date(2019, 11, 27)),
        ("Tue Dec 31 23:59:59 +0000 2019", dt.date(2019, 12, 31)),
        ("Wed Jan 01 00:30:00 +0100 2020", dt.date(2019, 12, 31)),
        ("nonsense", None),
        (None, None),
    ],
)
def test_date_posted(spark, created, day):
    df = spark.createDataFrame([(created,)], "created string")
    assert df.select(dates.date_posted()).first()[0] == day


def test_date_recorded_single_digits(spark):
    df = spark.createDataFrame([(2019, 1, 5)], "year short, month byte, day byte")
    assert df.select(dates.date_recorded()).first()[0] == dt.date(2019, 1, 5)


@pytest.mark.parametrize(
    ("stamp", "local", "shifted"),
    [
        ("2024-01-15 23:30:00", "UTC", dt.datetime(2024, 1, 16, 0, 30)),
        ("2024-07-15 23:30:00", "UTC", dt.datetime(2024, 7, 16, 1, 30)),
        ("2024-07-15 23:30:00", "America/New_York", dt.datetime(2024, 7, 16, 5, 30)),
        ("2024-07-15 23:30:00", None, dt.datetime(2024, 7, 16, 1, 30)),
    ],
)
def test_to_zone(spark, stamp, local, shifted):
    column = dates.to_zone(F.lit(stamp).cast("timestamp"), "Europe/Amsterdam", local)
    assert value(spark, column) == shifted


def test_now_in(spark):
    fixed = dt.datetime(2024, 1, 15, 12, 30)
    assert value(spark, dates.now_in("Europe/Amsterdam", fixed)) == fixed
    assert value(spark, dates.now_in("Europe/Amsterdam")) is not None


def test_since_date():
    assert dates.since_date("UTC", 1, dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)
    assert dates.since_date("UTC", 1, dt.datetime(2024, 1, 1, 0, 5)) == dt.date(2023, 12, 31)
    assert isinstance(dates.since_date("Europe/Amsterdam", 1), dt.date)


@pytest.fixture(scope="module")
def calendar(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-11-28', DATE'2024-01-03')) AS d")
    return days.select("d", *[c.alias(n) for n, c in dates.partition_parts(F.col("d")).items()])


def test_since_calendar(calendar):
    kept = calendar.where(dates.since(dt.date(2023, 11, 30)))
    assert kept.agg(F.min("d"), F.count("d")).first()[:] == (dt.date(2023, 11, 30), 35)


def test_since_componentwise_loses_days_after_month_end(calendar):
    kept = calendar.where(dates.since(dt.date(2023, 11, 30), "componentwise"))
    found = {row.d for row in kept.collect()}
    assert found == {dt.date(2023, 11, 30), dt.date(2023, 12, 30), dt.date(2023, 12, 31)}


def test_since_rejects_unknown_mode():
    with pytest.raises(ValueError):
        dates.since(dt.date(2024, 1, 1), "other")


def test_partition_types(calendar):
    assert [t for _, t in calendar.dtypes] == ["date", "smallint", "tinyint", "tinyint"]


def test_compact_date(spark):
    df = spark.sql("SELECT DATE'2024-01-05' AS date_recorded")
    assert df.select(dates.compact_date()).first()[0] == "20240105"
