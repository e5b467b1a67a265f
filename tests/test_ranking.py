import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagtide.operators import ranking as R
from tagtide.schemas import AGGREGATED

DAYS = [dt.date(2019, 11, 28), dt.date(2019, 11, 29), None]


def rows(seed=3, n=2000):
    """Most rows fall on one day; a third of all rows share one count."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        day = DAYS[0] if rng.random() < 0.7 else rng.choice(DAYS)
        count = 5 if rng.random() < 1 / 3 else rng.randrange(300)
        made.append((f"t{i:04d}", count, day))
    return made


def by_day(made):
    days = defaultdict(list)
    for tag, count, day in made:
        days[day].append((-count, tag))
    return {day: sorted(found) for day, found in days.items()}


@pytest.fixture(scope="module")
def frame(spark):
    made = spark.createDataFrame(rows(), "hashtag string, rt_count long, date_recorded date")
    return made.repartition(8)


def test_number_rows(frame):
    found = {(r.date_recorded, r.hashtag): r.rank for r in R.number_rows(frame).collect()}
    expected = {
        (day, tag): place
        for day, found in by_day(rows()).items()
        for place, (_, tag) in enumerate(found, 1)
    }
    assert found == expected


def test_ranks_when_a_count_fills_many_ranges(spark):
    """Counts that begin and end within ranges, and one that spans several."""
    made = [(f"t{i:05d}", 9 if i < 50 else 5 if i < 1900 else i % 4, DAYS[i % 2]) for i in range(2000)]
    spread = spark.createDataFrame(made, "hashtag string, rt_count long, date_recorded date").repartition(8)
    found = {(r.date_recorded, r.hashtag): r.rank for r in R.rank_rows(spread).collect()}
    assert found == ranks(made)


def ranks(made):
    return {
        (day, tag): 1 + sum(other < count for other, _ in found)
        for day, found in by_day(made).items()
        for count, tag in found
    }


def test_rank_rows(frame):
    found = {(r.date_recorded, r.hashtag): r.rank for r in R.rank_rows(frame).collect()}
    assert found == ranks(rows())


@pytest.mark.parametrize("n", [1, 10, 400])
def test_top_n_keeps_ties(frame, n):
    found = {(r.date_recorded, r.hashtag): r.rank for r in R.top_n_per_day(frame, n).collect()}
    assert found == {key: rank for key, rank in ranks(rows()).items() if rank <= n}


def test_more_than_ten_tied_at_the_cut(spark):
    made = [(f"t{i}", 100 - i, DAYS[0]) for i in range(9)] + [(f"x{i}", 7, DAYS[0]) for i in range(30)]
    made += [("low", 6, DAYS[0])]
    frame = spark.createDataFrame(made, "hashtag string, rt_count long, date_recorded date")
    top = R.top_n_per_day(frame).collect()
    assert len(top) == 39 and {r.rank for r in top} == set(range(1, 11))


def test_all_rows_tied(spark):
    frame = spark.range(5000).select(
        F.col("id").cast("string").alias("hashtag"),
        F.lit(7).cast("long").alias("rt_count"),
        F.lit(DAYS[0]).alias("date_recorded"),
    )
    top = R.top_n_per_day(frame)
    assert top.count() == 5000 and top.select("rank").distinct().count() == 1


def test_publish(spark):
    names = ["b", "a", "c"]
    made = [
        (names[i], [5, 5, 9][i], 1, 50.0, DAYS[0], DAYS[0], 2019, 11, 28) for i in range(3)
    ] + [("d", 1, 1, 50.0, DAYS[1], DAYS[1], 2019, 11, 29)]
    found = R.publish(spark.createDataFrame(made, AGGREGATED))
    assert {r.hashtag: r.hashtag_id for r in found.collect()} == {
        "c": "20191128-1",
        "a": "20191128-2",
        "b": "20191128-3",
        "d": "20191129-1",
    }


def test_published_top_ten_is_part_of_the_published_rows(frame):
    numbered = {(r.date_recorded, r.hashtag) for r in R.number_rows(frame).collect()}
    top = {(r.date_recorded, r.hashtag) for r in R.top_n_per_day(frame).collect()}
    assert top < numbered


def test_sorted_by_count(frame):
    found = [(-r.rt_count, r.hashtag) for r in R.sorted_by_count(frame).collect()]
    assert found == sorted(found)
