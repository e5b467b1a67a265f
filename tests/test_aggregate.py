import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tagtide.operators import aggregate as A
from tagtide.schemas import AGGREGATED, EXPLODED, NAMES, STAGING

DAY = dt.date(2019, 11, 28)
NOW = dt.datetime(2019, 11, 28, 15, 45)


def exploded_rows(seed=1, rows=3000):
    """Hashtag H0 holds a third of all rows, user u0 a third of those."""
    rng = random.Random(seed)
    made = []
    for i in range(rows):
        tag = 0 if rng.random() < 1 / 3 else rng.randrange(1, 60)
        user = 0 if rng.random() < 1 / 3 else rng.randrange(1, 200)
        recorded = DAY - dt.timedelta(days=rng.randrange(40))
        made.append(
            (
                f"H{tag}",
                rng.randrange(1000),
                str(i),
                25.0 * rng.randrange(5),
                f"u{user}",
                recorded - dt.timedelta(days=rng.randrange(3)),
                recorded,
                recorded.year,
                recorded.month,
                recorded.day,
            )
        )
    return made


def half_up(total, count):
    return float((Decimal(total) / count).quantize(Decimal("0.01"), ROUND_HALF_UP))


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = {}
    for tag, found in groups.items():
        last = max(r[6] for r in found)
        out[tag] = (
            tag,
            sum(r[1] for r in found),
            len(found),
            half_up(sum(int(r[3]) for r in found), len(found)),
            min(r[5] for r in found),
            last,
            last.year,
            last.month,
            last.day,
        )
    return out


@pytest.fixture(scope="module")
def exploded(spark):
    return spark.createDataFrame(exploded_rows(), EXPLODED)


def test_aggregate_equals_brute_force(exploded):
    found = A.aggregate_hashtags(exploded)
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in AGGREGATED]
    assert {r.hashtag: tuple(r) for r in found.collect()} == brute_force(exploded_rows())


def test_names_and_totals_come_from_one_stored_table(exploded):
    pairs = A.name_measures(exploded)
    whole = sorted(map(tuple, A.aggregate_hashtags(exploded).collect()))
    assert sorted(map(tuple, A.aggregate_names(pairs).collect())) == whole
    names = sorted({(r[0], r[4]) for r in exploded_rows()})
    assert sorted(map(tuple, A.names_of(pairs).collect())) == names
    assert sorted(map(tuple, A.hashtag_names(exploded).collect())) == names


def test_case_matters(spark):
    rows = [(t, *exploded_rows(rows=1)[0][1:]) for t in ("Tag", "tag")]
    assert A.aggregate_hashtags(spark.createDataFrame(rows, EXPLODED)).count() == 2


def test_no_sentiment_gives_null(spark):
    row = list(exploded_rows(rows=1)[0])
    row[3] = None
    found = A.aggregate_hashtags(spark.createDataFrame([tuple(row)], EXPLODED)).first()
    assert found.avg_sentiment is None and found.tweet_count == 1


def staged(spark, *rows, stamped=False):
    """Rows of (hashtag, rt_count, tweet_count, avg_sentiment, recorded)."""
    made = []
    for tag, count, tweets, mean, day in rows:
        row = [tag, count, tweets, mean, day - dt.timedelta(days=1), day]
        row += [dt.datetime(2019, 11, 28, 9)] if stamped else []
        made.append((*row, day.year, day.month, day.day))
    return spark.createDataFrame(made, STAGING if stamped else AGGREGATED)


def names(spark, **tags):
    return spark.createDataFrame([(t, n) for t, found in tags.items() for n in found], NAMES)


NEXT = DAY + dt.timedelta(days=3)


def test_merge_adds_up_unequal_counts_and_drops_equal_ones(spark):
    """Names go with the row that is dropped, however many they are."""
    old = staged(
        spark, ("same", 10, 2, 25.0, DAY), ("grown", 10, 2, 25.0, DAY), ("old", 1, 1, 50.0, DAY), stamped=True
    )
    new = staged(spark, ("same", 10, 3, 75.0, NEXT), ("grown", 15, 3, 25.01, NEXT), ("new", 4, 1, 0.0, NEXT))
    found = A.merge_staging(new, old, now=NOW)
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in STAGING]
    rows = {r.hashtag: r for r in found.collect()}
    before = DAY - dt.timedelta(days=1)
    assert rows["same"][1:7] == (10, 3, 75.0, NEXT - dt.timedelta(days=1), NEXT, NOW)
    assert rows["grown"][1:] == (25, 5, 25.01, before, NEXT, NOW, 2019, 12, 1)
    assert rows["old"][1:7] == (1, 1, 50.0, before, DAY, NOW)
    assert rows["new"][1:7] == (4, 1, 0.0, NEXT - dt.timedelta(days=1), NEXT, NOW)

    old_names = names(spark, same="a", grown="ab", old="c")
    new_names = names(spark, same="de", grown="bc", new="e")

    def merged(mode, **options):
        kept = A.merge_names(new_names, old_names, A.paired(new, old), mode, **options).collect()
        return {t: "".join(sorted(r.user_name for r in kept if r.hashtag == t)) for t in rows}

    assert merged("reference") == {"same": "de", "grown": "abc", "old": "c", "new": "e"}
    assert merged("reference", dedup_counts=False) == {"same": "ade", "grown": "abc", "old": "c", "new": "e"}
    assert merged("replace") == {"same": "de", "grown": "bc", "old": "c", "new": "e"}


def test_of_equal_counts_the_one_recorded_last_stays(spark):
    old = staged(spark, ("tag", 10, 2, 25.0, NEXT), stamped=True)
    new = staged(spark, ("tag", 10, 9, 75.0, DAY))
    assert A.merge_staging(new, old, now=NOW).first()[1:4] == (10, 2, 25.0)
    kept = A.merge_names(names(spark, tag="new"), names(spark, tag="old"), A.paired(new, old))
    assert sorted(r.user_name for r in kept.collect()) == sorted("old")


def test_merge_into_empty_staging(spark):
    new = staged(spark, ("new", 4, 1, 33.33, DAY))
    old = staged(spark, stamped=True)
    assert A.merge_staging(new, old, now=NOW).drop("last_update").collect() == new.collect()


def test_merge_again_counts_again_but_replace_does_not(spark):
    old = staged(spark, ("tag", 10, 2, 25.0, DAY), stamped=True)
    new = staged(spark, ("tag", 15, 3, 50.0, DAY))
    once = A.merge_staging(new, old, now=NOW)
    assert once.first()[1:4] == (25, 5, 37.5)
    assert A.merge_staging(new, once, now=NOW).first()[1] == 40
    replaced = A.merge_staging(new, old, now=NOW, mode="replace")
    assert replaced.first()[1:4] == (15, 3, 50.0)
    assert A.merge_staging(new, replaced, now=NOW, mode="replace").collect() == replaced.collect()


def test_merge_without_dedup_stamps_day_and_hour(spark):
    old = staged(spark, ("tag", 10, 2, 25.0, DAY), stamped=True)
    new = staged(spark, ("tag", 10, 2, 25.0, DAY))
    found = A.merge_staging(new, old, now=NOW, dedup_counts=False, stamp="day_hour")
    assert found.columns[-5:] == ["last_update1", "last_update2", "year", "month", "day"]
    row = found.first()
    assert (row.rt_count, row.tweet_count, row.last_update1, row.last_update2) == (20, 4, 28, 15)


def test_missing_means_leave_the_other(spark):
    old = staged(spark, ("tag", 10, 2, None, DAY), stamped=True)
    new = staged(spark, ("tag", 11, 2, 25.0, DAY))
    assert A.merge_staging(new, old, now=NOW).first()[1:4] == (21, 4, 25.0)


def test_merge_rejects_unknown_mode(spark):
    new = staged(spark, ("tag", 1, 1, 0.0, DAY))
    with pytest.raises(ValueError):
        A.merge_staging(new, new, mode="other")


def test_fresh_staging(spark):
    new = staged(spark, ("tag", 1, 1, 0.0, DAY))
    assert [r.last_update for r in A.fresh_staging(new, now=NOW).collect()] == [NOW]


def test_published_names_have_the_partition_of_their_row(spark):
    rows = staged(spark, ("tag", 1, 1, 0.0, DAY), stamped=True)
    found = A.published_names(names(spark, tag="ab", other="c"), rows).collect()
    assert sorted(map(tuple, found)) == [("tag", n, 2019, 11, 28) for n in "ab"]


def test_last_update(spark):
    old = staged(spark, ("tag", 1, 1, 0.0, DAY), stamped=True)
    assert A.last_update(old).first()[0] == dt.datetime(2019, 11, 28, 9)
    assert A.last_update(old.where(F.lit(False))).first()[0] is None
