import hashlib
import random
import re

import pytest
from conftest import plan_of
from llm.conftest import DOCUMENT, row, words
from pyspark.sql import functions as F

from tagtide.llm import decontamination as D

ITEM = "item_id long, text string"
LOWER = str.maketrans(D.UPPER, D.UPPER.lower())


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(rows, items):
    """Every window at every place."""
    windows = {}
    for item_id, text in items:
        found = split(text)
        size = min(10, len(found))
        if item_id is not None and found:
            for s in range(len(found) - size + 1):
                windows.setdefault(tuple(found[s : s + size]), set()).add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text, *_ in rows:
        found, hit, names = split(text), set(), set()
        for size in sizes:
            for s in range(len(found) - size + 1):
                held = windows.get(tuple(found[s : s + size]))
                if held:
                    hit.update(range(s, s + size))
                    names |= held
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(found), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted(map(tuple, D.report(docs, items, **options).collect()), key=repr)


BOTH = pytest.mark.parametrize("most_bytes", [D.MOST_BYTES, 0], ids=["broadcast", "shuffled"])


@pytest.fixture(scope="module")
def planted():
    """Items of 1 to 40 words; documents with whole items, parts, overlaps and near misses."""
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([40] * 6 + [10, 9, 5, 4, 1, 11, 25])]
    items += [(90, items[0][1]), (91, items[0][1].upper()), (7, items[3][1]), (None, items[4][1]), (92, None), (93, " .. ")]
    rows = []
    for i in range(120):
        text = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            part = split(rng.choice(items)[1])
            cut = rng.randrange(max(1, len(part)))
            part = part[cut : cut + rng.choice([3, 9, 10, 11, 40])]
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = "other"
            at = rng.randint(0, len(text))
            text[at:at] = part
        glue = rng.choice([" ", ", ", "\n", "-"])
        rows.append(row(i, glue.join(w.title() if rng.random() < 0.2 else w for w in text)))
    copied = " ".join(words(rng, 20) + split(items[1][1]) * 2)
    rows += [row(500 + i, copied) for i in range(60)]
    rows += [row(500, copied), row(500, items[2][1]), row(None, items[5][1])]
    return rows, items


@BOTH
def test_planted_items(spark, planted, most_bytes):
    rows, items = planted
    docs = spark.createDataFrame(rows, DOCUMENT).repartition(4)
    got = found(docs, spark.createDataFrame(items, ITEM), most_bytes=most_bytes)
    assert got == brute(rows, items)
    assert 100 < sum(r[-1] for r in got) < len(got)


@BOTH
def test_odd_rows(spark, odd, odd_rows, most_bytes):
    items = [(1, "words HERE"), (2, "copied"), (3, None), (None, "the very same row"), (4, "same row the very same row the very same row the very")]
    frame = spark.createDataFrame(items, ITEM).withColumns({n: F.lit(n) for n in ("size", "words", "k1", "item", "id", "n")})
    assert found(odd, frame, most_bytes=most_bytes) == brute(odd_rows, items)


def test_empty_tables(spark, odd, odd_rows, none):
    nothing = spark.createDataFrame([], ITEM)
    assert found(none, nothing) == []
    assert found(none, spark.createDataFrame([(1, "a b c")], ITEM)) == []
    assert found(odd, nothing) == brute(odd_rows, [])


def test_signs_and_letters(spark):
    rows = [row(1, "Größe-ÄB 12_3 \x00a\x7fb 日本語"), row(2, "größe Äb 12 3 a b 日本語"), row(3, "grÖße äb")]
    items = [(1, "GRößE Äb"), (2, "3;A;b;日本語")]
    assert found(spark.createDataFrame(rows, DOCUMENT), spark.createDataFrame(items, ITEM)) == brute(rows, items)


def test_rarest_token_is_the_prefix(spark):
    """Of a window's shingles the one in fewest places is joined; a window that lacks one is out."""
    common = "one two three four five"
    items = [(1, f"{common} six seven eight nine ten"), (2, f"{common} never seen in any document")]
    docs = spark.createDataFrame([row(i, common) for i in range(20)] + [row(99, items[0][1])], DOCUMENT)
    windows = D.item_windows(spark.createDataFrame(items, ITEM)).withColumn("id", F.col("item").cast("long"))
    tokens = D.window_tokens(windows)
    assert tokens.groupBy("id").count().where("count = 6").count() == 2
    with D.Scratch(spark, "test") as scratch:
        prefix = [tuple(r) for r in D._rarest(docs, tokens, [5], True, scratch).select("id", "k", "offset").collect()]
    assert [(i, k) for i, k, _ in prefix] == [(1, 5)] and prefix[0][2] > 0


def test_clean_keeps_the_others(spark, planted):
    rows, items = planted
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("k1", F.lit("own"))
    kept = D.clean(docs, spark.createDataFrame(items, ITEM))
    assert kept.columns == docs.columns
    good = sorted(r[0] for r in brute(rows, items) if not r[-1])
    assert sorted(r.doc_id for r in kept.collect()) == good


def test_native(spark, odd):
    """No Python in the scans that the work is done in."""
    items = D.item_windows(spark.createDataFrame([(1, "words here")], ITEM)).withColumn("id", F.lit(1))
    prefix = D.window_tokens(items).join(items.withColumnRenamed("words", "window"), "id")
    for small in (True, False):
        assert not re.search("Python|Arrow|Pandas", plan_of(D._hit_words(D._matches(odd, prefix, [2], small))))


def test_words_of_every_sign(spark):
    signs = [chr(i) for i in (*range(1, 0x3000), 0xA7CB, 0xA7DA, 0x10D50, 0x1F600)]
    rows = spark.createDataFrame([(f"A{c}b Q{c}",) for c in signs], "text string")
    lowered = F.translate("text", D.UPPER, D.UPPER.lower())
    known = F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), 0)
    assert rows.where(~known.eqNullSafe(D.words("text"))).count() == 0
    assert "regexp_extract_all" not in plan_of(rows.select(D.words("text")))
