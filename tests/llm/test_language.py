import random
import zlib

import pytest
from llm.conftest import DOCUMENT, row

from tagtide.llm import language as L

VOCABULARY = {
    "de": "der die und nicht schön über straße haus kind machen werden zwischen".split(),
    "en": "the and not house child make become between street beautiful thing other".split(),
    "fr": "le la et pas maison enfant faire devenir entre rue belle chose être".split(),
}


def text(rng, lang, n):
    return " ".join(rng.choice(VOCABULARY[lang]) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(600):
        lang = "en" if rng.random() < 0.6 else rng.choice(["de", "fr"])
        rows.append((i, text(rng, lang, rng.randint(3, 60)), None if i % 17 == 0 else lang, "s", 0))
    return rows


def test_held_out_accuracy(spark, corpus):
    found = {r.doc_id: r for r in L.identify(spark.createDataFrame(corpus, DOCUMENT).repartition(4)).collect()}
    assert len(found) == len(corpus)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in found.items())
    held = [(found[i].lang_pred, lang) for i, _, lang, *_ in corpus if lang and found[i].held_out]
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.98 * len(held)


def test_held_out_labels_are_not_learnt(spark, corpus):
    """Labels of held-out rows may say anything; predictions stay the same."""
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, "s", 0) for i, t, lang, *_ in corpus]
    both = [
        sorted((r.doc_id, r.lang_pred, r.score) for r in L.identify(spark.createDataFrame(rows, DOCUMENT)).collect())
        for rows in (corpus, wrong)
    ]
    assert both[0] == both[1] and "xx" not in {x for _, x, _ in both[0]}


def test_odd_rows(spark, odd, odd_rows, corpus):
    found = L.identify(odd).collect()
    assert len(found) == len(odd_rows)
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    rows = [*corpus, (9000, "12345 !!! \U0001f389", "en", "s", 0), (9001, "zwischenhaus", None, None, 0)]
    found = {r.doc_id: r for r in L.identify(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert found[9000].lang_pred == "und"
    assert found[9001].lang_pred == "de"  # an unseen word, by its n-grams


def test_without_training_rows(spark, none):
    assert L.identify(none).collect() == []
    rows = [row(1, "some text", lang=None), row(None, "more", lang="en")]
    assert {r.lang_pred for r in L.identify(spark.createDataFrame(rows, DOCUMENT)).collect()} == {"und"}


def test_words_come_first_then_shorter_grams():
    model = L.Model(
        ["a", "b"],
        [(0, "ab", {"a": 9}), (3, "<xy", {"b": 5}), (2, "<x", {"a": 50}), (1, "z", {"a": 3})],
        {(size, lang): 100 for size in range(6) for lang in "ab"},
    )
    assert model.word("ab")[0] > model.word("ab")[1]
    assert model.word("xyq")[1] > model.word("xyq")[0]  # the longest known n-gram decides
    assert model.word("xq")[0] > model.word("xq")[1]
    assert model.word("zz")[0] > model.word("zz")[1]
    assert model.word("qq") == (0.0, 0.0)
    assert model.predict("qq") == ("a", 0.5)


def test_counts_equal_a_plain_count(spark):
    rows = [(1, "Ab ab c", "x", "s", 0), (2, "ab", "y", "s", 0), (3, None, "y", "s", 0)]
    found = {(r.size, r.entry, r.lang): r.n for r in L.counted(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert found[0, "ab", "x"] == 2 and found[0, "ab", "y"] == 1 and found[0, "c", "x"] == 1
    assert found[4, "<ab>", "x"] == 2 and found[2, "<c", "x"] == 1 and found[1, "a", "x"] == 2


def test_signs_are_no_letters(spark):
    assert L.words("²³ ½ ① x²y Ⅻ") == ["x", "y"] and L.words("Größe_1") == ["größe"]
    rows = [(i, "some english words here", "en", "s", 0) for i in range(30)] + [(99, "² ½ ①", None, None, 0)]
    found = {r.doc_id: r for r in L.identify(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert (found[99].lang_pred, found[99].score) == ("und", 0.0)


def test_a_rare_language_keeps_its_entries(spark, monkeypatch):
    """One row in ten thousand: its words stay, though each is rarer than all of the large languages'."""
    monkeypatch.setattr(L, "MOST_ENTRIES", 40)
    large = spark.range(20_000).selectExpr(
        "id AS doc_id",
        "concat_ws(' ', transform(sequence(1, 8), i -> concat('en', char(97 + (id * i) % 26), char(97 + (id + i) % 26)))) AS text",
        "'en' AS lang",
    )
    rare = spark.createDataFrame([(50_001, "kaiku valo", "fi"), (50_003, "valo talvi", "fi")], "doc_id long, text string, lang string")
    model = L.fit(large.unionByName(rare), most_documents=100_000)
    assert model.langs == ["en", "fi"]
    assert {"valo"} <= set(model.tables[0]) and "<valo"[:5] in model.tables[5]
    assert model.predict("valo kaiku")[0] == "fi" and model.predict("talvivalo")[0] == "fi"
    assert all(len(table) <= 80 for table in model.tables)
