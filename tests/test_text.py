import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tagtide.functions.text import LEADING_URL, NON_WORD, clean_tags, clean_text, flatten_distinct

TEXTS = {
    "plain words": "plain words",
    "https://t.co/abc?x=1 first": " first",
    "ftp://host/file.txt, then": " then",
    "see https://t.co/abc and more\nnext": "see next",
    "HTTPS://t.co/abc stays": "HTTPStcoabc stays",
    "xhttp stays": "xhttp stays",
    "(http://t.co/a) gone": "",
    "café \U0001f389 party!": "caf  party",
    "it's 5:30, ok?": "its 530 ok",
    "two\nlines": "twolines",
    "win\r\nline": "win\rline",
    "vertical\x0btab": "vertical\x0btab",
    "snake_case #tag @name": "snake_case tag name",
    "nbsp here": "nbsphere",
    "": "",
}


@pytest.mark.parametrize(("raw", "clean"), list(TEXTS.items()))
def test_clean_text(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(clean_text(F.col("t"))).first()[0] == clean


def test_clean_text_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(clean_text(F.col("t"))).first()[0] is None


def test_texts_are_cleaned_as_by_the_patterns_without_running_them_per_character(spark):
    parts = ["http://a.b/c?d=é", "ftp://x", "file://", " ", "\n", "\r", "\u0085", "\u2028", "\u00a0", "\x00", "\x1f", "\x0c", "_", "http", "ähttp", "x", "é", "日", "\U0001f389", "."]
    texts = [a + b + c for a in parts for b in parts for c in parts]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    df = df.unionAll(spark.sql("SELECT CAST(X'41FF42C368747470E22E0A43' AS STRING)"))  # no UTF-8
    words = F.regexp_replace(F.regexp_replace("t", LEADING_URL, ""), NON_WORD, "")
    plain = F.regexp_replace(F.regexp_replace(words, r"http(?<!\whttp).*", ""), "\n", "")
    found = df.select(clean_text(F.col("t")).alias("ours"), plain.alias("plain"))
    assert found.where("NOT ours <=> plain").collect() == []
    assert "regexp_replace" not in plan_of(df.select(clean_text(F.col("t"))))


TAGS = [
    (["One", "Two", "One"], ["One", "Two"]),
    (["case", "Case"], ["case", "Case"]),
    (["café", "日本"], ["caf"]),
    (["é", "日本"], []),
    (["a,b", "two words", 'quo"ted', "[x]"], ["a", "b", "twowords", "quoted", "x"]),
    (["\\s", ",", ""], ["s"]),
    ([], []),
    (None, None),
]


@pytest.mark.parametrize(("raw", "clean"), TAGS)
def test_clean_tags(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t array<string>")
    assert df.select(clean_tags(F.col("t"))).first()[0] == clean


def test_flatten_distinct(spark):
    df = spark.createDataFrame([([["b", "a"], ["a", "c"], []],)], "t array<array<string>>")
    assert df.select(flatten_distinct(F.col("t"))).first()[0] == ["a", "b", "c"]
