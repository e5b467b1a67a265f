import pytest
from pyspark.sql import functions as F

from tagtide.functions import sentiment as S


def score(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(S.lexicon_score(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("nothing to report", 2),
        ("a good day", 3),
        ("good great happy love", 4),
        ("BAD news", 1),
        ("bad sad awful", 0),
        ("good and bad", 2),
        ("good good bad", 3),
        ("", 2),
        ("  \n ", 2),
        ("...!?", 2),
        # 3, 2, 2 and 4, 2, 2: whole-number means of 7/3 and 8/3
        ("Good. One. Two.", 2),
        ("Good great. One. Two!", 2),
        ("Good. Great.", 3),
        ("goods badly", 2),
        (None, 2),
    ],
)
def test_lexicon_score(spark, text, found):
    assert score(spark, text) == found


def test_words_are_on_one_side_only():
    assert not set(S.POSITIVE) & set(S.NEGATIVE)
    assert len(set(S.POSITIVE + S.NEGATIVE)) == len(S.POSITIVE + S.NEGATIVE)


def test_sentences(spark):
    df = spark.createDataFrame([("One. Two!! Three?\n four",)], "t string")
    assert df.select(S.sentences(F.col("t"))).first()[0] == ["One", " Two", " Three", "\n four"]


def test_percent(spark):
    rows = spark.createDataFrame([(n,) for n in range(5)], "n int").select(S.percent(F.col("n")))
    assert [row[0] for row in rows.collect()] == [0.0, 25.0, 50.0, 75.0, 100.0]


def test_model_is_loaded_per_task_and_scores_sentences(spark):
    def load():
        calls = []

        def model(sentences):
            calls.append(len(sentences))
            return [min(4, len(s.split())) for s in sentences]

        return model

    df = spark.createDataFrame([("a b c. d",), ("",), ("x y z w v. k l m n",)], "t string")
    rows = df.select("t", S.model_score(load)(F.col("t")).alias("s")).collect()
    assert {row.t: row.s for row in rows} == {"a b c. d": 2, "": 2, "x y z w v. k l m n": 4}


def test_model_is_called_once_per_batch(spark):
    """Every sentence gets the number of sentences in its call; all rows share one."""

    def load():
        return lambda sentences: [min(4, len(sentences) // 10)] * len(sentences)

    texts = [(i, ". ".join(["a"] * (i % 4)) if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(texts, "i int, t string").coalesce(1)
    rows = {r.i: r.s for r in df.select("i", S.model_score(load)(F.col("t")).alias("s")).collect()}
    assert {rows[i] for i, t in texts if t} == {4}
    assert {rows[i] for i, t in texts if not t} == {2}
