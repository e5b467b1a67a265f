"""A trained classifier of sentences into the five sentiment classes.

Multinomial logistic regression over word counts, by Spark's own solver: each partition
sums its gradients and a tree of tasks adds them up, so the sentences stay where they are.
An L1 share makes the weights sparse. Equal word lists with one class are one weighted
row, so a sentence that a third of all posts hold is no more work than another.

The driver holds the vocabulary (``most_words`` at most) and its weights, five numbers a
word; both are stored as a table and reach the tasks as one broadcast of that bounded size.

Nulls and odd rows: rows with a null sentence or a class that is none of the five are left
out of training; a table without any gives a model that says neutral; a sentence without
known words gets the class that the intercepts prefer; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.functions import sentiment
from tagtide.workspace import Scratch

CLASSES = sentiment.TOP_CLASS + 1
WORD = re.compile(r"[a-z0-9_]+")
#: Bytes of UTF-8 to those of the words of ``WORD``, apart by blanks.
_APART = bytes(c if WORD.fullmatch(chr(c)) else 32 for c in range(256))
#: Words of the model, the most frequent first, and in how many different rows one has to be.
MOST_WORDS, LEAST_ROWS = 50_000, 2
REGULAR, L1_SHARE, ROUNDS = 1e-4, 0.5, 100


@dataclass
class SentenceModel:
    weights: dict[str, np.ndarray]
    bias: np.ndarray

    def classify(self, sentences: list[str]) -> list[int]:
        # a look-up a word, and one sum of rows a sentence
        places = {word.encode(): i for i, word in enumerate(self.weights)}
        rows = np.array(list(self.weights.values())).reshape(-1, CLASSES)
        found = []
        for sentence in sentences:
            words = sentence.lower().encode(errors="replace").translate(_APART).split()
            known = [places[word] for word in words if word in places]
            total = self.bias + rows[known].sum(axis=0) if known else self.bias
            found.append(int(total.argmax()))
        return found

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a word; the intercepts stand under a null word."""
        rows = [(None, self.bias.tolist()), *((word, w.tolist()) for word, w in self.weights.items())]
        spark.createDataFrame(rows, "word string, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SentenceModel:
        rows = {row["word"]: np.array(row["weights"]) for row in spark.read.parquet(path).collect()}
        bias = rows.pop(None)
        return SentenceModel(rows, bias)


def neutral() -> SentenceModel:
    return SentenceModel({}, np.eye(CLASSES)[sentiment.NEUTRAL])


def words(sentence: Column) -> Column:
    return F.filter(F.split(F.lower(sentence), r"\W+"), lambda word: word != "")


def training_rows(sentences: DataFrame, sentence: str, label: str) -> DataFrame:
    """words, label, n: different word lists with a class and how often they occur."""
    given = sentences.select(words(F.col(sentence)).alias("words"), F.col(label).cast("int").alias("label"))
    whole = given.where(F.col("words").isNotNull() & F.col("label").between(0, sentiment.TOP_CLASS))
    return whole.groupBy("words", "label").agg(F.count(F.lit(1)).alias("n"))


def _vocabulary(rows: DataFrame, most_words: int) -> list[str]:
    counts = rows.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.where(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "word").limit(most_words)
    return [row["word"] for row in frequent.collect()]


def train(
    sentences: DataFrame, sentence: str = "sentence", label: str = "label", most_words: int = MOST_WORDS
) -> SentenceModel:
    """Fits the model on all ``sentences``; classes weigh the same, whatever their numbers."""
    spark = sentences.sparkSession
    with Scratch(spark, "sentence-model") as scratch:
        rows = scratch.stored(training_rows(sentences, sentence, label), "rows")
        totals = {row["label"]: row["n"] for row in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        vocabulary = _vocabulary(rows, most_words)
        if not totals:
            return neutral()
        if len(totals) == 1 or not vocabulary:
            # one class only, or nothing to tell them by: the most frequent one
            most = min(totals, key=lambda c: (-totals[c], c))
            return SentenceModel({}, np.eye(CLASSES)[most])
        share = F.coalesce(*[F.when(F.col("label") == c, F.lit(sum(totals.values()) / len(totals) / n)) for c, n in totals.items()])
        counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="words", outputCol="features")
        ready = counted.transform(rows).select(
            "features", F.col("label").cast("double").alias("label"), (F.col("n") * share).alias("weight")
        )
        solver = LogisticRegression(
            family="multinomial",
            weightCol="weight",
            regParam=REGULAR,
            elasticNetParam=L1_SHARE,
            maxIter=ROUNDS,
            standardization=False,
        )
        fitted = solver.fit(ready)
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = np.zeros((CLASSES, len(vocabulary)))
    weights[: len(matrix)] = matrix
    # A class without examples is never said.
    bias = np.full(CLASSES, -np.inf)
    for c in totals:
        bias[c] = intercepts[c]
    used = np.flatnonzero(np.abs(weights).sum(axis=0))
    return SentenceModel({vocabulary[i]: weights[:, i].copy() for i in used}, bias)


def scorer(spark: SparkSession, model: SentenceModel) -> Callable[[Column], Column]:
    """A scorer of texts for ``explode.score_posts`` and the jobs: run it after deduplication."""
    shared = spark.sparkContext.broadcast(model)
    return sentiment.model_score(lambda: shared.value.classify)
