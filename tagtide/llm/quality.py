"""Quality classifier: random Fourier features of document statistics, ridge, isotonic scale.

Every whole text becomes a row of statistics. Random Fourier features of the standardised
statistics stand for a Gaussian kernel. Each partition of the training rows sums its part
of the normal equations, which a ridge solution adds up. The raw scores are made
probabilities by isotonic regression on training rows that the ridge fit didn't see,
counted in bins.

Training rows are labelled rows that aren't held out, at most about ``MOST_ROWS`` of
them, picked by a hash. Scores depend on the text alone.

Nulls and odd rows: null text is the empty text and gets a score; rows with null labels or
ids don't train; repeated rows train and are scored each; without training rows, or with
one label only, every score is the share of label 1, or 0.5; an empty table gives no rows;
further columns are not read unless asked for by ``carry``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagtide.llm.columns import Shield
from tagtide.llm.folds import hashed_share, held_out
from tagtide.workspace import stored

MOST_ROWS = 100_000
FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
THRESHOLD = 0.3
TRAIN_TASKS = 16
BINS = 2_000
SEED = 88

STATISTICS = (
    "log_words log_chars word_length distinct_words top_word same_twice distinct_lines line_length"
    " upper digits symbols pipes exclamations stops other_bytes ends_marked short_words"
).split()
_UPPER, _DIGITS = slice(65, 91), slice(48, 58)
_SYMBOLS = [ord(c) for c in "#$%&*@^~<>=+\\{}[]_`/"]
_STOPS = [ord(c) for c in ".,;:?"]


def statistics(text: str) -> list[float]:
    """Shape of a whole text: lengths, repetition, and shares of kinds of characters."""
    data = text.encode("utf-8", "surrogatepass")
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(data)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    each = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return [
        float(np.log1p(n)),
        float(np.log1p(size)),
        min(30.0, len(text) / n),
        len(counts) / n,
        max(counts.values()) / n if n > 1 else 0.0,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
        float(each[_UPPER].sum()) / size,
        float(each[_DIGITS].sum()) / size,
        float(each[_SYMBOLS].sum()) / size,
        float(each[ord("|")]) / size,
        float(each[ord("!")]) / size,
        float(each[_STOPS].sum()) / size,
        float(each[128:].sum()) / size,
        sum(w[-1] in ".,;:?!" for w in words) / n,
        sum(len(w) <= 3 for w in words) / n,
    ]


def described(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """``carry`` and the statistics of every text, in one pass."""
    narrow = docs.select(F.col("text").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in carry])
    schema = T.StructType([*narrow.schema.fields[1:], T.StructField("_stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1024):
                few = batch.slice(cut, 1024)
                found = [statistics(text or "") for text in few.column(0).to_pylist()]
                columns = [*few.columns[1:], pa.array(found, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return narrow.mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    probability: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        angles = ((stats - self.mean) / self.scale).clip(-6, 6) @ self.frequencies + self.phases
        waves = np.sqrt(2.0 / len(self.phases)) * np.cos(angles)
        return np.concatenate([waves, np.ones((len(stats), 1))], axis=1)

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(stats), self.raw, self.probability).clip(0.0, 1.0)


def isotonic(raw: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools neighbours whose means fall; gives the pools' places and their rising means."""
    pools: list[list[float]] = []
    for x, w, m in zip(raw, weight, mean, strict=True):
        pools.append([x * w, w, m * w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    at = np.array(pools)
    return at[:, 0] / at[:, 1], at[:, 2] / at[:, 1]


def fit(stats: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, features: int = FEATURES) -> Model:
    """``stats``: doc_id and _stats; ``labels``: doc_id and quality."""
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL AND NOT held").select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("y")
    )
    rows = marked.where(hashed_share(most_rows, marked.count(), "_id"))
    rows = stats.select("doc_id", "_stats").join(rows, F.col("doc_id") == F.col("_id"))
    rows = stored(rows.select("doc_id", "_stats", "y"), "train")
    generator = np.random.default_rng(SEED)
    size = len(STATISTICS)
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("ones"),
        F.array(*[F.avg(F.col("_stats")[i]) for i in range(size)]).alias("mean"),
        F.array(*[F.stddev_pop(F.col("_stats")[i]) for i in range(size)]).alias("scale"),
    ).first()
    model = Model(
        np.array(found["mean"] if found["n"] else [0.0] * size, dtype=float),
        np.maximum(np.array(found["scale"] if found["n"] else [1.0] * size, dtype=float), 1e-6),
        generator.normal(size=(size, features)) / WIDTH,
        generator.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        np.array([0.0]),
        np.array([found["ones"] / found["n"] if found["n"] else 0.5]),
    )
    if not found["n"] or found["ones"] in (0, found["n"]):
        return model
    own = F.pmod(F.xxhash64(F.lit("scale"), "doc_id"), F.lit(5)) == 0

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for frame in frames:
            if len(frame):
                z = model.features(np.array(frame["_stats"].tolist()))
                a += z.T @ z
                b += z.T @ frame["y"].to_numpy()
        yield pd.DataFrame({"a": [a.tobytes()], "b": [b.tobytes()]})

    # TRAIN_TASKS matrices, whatever the size of the table
    parts = rows.where(~own).repartition(TRAIN_TASKS).mapInPandas(sums, "a binary, b binary").collect()
    a = sum(np.frombuffer(p["a"]).reshape(features + 1, features + 1) for p in parts)
    b = sum(np.frombuffer(p["b"]) for p in parts)
    model.weights = np.linalg.solve(a + RIDGE * max(1.0, a[-1, -1]) * np.eye(features + 1) / features, b)

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                raw = model.ridge(np.array(frame["_stats"].tolist())).clip(-0.5, 1.5)
                yield pd.DataFrame({"bin": np.floor((raw + 0.5) * (BINS / 2)).astype("int64"), "y": frame["y"]})

    bins = rows.where(own).mapInPandas(scored, "bin long, y double").groupBy("bin")
    bins = bins.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")).orderBy("bin").collect()
    if bins:
        raw = np.array([r["bin"] + 0.5 for r in bins]) / (BINS / 2) - 0.5
        model.raw, model.probability = isotonic(raw, np.array([r["n"] for r in bins]), np.array([r["mean"] for r in bins]))
    else:
        model.raw, model.probability = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def scored(docs: DataFrame, model: Model, carry: tuple[str, ...], threshold: float = THRESHOLD) -> DataFrame:
    """``carry``, held_out, score and predicted for every row of ``docs``.

    ``docs`` has a text, or the statistics ``_stats`` already.
    """
    known = "_stats" in docs.columns
    source = F.col("_stats") if known else F.col("text").cast("string")
    rows = docs.select(source.alias("_source"), held_out().alias("_held"), *[F.col(f"`{c}`") for c in carry])
    schema = T.StructType(
        [
            *rows.schema.fields[2:],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1024):
                few = batch.slice(cut, 1024)
                found = few.column(0).to_pylist()
                stats = np.array(found if known else [statistics(text or "") for text in found])
                score = model.score(stats.reshape(len(found), len(STATISTICS)))
                made = [few.column(1), pa.array(score), pa.array((score >= threshold).astype("int32"))]
                yield pa.RecordBatch.from_arrays([*few.columns[2:], *made], [f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def trained(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """The statistics of all ``docs``, stored without their texts, and the model."""
    stats = stored(described(docs, ("doc_id",)), "statistics")
    return stats, fit(stats, labels.select("doc_id", "quality", held_out().alias("held")))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats, model = trained(docs, labels)
    return scored(stats, model, ("doc_id",))


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that aren't rejected, all columns as they were.

    Texts are read again rather than stored with their statistics.
    """
    _, model = trained(docs, labels)
    shield = Shield(docs, "doc_id", "text")
    return shield.back(scored(shield.plain, model, shield.names, threshold).where("predicted = 1"))
