"""Language identification by words first, then by ever shorter character n-grams.

A known word adds its log frequency in every language. An unknown word falls back on its
longest known character n-grams, five letters with the word's ends marked, then four, down
to one. The sums over all words of a text are compared.

Training texts are documents with a language that aren't held out, at most about
``MOST_DOCUMENTS`` of each language, picked by a hash; of this bounded sample the model
keeps each language's ``MOST_ENTRIES`` most frequent words, and as many n-grams of each
length, so a rare language keeps its own beside large ones. The model grows with the number
of languages, which are listed on the driver. A prediction depends on the text alone, and
a letter is what Unicode has as one: signs such as ² and ½ are none.

Nulls and odd rows: null text, or text without a letter, is ``und`` with score 0; rows with
a null language or id don't train; repeated rows train and are predicted each; without
training rows everything is ``und``; ties go to the language first in code point order; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.llm.folds import held_out
from tagtide.workspace import stored

MOST_DOCUMENTS = 5_000
MOST_ENTRIES = 10_000
LONGEST = 5
SMOOTHING = 0.5
#: Words of whose evidence a score may be certain; sums of longer texts are scaled to it.
CERTAIN_WORDS = 25
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
CACHE = 200_000


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    found = []
    for run in WORD.findall((text or "").lower()):
        if run.isalpha():
            found.append(run)
        else:  # number signs count as word characters to the pattern
            found += "".join(c if c.isalpha() else " " for c in run).split()
    return found


def grams(word: str, size: int) -> list[str]:
    marked = f"<{word}>" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def counted(docs: DataFrame) -> DataFrame:
    """(size, entry, lang, n): counts of words (size 0) and n-grams, summed map-side first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                each.setdefault(lang, Counter()).update(words(text))
            rows = Counter()
            for lang, found in each.items():
                for word, n in found.items():
                    rows[0, word, lang] += n
                    for size in range(1, LONGEST + 1):
                        for gram in grams(word, size):
                            rows[size, gram, lang] += n
            keys = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[0], pa.int32()),
                    pa.array(keys[1], pa.string()),
                    pa.array(keys[2], pa.string()),
                    pa.array(list(rows.values()), pa.int64()),
                ],
                ["size", "entry", "lang", "n"],
            )

    found = docs.select("lang", "text").mapInArrow(run, "size int, entry string, lang string, n long")
    return found.groupBy("size", "entry", "lang").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies per language of known words and n-grams."""

    def __init__(self, langs: list[str], rows: list[tuple[int, str, dict[str, int]]], totals: dict[tuple[int, str], int]):
        self.langs, self.tables = langs, [dict() for _ in range(LONGEST + 1)]
        vocabulary = Counter(size for size, *_ in rows)
        for size, entry, counts in rows:
            self.tables[size][entry] = tuple(
                float(np.log((counts.get(lang, 0) + SMOOTHING) / (totals.get((size, lang), 0) + SMOOTHING * vocabulary[size])))
                for lang in langs
            )
        self.cache: dict[str, tuple[float, ...]] = {}

    def word(self, word: str) -> tuple[float, ...]:
        """What a word says for every language."""
        found = self.tables[0].get(word) or self.cache.get(word)
        if found is None:
            found = (0.0,) * len(self.langs)
            for size in range(LONGEST, 0, -1):
                table = self.tables[size]
                known = [table[g] for g in grams(word, size) if g in table]
                if known:
                    found = tuple(sum(x) / len(known) for x in zip(*known, strict=True))
                    break
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        found = Counter(words(text))
        if not found or not self.langs:
            return UNKNOWN, 0.0
        sums = [0.0] * len(self.langs)
        for word, n in found.items():
            for i, x in enumerate(self.word(word)):
                sums[i] += n * x
        total = sum(found.values())
        scale = min(1.0, CERTAIN_WORDS / total)
        best = max(range(len(sums)), key=lambda i: (sums[i], -i))
        odds = [np.exp(scale * (x - sums[best])) for x in sums]
        return self.langs[best], float(1.0 / sum(odds))


def fit(docs: DataFrame, most_documents: int = MOST_DOCUMENTS) -> Model:
    train = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    train = train.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id")
    each = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(each)
    if not langs:
        return Model([], [], {})
    spot, limit = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)), F.lit(0)
    for lang in langs:
        limit = F.when(F.col("lang") == lang, F.lit((1_000_000 * most_documents) // max(each[lang], most_documents))).otherwise(limit)
    counts = stored(counted(train.where(spot < limit)), "language-counts")
    totals = {(r["size"], r["lang"]): r["n"] for r in counts.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    best = Window.partitionBy("size", "lang").orderBy(F.desc("n"), "entry")
    kept = counts.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= MOST_ENTRIES)
    entries = counts.join(kept.select("size", "entry").distinct(), ["size", "entry"]).groupBy("size", "entry").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    rows = [(r["size"], r["entry"], r["by"]) for r in entries.collect()]
    return Model(langs, sorted(rows, key=lambda r: r[:2]), totals)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs``."""
    model = fit(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1024):
                few = batch.slice(cut, 1024)
                found = [shared.value.predict(text) for text in few.column(2).to_pylist()]
                columns = [*few.columns[:2], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
