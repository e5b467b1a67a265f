"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures.

Runs of letters of whole texts are counted as words; a run whose check sum with its
doc_id is divisible by 31 loses one code point first. A word is seen as the binary vector
of its letter multiset: a dimension is a letter with its how-manieth occurrence. One edit
changes at most two dimensions:

* a replaced letter leaves the length and changes two. Dimensions are dealt to four
  parts; two of them at least stay untouched, so every choice of two parts gives one
  signature, and words of one length are joined on them;
* an inserted or deleted letter changes one. Of two halves of the dimensions one stays, so
  each gives a signature, and words are joined with those one letter longer.

Words with the same letters in any other order share signatures as well, which the edit
rules out: it leaves one half of the shorter word as it is. So a signature also holds such
a half, its front or its back. Both are exact: no pair is lost. An edit distance of one is
verified inside the equi-join, so pairs that only share a signature are never written.

A word's near words are bounded by its length and the alphabet. All work is in DataFrame
functions. Runs jobs when called; the result is stored.

Nulls and odd rows: null text has no words; a null doc_id counts as empty text in the
check sum; rows of one doc_id all count; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.workspace import Scratch, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHORTEST, LEAST_COUNT = 7, 2
#: A near word that is so many times as frequent is the form.
TIMES = 10
DROPPED = 31
PARTS = 4
SAME, SHORT, LONG = 0, 1, 2


def words(docs: DataFrame) -> DataFrame:
    """word, n: runs of enough letters, some with a letter less, and how often they occur.

    ``explode_outer`` keeps the optimizer from adding a filter that finds the runs twice.
    """
    lowered = F.translate(F.col("text").cast("string"), UPPER, UPPER.lower())
    found = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{SHORTEST},}}"), 0)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode_outer(found).alias("run"))
    check = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % DROPPED == 0, less).otherwise(F.col("run"))
    return (
        runs.select("run", check.alias("h"))
        .select(word.alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.char_length("word") >= SHORTEST) & (F.col("n") >= LEAST_COUNT))
    )


def _digests(found: DataFrame) -> DataFrame:
    """Adds ``p0`` to ``p3``: an XOR of the hashes of a word's dimensions in each part."""
    letters = F.array_sort(F.filter(F.split("word", ""), lambda c: c != ""))
    dims = F.transform("letters", lambda c, i: F.xxhash64(c, i + 1 - F.array_position(F.col("letters"), c)))
    rows = found.withColumn("letters", letters).withColumn("dims", dims)

    def digest(part: int) -> Column:
        own = F.filter("dims", lambda x: F.pmod(x, F.lit(PARTS)) == part)
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))

    return rows.select("word", "n", *[digest(p).alias(f"p{p}") for p in range(PARTS)])


def _signatures(role: int, length: Column) -> list[Column]:
    """(role, signature) structs of a word that stands with words of ``length``."""
    half = F.floor(length / 2).cast("int")
    sides = [F.left("word", half), F.right("word", (length - half).cast("int"))]
    chosen = list(combinations(range(PARTS), 2)) if role == SAME else [(0, 1), (2, 3)]
    family = "same" if role == SAME else "longer"
    return [
        F.struct(
            F.lit(role).cast("byte").alias("role"),
            F.xxhash64(F.lit(f"{family}{k}{s}"), length, side, *[f"p{p}" for p in parts]).alias("sig"),
        )
        for k, parts in enumerate(chosen)
        for s, side in enumerate(sides)
    ]


def near_pairs(found: DataFrame) -> DataFrame:
    """word, near, near_n: every ordered pair of words one edit apart, each once."""
    length = F.char_length("word")
    marks = _signatures(SAME, length) + _signatures(SHORT, length) + _signatures(LONG, length - 1)
    signed = _digests(found).select("word", "n", F.inline(F.array(*marks)))
    a = signed.where(F.col("role") != LONG).alias("a")
    b = signed.where(F.col("role") != SHORT).alias("b")
    apart = (F.col("a.role") == SHORT) & (F.col("b.role") == LONG)
    apart = apart | (F.col("a.role") == SAME) & (F.col("b.role") == SAME) & (F.col("a.word") < F.col("b.word"))
    one = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    pairs = a.join(b, (F.col("a.sig") == F.col("b.sig")) & apart & one)
    ways = F.array(
        F.struct(F.col("a.word").alias("word"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")),
        F.struct(F.col("b.word").alias("word"), F.col("a.word").alias("near"), F.col("a.n").alias("near_n")),
    )
    return pairs.select(F.inline(ways)).distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root of every word that has a form.

    Each round doubles the steps taken. A form is ten times as frequent as its word, so
    counts of 64 bits allow 18 steps at most.
    """
    steps = scratch.stored(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = steps.join(ahead, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_at").isNotNull().alias("moved")
        )
        steps = scratch.stored(further, "steps")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``."""
    with Scratch(docs.sparkSession, "spelling") as scratch:
        found = scratch.stored(words(docs.select("doc_id", "text")), "words")
        pairs = scratch.stored(near_pairs(found), "pairs")
        best = pairs.groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
        )
        many = -F.col("best.less")
        is_form = many >= TIMES * F.col("n")
        rows = found.join(best, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, many).alias("form_n"),
        )
        rows = scratch.stored(rows, "rows")
        roots = _roots(rows.where("form IS NOT NULL"), scratch)
        whole = rows.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
        )
        return stored(whole, "spelling")
