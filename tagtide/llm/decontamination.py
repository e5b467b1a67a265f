"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ten words in a row of an item, or all words of a shorter one. Its tokens are
the shingles of five words in it, or the window itself if it has fewer. A document holds
a window only if it holds all tokens, so, with the tokens in order of rarity over all
documents, the necessary prefix of a window is its rarest token alone, and a window with
a token that occurs nowhere is out. Tokens of all documents are counted first; then only
the rarest tokens are joined with the positions of the documents. A match has to leave
room for the rest of the window before and after it in the document, and the words there
are compared with the window's. Equal windows of many items are one.

Windows are broadcast if their measured size allows it, so that no document is shuffled
and a common passage is no hot key; beyond ``most_bytes`` the shingles of the documents
are shuffled, and the texts in which a token was found are looked up for the comparison.
Both ways give the same rows. What is found belongs to a text: copies share it, by 128
bits of hash, which is what is aggregated before anything is shuffled.

All work is in DataFrame functions. Runs jobs when called; the result is stored.

Nulls and odd rows: null text has no words and is not contaminated; a null doc_id is a
row like others; every row of a repeated doc_id has its own result; an item without words
has no windows and items with a null item_id take no part; rows of one item_id are one
item; an empty table gives no rows, an empty benchmark no hits; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtide.workspace import Scratch, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Between words of a text whose A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Beyond A-Z, signs that have a lower case, or may have one in a newer Unicode.
UPPER_SIGN = r"[\p{javaUpperCase}\p{javaTitleCase}\p{Cn}&&[^\x00-\x7F]]"
WINDOW, SHINGLE = 10, 5
#: Size of the windows up to which they are broadcast.
MOST_BYTES = 64_000_000
KEY = ["k1", "k2"]


def words(text: str) -> Column:
    """The words of a text in lower-case A-Z.

    ``lower`` is much faster than ``translate`` and the same where no other sign has a
    lower case; splitting at the gaps is faster than finding the words.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lowered = F.when(whole.rlike(UPPER_SIGN), F.translate(whole, UPPER, UPPER.lower())).otherwise(F.lower(whole))
    return F.array_remove(F.split(lowered, GAP), "")


def _key() -> list[Column]:
    """128 bits of hash of a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(F.lit(seed), text).alias(name) for seed, name in enumerate(KEY)]


def _positions(last: Column) -> Column:
    """1 to ``last``, or 1; outer, as the optimizer else adds a filter that finds words twice."""
    return F.explode_outer(F.sequence(F.lit(1), F.greatest(last, F.lit(1))))


def _hash(size: int, start: Column) -> Column:
    """Of ``size`` words from a position that counts from 1."""
    return F.xxhash64(*[F.get("words", start + (i - 1)) for i in range(size)])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item, size, words: every window of every item, once."""
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), words("text").alias("all"))
    length = F.size("all")
    size = F.least(length, F.lit(WINDOW))
    rows = items.where(length > 0).select("item", "all", size.alias("size"), _positions(length - size + 1).alias("start"))
    return rows.select("item", "size", F.slice("all", F.col("start"), F.col("size")).alias("words")).distinct()


def window_tokens(windows: DataFrame) -> DataFrame:
    """id, k, h, offset: the tokens of every window, with their size and their place."""
    k = F.least("size", F.lit(SHINGLE))
    placed = windows.select("*", k.cast("int").alias("k"), _positions(F.col("size") - k + 1).alias("at"))
    hashed = F.coalesce(*[F.when(F.col("k") == size, _hash(size, F.col("at"))) for size in range(1, SHINGLE + 1)])
    return placed.select("id", "k", hashed.alias("h"), (F.col("at") - 1).alias("offset"))


def _shingled(docs: DataFrame, sizes: list[int], *columns: str) -> DataFrame:
    """``columns``, position and k, h for every position and token size of every text."""
    found = docs.select(*_key(), words("text").alias("words"))
    placed = found.select(*KEY, "words", F.size("words").alias("n_words"), _positions(F.size("words")).alias("pos"))
    last = F.col("n_words") - F.col("pos") + 1
    hashes = [
        F.struct(F.lit(size).alias("k"), F.when(last >= size, _hash(size, F.col("pos"))).alias("h")) for size in sizes
    ]
    if len(hashes) == 1:
        return placed.select(*columns, "pos", *[hashes[0][name].alias(name) for name in ("k", "h")])
    return placed.select(*columns, "pos", F.inline(F.array(*hashes)))


def _rarest(docs: DataFrame, tokens: DataFrame, sizes: list[int], small: bool, scratch: Scratch) -> DataFrame:
    """id, k, h, offset: the rarest token of every window all of whose tokens occur."""
    known = scratch.stored(tokens.select("k", "h").distinct(), "known")
    counted = _shingled(docs, sizes).join(F.broadcast(known) if small else known, ["k", "h"])
    counts = scratch.stored(counted.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")), "counts")
    ranked = tokens.join(counts, ["k", "h"], "left").groupBy("id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset", "k")).alias("first")
    )
    return ranked.where("first.n > 0").select("id", "first.k", "first.h", "first.offset")


def _fits(start: Column) -> Column:
    """Length and position: the whole window lies in the document."""
    return (start >= 1) & (start + F.col("size") - 1 <= F.col("n_words"))


def _matches(docs: DataFrame, prefix: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """k1, k2, start, size, id: every place of a text where a window occurs.

    ``prefix``: id, k, h, offset, size, window.
    """
    start = F.col("pos") - F.col("offset")
    out = [*KEY, start.alias("start"), "size", "id"]
    same = (F.col("d.k") == F.col("p.k")) & (F.col("d.h") == F.col("p.h"))
    if small:
        here = _shingled(docs, sizes, *KEY, "words", "n_words").alias("d")
        held = F.slice("words", start, F.col("size")) == F.col("window")
        return here.join(F.broadcast(prefix).alias("p"), same & _fits(start) & held).select(*out)
    here = _shingled(docs, sizes, *KEY, "n_words").alias("d")
    places = here.join(prefix.alias("p"), same & _fits(start)).select(*out, "window").distinct()
    texts = docs.select(*_key(), "text").join(places.select(*KEY).distinct(), KEY, "left_semi")
    texts = texts.dropDuplicates(KEY).select(*KEY, words("text").alias("words"))
    held = F.slice("words", F.col("start"), F.col("size")) == F.col("window")
    return places.join(texts, KEY).where(held).select(*KEY, "start", "size", "id")


def _hit_words(matches: DataFrame) -> DataFrame:
    """n_hit of every text: words in the union of its matches."""
    by_start = Window.partitionBy(*KEY).orderBy("start")
    places = matches.groupBy(*KEY, "start").agg((F.col("start") + F.max("size")).alias("end"))
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("before", F.lit(0))))
    return places.withColumn("before", before).groupBy(*KEY).agg(F.sum(fresh).alias("n_hit"))


def found_items(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """k1, k2, n_hit, items: what every text that holds a window has; items are sorted."""
    with Scratch(docs.sparkSession, "decontamination") as scratch:
        owned = scratch.stored(item_windows(benchmark), "owned")
        windows = owned.select("size", "words").distinct().withColumn("id", F.monotonically_increasing_id())
        windows = scratch.stored(windows, "windows")
        octets = F.octet_length(F.array_join("words", "")) + 16 * F.size("words") + 64
        sized = windows.agg(F.sum(octets).alias("bytes"), F.collect_set(F.least("size", F.lit(SHINGLE))).alias("k")).first()
        small, sizes = (sized["bytes"] or 0) <= most_bytes, sorted(sized["k"]) or [SHINGLE]
        tokens = scratch.stored(window_tokens(windows), "tokens")
        prefix = _rarest(docs, tokens, sizes, small, scratch)
        prefix = scratch.stored(prefix.join(windows.withColumnRenamed("words", "window"), "id"), "prefix")
        matches = scratch.stored(_matches(docs, prefix, sizes, small).distinct(), "matches")
        owners = owned.join(windows, ["size", "words"]).select("id", "item")
        held = matches.select(*KEY, "id").distinct().join(scratch.stored(owners, "owners"), "id")
        items = held.select(*KEY, "item").distinct().groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items"))
        return stored(_hit_words(matches).join(items, KEY), "found")


def report(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of ``docs``."""
    found = found_items(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), most_bytes)
    found = found.select(
        *KEY,
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    rows = docs.select("doc_id", *_key(), F.size(words("text")).cast("long").alias("n_words"))
    return rows.join(found, KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text holds no window, with all their columns."""
    found = found_items(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), most_bytes)
    hit = found.select(*[F.col(name).alias(f"_{name}") for name in KEY]).alias("hit")
    same = [key == F.col(f"hit._{name}") for key, name in zip(_key(), KEY, strict=True)]
    return docs.join(hit, same[0] & same[1], "left_anti")
