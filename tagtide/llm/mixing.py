"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents fall into blocks of about ``block_words`` words by a hash of the
document. Its target says how many whole copies of it and what rest are taken; the rest
is the start of its blocks in a permuted order, the last of them cut to the word. The
drawn blocks are the source's quota. A tree over the output shards splits the quotas of
all sources: each node draws, without replacement, what goes to its left half, so every
shard gets a random share whose sums are exact. A shard walks down from the root on its
own. It gets runs of the sources' permuted blocks that no other shard has, and its
documents are ordered by a hash, which is the local shuffle.

All random choices are hashes of, or generators seeded by, ``seed``, so reruns agree.

Nulls and odd rows: null text has size 0; null is a source of its own, the last one;
rows alike in doc_id and text get the same share, cut down to whole words; with no words
at all nothing is taken; an empty table gives no rows; further columns are kept as they
are in ``mix``; ``plan`` replaces columns named as its outputs and keeps names that begin
with an underscore for itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import cycle
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtide.llm.columns import Shield, with_length
from tagtide.workspace import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 200_000
SHARD_BLOCKS = 8
SEED = 20_240


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words to take per source: ``share`` of all by weight, none above ``most`` times its size."""
    caps = [most * n for n in sizes]
    found, open_, left = [0.0] * len(caps), set(range(len(caps))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        want = {i: left * weights[i] / total for i in open_}
        over = [i for i in sorted(open_) if want[i] >= caps[i]]
        for i in over:
            found[i] = float(caps[i])
            left -= caps[i]
            open_.remove(i)
        if not over:
            for i in open_:
                found[i] = want[i]
            break
    return found


def quota(shard: int, shards: int, quotas: Sequence[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks before this shard's, and this shard's, per source: one walk down the tree."""
    here, before = np.array(quotas, dtype=np.int64), np.zeros(len(quotas), dtype=np.int64)
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        draw = int(here.sum()) * (middle - low) // (high - low)
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(here, draw, method="marginals")
        if shard < middle:
            here, high = left, middle
        else:
            here, before, low = here - left, before + left, middle
    return before, here


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
    texts: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with its place in the mix.

    Without ``texts`` only doc_id and source come along, and texts are read once.

    Adds ``size``, ``source_size``, ``target`` and ``draws``, an array of (copy, shard,
    words): empty if the mix leaves the document out. ``weights`` go to the sources in
    code point order, again and again.
    """
    spark = docs.sparkSession
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = docs.withColumns({"size": words(F.col("text")), "_mark": mark})
    sizes = stored(sized.select("doc_id", "source", "size", "_mark"), "sizes")
    # One row per source: the mixture's own description.
    found = sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    totals = [int(r["n"]) for r in found]
    wanted = targets(totals, [w for w, _ in zip(cycle(weights), totals, strict=False)], share, most)
    whole = [int(t // n) if n else 0 for t, n in zip(wanted, totals, strict=True)]
    rest = [round(t) - k * n if n else 0 for t, k, n in zip(wanted, whole, totals, strict=True)]
    sources = spark.createDataFrame(
        [
            (i, r["source"], n, float(t), k, min(x, n), max(1, ceil(n / block_words)))
            for i, (r, n, t, k, x) in enumerate(zip(found, totals, wanted, whole, rest, strict=True))
        ],
        "_index int, _source string, source_size long, target double, _whole int, _rest long, _blocks long",
    )

    def located(df: DataFrame) -> DataFrame:
        # Broadcast: one row per source, which the driver has just made.
        df = df.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_source")))
        return df.withColumn("_block", F.pmod("_mark", "_blocks"))

    blocks = located(sizes).groupBy("_index", "_block", "_whole", "_rest").agg(F.sum("size").alias("_words"))
    # Each copy has its own order of the blocks; one row per block goes into a window.
    copies = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_whole"))))
    shuffled = Window.partitionBy("_index", "_copy").orderBy(F.xxhash64(F.lit(seed), "_copy", "_block"), "_block")
    copies = copies.withColumns(
        {
            "_rank": F.row_number().over(shuffled).cast("long"),
            "_before": F.sum("_words").over(shuffled) - F.col("_words"),
        }
    )
    last = F.col("_copy") == F.col("_whole")
    drawn = copies.where(~last | (F.col("_before") < F.col("_rest")))
    per_copy = Window.partitionBy("_index").orderBy("_copy").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("_index", "_copy").agg(F.count(F.lit(1)).alias("_count"))
    counts = counts.withColumn("_earlier", F.coalesce(F.sum("_count").over(per_copy), F.lit(0)))
    drawn = drawn.join(counts.drop("_count"), ["_index", "_copy"])
    drawn = drawn.withColumn("_number", F.col("_earlier") + F.col("_rank") - 1)
    drawn = stored(drawn.select("_index", "_block", "_copy", "_number", "_before", "_words", last.alias("_last"), "_rest"), "drawn")

    by_source = {r["_index"]: r["n"] for r in drawn.groupBy("_index").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas = [by_source.get(i, 0) for i in range(len(totals))]
    shards = max(1, ceil(sum(quotas) / shard_blocks))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                before, here = quota(int(shard), shards, quotas, seed)
                numbers = [np.arange(b, b + n) for b, n in zip(before, here, strict=True)]
                yield pd.DataFrame(
                    {
                        "_index": np.repeat(np.arange(len(here)), here).astype("int32"),
                        "_number": np.concatenate([*numbers, np.zeros(0, dtype=np.int64)]).astype("int64"),
                        "shard": np.full(int(here.sum()), shard, dtype="int64"),
                    }
                )

    homes = spark.range(shards).mapInPandas(walk, "_index int, _number long, shard long")
    placed = drawn.join(homes, ["_index", "_number"])

    # The one block per source that is cut: its documents in order of their hash.
    cut = F.col("_last") & (F.col("_before") + F.col("_words") > F.col("_rest"))
    edges = placed.where(cut).select("_index", "_block", (F.col("_rest") - F.col("_before")).alias("_room"))
    alike = (
        located(sizes)
        .join(F.broadcast(edges), ["_index", "_block"])  # one row per source at most
        .groupBy("_index", "_block", "_mark", "_room")
        .agg(F.count(F.lit(1)).alias("_alike"), F.max("size").alias("_each"))
    )
    in_block = Window.partitionBy("_index", "_block").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.col("_alike") * F.col("_each")).over(in_block), F.lit(0))
    room = F.greatest(F.lit(0), F.col("_room") - used)
    part = F.least(F.col("_each"), F.floor(room / F.col("_alike")))
    edge = stored(alike.select("_index", "_block", "_mark", part.cast("long").alias("_part")), "edge")

    draws = placed.groupBy("_index", "_block").agg(
        F.array_sort(F.collect_list(F.struct("_copy", "shard", cut.alias("_cut")))).alias("_draws")
    )
    if not texts:
        docs, sized = docs.select("doc_id", "source"), sizes
    rows = located(sized).join(stored(draws, "draws"), ["_index", "_block"], "left")
    rows = rows.join(edge, ["_index", "_block", "_mark"], "left")
    size, share_ = F.col("size"), F.coalesce(F.col("_part"), F.lit(0))
    taken = F.transform(
        F.coalesce(F.col("_draws"), F.array().cast("array<struct<_copy:int,shard:bigint,_cut:boolean>>")),
        lambda d: F.struct(
            d["_copy"].alias("copy"),
            d["shard"].alias("shard"),
            F.when(d["_cut"], share_).otherwise(size).alias("words"),
        ),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "source_size", "target", "draws")]
    return rows.select(*kept, "size", "source_size", "target", F.filter(taken, lambda d: d["words"] > 0).alias("draws"))


def taken(draws: Column) -> Column:
    """Words that the mix takes of a document, repeats counted."""
    return F.aggregate(draws, F.lit(0).cast("long"), lambda total, d: total + d["words"])


def mix(docs: DataFrame, more: tuple[str, ...] = ("copy", "shard"), **options) -> DataFrame:
    """The mix itself: a row per copy, shuffled within its shard, with the columns of ``docs`` and ``more``.

    Texts taken in part end after their last word taken. ``n_chars``, if there, follows.
    """
    shield = Shield(docs, "doc_id", "source", "text")
    rows = plan(shield.plain, **options).withColumn("_draw", F.explode("draws"))
    spans = F.regexp_extract_all(F.col("text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    head = F.array_join(F.slice(spans, F.lit(1), F.col("_draw.words").cast("int")), "")
    cut = F.col("_draw.words") < F.col("size")
    order = F.xxhash64(F.lit(options.get("seed", SEED)), F.col("_draw.copy"), F.col("doc_id"), F.col("text"))
    text = shield.of("text")
    rows = rows.withColumn(text, F.when(cut, head).otherwise(F.col("text")))
    rows = with_length(rows, shield, cut).withColumns(
        {"copy": F.col("_draw.copy"), "shard": F.col("_draw.shard"), "_order": order}
    )
    rows = rows.select(*shield.names, "copy", "shard", "_order")
    return shield.back(rows.repartition("shard").sortWithinPartitions("shard", "_order"), *more)
