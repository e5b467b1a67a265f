"""Mixture-controlled packing of token streams into windows of one length.

Every source is a queue of tokens, its documents one after another. Windows are
filled by deficit round-robin: each window credits every source with its share of
the window, a source is served while its credit lasts, and what it didn't get (or
got too much) is carried on.

Windows are filled in blocks, in parallel. How far each queue has come at the start
of any block follows from the targets alone, so the deficit at the end of a block is
what the next one starts with, and no task has to wait for another.

Nulls and odd rows: null text is the empty text, which is one end token; a null
source is a queue of its own; repeated or null doc_ids are separate documents; an
empty table gives no pieces; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.workspace import stored

WINDOW = 1024
#: Windows that one task fills at a time. At most one window of a block is padded.
BLOCK_WINDOWS = 512
#: Credit that a source saves up before a longer document of it is cut.
MIN_PIECE = 128
END_ID = 0

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, source string, ids binary"
)
#: Where pre-tokenizers can't differ between libraries; other texts go to `tokenizers` itself.
OTHER_SCRIPT = re.compile("[^\u0000-ɏ‐-‧€]|<\\|")


@lru_cache(maxsize=4)
def encoder(json_path: str, ranks_path: str, special: bool = False) -> Callable[[str], list[int]]:
    """Ids of a text as `tokenizers` gives them for the file ``json_path``.

    For texts in Latin script `tiktoken` finds the same ids from the same vocabulary,
    ``ranks_path``, in a fifth of the time. With ``special`` the tokenizer is used as loaded, so a string of
    a special token is that token, else it is ordinary text.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(json_path)
    whole.encode_special_tokens = not special
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    quick = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text: str) -> list[int]:
        if OTHER_SCRIPT.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        return quick.encode_ordinary(text)

    return encode


def tokenized(docs: DataFrame, json_path: str, ranks_path: str, special: bool = False) -> DataFrame:
    """Ids per document, with its place in the part of its source's queue that one task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(json_path, ranks_path, special), TaskContext.get().partitionId()
        ends: dict[str | None, int] = {}
        for batch in batches:
            for cut in range(0, batch.num_rows, 512):
                few = batch.slice(cut, 512)
                sources, starts, counts, ids = few.column(1).to_pylist(), [], [], []
                for source, text in zip(sources, few.column(2).to_pylist(), strict=True):
                    found = np.array([*encode(text or ""), END_ID], dtype="<u2")
                    starts.append(ends.get(source, 0))
                    counts.append(len(found))
                    ends[source] = starts[-1] + len(found)
                    ids.append(found.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column(0),
                        pa.array(sources, pa.string()),
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "part", "local_start", "n", "ids"],
                )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(
        run, "doc_id long, source string, part int, local_start long, n long, ids binary"
    )


class Schedule:
    """How many tokens each queue has given when ``x`` tokens are out, by the targets.

    Queues are drawn on in proportion to their targets; where one runs dry, the others
    share its part. ``targets`` None: the queues' own sizes, so all end together.
    """

    def __init__(self, sizes: list[int], targets: list[float] | None, block: int):
        self.sizes, self.total = sizes, sum(sizes)
        # Every queue's part of a block is rounded down, so a block may have a token more per queue.
        room = block - len(sizes) if block > 4 * len(sizes) else block
        self.blocks = ceil(self.total / room)
        weights = [max(0, round(w * 1_000_000)) for w in targets] if targets else list(sizes)
        if sum(w > 0 for w in weights) == 0:
            weights = list(sizes)
        left, at, given = list(sizes), 0, [0] * len(sizes)
        self.starts, self.phases = [], []
        while any(left):
            live = [w if n else 0 for w, n in zip(weights, left, strict=True)]
            if not any(live):  # only queues without a target are left
                live = [n if n else 0 for n in left]
            share = sum(live)
            # until the first queue is empty
            ends = min((n * share, w) for n, w in zip(left, live, strict=True) if w and n) if share else (0, 1)
            for n, w in zip(left, live, strict=True):
                if w and n and n * share * ends[1] < ends[0] * w:
                    ends = (n * share, w)
            length = ceil(ends[0] / ends[1])
            self.starts.append(at)
            self.phases.append((given, live, share, left))
            took = [min(n, length * w // share) for n, w in zip(left, live, strict=True)]
            given = [g + t for g, t in zip(given, took, strict=True)]
            left = [n - t for n, t in zip(left, took, strict=True)]
            at += max(1, sum(took))

    def given(self, queue: int, block: int) -> int:
        """Tokens of ``queue`` before ``block``."""
        if block >= self.blocks:
            return self.sizes[queue]
        x = self.total * block // self.blocks
        phase = max(0, bisect_right(self.starts, x) - 1)
        given, live, share, left = self.phases[phase]
        return given[queue] + min(left[queue], (x - self.starts[phase]) * live[queue] // share)

    def block_of(self, queue: int, position: int) -> int:
        low, high = 0, self.blocks - 1
        while low < high:
            middle = (low + high + 1) // 2
            if self.given(queue, middle) <= position:
                low = middle
            else:
                high = middle - 1
        return low


def fill(lengths: list[list[int]], window: int, least: int) -> list[tuple[int, int, int, int, int, int]]:
    """Deficit round-robin over the queues of one block.

    ``lengths``: the lengths of the pieces that wait in each queue, in order. Gives
    (queue, index of the piece, start in it, length, window, offset in the window).
    """
    sizes = [sum(x) for x in lengths]
    total, taken, out = sum(sizes), [0] * len(lengths), []
    heads = [[0, 0] for _ in lengths]
    first = 0
    for number in range(ceil(total / window)):
        through = min(total, (number + 1) * window)
        space = through - number * window
        credit = [n * through // total - t for n, t in zip(sizes, taken, strict=True)]
        at = 0

        def serve(queue: int, most: int) -> int:
            nonlocal at
            got = 0
            while got < most and heads[queue][0] < len(lengths[queue]):
                index, start = heads[queue]
                length = min(most - got, lengths[queue][index] - start)
                if length:
                    out.append((queue, index, start, length, number, at))
                at += length
                got += length
                heads[queue] = [index + 1, 0] if start + length == lengths[queue][index] else [index, start + length]
            taken[queue] += got
            return got

        for turn in range(len(lengths)):
            queue = (first + turn) % len(lengths)
            index, start = heads[queue]
            if credit[queue] <= 0 or index >= len(lengths[queue]):
                continue
            if credit[queue] >= least or lengths[queue][index] - start <= credit[queue]:
                space -= (got := serve(queue, min(space, credit[queue])))
                credit[queue] -= got
        while space:  # whose credit is largest, on its next ones if need be
            queue = max((q for q in range(len(lengths)) if taken[q] < sizes[q]), key=lambda q: (credit[q], -q))
            index, start = heads[queue]
            most = max(credit[queue], min(least, lengths[queue][index] - start), 1)
            space -= (got := serve(queue, min(space, most)))
            credit[queue] -= got
        first = (first + 1) % max(1, len(lengths))
    return out


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    targets: dict[str | None, float] | None = None,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    min_piece: int = MIN_PIECE,
    special: bool = False,
) -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens, with their ids.

    ``targets`` gives wanted proportions by source; sources not named come when the
    others have run out. Without it every window gets the proportions of the whole.
    ``special``: whether strings of special tokens are those tokens.
    Columns: those of ``PIECES``; ``ids`` are little-endian unsigned 16-bit numbers.
    """
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, json_path, ranks_path, special), "tokens")
    parts = tokens.groupBy("source", "part").agg(F.sum("n").alias("size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(
        parts.withColumn("queue_start", F.coalesce(F.sum("size").over(earlier), F.lit(0))), "queues"
    )
    # One row per source: the mixture's own description.
    totals = parts.groupBy("source").agg(F.sum("size").alias("size")).collect()
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    names = [r["source"] for r in totals]
    if not names:
        return spark.createDataFrame([], PIECES)
    wanted = [targets.get(name, 0.0) for name in names] if targets else None
    schedule = Schedule([int(r["size"]) for r in totals], wanted, window * block_windows)
    # Windows of a block at most: where queues run dry in it, each may be rounded again.
    stride = block_windows + 1 + len(names) * (len(names) + 2) // window
    number = {name: i for i, name in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents cut where a block ends."""
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for doc_id, source, start, n, ids in zip(*columns, strict=True):
                queue, at = number[source], 0
                block = schedule.block_of(queue, start)
                while at < n:
                    end = min(n, schedule.given(queue, block + 1) - start)
                    if end > at:
                        rows.append((block, queue, start + at, doc_id, at, n, ids[2 * at : 2 * end]))
                        at = end
                    block += 1
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
                ["block", "queue", "at", "doc_id", "doc_start", "doc_tokens", "ids"],
            )

    def fill_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["queue", "at"], kind="stable")
        block = int(rows["block"].iloc[0])
        queues = [g for _, g in rows.groupby("queue", sort=True)]
        columns = [
            (int(g["queue"].iloc[0]), g["doc_id"].tolist(), g["doc_start"].tolist(), g["doc_tokens"].tolist(), g["ids"].tolist())
            for g in queues
        ]
        out = []
        for q, i, start, length, at, offset in fill([[len(x) // 2 for x in c[4]] for c in columns], window, min_piece):
            queue, doc_ids, doc_starts, sizes, ids = columns[q]
            piece = ids[i][2 * start : 2 * (start + length)]
            crc = zlib.crc32(np.frombuffer(piece, "<u2").astype("<u4").tobytes())
            out.append((doc_ids[i], doc_starts[i] + start, length, crc, sizes[i], block * stride + at, offset, names[queue], piece))
        found = pd.DataFrame(out, columns=[x.split()[0] for x in PIECES.split(", ")])
        return found.astype({"doc_id": "Int64"})

    placed = tokens.join(
        parts.select(F.col("source").alias("_source"), F.col("part").alias("_part"), "queue_start"),
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")),
    ).select("doc_id", "source", (F.col("queue_start") + F.col("local_start")).alias("start"), "n", "ids")
    blocks = placed.mapInArrow(
        cut,
        "block long, queue int, at long, doc_id long, doc_start long, doc_tokens long, ids binary",
    )
    return blocks.groupBy("block").applyInPandas(fill_block, PIECES)
