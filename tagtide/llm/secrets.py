"""Secret scan with corpus-wide ownership of every candidate value.

Three fixed kinds of findings always count. Beyond them, bare tokens that look random are
candidates. The hash of every candidate and of every value found is counted over the whole
corpus by distinct owners and their distinct repositories. A value of few owners, or one of
whose repositories nearly all belong to one owner, is somebody's own and looks live, however
often that owner repeats it; any other is a copied example. Live candidates become findings of
the kind ``live``; so does, whoever holds it, the whole of a random-looking token that one of
the fixed kinds covers in part. Every finding carries this judgement and its counts, the
fixed kinds too; candidates that are examples are given beside the findings.

Nulls and odd rows: null text is the empty text, without findings; null owners or
repositories count as one; repeated rows are scanned each, and add no owner; an empty table
gives no rows; further columns are read only if asked for by ``carry``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagtide.llm.columns import Shield, with_length
from tagtide.workspace import stored

# The three base patterns, letters of the first in either case.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so the least length can stand in the pattern
KEYWORD = re.compile("passw|secret|token|api", re.ASCII | re.IGNORECASE)

#: ``bare`` is a candidate that the corpus shows to be a copied example.
KINDS = ("assign", "access", "hex", "live", "bare")
LIVE, BARE = KINDS.index("live"), KINDS.index("bare")
LEAST = 20
#: Maximal runs of base64 and base64url signs; ``TOKEN`` cuts them at assignments and full stops.
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]+(?:\.[A-Za-z0-9+/_-]+)*(?:={1,2}(?![A-Za-z0-9+/_.=-]))?")
PIECE = re.compile(r"[A-Za-z0-9_+-]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: What stands before the data of an inline image or font.
INLINE = ";base64,"
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: The median length of the words that paths and hosts are made of; those of base64 are shorter.
LEAST_WORD = 3
LEAST_BITS = 3.0
#: More distinct owners or repositories than these make a value a copied example.
MOST_OWNERS = 2
MOST_REPOSITORIES = 20
#: Unless one owner has at least so many hundredths of the repositories that hold it.
OWN_PERCENT = 90

FOUND = "array<struct<start:bigint,kind:int,end:bigint,value:bigint>>"
SPANS = "array<struct<start:bigint,kind:int,end:bigint,own:boolean,owners:bigint,repositories:bigint>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the three kinds."""
    found = []
    if KEYWORD.search(text):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def looks_random(value: str) -> bool:
    """Letters and digits mixed, many bits per character, and no UUID, which is a name."""
    if UUID.fullmatch(value) or not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return bits >= LEAST_BITS


def looks_like_path(value: str) -> bool:
    """Words with slashes or dots between them, or one case of letters only."""
    words = sorted(map(len, WORD.findall(value)))
    return not words or words[(len(words) - 1) // 2] >= LEAST_WORD or value.lower() == value or value.upper() == value


def tokens(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, what it is counted by) of random-looking tokens.

    A token with slashes or dots is one credential, counted by its longest piece if that is
    one by itself; of a path or an address the pieces are looked at. The data of inline
    images and fonts hold none.
    """
    for run in RUN.finditer(text):
        if text.endswith(INLINE, 0, run.start()):
            continue
        for m in TOKEN.finditer(text, run.start(), run.end()):
            value = m[0]
            if len(value) < LEAST:
                continue
            if "/" not in value and "." not in value:
                if looks_random(value):
                    yield m.start(), m.end(), value.rstrip("=")
                continue
            address = value.startswith("//") and text[max(0, m.start() - 1) : m.start()] == ":"
            pieces = [(p.start(), p.end(), p[0]) for p in PIECE.finditer(value) if len(p[0]) >= LEAST and looks_random(p[0])]
            if not address and looks_random(value) and not looks_like_path(value):
                yield m.start(), m.end(), max((p[2] for p in pieces), key=len, default=value)
            else:
                yield from ((m.start() + low, m.start() + high, p) for low, high, p in pieces)


def bare_spans(
    text: str, base: list[tuple[int, int, int, str]]
) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Random-looking tokens that touch no base span, and those that hold more than a base value."""
    found, wider, i, reach = [], [], 0, 0
    near: list[tuple[int, int]] = []
    for start, end, value in tokens(text):
        while i < len(base) and base[i][0] < end:
            reach = max(reach, base[i][2])
            near.append((base[i][2] - len(base[i][3]), base[i][2]))
            i += 1
        near = [x for x in near if x[1] > start]
        if reach <= start:
            found.append((start, end, value))
        elif any(x[0] < end and (start < x[0] or x[1] < end) for x in near):
            wider.append((start, end, value))
    return found, wider


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode()) - 2**63


def scan(docs: DataFrame, owner: Column, repository: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    """One pass over the texts: base spans and candidates with the hashes of their values."""
    fields = [
        T.StructField("_row", T.LongType()),
        T.StructField("_found", T._parse_datatype_string(FOUND)),
    ]
    # Positions, not names, so that columns of the table may be called anything.
    narrow = docs.select(
        F.col("text").alias("_text"),
        owner.cast("string").alias("_owner"),
        repository.cast("string").alias("_repository"),
        *[F.col(f"`{c}`") for c in carry],
    )
    kept = narrow.schema.fields[1:]
    kinds = [
        pa.int64(),
        pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.int64())])),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for cut in range(0, batch.num_rows, 1024):
                few = batch.slice(cut, 1024)
                rows: list[list] = [[], []]
                for text in few.column(0).to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    bare, wider = bare_spans(text, base)
                    found = base + [(s, LIVE, e, v) for s, e, v in wider] + [(s, BARE, e, v) for s, e, v in bare]
                    rows[0].append(row)
                    rows[1].append([{"start": s, "kind": k, "end": e, "value": _hash(v)} for s, k, e, v in found])
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [*few.columns[1:], *(pa.array(x, kind) for x, kind in zip(rows, kinds, strict=True))],
                    [f.name for f in kept] + [f.name for f in fields],
                )

    return narrow.mapInArrow(run, T.StructType([*kept, *fields]))


def ownership(scanned: DataFrame) -> DataFrame:
    """value, owners, repositories, most: how many owners hold a value, in how many of their
    repositories, and in how many of one owner's at most; over the whole corpus.

    Rows are first reduced to distinct (value, owner, repository), so a value that a third
    of all documents hold is counted map-side and never meets in one task as such.
    """
    values = scanned.select(
        F.explode(F.array_distinct(F.transform("_found", lambda f: f["value"]))).alias("value"),
        F.coalesce("_owner", F.lit("")).alias("owner"),
        F.coalesce("_repository", F.lit("")).alias("repository"),
    )
    by_owner = values.distinct().groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"), F.max("n").alias("most")
    )


def find(
    docs: DataFrame,
    owner: Column | None = None,
    repository: Column | None = None,
    carry: tuple[str, ...] = ("doc_id",),
    most_owners: int = MOST_OWNERS,
    most_repositories: int | None = MOST_REPOSITORIES,
) -> DataFrame:
    """``carry``, ``spans`` and ``examples`` per document, two arrays of SPANS in order.

    ``spans`` are the findings, ``examples`` the candidates that are none as they are copied.
    With ``most_repositories`` None no number of copies that one owner has makes a value an
    example. ``kind`` is a place in ``KINDS``; positions are in code points, ends exclusive;
    ``own`` tells a value of its owner from a copied one, by ``owners`` and ``repositories``.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.col("doc_id") if repository is None else repository
    scanned = stored(scan(docs, owner, repository, carry), "scanned")
    own = (F.col("owners") <= most_owners) | (100 * F.col("most") >= OWN_PERCENT * F.col("repositories"))
    if most_repositories is not None:
        own &= F.col("repositories") <= most_repositories
    judged = stored(ownership(scanned).select("value", own.alias("own"), "owners", "repositories"), "judged")
    has = F.size("_found") > 0
    each = scanned.where(has).select("_row", F.inline("_found"))
    kind = F.when((F.col("kind") == BARE) & F.col("own"), LIVE).otherwise(F.col("kind"))
    all_ = (
        each.join(judged, "value")
        .groupBy("_row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", kind.alias("kind"), "end", "own", "owners", "repositories"))
            ).alias("_all")
        )
    )
    # Documents without findings and candidates, nearly all, pass by.
    with_ = scanned.where(has).join(all_, "_row")
    without = scanned.where(~has).withColumn("_all", F.array().cast(SPANS))
    both = with_.select(*without.columns).unionAll(without)
    return both.select(
        *[F.col(f"`{c}`") for c in carry],
        F.filter("_all", lambda s: s["kind"] != BARE).alias("spans"),
        F.filter("_all", lambda s: s["kind"] == BARE).alias("examples"),
    )


def told(spans: Column, judged: bool = False) -> Column:
    """kind:start:end, comma-joined; if asked for with own or copied, owners and repositories."""
    names = F.array(*map(F.lit, KINDS))

    def one(s: Column) -> Column:
        said = [F.get(names, s["kind"]), s["start"], s["end"]]
        if judged:
            said += [F.when(s["own"], "own").otherwise("copied"), s["owners"], s["repositories"]]
        return F.concat_ws(":", *[x.cast("string") for x in said])

    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """Counts, digest and list of the findings per document, and what their owners say of them.

    ``n_copied`` are findings of the fixed kinds whose value is a copied example, ``n_examples``
    bare tokens that are; ``judged`` lists findings and examples with judgement and counts.
    """
    found = find(docs, carry=("doc_id",), **options)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"),
        told(spans).alias("spans"),
        count(LIVE).alias("n_live"),
        F.size(F.filter(base, lambda s: ~s["own"])).cast("long").alias("n_copied"),
        F.size("examples").cast("long").alias("n_examples"),
        told(F.array_sort(F.concat(spans, "examples")), judged=True).alias("judged"),
    )


def redact(docs: DataFrame, mask: str = "[REDACTED]", **options) -> DataFrame:
    """``docs`` with every finding replaced; overlapping ones as one. ``n_chars`` follows."""
    shield = Shield(docs, "doc_id", "source", "text")
    found = find(shield.plain, carry=shield.names, **options)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    merged = F.aggregate(
        "spans",
        none,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    text = F.col(shield.of("text"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    clean = F.aggregate(
        merged,
        start,
        lambda done, s: F.struct(
            F.concat(
                done["out"],
                F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")),
                F.lit(mask),
            ).alias("out"),
            s["end"].alias("at"),
        ),
        lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text))),
    )
    has = F.size("spans") > 0
    rows = found.withColumn(shield.of("text"), F.when(has, clean).otherwise(text))
    return shield.back(with_length(rows, shield, has))


def digest(text: str) -> str:
    """The base digest of one text, worked out plainly: for tests and spot checks."""
    said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base_spans(text))
    return hashlib.sha256(said.encode()).hexdigest()
