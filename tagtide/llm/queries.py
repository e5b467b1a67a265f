"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm import (
    decontamination,
    language,
    licences,
    mixing,
    near_dedup,
    packing,
    page_text,
    prefix_trie,
    quality,
    secrets,
    spelling,
    sql,
    topk,
    tree_search,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_pack_mixture(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, sf, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        special=True,
    )
    return pieces.drop("ids", "source")


def op2_tree_search(spark: SparkSession, sf: str) -> DataFrame:
    return tree_search.search(table(spark, sf, "embeddings"), "vec_id % 20 = 0", 20)


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))


def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.group(table(spark, sf, "documents"))


def op5_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixing.plan(table(spark, sf, "documents"), texts=False)
    return rows.select("doc_id", "size", "source_size", "target", mixing.taken(F.col("draws")).alias("taken"), "draws")


def op6_find_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(table(spark, sf, "documents"), most_repositories=None)


def op7_page_text(spark: SparkSession, sf: str) -> DataFrame:
    return page_text.extracted(table(spark, sf, "pages"))


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), "vec_id % 50 = 0", 5)


def op10_licences(spark: SparkSession, sf: str) -> DataFrame:
    return licences.report(table(spark, sf, "documents"))


def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_pack_mixture": op1_pack_mixture,
        "op2_tree_search": op2_tree_search,
        "op3_language": op3_language,
        "op4_near_dedup": op4_near_dedup,
        "op5_mix_sources": op5_mix_sources,
        "op6_find_secrets": op6_find_secrets,
        "op7_page_text": op7_page_text,
        "op8_quality": op8_quality,
        "op9_exact_topk": op9_exact_topk,
        "op10_licences": op10_licences,
        "op11_decontamination": op11_decontamination,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_spelling_variants": op13_spelling_variants,
    }


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op9_exact_topk": OP9_SQL,
        "op11_decontamination": sql.OP11,
        "op12_prefix_trie": sql.OP12,
        "op13_spelling_variants": sql.OP13,
    }
