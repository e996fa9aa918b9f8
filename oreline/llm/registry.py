"""Registered queries of this subpackage: name to ``(spark, sf_dir) -> DataFrame``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm.alignment import alignment
from oreline.llm.chat import mask_text, perspectives
from oreline.llm.common import documents
from oreline.llm.decontamination import contamination
from oreline.llm.exact_dedup import exact_dedup
from oreline.llm.licenses import license_scan
from oreline.llm.mixing import mix
from oreline.llm.packing import pack_documents
from oreline.llm.records import round_trip
from oreline.llm.repair import repaired_conversations
from oreline.llm.simhash import near_dedup
from oreline.llm.substring_dedup import substring_dedup
from oreline.llm.token_counts import token_counts
from oreline.llm.toxicity import score_documents

Query = Callable[[SparkSession, str], DataFrame]



def _perspectives(spark: SparkSession, d: str) -> DataFrame:
    turns = spark.read.parquet(f"{d}/conversations.parquet")
    return perspectives(turns).withColumn("mask", mask_text(F.col("mask")))


def _licenses(spark: SparkSession, d: str) -> DataFrame:
    found = license_scan(documents(spark, d))
    return found.select(
        "doc_id",
        F.size("identifiers").alias("n_sentences"),
        F.array_join("identifiers", ",").alias("identifiers"),
        F.array_join("licences", ",").alias("licences"),
    )


_QUERIES: dict[str, Query] = {
    "op1_exact_dedup": lambda spark, d: exact_dedup(documents(spark, d)),
    "op2_chat_perspectives": _perspectives,
    "op3_token_counts": lambda spark, d: token_counts(documents(spark, d)),
    "op4_substring_dedup": lambda spark, d: substring_dedup(documents(spark, d)).drop("kept_text"),
    "op5_token_records": lambda spark, d: round_trip(spark, documents(spark, d)),
    "op6_decontamination": lambda spark, d: contamination(
        documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")
    ),
    "op7_license_scan": _licenses,
    "op8_toxicity": lambda spark, d: score_documents(
        documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    ),
    "op9_simhash_near_dedup": lambda spark, d: near_dedup(documents(spark, d)),
    "op10_best_fit_packing": lambda spark, d: pack_documents(documents(spark, d)),
    "op11_conversation_repair": lambda spark, d: repaired_conversations(
        spark.read.parquet(f"{d}/conversations.parquet")
    ),
    "op12_cross_tokenizer_alignment": lambda spark, d: alignment(documents(spark, d)),
    "op13_source_mixing": lambda spark, d: mix(documents(spark, d)),
}

_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH t AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM t""",
    "op2_chat_perspectives": r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations
),
t AS (
  SELECT conv_id, role,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
         regexp_replace(
           regexp_replace(role, '<(\\*\|)', '<\\\1', 'g'), '(\|\\*)>', '\1\\>', 'g') AS name,
         regexp_replace(text, '<(\\*\|)', '<\\\1', 'g') AS text
  FROM given
),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (
  SELECT t.conv_id, speaker, place, place // 256 AS segment,
         CASE WHEN role = speaker THEN '<|assistant|>' || chr(10)
              WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user name=' || name || '|>' || chr(10) END AS header,
         text || '<|end|>' || chr(10) AS body,
         CASE WHEN role = speaker THEN '1:' ELSE '0:' END AS own
  FROM t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
)
SELECT conv_id, speaker, segment, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(header || body, '' ORDER BY place) AS text,
       string_agg('0:' || length(header) || ',' || own || length(body), ',' ORDER BY place) AS mask
FROM r GROUP BY conv_id, speaker, segment""",
}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
