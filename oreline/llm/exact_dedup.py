"""Exact dedup by a heavy-hitter split.

Frequent digests are found by Misra-Gries summaries (``approx_top_k`` keeps the frequent-items
sketch of that family), counted exactly, and the verified winners are broadcast, so that rows of a
hot group are answered where they are read. All other digests meet in an ordinary shuffle, in which
no group is larger than a small share of the rows. A digest that the summaries miss is not lost: it
takes the ordinary way.

Defined results: missing text counts as empty; of rows with equal text the one with the smallest
id stays, a missing id only if the group has no other; of repeated rows (same id, same text) one
stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import keep_one, stored, text_digest

# A digest is heavy from one row in HEAVY_SHARE on, so there are at most HEAVY_SHARE winners.
HEAVY_SHARE = 10_000
# Digests are summarised by hash shard: TRACKED counters and TOP reported items in each shard.
SKETCH_SHARDS = 64
TRACKED = 4_096
TOP = 512


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256, row (unique), stored."""
    return stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            text_digest(F.col(text_col)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def heavy_digests(rows: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """Verified winners of the summaries: text_sha256, group_size, first; at most ``share`` rows."""
    total = rows.count()
    least = max(2, -(-total // share))
    hashed = rows.withColumn("h", F.xxhash64("text_sha256"))
    candidates = (
        hashed.groupBy(F.pmod("h", F.lit(SKETCH_SHARDS)).alias("shard"))
        .agg(F.expr(f"approx_top_k(h, {TOP}, {TRACKED})").alias("top"))
        .select(F.explode("top.item").alias("h"))
    )
    # SKETCH_SHARDS * TOP hashes at most.
    return (
        hashed.join(F.broadcast(candidates), "h", "left_semi")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.min(_order()).alias("first"))
        .where(F.col("group_size") >= least)
    )


def _order():
    """Smallest id first, missing ids last, then any one of the repeated rows."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))


def dedup_rows(rows: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of :func:`digests`."""
    heavy = stored(heavy_digests(rows, share), "heavy-digests")
    winners = F.broadcast(heavy)  # at most ``share`` rows
    answered = rows.join(winners, "text_sha256")
    group = Window.partitionBy("text_sha256")
    shuffled = (
        rows.join(winners, "text_sha256", "left_anti")
        .withColumn("group_size", F.count("*").over(group))
        .withColumn("first", F.min(_order()).over(group))
    )
    return answered.unionByName(shuffled).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return dedup_rows(digests(docs, id_col, text_col))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    rows = digests(docs, id_col, text_col)
    found = stored(dedup_rows(rows), "exact-dedup")
    keepers = found.where("kept").select("doc_id", "text_sha256")
    # Repeated rows share id and text; only in groups of two or more can there be any.
    again = (
        found.where("group_size > 1 and not kept and doc_id <=> keep_id")
        .select("text_sha256", F.lit(2).alias("copies"))
        .distinct()
    )
    keepers = stored(
        keepers.join(again, "text_sha256", "left").select(
            "doc_id", "text_sha256", F.coalesce("copies", F.lit(1)).alias("copies")
        ),
        "exact-keepers",
    )
    return keep_one(docs, keepers, id_col, text_col)
