"""Helpers shared by the operators: stored intermediates and keeping one row of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.session import scratch_path

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# ASCII white space, the only characters that part words here.
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage with files that outlive any executor. The shuffle files behind it are freed
    as soon as it is written, so a long chain of steps holds one step's shuffle at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        # zstd keeps its buffers on the heap; those of snappy pile up outside it over many files.
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def released(df: DataFrame) -> None:
    """Delete a :func:`stored` table that no later step reads."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have."""
    while wish.lower() in (c.lower() for c in df.columns):
        wish += "_"
    return wish


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; missing text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def text_digest(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def keep_one(
    docs: DataFrame, keepers: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that ``keepers`` (keep_id, keep_digest, copies) names, one row each.

    Rows are named by id and text. Where several rows share both (``copies`` above 1), one stays.
    """
    key, digest = fresh_name(docs, "_keep_id"), fresh_name(docs, "_keep_digest")
    copies = fresh_name(docs, "_copies")
    named = keepers.toDF(key, digest, copies)
    marked = docs.withColumn(digest, text_digest(F.col(text_col)))
    same = marked[digest].eqNullSafe(named[digest]) & marked[id_col].eqNullSafe(named[key])
    if named.where(F.col(copies) > 1).isEmpty():
        return marked.join(named, same, "left_semi").select(*docs.columns)
    kept = marked.join(named.withColumnRenamed(digest, digest + "2"),
                       (marked[digest] == F.col(digest + "2"))
                       & marked[id_col].eqNullSafe(F.col(key)))
    kept = kept.drop(key, digest + "2")
    once = kept.where(F.col(copies) == 1)
    repeated = kept.where(F.col(copies) > 1).dropDuplicates([id_col, digest])
    return once.unionByName(repeated).select(*docs.columns)
