"""Renaming, splitting and keying of wide tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rename_select(df: DataFrame, names: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns as they are, then every ``{source: target}``."""
    return df.select(*keep, *[F.col(quoted(old)).alias(new) for old, new in names.items()])


def normalise_columns(df: DataFrame) -> DataFrame:
    """Column names stripped, lower case, blanks as underscores."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns collide after renaming: {', '.join(repeated)}")
    return df.toDF(*names)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Without the rows in which every column is missing."""
    return df.dropna(how="all")


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A unique 64-bit row id without a shuffle.

    The id depends on how the scan is split, so take it once, write the table, and derive every
    other table that needs it from what was written.
    """
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def with_content_id(df: DataFrame, name: str, copies_per_task: int = 1_000_000) -> DataFrame:
    """A text id made from the row itself, equal in every run: digest, ``-``, copy number.

    Equal rows are counted map-side and laid out again from the count. A row with more copies
    than ``copies_per_task`` is first spread over tasks in blocks of that many, so no task
    numbers a hot group alone.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    # NULL fields stay in the text, so a missing value and a missing column differ.
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    counted = (
        df.groupBy(*columns)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_digest", F.sha2(text, 256))
    )
    few = counted.where(F.col("_copies") <= copies_per_task).withColumn(
        "_copy", F.explode(F.expr("sequence(0, _copies - 1)"))
    )
    size = copies_per_task
    blocks = (
        counted.where(F.col("_copies") > size)
        .withColumn("_block", F.explode(F.expr(f"sequence(0, (_copies - 1) div {size})")))
        .repartition("_digest", "_block")
    )
    last = f"least(_copies, (_block + 1) * {size}) - 1"
    many = blocks.withColumn("_copy", F.explode(F.expr(f"sequence(_block * {size}, {last})")))
    numbered = few.unionByName(many.drop("_block"))
    return numbered.select(F.concat_ws("-", "_digest", "_copy").alias(name), *columns)
