"""Conditional aggregates, kept apart by what they give when nothing matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    """Rows that meet the condition; 0 when none do."""
    return F.count_if(condition)


def tally_where(condition: Column) -> Column:
    """Rows that meet the condition; NULL when none do."""
    return F.sum(F.when(condition, 1))


def flag_total(condition: Column) -> Column:
    """Rows that meet the condition; 0 when none do, NULL when there are no rows."""
    return F.sum(F.when(condition, 1).otherwise(0))


def pivot_counts(column: Column, names: Mapping[str, str]) -> list[Column]:
    """One count per listed value of ``column``: ``{value: output name}``."""
    return [count_where(column == value).alias(name) for value, name in names.items()]


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counted = df.groupBy(column).agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), F.asc_nulls_last(column))


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of an order. End the order with a key, so that ties fall the same way."""
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.select(value.alias(name)).distinct()


def aliased(measures: Mapping[str, Column]) -> Sequence[Column]:
    return [column.alias(name) for name, column in measures.items()]


def in_order(df: DataFrame, ordered: bool, *columns: Column | str) -> DataFrame:
    """``df`` sorted for reading; as it is if it is to be stored. End with the key: no ties."""
    return df.orderBy(*columns) if ordered else df
