"""Row flags, profiles and row-count contracts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.exact import rate_pct
from oreline.functions.parse import is_unread
from oreline.functions.text import is_blank, is_padded
from oreline.operators.aggregates import count_where
from oreline.operators.reshape import quoted


class ContractBroken(ValueError):
    """A table does not hold the number of rows it must."""


def flag(broken: Column, label: str) -> Column:
    """``label`` where the condition holds, else ``ok``."""
    return F.when(broken, label).otherwise("ok")


def any_missing(columns: Sequence[str], blank_is_missing: bool = True) -> Column:
    """Some column is NULL (or, unless switched off, the empty string)."""
    missing = [is_blank(F.col(c)) if blank_is_missing else F.col(c).isNull() for c in columns]
    return reduce(Column.__or__, missing)


def _as_rows(one_row: DataFrame, names: Mapping[str, str], *values: str) -> DataFrame:
    """A one-row frame of ``<key>_<value>`` columns turned into a row per key."""
    entries = [
        F.struct(
            F.lit(name).alias("column"), *[F.col(f"{key}_{value}").alias(value) for value in values]
        )
        for key, name in names.items()
    ]
    return one_row.select(F.inline(F.array(*entries)))


def profile_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, blank_is_missing: bool = True
) -> DataFrame:
    """``(column, nulls, pct)`` of the columns that miss values, in one pass over the table."""
    names = {f"c{i}": name for i, name in enumerate(columns or df.columns)}
    text = {name for name, kind in df.dtypes if kind == "string"}
    counts = []
    for key, name in names.items():
        value = F.col(quoted(name))
        missing = is_blank(value) if blank_is_missing and name in text else value.isNull()
        counts.append(count_where(missing).alias(f"{key}_nulls"))
    counted = df.agg(F.count("*").alias("_rows"), *counts)
    rates = {f"{key}_pct": rate_pct(F.col(f"{key}_nulls"), F.col("_rows")) for key in names}
    return _as_rows(counted.withColumns(rates), names, "nulls", "pct").where("nulls > 0")


def null_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row with the NULLs of each named column: ``{output: column}``."""
    return df.agg(*[count_where(F.col(c).isNull()).alias(n) for n, c in columns.items()])


def profile_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, distinct_values)`` of each column, NULL not counted, in one pass.

    Values are folded map-side, so the shuffle carries each column's distinct values alone.
    """
    names = {f"c{i}": name for i, name in enumerate(columns)}
    counts = [
        F.count_distinct(F.col(quoted(name))).alias(f"{key}_distinct_values")
        for key, name in names.items()
    ]
    return _as_rows(df.agg(*counts), names, "distinct_values")


def frequencies_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, rows)`` for several columns in one pass; values as text."""
    text = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns])
    long = text.unpivot([], [quoted(c) for c in columns], "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("rows"))


def profile_frequencies(
    df: DataFrame, columns: Sequence[str], by_value: Sequence[str] = ()
) -> DataFrame:
    """Frequencies of each column, most frequent first; the ``by_value`` ones in value order.

    Numbers are ordered as numbers.
    """
    counted = frequencies_of(df, columns)
    is_number = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema}
    numeric = [c for c in columns if is_number[c]]
    first = F.when(F.col("column").isin(*by_value), None).otherwise(F.col("rows"))
    number = F.when(F.col("column").isin(*numeric), F.col("value").try_cast("double"))
    return counted.orderBy(
        "column", F.desc(first), F.asc_nulls_last(number), F.asc_nulls_last("value")
    )


def profile_shape(df: DataFrame, table: str) -> DataFrame:
    """One row: the table's name, its rows, its columns and their types."""
    types = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(table).alias("table_name"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(types).alias("column_types"),
    )


def padded_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, padded)``: rows whose text has blanks at an end, one pass for all columns."""
    names = {f"c{i}": name for i, name in enumerate(columns)}
    counted = df.agg(
        *[count_where(is_padded(F.col(name))).alias(f"{key}_padded") for key, name in names.items()]
    )
    return _as_rows(counted, names, "padded")


def unread_counts(df: DataFrame, parsers: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """``(column, given, unread)``: text values given, and those their parser makes nothing of."""
    names = {f"c{i}": name for i, name in enumerate(parsers)}
    counted = df.agg(
        *[count_where(~is_blank(F.col(n))).alias(f"{key}_given") for key, n in names.items()],
        *[
            count_where(is_unread(F.col(n), parsers[n](F.col(n)))).alias(f"{key}_unread")
            for key, n in names.items()
        ],
    )
    rows = [
        F.struct(F.lit(n).alias("column"), F.col(f"{key}_given").alias("given"),
                 F.col(f"{key}_unread").alias("unread"))
        for key, n in names.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` of several frames in one job."""
    counted = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def row_count_contract(
    tables: Mapping[str, DataFrame], expected: Mapping[str, int | DataFrame]
) -> DataFrame:
    """``(table_name, expected, actual, ok)``.

    An expectation is a number, or a frame that must be as long.
    """
    checks = []
    for name, df in tables.items():
        want = expected[name]
        bound = (
            want.agg(F.count("*").alias("n")).scalar()
            if isinstance(want, DataFrame)
            else F.lit(want).cast("bigint")
        )
        counted = df.agg(F.count("*").alias("actual"))
        checks.append(
            counted.select(F.lit(name).alias("table_name"), bound.alias("expected"), "actual")
        )
    checked = reduce(DataFrame.unionAll, checks)
    return checked.withColumn("ok", F.col("expected") == F.col("actual"))


def enforce_contract(checked: DataFrame) -> list[dict]:
    """Raise if any row-count check failed; otherwise the checks, one small dict per table."""
    rows = [row.asDict() for row in checked.collect()]
    broken = [r for r in rows if not r["ok"]]
    if broken:
        said = "; ".join(
            f"{r['table_name']}: {r['actual']} rows, not {r['expected']}" for r in broken
        )
        raise ContractBroken(said)
    return rows
