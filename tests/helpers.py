from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def column(df: DataFrame, name: str) -> list:
    return [r[name] for r in df.collect()]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
