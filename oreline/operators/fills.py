"""Filling of missing values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.exact import Sums, known


def fill_constants(df: DataFrame, values: Mapping[str, str | float]) -> DataFrame:
    """Missing (NULL or NaN) values replaced per column."""
    return df.fillna(dict(values))


def fill_mean(
    df: DataFrame,
    column: str,
    places: int,
    digits: int | None = None,
    known_in: DataFrame | None = None,
) -> DataFrame:
    """Missing values replaced by the mean of the known ones, rounded to ``digits`` if given.

    The mean is a scalar subquery: one narrow scan, one number put into the plan, no join and no
    collect. With no known value it is NULL and the column stays as it is. ``known_in`` names a
    frame with the same known values that is cheaper to scan, such as the rows before a filter
    that only drops rows without the value.
    """
    value, sums = F.col(column), Sums()
    measure = sums.of(value, places)
    mean = measure.mean_unrounded() if digits is None else measure.mean(digits)
    scanned = sums.over((df if known_in is None else known_in).select(column))
    return df.withColumn(column, F.coalesce(known(value), scanned.agg(mean.alias("mean")).scalar()))
