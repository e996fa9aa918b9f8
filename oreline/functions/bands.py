"""Bands over a numeric column."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_BELOW = {"<": operator.lt, "<=": operator.le}


def band(value: Column, steps: Sequence[tuple[str, str, float]], top: str) -> Column:
    """Label of the first step whose upper bound holds, else ``top``.

    A step is ``(label, "<" or "<=", bound)``. A missing value meets no bound and lands in ``top``.
    """
    label = None
    for name, sign, bound in steps:
        below = _BELOW[sign](value, F.lit(bound))
        label = F.when(below, name) if label is None else label.when(below, name)
    return F.lit(top) if label is None else label.otherwise(top)
