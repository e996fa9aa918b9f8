"""Text to typed values. Bad text becomes NULL; ANSI mode stays on for everything else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreline.schemas import DATE_FORMAT, TIMESTAMP_FORMAT

# Decimal notation only: the JVM parser would also take "1d", "0x1p3" and "NaN".
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})?$"
)


def _given(text: Column, parsed: Column) -> Column:
    """Empty text is common and needs no parser: a failed parse costs ten times a good one."""
    return F.when(F.length(text) > 0, parsed)


def parse_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    return _given(text, F.try_to_timestamp(text, F.lit(fmt)))


def parse_date(text: Column, fmt: str = DATE_FORMAT) -> Column:
    return _given(text, F.try_to_date(text, fmt))


def parse_iso_timestamp(text: Column) -> Column:
    """A date, ``T`` or a blank, a time to the second, up to six decimals, and a zone if given."""
    return F.when(text.rlike(_ISO_TIME), text.try_cast("timestamp"))


def parse_number(text: Column) -> Column:
    """Finite numbers only: text beyond the range of a double is as unreadable as a word."""
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def is_unread(text: Column, parsed: Column) -> Column:
    """Text was given, and it could not be parsed."""
    return (F.length(F.trim(text)) > 0) & parsed.isNull()
