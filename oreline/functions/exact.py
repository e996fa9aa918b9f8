"""Sums, means and rates whose result does not depend on the order of addition.

A double is split into whole numbers of two units, ``10**-places`` and 1e-10, which are summed as
64-bit integers, and what is finer, which is summed as a decimal with 28 places; it is NULL for most
values and costs them nothing. So figures do not change with partitioning, retries or skew, and a sum
runs in a hash aggregate at about the speed of a double sum. ``places`` only says where most values
end, so that the finer units are zero. What lies below the fifteenth digit of a value, all that a
double holds of a decimal, is not counted. Rounding is done on the result.

Infinite values, those whose units leave 62 bits, and sums of units beyond 64 bits stop no job: such a
group gets the plain double sum.

Measures are declared before an aggregate, so that a value is split once for its sum and its mean::

    sums = Sums()
    fare = sums.of(F.col("fare"), 2)
    sums.over(df).groupBy("city").agg(fare.sum().alias("revenue"), fare.mean(2).alias("fare"))
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINE = 10
_FINEST = "decimal(38,28)"
_MOST_UNITS = float(2**62)
_PRECISION = 2.0**-50
_SMALL = 1e-6
_UNITS_BELOW = 1e13
# Added to the finer rest for a value that has no units: far more than all rests together.
_NO_UNITS = Decimal(10**9)


def not_split() -> Column:
    """The finer rest of what has no units."""
    return F.lit(_NO_UNITS).cast(_FINEST)


def known(value: Column) -> Column:
    """The value, with NaN read as missing."""
    return F.nullif(value, F.lit(float("nan")))


def units(value: Column, places: int) -> Column:
    """Nearest whole number of ``10**-places`` units, as bigint; NULL for values too large."""
    return F.when(F.abs(value) < _UNITS_BELOW, F.rint(value * 10.0**places)).cast("bigint")


def _split(
    value: Column, places: int, let: Callable[[int, str, Column], Column]
) -> dict[str, Column]:
    """Parts of a value. ``let`` names what is used more than once, layer by layer."""
    value, scale = value.cast("double"), F.lit(10.0**places)
    v = let(0, "v", known(value))
    u = let(0, "u", F.when(F.abs(value) * scale < _MOST_UNITS, F.rint(value * scale)).cast("bigint"))
    left = let(1, "l", v - u / scale)
    # A small value is kept whole: as a decimal it is exact, the rest of a division is not.
    fine = F.when(F.abs(v) < _SMALL, 0.0).otherwise(F.rint(left * 10.0**FINE))
    tiny = left - fine / 10.0**FINE
    # Less than the value's own precision is noise of its decimals.
    rest = F.when(F.abs(tiny) > F.abs(v) * _PRECISION, tiny.cast(_FINEST))
    rest = rest.when(v.isNotNull() & u.isNull(), not_split())
    return {"v": v, "u": u, "r": let(2, "r", fine.cast("bigint")), "t": let(2, "t", rest)}


@dataclass(frozen=True)
class Totals:
    """What has been summed of a measure: both units, the finer rest, values, the plain sum."""

    places: int
    u: Column
    r: Column
    t: Column
    values: Column
    plain: Column

    def _main(self) -> Column:
        """The sum of both units; NULL if it left 64 bits."""
        whole = self.u.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-self.places))
        return whole + self.r.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-FINE))

    def decimal(self) -> Column:
        """The sum as a decimal with ten places; NULL where it holds more, or has no values."""
        return F.when(self.t.isNull(), self._main())

    def double(self) -> Column:
        """The sum as a double; NULL when there are no values."""
        main = self._main()
        finer = F.coalesce(
            (main.try_cast(_FINEST) + self.t).cast("double"),
            main.cast("double") + self.t.cast("double"),
        )
        finer = F.when(F.abs(self.t) < _NO_UNITS / 10, finer)
        total = F.when(self.t.isNull(), main.cast("double")).otherwise(finer)
        return F.coalesce(total, self.plain)

    def mean(self, digits: int) -> Column:
        """The mean rounded half up to ``digits``; NULL when there are no values."""
        mean = F.round(per_count(self.decimal(), self.values), digits).cast("double")
        return F.coalesce(mean, F.round(self.double() / F.nullif(self.values, F.lit(0)), digits))

    def mean_unrounded(self) -> Column:
        """The mean as a double; NULL when there are no values."""
        n = F.nullif(self.values, F.lit(0))
        total = self.decimal()
        # Whole units divided once give the nearest double.
        in_units = self.u.cast("double") / (n * 10**self.places).cast("double")
        finest = (total * F.lit(Decimal(10**FINE))).cast("double")
        in_finest = finest / (n * 10**FINE).cast("double")
        exact = F.when(total.isNotNull(), F.when(self.r != 0, in_finest).otherwise(in_units))
        return F.coalesce(exact, self.double() / n)


class Exact:
    """A measure, split into columns that an aggregate or a window can sum."""

    def __init__(self, places: int, parts: dict[str, Column]):
        self.places, self.parts = places, parts

    def totals(self) -> Totals:
        return self.of(self.sums())

    def sums(self) -> dict[str, Column]:
        """The aggregates that totals are made of, by name."""
        p = self.parts
        return {
            "u": F.try_sum(p["u"]), "r": F.try_sum(p["r"]), "t": F.sum(p["t"]),
            "values": F.count(p["v"]), "plain": F.sum(p["v"]),
        }

    def of(self, sums: dict[str, Column]) -> Totals:
        return Totals(self.places, **sums)

    def sum(self) -> Column:
        return self.totals().double()

    def mean(self, digits: int) -> Column:
        return self.totals().mean(digits)

    def mean_unrounded(self) -> Column:
        return self.totals().mean_unrounded()


class Sums:
    """Measures of one aggregate. Each value is split once, in columns added by :meth:`over`."""

    def __init__(self):
        self._layers: list[dict[str, Column]] = [{}, {}, {}]
        self._measures = 0

    def of(self, value: Column, places: int) -> Exact:
        number, self._measures = self._measures, self._measures + 1

        def let(layer: int, name: str, column: Column) -> Column:
            named = f"_x{number}_{name}"
            self._layers[layer][named] = column
            return F.col(named)

        return Exact(places, _split(value, places, let))

    def over(self, df: DataFrame) -> DataFrame:
        for layer in self._layers:
            df = df.withColumns(layer)
        return df


def exact(value: Column, places: int) -> Exact:
    """A measure by itself, where no columns can be added before the aggregate."""
    return Exact(places, _split(value, places, lambda _, __, column: column))


def per_count(total: Column, count: Column) -> Column:
    """A decimal total over a count, as a decimal with 15 places."""
    return total / F.nullif(count, F.lit(0)).cast("decimal(20,0)")


def sum_exact(value: Column, places: int) -> Column:
    """Sum as a double; NULL when there are no values."""
    return exact(value, places).sum()


def avg_exact(value: Column, places: int, digits: int) -> Column:
    """Mean rounded half up to ``digits``; NULL when there are no values."""
    return exact(value, places).mean(digits)


def mean_exact(value: Column, places: int) -> Column:
    """Unrounded mean as a double; NULL when there are no values."""
    return exact(value, places).mean_unrounded()


def avg_whole(value: Column, digits: int) -> Column:
    """Mean of an integer column rounded half up to ``digits``."""
    total = F.sum(value.cast("bigint")).cast("decimal(20,0)")
    return F.round(per_count(total, F.count(value)), digits).cast("double")


def rate_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, one decimal, kept as a decimal type."""
    return F.round(part * F.lit(Decimal("100.0")) / F.nullif(whole, F.lit(0)), 1)
