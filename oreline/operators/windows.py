"""Top-k per group and running totals."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oreline.functions.exact import Sums, not_split

# Slots of a running total. Each is the work of one task.
SLOTS = 256


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    """First ``k`` rows of each group, numbered in ``rank``.

    ``row_number() <= k`` lets Spark cut every group to ``k`` rows before the shuffle, so a hot
    group sends at most ``k`` rows per task. End ``order`` with a unique column.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def running_total(
    df: DataFrame, at: str, amount: str, total: str, places: int, slots: int = SLOTS
) -> DataFrame:
    """``sum(amount) over (order by at)``: rows with equal ``at`` share a value, NULL ``at`` last.

    One window over all rows would be one task. Here quantiles of the times (one narrow scan, at most
    ``slots`` numbers) cut the rows into slots of about equal length. Slots are summed map-side, and
    what lies before each is a window over one row per slot, broadcast back. Rows then need a window
    within their slot only: one shuffle, no join of rows. A time that fills a slot alone is hot: its
    rows all have the value at its end, so they are not shuffled at all.
    """
    micros = F.unix_micros(F.col(at))
    shares = [k / slots for k in range(1, slots)]
    found = df.agg(F.percentile_approx(micros, shares, 10 * slots).alias("b")).first().b or []
    marks = sorted(set(found))
    hot = {m for m, n in Counter(found).items() if n > 1}
    sums = Sums()
    measure = sums.of(F.col(amount), places)
    slot, is_hot = _slot(micros, marks), micros.isNull() | (micros.isin(*hot) if hot else F.lit(False))
    rows = sums.over(df.withColumn("_slot", slot).withColumn("_hot", is_hot))
    sums_of = {f"_s_{name}": c for name, c in measure.sums().items()}
    # A hot time is the last one of its slot. One row per slot and kind, twice ``slots`` at most.
    each = rows.groupBy("_slot", "_hot").agg(*[c.alias(name) for name, c in sums_of.items()])
    lost = (F.col("_s_values") > 0) & (F.col("_s_u").isNull() | F.col("_s_r").isNull())
    each = each.withColumn("_s_t", F.when(lost, not_split()).otherwise(F.col("_s_t")))
    order = W.orderBy("_slot", "_hot")
    keys = ["_slot", "_hot"]

    def so_far(last: int) -> DataFrame:
        frame = order.rowsBetween(W.unboundedPreceding, last)
        return each.select(*keys, *[_sum_of(name)(name).over(frame).alias(name) for name in sums_of])

    def result(own: Callable[[str], Column]) -> Column:
        totals = measure.of({name.removeprefix("_s_"): own(name) for name in sums_of})
        return F.when(totals.values > 0, totals.double()).alias(total)

    mine = W.partitionBy("_slot").orderBy(at).rangeBetween(W.unboundedPreceding, W.currentRow)
    within = [c.over(mine).alias(f"{name}_") for name, c in sums_of.items()]
    cold = rows.where("NOT _hot").select(*df.columns, "_slot", *within)
    cold = cold.join(F.broadcast(so_far(-1).where("NOT _hot").drop("_hot")), "_slot")
    same = rows.where("_hot").select(*df.columns, "_slot")
    same = same.join(F.broadcast(so_far(0).where("_hot").drop("_hot")), "_slot")

    def both(name: str) -> Column:
        """NULL sums are those of no values, but for whole numbers that left 64 bits."""
        before, own = F.col(name), F.col(f"{name}_")
        if name in ("_s_u", "_s_r"):
            before = F.when(F.coalesce("_s_values", F.lit(0)) > 0, before).otherwise(0)
            return F.try_add(before, F.when(F.col("_s_values_") > 0, own).otherwise(0))
        return F.coalesce(before + own, before, own)

    return cold.select(*df.columns, result(both)).unionByName(same.select(*df.columns, result(F.col)))


def _sum_of(name: str) -> Callable[[str], Column]:
    """Whole numbers that leave 64 bits are NULL; the others just go on."""
    return F.sum if name in ("_s_t", "_s_plain") else F.try_sum


def _slot(value: Column, marks: Sequence[int]) -> Column:
    """How many of the sorted ``marks`` lie below a value, by halving; one more than all for NULL."""
    if not marks:
        return F.when(value.isNull(), 1).otherwise(0)
    steps = [1 << k for k in reversed(range(len(marks).bit_length()))]
    bounds = F.array(*[F.lit(m).cast("bigint") for m in marks])
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda i, step: F.when(F.get(bounds, i + step - 1) < value, i + step).otherwise(i),
    )
    return F.when(value.isNull(), len(marks) + 1).otherwise(found)
