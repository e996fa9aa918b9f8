"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies that each of its documents should have. The
whole part is given to every document; the rest, below one, is a probability of one copy more, and
pivotal rounding turns these probabilities into zeros and ones: two documents with fractional
probabilities move mass (words) from one to the other, in a random direction with the odds that
keep every expectation, until one of the two is whole. The words taken of a pair stay the same, so
a source misses its target by part of one document at most, the last one left.

Pairing runs as a reduction tree. In each round a block of at most a few dozen documents is folded
pair by pair to one residual, and the residuals are the documents of the next round. Blocks hold
documents of neighbouring sizes, largest first: a large document meets others of its size and then
smaller ones. Documents of over a sixty-fourth of their source are rounded first and the others make
up for what those took too much or too little, so that what is left last is small. Blocks are cut by
counts per size, and one size that is common is dealt to blocks by hash, so no source and no size is
ever in one task. Equal rows are counted, and rounded among each other by arithmetic: they meet
others as one document.

Every random number is a hash of the documents that meet, so a mix depends on the rows alone and is
the same in each run. Everything is column functions.

Defined results: missing text has no words; a document without words is taken as no words; a
missing source is a source of its own, the last one; rows with missing or repeated ids are documents
like others; without words at all every target is zero; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2
# Documents that a block holds on average; sizes that are not common make it twice that at most.
BLOCK = 32
# A document is large from one part in LARGE of its source's words on; a source has LARGE at most.
LARGE = 64
# Equal rows that are written out from one count in one go.
COPIES_PER_ROW = 4_096

_WORDS = r"[^\x20\x09-\x0D]+"
_ITEM = "array<struct<size:bigint,h:bigint,doc_id:{kind},p:double,copies:bigint>>"


def sized(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """doc_id, source, size, rows: how many rows of a source have that id and that many words."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(_WORDS))
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            size.cast("long").alias("size"),
        )
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("rows"))
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """source, number (its place), source_size, target; one row per source.

    Weights repeat over the sources by code point. Sources fill up in the order of their limit over
    their weight; from the first one on that its share does not fill, all share by weight what is
    left, which is what resharing the excess again and again ends in.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    given = (
        sizes.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
        # One row per source in these windows.
        .withColumn("number", F.row_number().over(place) - 1)
        .withColumn("weight", F.get(cycle, F.col("number") % len(weights)))
        .withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(whole)
    left = budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    filled = (
        given.withColumn("left", left)
        .withColumn("heavy", F.sum("weight").over(after))
        .withColumn("full", F.col("limit") * F.col("heavy") <= F.col("left") * F.col("weight"))
    )
    # What the first source that stays below its limit finds left goes to it and all behind it.
    state = F.struct(F.col("limit") / F.col("weight"), "number", "left", "heavy")
    rest = filled.withColumn("open", F.min(F.when(~F.col("full"), state)).over(whole))
    shared = F.col("open.left") * F.col("weight") / F.col("open.heavy")
    return rest.select(
        "source",
        "number",
        "source_size",
        F.when(F.col("full"), F.col("limit")).otherwise(shared).alias("target"),
    )


def _uniform(*keys: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") + 0.5) / float(1 << 53)


def _meet(acc: Column, new: Column, seed: Column) -> Column:
    """Two documents move mass until one of them is whole; it is ``done``, the other stays."""
    old = acc["left"]
    a, b = old["size"] * old["p"], new["size"] * new["p"]
    room_old, room_new = old["size"] - a, new["size"] - b
    up, down = F.least(room_old, b), F.least(a, room_new)  # words to the old one, to the new one
    gains = F.when(a >= old["size"], True).when(a <= 0, False).otherwise(
        _uniform(seed, old["h"], new["h"]) * (up + down) < down
    )

    def whole(x: Column, copies: int) -> Column:
        return _item(x, F.lit(float(copies)), x["copies"] + copies)

    def rest(x: Column, mass: Column) -> Column:
        p = F.least(F.greatest(mass / x["size"], F.lit(0.0)), F.lit(1.0))
        return _item(x, p, x["copies"])

    gain = F.when(
        room_old <= b, F.struct(rest(new, b - up).alias("left"), whole(old, 1).alias("done"))
    ).otherwise(F.struct(rest(old, a + up).alias("left"), whole(new, 0).alias("done")))
    give = F.when(
        a <= room_new, F.struct(rest(new, b + down).alias("left"), whole(old, 0).alias("done"))
    ).otherwise(F.struct(rest(old, a - down).alias("left"), whole(new, 1).alias("done")))
    step = F.when(gains, gain).otherwise(give)
    return F.struct(
        step["left"].alias("left"), F.array_append(acc["done"], step["done"]).alias("done")
    )


def _item(x: Column, p: Column, copies: Column) -> Column:
    return F.struct(
        x["size"].alias("size"), x["h"].alias("h"), x["doc_id"].alias("doc_id"),
        p.alias("p"), copies.alias("copies"),
    )


def _blocks(items: DataFrame, block: int) -> DataFrame:
    """``items`` with the block they are in: neighbours by size, a common size by hash."""
    larger = (
        Window.partitionBy("number").orderBy(F.col("size").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per source and size, so the window does not grow with the rows of a hot source.
    places = (
        items.groupBy("number", "size")
        .agg(F.count("*").alias("many"))
        .withColumn("at", F.coalesce(F.sum("many").over(larger), F.lit(0)))
    )
    parts = F.ceil(F.col("many") / block)
    return (
        items.join(places, ["number", "size"])
        .withColumn("part", F.when(F.col("many") > block, 1 + F.pmod("h", parts)).otherwise(0))
        .withColumn("block", F.floor(F.col("at") / block))
        .drop("many", "at")
    )


def _folded(items: DataFrame, seed: int, block: int) -> DataFrame:
    """Blocks reduced to what is ``left`` of them and the documents that are ``done``."""
    kind = items.schema["doc_id"].dataType.simpleString()
    one = F.struct("size", "h", "doc_id", "p", "copies")
    grouped = (
        _blocks(items, block)
        .groupBy("number", "block", "part")
        # A block holds a few dozen items, by counts.
        .agg(F.reverse(F.array_sort(F.collect_list(one))).alias("items"))
    )
    none = F.array().cast(_ITEM.format(kind=kind))
    start = F.struct(F.get("items", F.lit(0)).alias("left"), none.alias("done"))
    folded = F.aggregate(
        F.slice("items", 2, F.size("items")), start, lambda acc, x: _meet(acc, x, F.lit(seed))
    )
    return grouped.select("number", folded.alias("f")).select("number", "f.left", "f.done")


def rounded(items: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """number, doc_id, size, copies for ``items`` (number, size, h, doc_id, p, copies).

    Round after round folds the blocks; each round has a small share of the rows of the one before.
    The last document of a source is rounded by a draw of its own.
    """
    cols = ["number", "size", "h", "doc_id", "p", "copies"]
    done = []
    while True:
        folded = stored(_folded(items, seed, block), "mix-round")
        done.append(folded.select("number", F.explode("done").alias("x")).select("number", "x.*"))
        items = folded.select("number", "left.*").select(*cols)
        seed += 1
        if items.groupBy("number").count().where("count > 1").isEmpty():
            break
    last = items.withColumn(
        "copies", F.col("copies") + (_uniform(F.lit(seed), F.col("h")) < F.col("p")).cast("long")
    )
    for part in done:
        last = last.unionByName(part)
    return last.select("number", "doc_id", "size", "copies")


def dealt(each: DataFrame, seed: int) -> DataFrame:
    """number, doc_id, size, copies: one row for each of the ``rows`` of ``each``, given its rate."""
    whole, mass = F.floor("rate"), F.col("rows") * (F.col("rate") - F.floor("rate"))
    # Of equal rows, whole numbers of extra copies are dealt at once; one row keeps the fraction.
    each = stored(
        each.withColumn("whole", whole)
        .withColumn("more", F.floor(mass))
        .withColumn("p", mass - F.floor(mass)),
        "mix-shares",
    )
    items = each.where("p > 0").select(
        "number", "size", F.xxhash64("number", "doc_id", "size", F.lit(seed)).alias("h"), "doc_id",
        "p", F.col("whole").alias("copies"),
    )
    plain = F.col("rows") - F.col("more") - (F.col("p") > 0).cast("long")
    kinds = F.array(
        F.struct((F.col("whole") + 1).alias("copies"), F.col("more").alias("rows")),
        F.struct(F.col("whole").alias("copies"), plain.alias("rows")),
    )
    counted = each.select("number", "doc_id", "size", F.explode(kinds).alias("x"))
    counted = counted.select("number", "doc_id", "size", "x.*").where("rows > 0")
    return rounded(items, seed).unionByName(_written_out(counted))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
    large: int = LARGE, seed: int = 13,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, copies, taken (size times copies)."""
    sizes = stored(sized(docs, id_col, source_col, text_col), "mix-sizes")
    plan = stored(targets(sizes, weights, share, most), "mix-targets")
    place = plan.select(F.col("source").alias("_source"), "number", "source_size", "target")
    each = sizes.join(place, F.col("source").eqNullSafe(F.col("_source")))
    is_large = F.col("size") * large > F.col("source_size")
    cols = ["number", "doc_id", "size", "rows"]

    rate = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    first = stored(
        dealt(each.where(is_large).select(*cols, rate.alias("rate")), seed), "mix-large"
    )
    # What the large documents leave is the target of the others, one rate per source.
    given = first.groupBy("number").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.sum("size").alias("given")
    )
    left = F.col("target") - F.coalesce(F.col("taken"), F.lit(0))
    words = F.col("source_size") - F.coalesce(F.col("given"), F.lit(0))
    rest_rate = F.greatest(F.coalesce(left / F.nullif(words, F.lit(0)), F.lit(0.0)), F.lit(0.0))
    rates = plan.join(given, "number", "left").select(
        "number", F.least(rest_rate, F.lit(float(most))).alias("rate")
    )
    others = each.where(~is_large).select(*cols).join(stored(rates, "mix-rates"), "number")
    others = others.withColumn("rate", F.when(F.col("size") > 0, F.col("rate")).otherwise(0.0))
    both = first.unionByName(dealt(others, seed + 1))
    return both.join(plan, "number").select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def _written_out(counted: DataFrame, size: int = COPIES_PER_ROW) -> DataFrame:
    """One row for each of ``rows``; long runs are spread over tasks in blocks first."""
    few = counted.where(F.col("rows") <= size)
    blocks = counted.where(F.col("rows") > size).withColumn(
        "block", F.explode(F.expr(f"sequence(0, (rows - 1) div {size})"))
    )
    many = (
        blocks.repartition("number", "doc_id", "block")
        .withColumn("rows", F.expr(f"least({size}L, rows - block * {size})"))
        .drop("block")
    )
    both = few.unionByName(many)
    return both.withColumn("_", F.explode(F.expr("array_repeat(0, int(rows))"))).drop("_", "rows")
