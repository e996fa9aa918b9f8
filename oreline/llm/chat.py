"""Chat formatting by perspective rotation.

A conversation is rendered once for every participant (role): that speaker's turns are the
assistant's, all others are users with a name. Beside the text stands its mask as runs: how many
characters come next, and whether they are trained on. The speaker's own words and the end mark
after them are; headers and all other turns are not. Roles that do not speak (``silent``, by default
``system``) have a header of their own, are never trained on and get no perspective.

A conversation is rendered in segments of ``segment_turns`` rows (256; None leaves it whole); the
segments of a perspective in order are its dialogue. Rows are cut by their number, so no row of the
result holds more, whatever ids and turn numbers say. They are numbered without gathering a
conversation: equal rows are folded to a count, the counts are sorted by range, each range is summed
per conversation, and a row's number is its place in its range behind the ranges before it. Turns
and participants meet in a join that the adaptive skew join may split.

Marks cannot be forged: a backslash is put into every ``<|`` of a text or role, and every ``|>`` of a
role (one more into those that have some, so it can be undone).

Defined results: turns are ordered by turn number, role and text, missing ones first, so ties and
repeated rows all stay; a missing role is the participant ``unknown``, missing text is empty; rows
without a conversation id form one conversation; a conversation in which only silent roles speak, and
an empty table, give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import stored

SEGMENT_TURNS = 256
UNKNOWN = "unknown"
SILENT = ("system",)
END = "<|end|>\n"

_ROW = ("turn", "role", "text")


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*\|)", r"<\\$1")


def _name(role: Column) -> Column:
    return F.regexp_replace(_escaped(role), r"(\|\\*)>", r"$1\\>")


def _numbered(rows: DataFrame) -> DataFrame:
    """Distinct rows with how often they occur (``n``) and the number of the first (``at``, from 0)."""
    counted = rows.groupBy("conv_id", *_ROW).agg(F.count("*").alias("n"))
    # Written, so that a lost executor cannot deal the ranges anew.
    ranges = stored(
        counted.repartitionByRange("conv_id", *_ROW).withColumn("part", F.spark_partition_id()),
        "turn-ranges",
    )
    parts = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranges.groupBy("conv_id", "part").agg(F.sum("n").alias("rows"))
        .select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"),
                F.coalesce(F.sum("rows").over(parts), F.lit(0)).alias("base"))
    )
    inside = (
        Window.partitionBy("conv_id", "part").orderBy(*_ROW)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    placed = ranges.withColumn("at", F.sum("n").over(inside) - F.col("n")).join(before, here)
    return placed.select("conv_id", *_ROW, "n", (F.col("at") + F.col("base")).alias("at"))


def _segments(rows: DataFrame, segment_turns: int | None) -> DataFrame:
    """conv_id, segment, turns: the rows of each segment in order."""
    placed = _numbered(rows)
    if segment_turns is None:
        cut = placed.withColumn("segment", F.lit(0).cast("long")).withColumn("times", F.col("n"))
    else:
        size, last = F.lit(segment_turns), F.col("at") + F.col("n") - 1
        cut = placed.withColumn(
            "segment",
            F.explode(F.sequence(F.floor(F.col("at") / size), F.floor(last / size))),
        ).withColumn(
            "times",
            F.least(F.col("at") + F.col("n"), (F.col("segment") + 1) * size)
            - F.greatest(F.col("at"), F.col("segment") * size),
        )
    listed = F.sort_array(F.collect_list(F.struct("at", "role", "text", "times")))
    repeated = F.transform(
        listed, lambda t: F.array_repeat(
            F.struct(t.role.alias("role"), t.text.alias("text")), t.times.cast("int")
        )
    )
    return cut.groupBy("conv_id", "segment").agg(F.flatten(repeated).alias("turns"))


def perspectives(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", segment_turns: int | None = SEGMENT_TURNS,
    silent: Sequence[str] = SILENT,
) -> DataFrame:
    """conv_id, speaker, segment, n_turns, text, mask (runs of trained, chars)."""
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    speakers = rows.where(~F.col("role").isin(*silent)) if silent else rows
    speakers = speakers.select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker"))
    both = _segments(rows, segment_turns).join(
        speakers.distinct(), F.col("conv_id").eqNullSafe(F.col("_conv"))
    )
    speaker = F.col("speaker")

    def header(role: Column) -> Column:
        user = F.concat(F.lit("<|user name="), _name(role), F.lit("|>\n"))
        own = F.when(role == speaker, F.lit("<|assistant|>\n"))
        if silent:
            own = own.when(role.isin(*silent), F.concat(F.lit("<|"), _name(role), F.lit("|>\n")))
        return own.otherwise(user)

    def rendered(t: Column) -> Column:
        return F.concat(header(t.role), _escaped(t.text), F.lit(END))

    def mask(t: Column) -> Column:
        return F.array(
            F.struct(
                F.lit(False).alias("trained"),
                F.char_length(header(t.role)).alias("chars"),
            ),
            F.struct(
                (t.role == speaker).alias("trained"),
                (F.char_length(_escaped(t.text)) + len(END)).alias("chars"),
            ),
        )

    return both.select(
        "conv_id",
        "speaker",
        "segment",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", rendered), "").alias("text"),
        F.flatten(F.transform("turns", mask)).alias("mask"),
    )


def mask_text(mask: Column) -> Column:
    """A mask as text: ``0:14,1:80,...``, trained or not and characters of each run."""
    run = F.transform(mask, lambda m: F.concat_ws(":", m.trained.cast("int"), m.chars))
    return F.array_join(run, ",")
