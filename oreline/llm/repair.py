"""Repair of conversation structure by a rank-convergence parallel Viterbi search.

A repaired conversation has turns that alternate: an optional system turn, then user and assistant
in pairs, or nothing at all. Each row is kept (cost 0), given another role (1) or deleted (2; a must
for blank and repeated rows), empty turns are inserted (5), and a truncated row that stays adds 5.
Of all cheapest repairs the one whose edit initials, in order, are least in ASCII is taken.

The search knows four states: nothing yet, after the system turn, after a user's, after an
assistant's. Its backward costs (what the rest of the conversation costs from each state) go from
the end of a conversation to its start. Rows are range-sorted by conversation and turn, so that a
long conversation lies in many partitions. Each partition starts from the costs that it guesses for
what lies behind it, all at once. Costs of states that differ by a constant choose the same edits,
so a partition is right as soon as its costs equal the true ones up to a constant: fix-up passes run
again from the neighbour's costs, from right to left, only until the costs are those of the pass
before. Where that takes more than a few passes (costs that never converge, as over a million
truncated turns), the partitions give their costs for each state alone, from which any neighbour's
costs follow by minima, and one pass more ends it. Then a pass from left to right traces the edits,
again with partitions stitched by the state in which each one is entered.

The driver sees one row per partition (four costs, four states), whatever the rows. Equal rows of a
conversation are counted first: one row and its copies, which are deleted. Texts move once, to the
task that writes out their conversation; rows stream through it, so none is held in memory.

Defined results: turns are ordered by number (missing first), role, the first characters of the text
and its digest, so ties have an order and repeated rows stand together; a missing role or text is
one space (so such a text is blank); rows without a conversation id are one conversation; an empty
text is blank; a role counts by its first letter; an empty table gives an empty result; other
columns are not read. A conversation's edits are one value of its row, one letter per edit.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import stored

BLANK = " "
# Rows of a sorted partition that are searched as one value.
BLOCK_ROWS = 1_024
# Fix-up passes before the costs of single states are asked for.
FIX_UPS = 3
# Characters of a text by which turns of equal number and role are ordered.
TIE_CHARS = 32

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Where a turn of a role leads to from each state; -1 where it may not stand.
_ON_USER = (USER, USER, -1, USER)
_ON_ASSISTANT = (-1, -1, ASSISTANT, -1)
_ON_SYSTEM = (SYSTEM, -1, -1, -1)
_ON_OTHER = (-1, -1, -1, -1)
_ON = (_ON_OTHER, _ON_SYSTEM, _ON_USER, _ON_ASSISTANT)
_FAR = 1 << 40
# Costs behind the last row: nothing and whole pairs may end, the others insert what is missing.
END = (0, 2 * INSERT, INSERT, 0)

# Edits as they are traced: who is inserted and what a role becomes is part of the letter.
_KEEP, _DELETE = "K", "D"
_INSERT, _REROLE = {USER: "i", ASSISTANT: "j"}, {USER: "r", ASSISTANT: "q"}
AUDIT = str.maketrans("ijrq", "IIRR")
_ROLE = {"i": "user", "j": "assistant", "r": "user", "q": "assistant"}
_COST = {"K": KEEP, "D": DELETE, "i": INSERT, "j": INSERT, "r": REROLE, "q": REROLE}

# A row's code: role initial (2 bits), must go, truncated, first row of its conversation, blank. The
# search sees the lower four bits.
_GONE, _TRUNCATED, _FIRST, _BLANK = 4, 8, 16, 32

_KEY = ("conv_id", "turn", "role", "tie", "digest")


# ---------------------------------------------------------------- search of one row


def _closed(costs: list[int]) -> list[int]:
    """Costs with empty turns inserted where that is cheaper."""
    for _ in range(2):
        user, assistant = costs[USER] + INSERT, costs[ASSISTANT] + INSERT
        costs = [
            min(costs[START], user), min(costs[SYSTEM], user),
            min(costs[USER], assistant), min(costs[ASSISTANT], user),
        ]
    return costs


def _options(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row from a state, apart from inserts, by initial: letter, cost, state behind."""
    found = [(_DELETE, DELETE, state)]
    if not code & _GONE:
        more = TRUNCATED if code & _TRUNCATED else 0
        behind = _ON[code & 3][state]
        if behind >= 0:
            found.append((_KEEP, KEEP + more, behind))
        for role, on in ((USER, _ON_USER), (ASSISTANT, _ON_ASSISTANT)):
            if on[state] >= 0:
                found.append((_REROLE[role], REROLE + more, on[state]))
    return found


def before(code: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of a row from those behind it."""
    return tuple(
        _closed([min(c + costs[t] for _, c, t in _options(code, s)) for s in range(4)])
    )


@lru_cache(maxsize=1 << 16)
def _shifted(code: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of a row up to a constant: the least one is zero."""
    found = before(code, costs)
    least = min(found)
    return tuple(min(c - least, _FAR) for c in found)


@lru_cache(maxsize=1 << 16)
def _edits(code: int, costs: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least edits of a row on a cheapest way from ``state``, and the state behind it."""
    here, letters = before(code, costs), ""
    while True:
        steps = _options(code, state)
        on = USER if state != USER else ASSISTANT
        options = [steps[0], (_INSERT[on], INSERT, on), *steps[1:]]  # D, I, K, R
        for letter, cost, behind in options:
            inserted = letter in "ij"
            if cost + (here if inserted else costs)[behind] == here[state]:
                break
        letters, state = letters + letter, behind
        if not inserted:
            return letters, state


def _ending(state: int) -> str:
    return {START: "", SYSTEM: "ij", USER: "j", ASSISTANT: ""}[state]


# ---------------------------------------------------------------- rows in order


def _rows(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(BLANK))
    return turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(BLANK)).alias("role"),
        text.alias("text"),
        F.substring(text, 1, TIE_CHARS).alias("tie"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def _faults(rows: DataFrame) -> DataFrame:
    """One row per different row of a conversation: key, n, blank, again, truncated."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    counted = (
        rows.select(*_KEY, last.alias("last"))
        .groupBy(*_KEY, "last")
        .agg(F.count("*").alias("n"))
        .withColumn("blank", F.col("last") == "")
        .withColumn("at", F.struct(F.col("turn").isNotNull(), F.col("turn")))
    )
    counted = stored(counted, "repair-rows")
    # Only texts that more than one turn has can repeat an earlier one.
    first = (
        counted.where(~F.col("blank"))
        .groupBy("conv_id", "role", "digest")
        .agg(F.min("at").alias("first"), F.count("*").alias("turns"))
        .where("turns > 1")
        .toDF("_c", "_r", "_d", "first", "turns")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("_c"))
        & (F.col("role") == F.col("_r"))
        & (F.col("digest") == F.col("_d"))
    )
    again = ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    return counted.join(first, same, "left").select(
        *_KEY, "n", "blank", again.alias("again"), (~F.col("last").isin(*".!?")).alias("truncated")
    )


def _code(initial: Column) -> Column:
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    gone = F.when(F.col("blank") | F.col("again"), _GONE).otherwise(0)
    blank = F.when(F.col("blank"), _BLANK).otherwise(0)
    return kind + gone + F.when(F.col("truncated"), _TRUNCATED).otherwise(0) + blank


_BLOCK = "part int, block int, codes binary, counts binary, keys array<struct<{key}>>"


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows: codes, counts and keys.

    The first row of a partition is marked as the first of a conversation, which may be wrong.
    """
    part, number, last = TaskContext.get().partitionId(), 0, ()
    for batch in batches:
        conv = batch.column("conv_id").to_pylist()
        codes = np.array(batch.column("code"), np.uint8)
        for i, c in enumerate(conv):
            if (c,) != last:
                codes[i] |= _FIRST
                last = (c,)
        counts = np.array(batch.column("n"), "<i8")
        keys = pa.StructArray.from_arrays([batch.column(k) for k in _KEY], list(_KEY))
        for low in range(0, len(conv), size):
            high = min(low + size, len(conv))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([codes[low:high].tobytes()]),
                    pa.array([counts[low:high].tobytes()]),
                    pa.ListArray.from_arrays([0, high - low], keys.slice(low, high - low)),
                ],
                ["part", "block", "codes", "counts", "keys"],
            )
            number += 1


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in order, packed in blocks of a partition: part, block, codes, counts, keys."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "tie", "digest"]
    narrow = rows.select(*_KEY, "n", _code(F.substring("role", 1, 1)).cast("int").alias("code"))
    kinds = ", ".join(f"{k}: {rows.schema[k].dataType.simpleString()}" for k in _KEY)
    narrow = stored(narrow, "repair-faults")
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(
        ordered.mapInArrow(partial(_packed, size=size), _BLOCK.format(key=kinds)), "repair-blocks"
    )


def _continued(blocks: DataFrame) -> frozenset[int]:
    """Partitions that begin with a row of the conversation that the one before ends with."""
    edges = blocks.select(
        "part", "block", F.get("keys", F.lit(0))["conv_id"].alias("first"),
        F.element_at("keys", -1)["conv_id"].alias("last"),
    )
    # One row per partition.
    ends = edges.groupBy("part").agg(
        F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last")
    )
    rows = sorted(ends.collect())
    return frozenset(b.part for a, b in itertools.pairwise(rows) if a.last == b.first)


def _marked(codes: bytes, part: int, block: int, continued: frozenset[int]) -> bytes:
    if block or part not in continued:
        return codes
    return bytes([codes[0] & ~_FIRST]) + codes[1:]


# ---------------------------------------------------------------- passes over partitions

_COSTS = "part int, block int, right array<long>, left array<long>"


def _backward(
    batches: Iterator[pa.RecordBatch], behind: dict[int, tuple[int, ...]], continued: frozenset[int]
) -> Iterator[pa.RecordBatch]:
    """Costs up to a constant at both ends of each block, blocks from the last to the first.

    ``old`` are those of the pass before: once the same, the rest of the partition stays as it was.
    """
    costs, at, same = END, None, False
    for batch in batches:
        rows = []
        for part, block, codes, right, left in zip(
            *(batch.column(k).to_pylist() for k in ("part", "block", "codes", "right", "left")),
            strict=True,
        ):
            if part != at:
                at, costs, same = part, behind[part], False
            same = same or (right is not None and tuple(right) == costs)
            if same:
                rows.append((part, block, right, left))
                continue
            start = costs
            for code in reversed(_marked(codes, part, block, continued)):
                # In front of the first row of a conversation lies the end of another one.
                costs = END if code & _FIRST else _shifted(code & 15, costs)
            rows.append((part, block, list(start), list(costs)))
        yield _record(rows, ("part", "block", "right", "left"), _COSTS_ARROW)


_COSTS_ARROW = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))


def _record(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names)
    )


def _alone(
    batches: Iterator[pa.RecordBatch], continued: frozenset[int]
) -> Iterator[pa.RecordBatch]:
    """For each partition, and each state alone behind it: the costs in front of it."""
    done: dict[int, list[tuple[int, ...]]] = {}
    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in ("part", "block", "codes"))
        for part, block, codes in zip(*columns, strict=True):
            if part not in done:
                done[part] = [tuple(0 if s == t else _FAR for s in range(4)) for t in range(4)]
            for code in reversed(_marked(codes, part, block, continued)):
                done[part] = [before(code & 15, c) for c in done[part]]
                if code & _FIRST:
                    done[part] = [END] * 4
    rows = [(part, [c for costs in each for c in costs]) for part, each in done.items()]
    if rows:
        yield _record(rows, ("part", "costs"), (pa.int32(), pa.list_(pa.int64())))


def _shift(costs: list[int]) -> tuple[int, ...]:
    return tuple(c - min(costs) for c in costs)


def _in_parts(blocks: DataFrame, *columns: str, last_first: bool = False) -> DataFrame:
    """The blocks of each partition in one task, in order."""
    block = F.desc("block") if last_first else F.asc("block")
    narrow = blocks.select("part", "block", *columns)
    return narrow.repartition("part").sortWithinPartitions("part", block)


def _searched(blocks: DataFrame, fix_ups: int, continued: frozenset[int]) -> DataFrame:
    """part, block, right: the costs behind each block, up to a constant."""
    codes = blocks.select("part", "block", "codes")
    # One row per partition, here and below.
    parts = sorted(r.part for r in codes.select("part").distinct().collect())
    behind = dict.fromkeys(parts, END)
    none = F.lit(None).cast("array<long>")
    table = codes.select("part", "block", none.alias("right"), none.alias("left"))
    todo, passes = parts, 0
    while True:
        old = table.where(F.col("part").isin(todo))
        run = partial(_backward, behind={p: behind[p] for p in todo}, continued=continued)
        given = codes.join(old, ["part", "block"])
        found = stored(
            _in_parts(given, "codes", "right", "left", last_first=True).mapInArrow(run, _COSTS),
            "repair-costs",
        )
        table = table.where(~F.col("part").isin(todo)).unionByName(found) if passes else found
        passes += 1
        heads = table.where("block = 0").select("part", "left").collect()
        left = {r.part: tuple(r.left) for r in heads}
        want = {p: left[q] for p, q in itertools.pairwise(parts)}
        if passes > fix_ups:
            want = _stitched(codes, parts, continued)
        todo = [p for p in parts[:-1] if want[p] != behind[p]]
        if not todo:
            return table.select("part", "block", "right")
        behind |= want


def _stitched(
    codes: DataFrame, parts: list[int], continued: frozenset[int]
) -> dict[int, tuple[int, ...]]:
    """The true costs behind each partition, from what each one makes of single states."""
    run = _in_parts(codes, "codes", last_first=True).mapInArrow(
        partial(_alone, continued=continued), "part int, costs array<long>"
    )
    alone = {r.part: np.array(r.costs, "<i8").reshape(4, 4) for r in run.collect()}
    want = {}
    costs = END
    for part in reversed(parts):
        want[part] = costs
        costs = _shift((np.array(costs)[:, None] + alone[part]).min(0).tolist())
    return want


def _costs_in(codes: bytes, right: list[int]) -> list[tuple[int, ...]]:
    """Costs behind each row of a block."""
    out, costs = [END] * len(codes), tuple(right)
    for i in range(len(codes) - 1, -1, -1):
        out[i], code = costs, codes[i]
        costs = END if code & _FIRST else _shifted(code & 15, costs)
    return out


def _exits(
    batches: Iterator[pa.RecordBatch], continued: frozenset[int]
) -> Iterator[pa.RecordBatch]:
    """For each partition the state in which each state of entry leaves it."""
    done: dict[int, list[int]] = {}
    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in ("part", "block", "codes", "right"))
        for part, block, codes, right in zip(*columns, strict=True):
            codes = _marked(codes, part, block, continued)
            states = done.get(part, [START, SYSTEM, USER, ASSISTANT])
            # Only what comes after the last start of a conversation leaves the partition.
            marks = np.flatnonzero(np.frombuffer(codes, np.uint8) & _FIRST)
            low = int(marks[-1]) if len(marks) else 0
            if len(marks):
                states = [START] * 4
            for code, costs in zip(codes[low:], _costs_in(codes, right)[low:], strict=True):
                known = {s: _edits(code & 15, costs, s)[1] for s in set(states)}
                states = [known[s] for s in states]
            done[part] = states
    rows = list(done.items())
    if rows:
        yield _record(rows, ("part", "exits"), (pa.int32(), pa.list_(pa.int32())))


_TRACE = (
    "conv_id {id}, turn long, role string, tie string, digest binary, n long, code int, "
    "edits string, state int"
)


def _trace(
    batches: Iterator[pa.RecordBatch], entries: dict[int, int], continued: frozenset[int]
) -> Iterator[pa.RecordBatch]:
    """Each row with its edits and the state behind it."""
    at, state = None, START
    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in ("part", "block", "codes", "right"))
        edits, states = [], []
        for part, block, codes, right in zip(*columns, strict=True):
            codes = _marked(codes, part, block, continued)
            if part != at:
                at, state = part, entries[part]
            for code, costs in zip(codes, _costs_in(codes, right), strict=True):
                if code & _FIRST:
                    state = START
                letters, state = _edits(code & 15, costs, state)
                edits.append(letters)
                states.append(state)
        keys = batch.column("keys").flatten()
        codes = b"".join(batch.column("codes").to_pylist())
        counts = b"".join(batch.column("counts").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                *(keys.field(k) for k in range(len(_KEY))),
                pa.array(np.frombuffer(counts, "<i8"), pa.int64()),
                pa.array(np.frombuffer(codes, np.uint8).astype(np.int32)),
                pa.array(edits, pa.string()),
                pa.array(states, pa.int32()),
            ],
            [*_KEY, "n", "code", "edits", "state"],
        )


def _traced(blocks: DataFrame, fix_ups: int) -> DataFrame:
    """The rows of all blocks with their edits."""
    continued = _continued(blocks)
    costs = _searched(blocks, fix_ups, continued)
    both = blocks.join(costs, ["part", "block"])
    run = _in_parts(both, "codes", "right").mapInArrow(
        partial(_exits, continued=continued), "part int, exits array<int>"
    )
    exits = {r.part: r.exits for r in run.collect()}  # one row per partition
    entries, state = {}, START
    for part in sorted(exits):
        entries[part] = state
        state = exits[part][state]
    kind = blocks.schema["keys"].dataType.elementType["conv_id"].dataType.simpleString()
    return _in_parts(both, "codes", "counts", "right", "keys").mapInArrow(
        partial(_trace, entries=entries, continued=continued), _TRACE.format(id=kind)
    )


# ---------------------------------------------------------------- conversations written out


def _streamed(rows: DataFrame, traced: DataFrame) -> DataFrame:
    """Rows with edits, each followed by its text, the conversations of a task one after another."""
    texts = rows.where(F.col("text") != "").select(*_KEY, "text")
    both = traced.withColumn("text", F.lit(None).cast("string")).unionByName(
        texts, allowMissingColumns=True
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "tie", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order, F.col("edits").isNull())


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, turn, role, n, code, edits, state, text), rows of a conversation in order."""
    names = (*_KEY, "n", "code", "edits", "state", "text")
    held = None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in names), strict=True):
            conv, turn, role, _, _, n, code, edits, state, text = row
            if edits is not None:
                if held is not None:
                    yield held
                held = (conv, turn, role, n, code, edits, state, "")
            elif held is not None and held[-1] == "":
                held = (*held[:-1], text)
    if held is not None:
        yield held


def _edited(turn: tuple) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of a row: what is inserted before it, the row, and its copies."""
    _, _, role, n, _, edits, _, text = turn
    for e in edits:
        if e in "ij":
            yield e, _ROLE[e], ""
        elif e == _DELETE:
            yield e, None, None
        else:
            yield e, _ROLE.get(e, role), text
    for _ in range(n - 1):
        yield _DELETE, None, None


def _typed(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType, Iterator[pa.RecordBatch]]:
    """The type of conversation ids, and the batches."""
    first = next(batches, None)
    if first is None:
        return pa.null(), iter(())
    return first.schema.field("conv_id").type, itertools.chain([first], batches)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, batches = _typed(batches)
    names = ("conv_id", "place", "edit", "role", "text")
    kinds = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
    rows, size = [], 0
    for conv, turns in itertools.groupby(_turns(batches), key=lambda t: t[0]):
        place, state = 0, START
        for turn in turns:
            state = turn[6]
            for edit, role, text in _edited(turn):
                rows.append((conv, place, edit.translate(AUDIT), role, text))
                place, size = place + 1, size + len(text or "")
                if len(rows) >= 4096 or size > 4_000_000:
                    yield _record(rows, names, kinds)
                    rows, size = [], 0
        for e in _ending(state):
            rows.append((conv, place, e.translate(AUDIT), _ROLE[e], ""))
            place += 1
    if rows:
        yield _record(rows, names, kinds)


class _Report:
    """Counts, audit and digest of one conversation, row after row."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit, self.digest, self.lines = [], hashlib.sha256(), 0
        self.low = self.high = self.initial = None
        self.turns = self.state = 0

    def line(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def add(self, turn: tuple, initial: str, blank: bool) -> None:
        _, number, _, n, code, edits, state, text = turn
        if number is not None and number != self.high:
            self.low = number if self.low is None else self.low
            self.high, self.turns = number, self.turns + 1
        fresh = not code & _GONE
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - fresh
        self.truncated += 1 if fresh and code & _TRUNCATED else 0
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.illegal += n - 1
        self.initial, self.state = initial, state
        for edit, role, said in _edited((*turn[:3], 1, *turn[4:])):
            self.cost += _COST[edit]
            if role is not None:
                self.line(role, said)
                self.cost += TRUNCATED if edit in "Krq" and code & _TRUNCATED else 0
        self.cost += DELETE * (n - 1)
        self.audit.append(edits.translate(AUDIT) + _DELETE * (n - 1))

    def row(self, conv) -> tuple:
        for edit in _ending(self.state):
            self.cost += INSERT
            self.audit.append("I")
            self.line(_ROLE[edit], "")
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (
            conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            "".join(self.audit), self.digest.hexdigest(),
        )


_REPORT = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    "repaired_sha256",
)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, batches = _typed(batches)
    kinds = (kind, *[pa.int64()] * 6, pa.string(), pa.string())
    rows = []
    for conv, turns in itertools.groupby(_turns(batches), key=lambda t: t[0]):
        report = _Report()
        for turn in turns:
            report.add(turn, turn[2][:1], bool(turn[4] & _BLANK))
        rows.append(report.row(conv))
        if len(rows) == 1024:
            yield _record(rows, _REPORT, kinds)
            rows = []
    if rows:
        yield _record(rows, _REPORT, kinds)


def _run(
    turns: DataFrame, write: Callable, schema: str, names: tuple[str, ...], block_rows: int,
    fix_ups: int,
) -> DataFrame:
    rows = _rows(turns, *names)
    blocks = _blocks(_faults(rows), block_rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _streamed(rows, _traced(blocks, fix_ups)).mapInArrow(write, schema.format(id=kind))


def repair(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", block_rows: int = BLOCK_ROWS, fix_ups: int = FIX_UPS,
) -> DataFrame:
    """One row per edit: conv_id, place, edit (K, R, D, I), role and text (null if deleted)."""
    schema = "conv_id {id}, place long, edit string, role string, text string"
    names = (id_col, turn_col, role_col, text_col)
    return _run(turns, _repaired, schema, names, block_rows, fix_ups)


def audits(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", block_rows: int = BLOCK_ROWS, fix_ups: int = FIX_UPS,
) -> DataFrame:
    """One row per conversation: faults, cost, edits, and the digest of the repaired turns.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    schema = (
        "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string, repaired_sha256 string"
    )
    names = (id_col, turn_col, role_col, text_col)
    return _run(turns, _reports, schema, names, block_rows, fix_ups)


# ---------------------------------------------------------------- damage, for trials


def damaged(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows with faults by the CRC-32 of ``id:turn`` modulo 20; missing values are one space.

    0 drops a row, 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it a
    user's.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(BLANK)) for c in (id_col, turn_col)]
    kind = F.crc32(F.encode(F.concat_ws(":", *named), "UTF-8")) % 20
    role = F.coalesce(F.col(role_col), F.lit(BLANK))
    text = F.coalesce(F.col(text_col), F.lit(BLANK))
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        kind.alias("_kind"),
    ).where("_kind != 0")
    again = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_copy", F.explode(again)).drop("_kind", "_copy")


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """Damage, repair and report of every conversation, also of those of which no row is left."""
    found = audits(damaged(turns))
    everyone = turns.select(F.col("conv_id").alias("_conv")).distinct()
    joined = everyone.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in _REPORT[1:7]]
    return joined.select(
        F.col("_conv").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
