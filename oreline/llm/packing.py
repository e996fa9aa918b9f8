"""Best-fit packing of token sequences in bulk-synchronous rounds.

Lengths are whole numbers up to the capacity, so documents and gaps are range-sorted by counting: a
piece's place in the order is its length and its rank among the pieces of that length, a gap's its
size and its rank among the gaps of that size. A round is one sweep over the two orders, from the
longest pieces down: each length takes the next gap size at or above it (its successor) that still
has untouched gaps. Conflicts are resolved by rank: the first gap takes the first pieces, as many
of that length as it holds, the next gap the next ones. A length without an untouched successor
waits for gaps that this round has changed, and only what those cannot take opens new sequences.
Then gaps are updated and the next round begins.

The sweep itself reads the two histograms (at most ``capacity`` counts each, whatever the data);
pieces and gaps stay distributed tables, updated and matched by joins. Ranks come from counts per
task and length, so no length, however common, is sorted or numbered in one task.

Defined results: missing text is an empty document, which has its end id alone; rows with missing
or repeated ids are packed like others; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreline.llm.common import stored
from oreline.llm.tokens import BYTE_BPE, definition, encoder, text_runs

CAPACITY = 1_024
END_ID = 2

_PIECE_COLUMNS = "piece int, start long, length long, ids_crc32 long, task int, nth long"
_RUNS = (
    "length long, first long, pieces long, per long, round int, gap long, gap_rank long, "
    "opened long"
)
_MOVES = "gap long, first long, gaps long, to_gap long, to_rank long"


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: Broadcast, capacity: int, end: int):
    """Pieces of each document: the first one takes the remainder, the others are full."""
    encode, tail = encoder(tokenizer).encode_batch, np.array([end], "<u4").tobytes()
    task, seen = TaskContext.get().partitionId(), Counter()
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    for batch in batches:
        for low, texts in text_runs(batch.column(1)):
            ids, ends = encode(texts)
            data, at, rows = memoryview(ids.astype("<u4").tobytes()), [], []
            for i, (first, last) in enumerate(itertools.pairwise(ends.tolist()), low):
                total = last - first + 1
                start, length = 0, total % capacity or capacity
                piece = 0
                while start < total:
                    # The end id stands behind the text's own ids, in the last piece.
                    behind = start + length == total
                    part = data[4 * (first + start) : 4 * (first + start + length - behind)]
                    crc = zlib.crc32(tail, zlib.crc32(part)) if behind else zlib.crc32(part)
                    rows.append((piece, start, length, crc, task, seen[length]))
                    at.append(i)
                    seen[length] += 1
                    start, length, piece = start + length, capacity, piece + 1
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), *columns],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE,
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the place among pieces of that length, stored."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut = partial(
        _pieces, tokenizer=definition(docs.sparkSession, tokenizer), capacity=capacity, end=end_id
    )
    kind = pairs.schema["doc_id"].dataType.simpleString()
    return stored(pairs.mapInArrow(cut, f"doc_id {kind}, {_PIECE_COLUMNS}"), "pieces")


def _ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces with their rank among those of equal length; the number of pieces of each length."""
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-bases"
    )
    sizes = bases.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    ranked = pieces.join(bases.drop("n"), ["length", "task"]).withColumn(
        "rank", F.col("base") + F.col("nth")
    )
    return stored(ranked.drop("base", "nth", "task"), "ranked"), {r.length: r.n for r in sizes}


class _Sweep:
    """One round over the histograms; ``runs`` of pieces, and ``moves`` of gaps from size to size.

    A run is (length, first rank, pieces, pieces per gap, gap size or None, first gap rank, first
    new sequence or None).
    """

    def __init__(self, waiting: dict[int, list[int]], gaps: dict[int, int], capacity: int,
                 sequences: int):
        self.waiting, self.gaps, self.capacity, self.sequences = waiting, gaps, capacity, sequences
        self.taken, self.runs, self.moves = Counter(), [], []
        self.changed = Counter()  # gaps by the size that this round has given them

    def _put(self, length: int, pieces: int, per: int, gap: int | None) -> None:
        """Whole loads of ``per`` pieces, then what is left over as a load of its own."""
        for loads, load in ((pieces // per, per), (1, pieces % per)):
            if not loads or not load:
                continue
            first, n = self.waiting[length][0], loads * load
            to_gap = (self.capacity if gap is None else gap) - load * length
            if gap is None:
                self.runs.append((length, first, n, load, None, None, self.sequences))
                self.sequences += loads
            else:
                self.runs.append((length, first, n, load, gap, self.taken[gap], None))
                self.moves.append((gap, self.taken[gap], loads, to_gap))
                self.taken[gap] += loads
            self.changed[to_gap] += loads
            self.waiting[length][0] += n
            self.waiting[length][1] -= n

    def run(self) -> None:
        promised = 0
        for length in sorted(self.waiting, reverse=True):
            for gap in sorted(g for g in self.gaps if g >= length):  # successors, nearest first
                pieces, free = self.waiting[length][1], self.gaps[gap] - self.taken[gap]
                if pieces and free:
                    per = gap // length
                    self._put(length, min(pieces, free * per), per, gap)
            room = sum(n * (g // length) for g, n in self.changed.items() if g >= length)
            wait = min(self.waiting[length][1], max(0, room - promised))
            promised += wait
            surplus = self.waiting[length][1] - wait
            if surplus:
                self._put(length, surplus, self.capacity // length, None)

    def after(self) -> tuple[dict[int, int], list[tuple]]:
        """Gaps of the next round, and the moves with their ranks there. Untouched gaps go first."""
        now = Counter({g: n - self.taken[g] for g, n in self.gaps.items()})
        moves = [(g, self.taken[g], n, g, 0) for g, n in now.items() if n]
        for gap, first, loads, to_gap in self.moves:
            moves.append((gap, first, loads, to_gap, now[to_gap]))
            now[to_gap] += loads
        return now, moves


def _opened(pieces: DataFrame, runs: DataFrame, capacity: int) -> DataFrame:
    """sequence_id, left (its gap) of the sequences that a round opens, from their first pieces."""
    return (
        pieces.join(F.broadcast(runs.where("opened is not null")), "length")
        .where("rank >= first and rank < first + pieces and (rank - first) % per = 0")
        .select(
            (F.col("opened") + F.expr("(rank - first) div per")).alias("sequence_id"),
            (F.lit(capacity) - F.col("per") * F.col("length")).alias("gap"),
            (F.col("to_rank") + F.expr("(rank - first) div per")).alias("rank"),
        )
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of :func:`token_pieces` with sequence_id and offset."""
    spark: SparkSession = pieces.sparkSession
    ranked, sizes = _ranked(pieces)
    waiting = {length: [0, n] for length, n in sizes.items()}
    gaps: dict[int, int] = {}
    sequences, number = 0, 0
    all_runs, matched = [], []
    bins = spark.createDataFrame([], "sequence_id long, gap long, rank long")
    while any(n for _, n in waiting.values()):
        sweep = _Sweep({k: v for k, v in waiting.items() if v[1]}, gaps, capacity, sequences)
        sweep.run()
        after, moves = sweep.after()
        least = min((k for k, v in waiting.items() if v[1]), default=capacity + 1)
        runs = []
        for length, first, n, per, gap, gap_rank, opened in sweep.runs:
            to_rank = None
            if opened is not None:
                left = capacity - per * length
                to_rank = after[left]
                after[left] += n // per
            runs.append((length, first, n, per, number, gap, gap_rank, opened, to_rank))
        all_runs += [r[:-1] for r in runs]
        if gaps:
            matched.append(bins.withColumn("round", F.lit(number)))
        if any(n for _, n in waiting.values()):
            # Bounded by the capacity: a sweep ends a length or a gap size with every run.
            moved = spark.createDataFrame(moves, _MOVES)
            kept = (
                bins.join(F.broadcast(moved), "gap")
                .where("rank >= first and rank < first + gaps")
                .select(
                    "sequence_id", F.col("to_gap").alias("gap"),
                    (F.col("to_rank") + F.col("rank") - F.col("first")).alias("rank"),
                )
            )
            fresh = _opened(
                ranked.select("length", "rank"),
                spark.createDataFrame(runs, f"{_RUNS}, to_rank long"), capacity,
            )
            bins = stored(kept.unionByName(fresh).where(F.col("gap") >= least), "gaps")
            gaps = {g: n for g, n in after.items() if g >= least and n}
        sequences, number = sweep.sequences, number + 1
    return _placed(ranked, spark.createDataFrame(all_runs, _RUNS), matched, capacity)


def _placed(ranked: DataFrame, runs: DataFrame, matched: list[DataFrame], capacity: int):
    """Every piece finds its run by length and rank, and through the run its gap by rank."""
    within = F.col("rank") - F.col("first")
    found = (
        ranked.join(F.broadcast(runs), "length")
        .where("rank >= first and rank < first + pieces")
        .withColumn("load", within - within % F.col("per"))
        .withColumn("load", (F.col("load") / F.col("per")).cast("long"))
        .withColumn("slot", within % F.col("per"))
    )
    opening = found.where("gap is null").select(
        *_RESULT, (F.col("opened") + F.col("load")).alias("sequence_id"),
        (F.col("slot") * F.col("length")).alias("offset"),
    )
    if not matched:
        return opening
    bins = matched[0]
    for more in matched[1:]:
        bins = bins.unionByName(more)
    fitted = (
        found.where("gap is not null")
        .select(*_RESULT, "round", "gap", (F.col("gap_rank") + F.col("load")).alias("at"),
                (F.lit(capacity) - F.col("gap") + F.col("slot") * F.col("length")).alias("offset"))
        .join(bins.withColumnRenamed("rank", "at"), ["round", "gap", "at"])
        .select(*_RESULT, "sequence_id", "offset")
    )
    return opening.unionByName(fitted)


_RESULT = ("doc_id", "piece", "start", "length", "ids_crc32")


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE,
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, id_col, text_col, tokenizer, capacity, end_id), capacity)
