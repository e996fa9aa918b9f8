"""Alignment of two tokenizers' ids over the same texts.

Both id lists of a text have cumulative ends in bytes. Each list's ends become a dictionary from end
to index; the intersection of the two key sets are the places where both tokenizers cut. Sorted,
these places slice both id lists into groups that cover the same bytes, and each slice gives the link
of its two tokens that end together (no token of either vocabulary is without bytes, so a slice has
one such pair).

Links are counted by id pair over all documents, and each document then learns how often its own
pairs are linked anywhere. The table of pairs is bounded by the two vocabularies, but may be large:
it is broadcast if it has at most ``BROADCAST_PAIRS`` rows, by count, and joined by a shuffle else.

Defined results: texts that are missing or empty, or that one of the tokenizers changes (its tokens'
bytes are not the text's), have no tokens and no groups; rows with missing or repeated ids are
documents like others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm.common import stored
from oreline.llm.tokens import BYTE_BPE, Encoder, Known, encode_units, little, text_runs

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
# Different id pairs up to which their counts are broadcast: 24 bytes each.
BROADCAST_PAIRS = 2_000_000
# Characters that are aligned in one go.
RUN_CHARS = 3_000_000

_SPACE_PIECE = "▁"


class _Tokens:
    """What is known of a vocabulary: its bytes, their numbers, and ids written as text."""

    def __init__(self, entries: list[bytes], between: str, last: str):
        if not all(entries):
            raise ValueError("an entry of the vocabulary has no bytes")
        self.bytes = pa.array(entries, pa.binary())
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        # Each id as it stands within its group, and as the last of it.
        self.names = [f"{i}{end}".encode() for i in range(len(entries)) for end in (between, last)]


class Pair:
    """Tokenizer A (byte-level, a space put before the text) and B (pieces, which adds its own)."""

    def __init__(self, a: str, b: bytes):
        import sentencepiece

        self.a = Encoder(a, spaced=True, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.known = Known()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # Pieces never reach from a word over the space behind it, so B may be cut at spaces. (Texts
        # with B's own sign for a space may get other ids; they have no tokens here.)
        self.cuts = not any(_SPACE_PIECE in p.lstrip(_SPACE_PIECE) for p in pieces)
        b_bytes = [
            bytes([int(p[3:5], 16)])
            if self.b.is_byte(i)
            else p.replace(_SPACE_PIECE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.tokens_a = _Tokens(self.a.entries(), ",", "|")
        self.tokens_b = _Tokens(b_bytes, ",", ";")
        self.names = pa.array(self.tokens_a.names + self.tokens_b.names, pa.binary())

    def _learn(self, units: list[str]) -> list[bytes]:
        """B puts a space before what it is given, so the unit's own one is left out."""
        found = self.b.encode([u[1:] for u in units], num_threads=1)
        return [little(array("I", ids)) for ids in found]

    def ids_b(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.cuts:
            return encode_units(texts, self.known, self._learn, spaced=True)
        found = self.b.encode(texts.to_pylist(), num_threads=1)
        ends = np.concatenate([[0], np.cumsum([len(ids) for ids in found])])
        return np.array(list(itertools.chain.from_iterable(found)), np.uint32), ends


def _same_bytes(spaced: pa.Array, ids: np.ndarray, ends: np.ndarray, tokens: _Tokens) -> np.ndarray:
    """Of each text, whether the bytes of its tokens are those of a space and the text."""
    data = tokens.bytes.take(pa.array(ids))
    at = np.concatenate([[0], np.cumsum(tokens.sizes[ids])])[ends]
    want, got, text = _offsets(spaced), _buffer(data), _buffer(spaced)
    if np.array_equal(at, want) and got == text:
        return np.ones(len(spaced), bool)
    return np.array(
        [
            got[a:b] == text[c:d]
            for (a, b), (c, d) in zip(
                itertools.pairwise(at.tolist()), itertools.pairwise(want.tolist()), strict=True
            )
        ],
        bool,
    )


def _offsets(texts: pa.Array) -> np.ndarray:
    """Where the values of a string or binary array begin and end, from its first one on."""
    return np.concatenate([[0], np.cumsum(np.array(pc.binary_length(texts), np.int64))])


def _buffer(texts: pa.Array) -> memoryview:
    """The bytes of all values, one after the other."""
    size, (_, places, data) = int(_offsets(texts)[-1]), texts.buffers()
    if not size:
        return memoryview(b"")
    begin = int(np.frombuffer(places, np.int32)[texts.offset])
    return memoryview(data)[begin : begin + size]


class Aligned:
    """Groups of a run of texts.

    ``ids``, ``ends``: of A and of B, ids of all texts and where each text begins and ends.
    ``cuts``: behind each group, the place in the ids of A and of B. ``groups``: where the groups of
    each text begin and end.
    """

    def __init__(self, pair: Pair, texts: pa.Array):
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
        self.ids, self.ends = zip(pair.a.encode_batch(texts), pair.ids_b(texts), strict=True)
        self.sound = np.array(pc.binary_length(texts)) > 0
        for ids, ends, tokens in zip(
            self.ids, self.ends, (pair.tokens_a, pair.tokens_b), strict=True
        ):
            self.sound &= _same_bytes(spaced, ids, ends, tokens)
        reach = [
            np.cumsum(tokens.sizes[ids])
            for ids, tokens in zip(self.ids, (pair.tokens_a, pair.tokens_b), strict=True)
        ]
        cuts, counts = [], []
        for k, sound in enumerate(self.sound.tolist()):
            found = _common(*(self._of(reach[side], side, k) for side in (0, 1))) if sound else ()
            counts.append(len(found[0]) if found else 0)
            if found:
                cuts.append([found[side] + self.ends[side][k] for side in (0, 1)])
        none = np.zeros(0, np.int64)
        self.cuts = [np.concatenate([none, *(c[side] for c in cuts)]) for side in (0, 1)]
        self.groups = np.concatenate([[0], np.cumsum(counts)])

    def _of(self, reach: np.ndarray, side: int, k: int) -> list[int]:
        """Ends of a text's tokens in bytes, from its own start."""
        low, high = self.ends[side][k], self.ends[side][k + 1]
        before = reach[low - 1] if low else 0
        return (reach[low:high] - before).tolist()

    def tokens(self, side: int) -> np.ndarray:
        """Number of tokens of each text."""
        return np.where(self.sound, np.diff(self.ends[side]), 0)

    def links(self) -> np.ndarray:
        """The linked ids of each group: A's in the upper 32 bits, B's in the lower ones."""
        a, b = (self.ids[side][self.cuts[side]].astype(np.int64) for side in (0, 1))
        return a << 32 | b

    def named(self, pair: Pair) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        lasts, items = [], []
        for side, vocabulary in ((0, 0), (1, len(pair.tokens_a.names))):
            mine = np.repeat(self.sound, np.diff(self.ends[side]))
            last = np.zeros(len(mine), bool)
            last[self.cuts[side]] = True
            lasts.append(last[mine])
            items.append(vocabulary + 2 * self.ids[side][mine].astype(np.int64) + last[mine])
        sizes = [np.diff(np.concatenate([[0], np.flatnonzero(x) + 1])) for x in lasts]
        before = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
        places = [
            np.arange(len(items[0])) + np.repeat(before[1][:-1], sizes[0]),
            np.arange(len(items[1])) + np.repeat(before[0][1:], sizes[1]),
        ]
        row = np.empty(len(items[0]) + len(items[1]), np.int64)
        for place, item in zip(places, items, strict=True):
            row[place] = item
        data = pair.names.take(pa.array(row))
        at = _offsets(data)
        ends = at[(before[0] + before[1])[self.groups]].tolist()
        text = _buffer(data)
        return [bytes(text[a : b - 1]) for a, b in itertools.pairwise(ends)]


def _common(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of A's and of B's tokens that end together, in order."""
    index_a = dict(zip(ends_a, range(len(ends_a)), strict=True))
    index_b = dict(zip(ends_b, range(len(ends_b)), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    a, b = (map(index.__getitem__, common) for index in (index_a, index_b))
    return np.fromiter(a, np.int64, len(common)), np.fromiter(b, np.int64, len(common))


@lru_cache(maxsize=1)
def _loaded(key: int, a: str, b: bytes) -> Pair:
    return Pair(a, b)


def _pair(files: Broadcast) -> Pair:
    """The tokenizers of this worker process, kept between tasks."""
    a, b = files.value
    return _loaded(hash((a, b)), a, b)


def _files(spark: SparkSession, a: str, b: str) -> Broadcast:
    """Both tokenizers' files, a few MB, whatever the documents."""
    with open(a, encoding="utf-8") as left, open(b, "rb") as right:
        return spark.sparkContext.broadcast((left.read(), right.read()))


_GROUPED = (
    "a array<int>, b array<int>, "
    "groups array<struct<a_end: int, b_end: int>>, links array<struct<a: int, b: int>>"
)


def _groups(batches: Iterator[pa.RecordBatch], files: Broadcast) -> Iterator[pa.RecordBatch]:
    pair = _pair(files)
    for batch in batches:
        for low, texts in text_runs(batch.column(1), RUN_CHARS):
            found = Aligned(pair, texts)
            spans = [
                pa.array(found.cuts[side] + 1 - np.repeat(found.ends[side][:-1], np.diff(found.groups)),
                         pa.int32()) for side in (0, 1)
            ]
            linked = [pa.array(found.ids[side][found.cuts[side]].astype(np.int32)) for side in (0, 1)]
            at = pa.array(found.groups, pa.int32())
            columns = [
                _lists(found.ids[side], found.ends[side], found.sound) for side in (0, 1)
            ]
            for names, parts in ((("a_end", "b_end"), spans), (("a", "b"), linked)):
                columns.append(pa.ListArray.from_arrays(at, pa.StructArray.from_arrays(parts, list(names))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, len(texts)), *columns],
                ["doc_id", "a", "b", "groups", "links"],
            )


def _lists(ids: np.ndarray, ends: np.ndarray, sound: np.ndarray) -> pa.ListArray:
    parts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
    none = pa.array([[]], parts.type)
    return pa.concat_arrays([parts, none]).take(
        pa.array(np.where(sound, np.arange(len(sound)), len(sound)))
    )


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTE_BPE,
    b: str = PIECE_BPE,
) -> DataFrame:
    """Per document: ids of A and of B, the ends of each group in both lists, and its links."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = pairs.schema["doc_id"].dataType.simpleString()
    run = partial(_groups, files=_files(docs.sparkSession, a, b))
    return pairs.mapInArrow(run, f"doc_id {kind}, {_GROUPED}")


_COUNTED = (
    "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<struct<pair: long, n: int>>"
)


def _counted(batches: Iterator[pa.RecordBatch], files: Broadcast) -> Iterator[pa.RecordBatch]:
    """Numbers of tokens and groups, the digest of the groups, and the different links."""
    pair = _pair(files)
    for batch in batches:
        for low, texts in text_runs(batch.column(1), RUN_CHARS):
            found = Aligned(pair, texts)
            links, pairs, times, sizes = found.links(), [], [], [0]
            for start, end in itertools.pairwise(found.groups.tolist()):
                which, n = np.unique(links[start:end], return_counts=True)
                pairs.append(which)
                times.append(n)
                sizes.append(len(which))
            digests = [
                hashlib.sha256(text).hexdigest() if sound else ""
                for text, sound in zip(found.named(pair), found.sound.tolist(), strict=True)
            ]
            counts = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(pairs)), pa.array(np.concatenate(times).astype(np.int32))],
                ["pair", "n"],
            )
            groups = pa.array(np.diff(found.groups), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, len(texts)),
                    *(pa.array(found.tokens(side), pa.int64()) for side in (0, 1)),
                    groups,
                    groups,
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), counts),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
            )


def pair_counts(counted: DataFrame) -> DataFrame:
    """pair, count (links that hold it, over all documents), best (no pair of its B id has more)."""
    each = stored(
        counted.select(F.explode("pairs").alias("x"))
        .groupBy(F.col("x.pair").alias("pair"))
        .agg(F.sum("x.n").alias("count"))
        .withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))),
        "align-counts",
    )
    most = each.groupBy("b").agg(F.max("count").alias("most"))
    return stored(
        each.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")),
        "align-pairs",
    )


def alignment(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTE_BPE,
    b: str = PIECE_BPE, broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair no other pair of the same B id exceeds in all documents;
    count_sum adds up the counts of the pairs of all links.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    run = partial(_counted, files=_files(docs.sparkSession, a, b))
    counted = stored(
        texts.mapInArrow(run, _COUNTED.format(id=kind)).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "align-counted",
    )
    pairs = pair_counts(counted)
    if pairs.count() <= broadcast_pairs:
        pairs = F.broadcast(pairs)
    links = counted.select("row", F.explode("pairs").alias("x")).select("row", "x.*")
    sums = (
        links.join(pairs, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return counted.drop("pairs").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
