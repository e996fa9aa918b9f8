"""Substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words. Every word goes that a window covers whose words also
start earlier: in a document with a smaller id, or earlier in the same document.

1. Anchors. The smallest hash among the ``ANCHOR``-word runs of a window is its anchor. Equal
   windows have equal anchors, so a window can only recur if its anchor stands in two places.
   Anchors are counted over all documents; about one in seven words is one.
2. Passages are confirmed: windows with a recurring anchor are compared by two 64-bit hashes over
   all documents, and the first place of each that recurs is found. (Two different windows agree by
   chance once in 2**128 pairs.)
3. Automata. Documents are dealt to shards of about ``shard_bytes`` of text. An Aho-Corasick
   automaton is compiled for each shard from the passages that were confirmed among its documents
   (but for those of which it has the first place alone), and all documents of the shard are
   streamed through it, which locates every occurrence. Each
   document is read by one automaton, whatever the number of shards. A passage is a pattern of
   the hashes of its two ten-word halves; a document is read as ten streams of halves, one for
   each place at which a window may start. Occurrences are verified by both hashes.

A passage crosses the network once per shard that has it, so no passage, however common, gathers
its occurrences in one task. Rows of one id are dealt by their texts as well, and rows that are equal
in id and text, if there are any, are worked out once and repeated at the end: no id and no text,
however common, is one shard's work.

Defined results: missing text has no words; rows of one id are one document, and of windows that
start at the same word of it none is earlier; rows without an id come after all others, in order of
a hash of their text; texts of fewer words than a window lose nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import released, stored

WINDOW_WORDS = 20
ANCHOR = 8
HALVES = 2
LETTERS = 4
SHARD_BYTES = 3_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_PASSAGE = "shard int, missing boolean, key long, start int, hash long, more long, n long"
# A passage's letters as one number.
_PLACES = np.uint64(64) ** np.arange(LETTERS * HALVES, dtype=np.uint64)
_RESULT = ("doc_id", "n_words", "n_removed", "kept_text", "kept_sha256")
_KEPT = (
    "doc_id long, copies long, n_words long, n_removed long, kept_text string, kept_sha256 string"
)


def _slices(strings: pa.StringArray) -> list[bytes]:
    """The strings as bytes, cut out of their buffer: several times faster than one by one."""
    if not len(strings):
        return []
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    whole = data.to_pybytes() if data else b""
    return [whole[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class Words:
    """The words of several texts, one after the other, each with a 64-bit number."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        flat = lists.flatten()
        given = pc.not_equal(flat, "")
        # Texts that begin or end with white space give empty words.
        before = np.concatenate([[0], np.cumsum(given.to_numpy(zero_copy_only=False))])
        self.offsets = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        self.words = flat.filter(given)
        coded = self.words.dictionary_encode()
        distinct = _slices(coded.dictionary)
        numbers = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
        codes = coded.indices.to_numpy()
        self.numbers = numbers[codes] if len(codes) else np.empty(0, np.uint64)
        self.sizes = np.diff(self.offsets)
        self.text = np.repeat(np.arange(len(texts)), self.sizes)

    def room(self, window: int) -> np.ndarray:
        """Where a window fits into its text, for each place at which one starts in the whole."""
        n = max(0, len(self.numbers) - window + 1)
        ends = np.repeat(self.offsets[1:], self.sizes)
        return ends[:n] - np.arange(n) >= window

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text as its kept words with one space between."""
        offsets = np.concatenate([[0], np.cumsum(kept)])[self.offsets]
        lists = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), self.words.filter(pa.array(kept))
        )
        return pc.binary_join(lists, " ")


def run_hashes(numbers: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` numbers: a polynomial built by doubling, then mixed."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, done = None, 0
    power, size, base = numbers, 1, _BASE  # hashes of runs of 1, 2, 4, ... numbers; base**size
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                part = power[done : done + n]
                total = part if total is None else total * base + part
                done += size
            if 2 * size > width:
                break
            power = power[:-size] * base + power[size:]
            size, base = 2 * size, base * base
        mixed = (total ^ total >> np.uint64(32)) * _MIX
        return mixed ^ mixed >> np.uint64(29)


def window_hashes(numbers: np.ndarray, width: int) -> np.ndarray:
    """Both hashes of each window, a row each; the second from words that are mixed anew."""
    with np.errstate(over="ignore"):
        again = (numbers ^ numbers >> np.uint64(31)) * _SECOND
    return np.stack([run_hashes(numbers, width), run_hashes(again ^ again >> np.uint64(30), width)])


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over each run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        values, size = choose(values[:-size], values[size:]), 2 * size
    rest = width - size
    return choose(values[:-rest], values[rest:]) if rest else values


def anchors(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor of each window; the places and hashes of all runs that are some window's anchor."""
    fits = words.room(window)
    if not len(fits):
        none = np.empty(0, np.uint64)
        return none, np.empty(0, np.int64), none
    runs = run_hashes(words.numbers, anchor)
    wide = window - anchor + 1
    of_window = _sliding(runs, wide, np.minimum)
    edge = np.zeros(wide - 1, np.uint64)
    # A run is chosen if it equals the anchor of a window around it; anchors never exceed it.
    inside = np.where(fits, of_window, np.uint64(0))
    highest = _sliding(np.concatenate([edge, inside, edge]), wide, np.maximum)
    chosen = np.flatnonzero(highest == runs)
    return of_window, chosen, runs[chosen]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text in its second column."""
    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // most
    ends = [*(np.flatnonzero(np.diff(block)) + 1), len(sizes)]
    for start, end in zip([0, *ends], ends, strict=False):
        yield batch.slice(start, end - start)


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, anchor: int):
    for batch in (piece for whole in batches for piece in _pieces(whole, SHARD_BYTES)):
        words = Words(batch.column(1))
        _, places, grams = anchors(words, window, anchor)
        shards = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shards[words.text[places]], pa.int32()), _signed(grams)], ["shard", "gram"]
        )


def _numbered(docs: pa.Table) -> np.ndarray:
    """Of each row the number of its document, in order of ids, those without an id last."""
    both = np.empty(docs.num_rows, [("missing", bool), ("key", np.int64)])
    both["missing"] = docs.column("missing").to_numpy().astype(bool)
    both["key"] = docs.column("key").to_numpy()
    return np.unique(both, return_inverse=True)[1]


def _words_of(docs: pa.Table) -> Words:
    texts = docs.column("text")
    return Words(pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string()))


def _distinct(hashes: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair of hashes stands first, and how often it stands there."""
    order = np.argsort(hashes, kind="stable")
    one, two = hashes[order], more[order]
    if ((one[1:] == one[:-1]) & (two[1:] != two[:-1])).any():
        order = np.lexsort((more, hashes))  # stable as well
        one, two = hashes[order], more[order]
    new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(order)]
    starts = np.flatnonzero(new)
    return order[starts], np.diff(np.append(starts, len(order)))


def _candidates(key, docs: pa.Table, grams: pa.Table, window: int, anchor: int) -> pa.Table:
    """Of a shard: each window with a recurring anchor, its first place here, and how often."""
    recurring = np.sort(grams.column("gram").to_numpy().view(np.uint64))
    words = _words_of(docs)
    fits = words.room(window)
    of_window = anchors(words, window, anchor)[0]
    at = np.searchsorted(recurring, of_window)
    hit = fits & (at < len(recurring))
    hit[hit] = recurring[at[hit]] == of_window[hit]
    places = np.flatnonzero(hit)
    rows = words.text[places]
    starts = places - words.offsets[rows]
    order = np.lexsort((starts, _numbered(docs)[rows]))
    rows, starts = rows[order], starts[order]
    hashes, more = window_hashes(words.numbers, window)[:, places[order]]
    first, times = _distinct(hashes, more)
    at = pa.array(rows[first])
    return pa.table(
        {
            "shard": pa.array(np.full(len(first), key[0].as_py() or 0, np.int32)),
            "missing": docs.column("missing").combine_chunks().take(at),
            "key": docs.column("key").combine_chunks().take(at),
            "start": pa.array(starts[first].astype(np.int32)),
            "hash": _signed(hashes[first]),
            "more": _signed(more[first]),
            "n": pa.array(times.astype(np.int64)),
        }
    )


class _Automaton:
    """Finds confirmed passages in documents read as streams of halves.

    A half is written as four letters of six bits of its hash: nodes of the trie are searched edge
    by edge, so a small alphabet is fast. Passages that are written alike are kept as a chain.
    """

    def __init__(self, window: int, passages: int):
        self.half = window // HALVES
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.alike = np.full(passages, -1)

    def letters(self, numbers: np.ndarray) -> np.ndarray:
        """A row of letters for the half that starts at each word."""
        bits = np.uint64(64) - np.arange(1, LETTERS + 1, dtype=np.uint64) * np.uint64(6)
        found = run_hashes(numbers, self.half)[:, None] >> bits & np.uint64(63)
        return found.astype(np.uint8)

    def add(self, letters: np.ndarray, starts: np.ndarray, passages: np.ndarray) -> None:
        if not len(passages):
            return
        both = np.concatenate([letters[starts + k * self.half] for k in range(HALVES)], axis=1)
        size = LETTERS * HALVES
        # Each text once, with the first passage that is written so; the others hang on it.
        order = np.argsort(both.astype(np.uint64) @ _PLACES, kind="stable")
        sorted_ = both[order]
        same = np.concatenate([[False], (sorted_[1:] == sorted_[:-1]).all(axis=1)])
        ranked = passages[order]
        self.alike[ranked[:-1][same[1:]]] = ranked[1:][same[1:]]
        first = order[~same]
        text, add = both[first].tobytes().decode("ascii"), self.trie.add_word
        get = self.trie.get if len(self.trie) else None
        for at, passage in zip(range(0, len(text), size), passages[first].tolist(), strict=True):
            key = text[at : at + size]
            if get and (before := get(key, -1)) >= 0:
                self.alike[self._last(passage)] = before
            add(key, passage)

    def _last(self, passage: int) -> int:
        """The end of a chain."""
        while self.alike[passage] >= 0:
            passage = self.alike[passage]
        return passage

    def find(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and passage of each occurrence; one stream for each place a window can start at."""
        starts, values = [], []
        for phase in range(min(self.half, len(letters))):
            stream = letters[phase :: self.half].tobytes().decode("ascii")
            if hits := list(self.trie.iter(stream)):
                ends, found = np.array(hits, np.int64).T
                first = ends - LETTERS * HALVES + 1
                whole = first % LETTERS == 0  # else letters of two halves agree by chance
                starts.append(phase + first[whole] // LETTERS * self.half)
                values.append(found[whole])
        none = np.empty(0, np.int64)
        return np.concatenate([*starts, none]), np.concatenate([*values, none])


def _strip(docs: pa.Table, passages: pa.Table, window: int) -> pa.Table:
    """The documents of a shard without the words that its automaton finds to have come earlier."""
    words, number = _words_of(docs), _numbered(docs)
    fits = words.room(window)
    windows = window_hashes(words.numbers, window)
    hash_ = passages.column("hash").to_numpy().view(np.uint64)
    passage_count = len(hash_)
    # The second hash is read off the passage's own words, which are in this shard.
    hashes = np.stack([hash_, np.zeros(passage_count, np.uint64)])
    starts = passages.column("start").to_numpy().astype(np.int64)
    is_first = passages.column("is_first").to_numpy().astype(bool)
    automaton = _Automaton(window, passage_count)
    letters = automaton.letters(words.numbers)
    home = np.full(passage_count, -1)  # the document that keeps the passage, if it is in this shard
    todo = np.arange(passage_count)
    for turn in _rows_by_key(docs, passages, number):  # one, unless rows share an id
        places = words.offsets[turn[todo]] + starts[todo]
        here = (turn[todo] >= 0) & (places < windows.shape[1])
        here[here] = fits[places[here]] & (windows[0, places[here]] == hash_[todo[here]])
        hashes[1, todo[here]] = windows[1, places[here]]
        automaton.add(letters, places[here], todo[here])
        home[todo[here]] = np.where(is_first[todo[here]], number[turn[todo[here]]], -1)
        todo = todo[~here]
    gone = np.zeros(len(words.numbers) + 1, np.int64)
    if passage_count:
        automaton.trie.make_automaton()
        places, some = automaton.find(letters)
        inside = fits[places]
        places, some = places[inside], some[inside]
        while True:
            sure = (hashes[:, some] == windows[:, places]).all(axis=0)
            other = ~sure & (automaton.alike[some] >= 0)
            if not other.any():
                break
            some[other] = automaton.alike[some[other]]
        places, some = places[sure], some[sure]
        rows = words.text[places]
        kept_here = (home[some] == number[rows]) & (starts[some] == places - words.offsets[rows])
        earlier = np.bincount(places[~kept_here], minlength=len(gone))
        gone += earlier
        gone[window:] -= earlier[: len(gone) - window]
    covered = np.cumsum(gone[:-1]) > 0
    kept = words.joined(~covered)
    removed = np.concatenate([[0], np.cumsum(covered)])[words.offsets]
    digests = [hashlib.sha256(t).hexdigest() for t in _slices(kept)]
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "copies": docs.column("copies"),
            "n_words": pa.array(words.sizes.astype(np.int64)),
            "n_removed": pa.array(np.diff(removed).astype(np.int64)),
            "kept_text": kept,
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


def _rows_by_key(docs: pa.Table, passages: pa.Table, number: np.ndarray) -> Iterator[np.ndarray]:
    """For each passage the first row with its id, then the second, and so on; -1 if there is none."""
    by_number = np.argsort(number, kind="stable")
    sizes = np.bincount(number)
    starts = np.cumsum(sizes) - sizes
    firsts = by_number[starts]  # a row of each document, documents in order
    missing = docs.column("missing").to_numpy().astype(bool)[firsts]
    keys = docs.column("key").to_numpy()[firsts]
    known = int((~missing).sum())
    wanted, lost = (passages.column(c).to_numpy() for c in ("key", "missing"))
    document = np.where(
        lost.astype(bool),
        known + np.searchsorted(keys[known:], wanted),
        np.searchsorted(keys[:known], wanted),
    )
    for turn in range(int(sizes.max(initial=0))):
        there = turn < sizes[document]
        rows = np.full(len(document), -1)
        rows[there] = by_number[starts[document[there]] + turn]
        yield rows


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text, kept_sha256 (of kept words)."""
    if window % HALVES or window < ANCHOR:
        raise ValueError(f"a window takes a multiple of {HALVES} words, {ANCHOR} at least")
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    missing, text = F.col("doc_id").isNull(), F.xxhash64("text")
    key = F.coalesce("doc_id", text)
    told = pairs.groupBy("doc_id", text.alias("of")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")
    )
    all_rows = told.agg(F.sum("bytes").alias("bytes"), F.max("n").alias("most")).first()
    shards = max(1, -(-(all_rows.bytes or 0) // shard_bytes))
    if (all_rows.most or 0) > 1:
        # None of these takes words from another: their windows start at the same words of one document.
        once = pairs.groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
        pairs = stored(once, "distinct-documents")
    else:
        pairs = pairs.withColumn("copies", F.lit(1).cast("long"))
    dealt = pairs.select(
        "doc_id", "copies", "text", missing.alias("missing"), key.alias("key"),
        F.pmod(F.xxhash64(missing, key, text), F.lit(shards)).cast("int").alias("shard"),
    )
    sizes = {"window": window, "anchor": ANCHOR}
    counted = (
        dealt.select("shard", "text")
        .mapInArrow(partial(_anchor_rows, **sizes), "shard int, gram long")
        .groupBy("gram", "shard").agg(F.count("*").alias("n"))
    )
    # At most one row per shard for any anchor, and for any passage.
    everywhere = F.sum("n").over(Window.partitionBy("gram"))
    recurring = stored(
        counted.withColumn("n", everywhere).where("n >= 2").select("shard", "gram"), "anchors"
    )
    by_shard = dealt.groupBy("shard")

    def candidates_of(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _candidates(key, left, right, **sizes)

    candidates = stored(
        by_shard.cogroup(recurring.groupBy("shard")).applyInArrow(candidates_of, _PASSAGE), "passages"
    )
    released(recurring)
    # Rows of one document may lie in several shards: their places differ by where they start.
    same, place = Window.partitionBy("hash", "more"), F.struct("missing", "key", "start")
    # A passage of which a shard has the first place and no other occurrence takes nothing there.
    confirmed = stored(
        candidates.withColumn("first", F.min(place).over(same))
        .withColumn("all", F.sum("n").over(same))
        .withColumn("is_first", place == F.col("first"))
        .where("all >= 2 AND NOT (is_first AND n = 1)")
        .select("shard", "missing", "key", "start", "hash", "is_first"),
        "confirmed",
    )
    released(candidates)

    def strip(left: pa.Table, right: pa.Table) -> pa.Table:
        return _strip(left, right, window)

    kept = by_shard.cogroup(confirmed.groupBy("shard")).applyInArrow(strip, _KEPT)
    if all_rows.most is None or all_rows.most <= 1:
        return kept.select(*_RESULT)
    return kept.select(*_RESULT, F.explode(F.sequence(F.lit(1), "copies"))).select(*_RESULT)
