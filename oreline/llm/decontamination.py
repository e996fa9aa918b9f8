"""Benchmark decontamination by greedy string tiling.

Words are compared case-folded, without outer punctuation. A document and a benchmark item are
compared if they share seeds (five words in a row); the seeds of a block of items are indexed and
sent to every task, and each document looks its own five-word runs up as it is read, so nothing is
shuffled. Blocks hold at most ``block_words`` words; a benchmark of several blocks takes one pass
over the documents for each.

Seeds that many items share do not set off a tiling each: how much of an item its shared seeds could
cover is counted for all items of the block at once, and only items that can reach the threshold are
tiled, best first, until no other can be better.

Tiling: the longest matches of unmarked words that do not overlap are marked first, then shorter
ones, down to five words. Matches of a length are found by comparing rolling Karp-Rabin hashes of
both sides, verified word by word and extended. Tiles may stand in any order, so passages that have
been rearranged are found too. A document is contaminated if the tiles cover at least 0.8 of an
item's words. With ``longest`` one tile of that many words is enough too, whatever its share of a long
item.

Defined results: missing or empty texts match nothing, nor do items without words; items of fewer than
five words have no seed and are found in documents that consist of just their words; of equally
covered items the one that comes first by id is named; repeated rows and ids are judged row by row; an
empty table of documents gives no rows, an empty benchmark finds nothing; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import fresh_name, released, stored

SEED_WORDS = 5
COVERAGE = 0.8
BLOCK_WORDS = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BARE = re.compile(r"\w+(?:\W+\w+)*")
_KNOWN_WORDS = 300_000
_FOUND = "item_id long, coverage double, matched_words int, tiles int, longest int"


class _Numbers:
    """64-bit numbers of raw words; 0 for words of punctuation alone. What is kept is bounded."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        raw = text.casefold().split()
        known = self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for word in {w for w in raw if w not in known}:
            found = _BARE.search(word)
            known[word] = xxhash.xxh64_intdigest(found.group()) | 1 if found else 0
        numbers = np.array([known[w] for w in raw], np.uint64)
        return numbers[numbers != 0]


def rolling(numbers: np.ndarray, width: int) -> np.ndarray:
    """The Karp-Rabin hash of each run of ``width`` numbers, modulo 2**64."""
    if len(numbers) < width:
        return np.empty(0, np.uint64)
    total = numbers[: len(numbers) - width + 1].copy()
    for k in range(1, width):
        total = total * _BASE + numbers[k : len(numbers) - width + 1 + k]
    return total


def _free_runs(marked: np.ndarray, width: int) -> np.ndarray:
    """Starts of runs of ``width`` unmarked words."""
    if len(marked) < width:
        return np.empty(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(sums[width:] == sums[:-width])


def _matches(item, text, item_marked, text_marked, width: int) -> list[tuple[int, int, int]]:
    """(length, item start, text start) of maximal unmarked matches of at least ``width`` words."""
    places = defaultdict(list)
    hashes = rolling(text, width)
    for t in _free_runs(text_marked, width):
        places[int(hashes[t])].append(int(t))
    hashes = rolling(item, width)
    found = []
    for i in map(int, _free_runs(item_marked, width)):
        for t in places.get(int(hashes[i]), ()):
            before = i and t and item[i - 1] == text[t - 1]
            if before and not item_marked[i - 1] and not text_marked[t - 1]:
                continue  # part of a match that starts earlier
            n = 0
            while (
                i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n]
                and not item_marked[i + n] and not text_marked[t + n]
            ):
                n += 1
            if n >= width:  # else the hashes agree by chance
                found.append((n, i, t))
    return found


def tile(item: np.ndarray, text: np.ndarray, shortest: int = SEED_WORDS) -> list[tuple]:
    """Tiles (length, item start, text start), longest first, that do not overlap."""
    item_marked, text_marked = np.zeros(len(item), bool), np.zeros(len(text), bool)
    tiles = []
    width = max(shortest, min(len(item), len(text)))
    while len(item) >= shortest and len(text) >= shortest:
        again = False
        for n, i, t in sorted(
            _matches(item, text, item_marked, text_marked, width), key=lambda m: (-m[0], m[1], m[2])
        ):
            if item_marked[i : i + n].any() or text_marked[t : t + n].any():
                again = True  # what is left of it may still be long enough
                continue
            item_marked[i : i + n] = text_marked[t : t + n] = True
            tiles.append((n, i, t))
        if again:
            continue
        if width == shortest:
            break
        width = max(shortest, width // 2)
    return tiles


@dataclass
class Items:
    """A block of benchmark items with an index of their seeds."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray  # sorted
    places: np.ndarray  # the place of each seed among the words of all items
    owners: np.ndarray  # item of each of these words
    sizes: np.ndarray  # words of each item
    short: dict[bytes, int]  # items without seeds: their words to the first of them

    @classmethod
    def of(cls, rows: list[tuple], shortest: int = SEED_WORDS) -> Items:
        numbers = _Numbers()
        return cls.numbered([i for i, _ in rows], [numbers(text or "") for _, text in rows], shortest)

    @classmethod
    def numbered(cls, ids: list, words: list[np.ndarray], shortest: int = SEED_WORDS) -> Items:
        seeds = [rolling(w, shortest) for w in words]
        flat = np.concatenate([*seeds, np.empty(0, np.uint64)])
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        places = np.concatenate(
            [*(at + np.arange(len(s)) for at, s in zip(starts, seeds, strict=True)), np.empty(0)]
        ).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        short: dict[bytes, int] = {}
        for k in np.flatnonzero((sizes > 0) & (sizes < shortest)).tolist():
            short.setdefault(words[k].tobytes(), k)
        return cls(
            ids, words, flat[order], places[order],
            np.repeat(np.arange(len(words)), sizes), sizes, short,
        )

    def candidates(
        self, text: np.ndarray, least: float, longest: int | None = None, shortest: int = SEED_WORDS
    ) -> list[tuple[float, int, np.ndarray]]:
        """(bound of the coverage, item, places in the text of its seeds), most first.

        Tiles consist of shared seeds, so what the seeds of an item cover is a bound for its tiles.
        """
        hashes = rolling(text, shortest)
        low = np.searchsorted(self.seeds, hashes)
        common = low < len(self.seeds)
        common[common] = self.seeds[low[common]] == hashes[common]
        if not common.any():
            return []
        shared, which = np.unique(hashes[common], return_inverse=True)
        low = np.searchsorted(self.seeds, shared, "left")
        times = np.searchsorted(self.seeds, shared, "right") - low
        # Every place of a shared seed in any item, once, in order of items and places.
        at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        places = np.sort(self.places[at])
        owners = self.owners[places]
        same = owners[1:] == owners[:-1]
        step = np.where(same, places[1:] - places[:-1], shortest)
        covered = np.append(np.minimum(step, shortest), shortest)
        firsts = np.flatnonzero(np.append(True, ~same))
        reach = np.add.reduceat(covered, firsts)
        sizes = self.sizes[owners[firsts]]
        able = reach >= least * sizes
        if longest is not None:
            stretch = np.cumsum(np.append(True, ~same | (step > 1)))  # seeds one word apart
            runs = np.bincount(stretch)[stretch] + shortest - 1
            able |= np.maximum.reduceat(runs, firsts) >= longest
        found, at_text = [], np.flatnonzero(common)
        if able.any():
            owner_of, seed = self.owners[self.places[at]], np.repeat(np.arange(len(shared)), times)
            order = np.argsort(owner_of, kind="stable")
            owner_of, seed = owner_of[order], seed[order]
            for k in np.flatnonzero(able):
                one = owners[firsts[k]]
                mine = seed[slice(*np.searchsorted(owner_of, [one, one + 1]))]
                own = np.zeros(len(shared), bool)
                own[mine] = True
                found.append((reach[k] / sizes[k], int(one), at_text[own[which]]))
        return sorted(found, key=lambda c: (-c[0], c[1]))

    def best(
        self, text: np.ndarray, least: float, longest: int | None = None, shortest: int = SEED_WORDS
    ) -> tuple | None:
        """(item, coverage, matched words, tiles, longest tile) of the best covered item found."""
        if len(text) < shortest:
            same = self.short.get(text.tobytes()) if len(text) else None
            return None if same is None else (same, 1.0, len(text), 1, len(text))
        best = None
        for bound, one, there in self.candidates(text, least, longest, shortest):
            if best and bound < best[1]:
                break
            if best and bound == best[1] and one > best[0]:
                continue
            item = self.words[one]
            tiles = tile(item, _spans(text, there, shortest), shortest)
            matched, most = sum(n for n, _, _ in tiles), max((n for n, _, _ in tiles), default=0)
            if matched >= least * len(item) or (longest is not None and most >= longest):
                found = (one, matched / len(item), matched, len(tiles), most)
                if best is None or (-found[1], one) < (-best[1], best[0]):
                    best = found
        return best


def _spans(text: np.ndarray, starts: list[int], shortest: int) -> np.ndarray:
    """The stretches of the text that shared seeds cover, parted by a number no word has."""
    covered = np.zeros(len(text) + 1, bool)
    places = np.unique(starts)
    for k in range(shortest):
        covered[places + k] = True
    parts = []
    for stretch in np.split(np.arange(len(covered)), np.flatnonzero(~covered)):
        stretch = stretch[covered[stretch]]
        if len(stretch):
            parts += [text[stretch], np.zeros(1, np.uint64)]  # word numbers are odd
    return np.concatenate(parts)


def item_blocks(
    benchmark: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "item_id",
    text_col: str = "text",
) -> Iterator[Items]:
    """Items in id order, in blocks of at most ``block_words`` words (a longer item is a block)."""
    rows, size = [], 0
    ordered = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).orderBy(
        F.col("i").asc_nulls_last(), "t"
    )
    for row in ordered.toLocalIterator():
        n = len((row.t or "").split())
        if rows and size + n > block_words:
            yield Items.of(rows)
            rows, size = [], 0
        rows.append((row.i, row.t))
        size += n
    yield Items.of(rows)


def _best_column(sent: Broadcast, text: Column, least: float, longest: int | None) -> Column:
    @F.pandas_udf(_FOUND)
    def best(texts: pd.Series) -> pd.DataFrame:
        items, numbers, rows = sent.value, _Numbers(), []
        for text in texts:
            found = items.best(numbers(text or ""), least, longest)
            rows.append((items.ids[found[0]], *found[1:]) if found else (None, 0.0, 0, 0, 0))
        names = ["item_id", "coverage", "matched_words", "tiles", "longest"]
        return pd.DataFrame(rows, columns=names).astype({"item_id": "Int64"})

    return best(text)


def with_matches(
    docs: DataFrame, benchmark: DataFrame, column: str, text_col: str = "text",
    least: float = COVERAGE, block_words: int = BLOCK_WORDS, longest: int | None = None,
) -> DataFrame:
    """``docs`` with a struct ``column`` of the best item that was found, or of zeros."""
    context = docs.sparkSession.sparkContext
    names, last, before = docs.columns, None, None
    for items in item_blocks(benchmark, block_words):
        if last is not None:
            docs = stored(docs, "decontamination")
            if before is not None:
                released(before)
            before = docs
        found = _best_column(context.broadcast(items), F.col(text_col), least, longest)
        if last is None:
            docs = docs.withColumn(column, found)
        else:
            now = fresh_name(docs, "_now")
            docs = docs.withColumn(now, found).withColumn(
                column,
                F.when(F.col(now).coverage > F.col(column).coverage, F.col(now)).otherwise(
                    F.col(column)
                ),
            )
        docs = docs.select(*names, column)
        last = items
    return docs


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least: float = COVERAGE, block_words: int = BLOCK_WORDS, longest: int | None = None,
) -> DataFrame:
    """Per document: doc_id, contaminated, item_id, coverage, matched_words, tiles."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = with_matches(pairs, benchmark, "found", "text", least, block_words, longest)
    return found.select(
        "doc_id", (F.col("found.matched_words") > 0).alias("contaminated"), "found.item_id",
        "found.coverage", "found.matched_words", "found.tiles",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: float = COVERAGE,
    longest: int | None = None,
) -> DataFrame:
    """``docs`` without the rows in which a benchmark item was found."""
    column = fresh_name(docs, "_found")
    found = with_matches(docs, benchmark, column, text_col, least, longest=longest)
    return found.where(F.col(column).matched_words == 0).drop(column)
