"""Token ids of whole texts, with the encodings of repeated units kept.

The byte-level pre-tokenizer never joins what stands on both sides of a space that precedes a
non-space character: a run of white space gives up its last character to the word that follows. So
a text may be cut before each single space between other characters, and the ids of the text are
those of its units in order. A batch of texts is cut and its units are numbered by Arrow; each
different unit is looked up once, and the ids of all texts are put together from those by one take.
Special tokens are found before that, as the library does it, and have one id each; the parts
between them are encoded like texts, so that spaces at a part's end stay together. Units repeat, so
each is encoded by the tokenizers library once and kept. What is kept is bounded.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
from array import array
from collections.abc import Callable
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

# The letter that byte-level vocabularies write for each byte: printable ones as they are, the others
# in order from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [byte for byte in range(256) if byte not in _PRINTABLE]
_BYTE_LETTERS = {byte: 256 + k for k, byte in enumerate(_HIDDEN)}
_SPACE_LETTER = chr(_BYTE_LETTERS[32])
# Characters of units that a worker keeps in each of two generations.
_KEPT = 3_000_000


class Known:
    """Ids of units seen lately: those in use stay, the others go with their generation."""

    def __init__(self, kept: int = _KEPT):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.kept, self.held = kept, 0

    def trim(self) -> None:
        if self.held > self.kept:
            self.old, self.new, self.held = self.new, {}, 0

    def all_of(self, units: list[str], learn: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of different units; those not known are learnt."""
        new, old = self.new, self.old
        missing = [u for u in units if u not in new]
        self.held += sum(map(len, missing))
        if old:
            again = [u for u in missing if u in old]
            new.update(zip(again, map(old.__getitem__, again), strict=True))
            missing = [u for u in missing if u not in old]
        new.update(zip(missing, learn(missing), strict=True))
        return list(map(new.__getitem__, units))


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    With ``spaced`` a space is put before every text. With ``special`` off, the strings of special
    tokens are text like any other.
    """

    def __init__(
        self, definition: str, kept: int = _KEPT, spaced: bool = False, special: bool = True
    ):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.spaced = spaced
        if not special:
            self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder() if special else {}
        self.special = {t.content: little(array("I", [i])) for i, t in added.items()}
        longest = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_cut = re.compile(f"({'|'.join(longest)})")
        # Special tokens that take in spaces, or are only found as words, are left to the library.
        self.plain = not any(
            t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()
        )
        self.known = Known(kept)

    def _word(self, unit: str) -> bytes:
        """Letters alone are one word to the pre-tokenizer, so they go straight to the model."""
        if not unit.isascii():
            unit = unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
        elif unit[0] == " ":
            unit = _SPACE_LETTER + unit[1:]
        return little(array("I", [t.id for t in self.tokenizer.model.tokenize(unit)]))

    def _learn(self, units: list[str]) -> list[bytes]:
        words = [u.removeprefix(" ").isalpha() for u in units]
        rest = [u for u, word in zip(units, words, strict=True) if not word]
        found = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [
            self._word(u) if word else little(array("I", next(found).ids))
            for u, word in zip(units, words, strict=True)
        ]

    def entries(self) -> list[bytes]:
        """The bytes of each id; special tokens have those of their strings."""
        letters = {chr(letter): byte for byte, letter in _BYTE_LETTERS.items()}
        letters |= {chr(byte): byte for byte in _PRINTABLE}
        added = self.tokenizer.get_added_tokens_decoder()
        return [
            added[i].content.encode()
            if i in added
            else bytes(letters[c] for c in self.tokenizer.id_to_token(i))
            for i in range(self.tokenizer.get_vocab_size())
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.encode_batch(pa.array(texts, pa.string()))
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in itertools.pairwise(ends.tolist())]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins and ends in them."""
        if not self.plain:
            return self._by_library(texts.to_pylist())
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= np.array(pc.match_substring(texts, token))
        if not special.any():
            return self._parts(texts)
        # Texts with special tokens: parts and special tokens take turns.
        out = []
        for i, text in enumerate(texts.to_pylist()):
            if not special[i]:
                continue
            cut = self.special_cut.split(text)
            ids, ends = self._parts(pa.array(cut[::2], pa.string()))
            parts = [ids[a:b] for a, b in itertools.pairwise(ends)]
            for k, token in enumerate(cut[1::2]):
                parts.insert(2 * k + 1, np.frombuffer(self.special[token], "<u4"))
            out.append(np.concatenate(parts))
        some = pa.array(~special)
        return _merged(~special, self._parts(texts.filter(some)), _laid(out))

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return _laid([np.array(f.ids, "<u4") for f in found])

    def _parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens."""
        return encode_units(texts, self.known, self._learn, _FINER, self.spaced)


# White space and what some library may take for it: texts are cut at single spaces without any of
# these beside them. More than the library's own white space only means fewer cuts.
_ODD = r"(?:^|[\pZ\x00-\x20\x{85}]) | (?:$|[\pZ\x00-\x20\x{85}])|\x00"
_VISIBLE = r"[^\s\x00-\x20\x85]"
_CUT = re.compile(f"(?<={_VISIBLE})(?= {_VISIBLE})")
# Stands between units; texts that hold it are cut by themselves.
_MARK = "\x00"
# Where the byte-level pre-tokenizer always cuts as well: between a letter and a mark, and around a
# line break between a mark and a letter. Latin letters only: all libraries agree on them.
_LETTER = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]"
_FINER = (
    (f"({_LETTER})([.,;:!?])", f"\\1{_MARK}\\2"),
    (f"([.,;:!?])\n({_LETTER})", f"\\1{_MARK}\n{_MARK}\\2"),
)
# Characters of a text that are cut and looked up in one go.
_LONG = 4_000_000


def encode_units(
    texts: pa.Array, known: Known, learn: Callable[[list[str]], list[bytes]],
    finer: tuple[tuple[str, str], ...] = (), spaced: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text begins and ends in them.

    ``learn`` gives the ids of units; all but the first one of a text begin with a space. With
    ``spaced`` a space is put before each text. Units are looked up once a batch. ``finer`` are
    patterns where units are cut as well.
    """
    known.trim()
    odd = np.array(pc.match_substring_regex(texts, _ODD)) | (np.array(pc.utf8_length(texts)) > _LONG)
    if spaced:
        texts = pc.binary_join_element_wise(pa.scalar(" "), texts, "")

    def cut(some: pa.Array) -> pa.ListArray:
        marked = pc.replace_substring(some, " ", f"{_MARK} ")
        for pattern, put in finer:
            marked = pc.replace_substring_regex(marked, pattern, put)
        return pc.split_pattern(marked, _MARK)

    def ids(units: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        return _looked_up(units, known, learn)

    if not odd.any():
        return ids(cut(texts))
    out = []
    for text in texts.filter(pa.array(odd)).to_pylist():
        parts = [np.zeros(0, "<u4")]
        for low, high in _slices(text):
            units = _CUT.split(text[low:high])
            parts.append(ids(pa.array([units], pa.list_(pa.string())))[0])
        out.append(np.concatenate(parts))
    return _merged(~odd, ids(cut(texts.filter(pa.array(~odd)))), _laid(out))


def _slices(text: str):
    """(from, to) of pieces of about _LONG characters, each ending where texts are cut."""
    low = 0
    while len(text) - low > _LONG:
        found = _CUT.search(text, low + _LONG)
        if found is None:
            break
        yield low, found.start()
        low = found.start()
    yield low, len(text)


def _looked_up(units: pa.ListArray, known: Known, learn) -> tuple[np.ndarray, np.ndarray]:
    ends = np.array(units.offsets, np.int64)
    flat = units.flatten().dictionary_encode()
    codes, blobs = np.array(flat.indices), known.all_of(flat.dictionary.to_pylist(), learn)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    table = pa.ListArray.from_arrays(starts, pa.array(np.frombuffer(b"".join(blobs), "<u4")))
    ids = np.array(table.take(pa.array(codes)).flatten(), np.uint32)
    places = np.concatenate([[0], np.cumsum(sizes[codes])])
    return ids, places[ends - ends[0]]


def _laid(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint32), *parts]).astype("<u4"), ends


def _merged(mine: np.ndarray, yes: tuple, no: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Two results as one, in the order of the texts: where ``mine`` holds the next one of ``yes``."""
    take = {True: iter(itertools.pairwise(yes[1])), False: iter(itertools.pairwise(no[1]))}
    ids = {True: yes[0], False: no[0]}
    parts = []
    for m in mine.tolist():
        a, b = next(take[m])
        parts.append(ids[m][a:b])
    return _laid(parts)


def little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


_ENCODERS: dict[int, Encoder] = {}


def encoder(definition: Broadcast) -> Encoder:
    """The encoder of this worker process, kept between tasks."""
    key = hash(definition.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition.value)
    return _ENCODERS[key]


def definition(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file, read once by the driver: a few MB, whatever the documents."""
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def blocks(texts: list[str], most: int = 4_000_000):
    """(from, to) of runs of texts with about ``most`` characters in all."""
    return runs(map(len, texts), most)


def runs(lengths, most: int = 4_000_000):
    """(from, to) of runs of texts of these lengths with about ``most`` characters in all."""
    start, size, i = 0, 0, -1
    for i, length in enumerate(lengths):
        size += length
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start <= i:
        yield start, i + 1


def text_runs(texts: pa.Array, most: int = 4_000_000):
    """(from, texts) of such runs of an array, missing texts as empty ones."""
    texts = texts.cast(pa.string()).fill_null("")
    for low, high in runs(pc.utf8_length(texts).to_pylist(), most):
        yield low, texts.slice(low, high - low)
