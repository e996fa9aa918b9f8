"""A counterfactual-regularised toxicity classifier.

Logistic regression over the words of a text and their beginnings. Beside the labelled texts the
fit sees pairs of labelled sentences, one as written and one with its identity terms swapped for
others of their group, and pays for the squared change of the score. A term that names a group then
earns no weight of its own, however often it stands beside abuse in the labelled texts, which is
what makes neutral mentions look toxic.

The fit takes a bounded sample of labelled rows: ``train_rows`` with the smallest hash of their id,
on which features are counted, chosen and weighted in one task. Scoring reads every text.

Labels are learned only from rows whose crc32(id as text) mod 4 is not 2. The score is a function
of the text alone. Defined results: missing text is empty and gets the score of the bias; of
repeated labels of one id the higher one counts, of repeated rows of one id the smallest text;
missing labels and ids teach nothing; without any labelled row every score is 0; other columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import stored

THRESHOLD = 0.3
TRAIN_ROWS = 16_384
# Features live in a hashed space; at most MOST_FEATURES whose likelihood ratio (G) between toxic and
# other rows is at least LEAST_G are kept: about one in a million gets there by chance.
FEATURE_SPACE = 1 << 22
MOST_FEATURES = 20_000
LEAST_G = 22.0
PREFIXES = (4, 5)
PENALTY = 4.0
RIDGE = 2e-4
STEPS = 300

# Terms that name groups of people; those of one line may stand for each other.
IDENTITY_TERMS = (
    ("men", "women"),
    ("man", "woman"),
    ("boy", "girl"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
)
_SWAP = {
    term: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, term in enumerate(group)
}
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\w+(?:\W+\w+)*")
_KNOWN_WORDS = 300_000


def words(text: str) -> set[str]:
    return set(text.lower().split())


def features(word: str) -> list[int]:
    """Hashed features of a raw word: itself without outer punctuation, and its beginnings."""
    found = _WORD.search(word)
    bare = found.group() if found else word
    names = [f"={bare}", *(f"^{bare[:n]}" for n in PREFIXES if len(bare) > n)]
    return [xxhash.xxh32_intdigest(n) % FEATURE_SPACE for n in names]


def _vector(some: set[str]) -> bytes:
    return np.array(sorted({f for w in some for f in features(w)}), np.int32).tobytes()


def swapped(sentence: str) -> set[str] | None:
    """The words of a sentence with identity terms swapped; None if it has none."""
    own = words(sentence)
    other = set()
    for word in own:
        found = _WORD.search(word)
        other.add(_SWAP.get(found.group() if found else word, word))
    return other if other != own else None


def _vectors(batches: Iterator[pa.RecordBatch]):
    """Per labelled text its features; per sentence with identity terms those of both versions."""
    for batch in batches:
        labels, own, other = [], [], []
        for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            labels.append(toxic)
            own.append(_vector(words(text)))
            other.append(None)
            for sentence in _SENTENCE.split(text):
                if (changed := swapped(sentence)) is not None:
                    labels.append(None)
                    own.append(_vector(words(sentence)))
                    other.append(_vector(changed))
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array(own, pa.binary()), pa.array(other, pa.binary())],
            ["toxic", "own", "other"],
        )


class _Rows:
    """Sparse rows of 0 and 1."""

    def __init__(self, vectors: list[np.ndarray]):
        self.sizes = np.array([len(v) for v in vectors], np.int64)
        self.flat = np.concatenate([*vectors, np.empty(0, np.int32)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(vectors)), self.sizes)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.flat], len(self.sizes))

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.flat, values[self.row], width)

    def only(self, place: np.ndarray) -> _Rows:
        """The same rows over chosen features; ``place`` is -1 for all others."""
        kept, now = place[self.flat] >= 0, _Rows([])
        now.sizes = np.bincount(self.row[kept], minlength=len(self.sizes)).astype(np.int64)
        now.flat, now.row = place[self.flat[kept]], self.row[kept]
        return now


def _choose(rows: _Rows, toxic: np.ndarray) -> np.ndarray:
    """Features whose rows are toxic far more or less often than all rows are, best first."""
    prior = (toxic.sum() + 0.5) / (len(toxic) + 1)
    with1, with0 = rows.back(toxic, FEATURE_SPACE), rows.back(1 - toxic, FEATURE_SPACE)
    both = np.maximum(with1 + with0, 1)
    g = 2 * (
        with1 * np.log(np.maximum(with1, 1e-9) / (both * prior))
        + with0 * np.log(np.maximum(with0, 1e-9) / (both * (1 - prior)))
    )
    best = np.argsort(-g, kind="stable")[:MOST_FEATURES]
    return best[g[best] >= LEAST_G]


def fit(labels: list, own: list[np.ndarray], other: list) -> dict[int, float]:
    """Weights by feature, the bias under -1; empty if nothing is labelled."""
    labelled = [i for i, t in enumerate(labels) if t is not None]
    if not labelled:
        return {}
    pairs = [i for i, o in enumerate(other) if o is not None]
    toxic = np.array([labels[i] for i in labelled], float)
    rows = _Rows([own[i] for i in labelled])
    chosen = _choose(rows, toxic)
    place = np.full(FEATURE_SPACE, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    rows = rows.only(place)
    left, right = (_Rows([side[i] for i in pairs]).only(place) for side in (own, other))
    width, n = len(chosen), len(labelled)
    prior = (toxic.sum() + 0.5) / (n + 1)
    weights = np.zeros(width + 1)
    weights[width] = math.log(prior / (1 - prior))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        score = 1 / (1 + np.exp(-np.clip(rows.times(weights) + weights[width], -30, 30)))
        error = score - toxic
        slope = np.append(rows.back(error, width) / n + RIDGE * weights[:width], error.mean())
        if pairs:
            change = left.times(weights) - right.times(weights)
            pull = left.back(change, width) - right.back(change, width)
            slope[:width] += 2 * PENALTY * pull / len(pairs)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return {-1: float(weights[width])} | dict(
        zip(chosen.tolist(), weights[:width].tolist(), strict=True)
    )


def _fit(batches: Iterator[pa.RecordBatch]):
    labels, own, other = [], [], []
    for batch in batches:
        toxic, first, second = (c.to_pylist() for c in batch.columns)
        labels += toxic
        own += [np.frombuffer(v, np.int32) for v in first]
        other += [None if v is None else np.frombuffer(v, np.int32) for v in second]
    weights = fit(labels, own, other)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(weights), pa.int32()), pa.array(list(weights.values()), pa.float64())],
        ["feature", "weight"],
    )


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> dict[int, float]:
    """Weights of at most ``MOST_FEATURES`` features, fitted on at most ``train_rows`` rows."""
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = (
        texts.join(F.broadcast(sample), "doc_id")  # train_rows rows of two numbers
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("toxic", "text")
    )
    vectors = stored(
        rows.mapInArrow(_vectors, "toxic int, own binary, other binary"), "toxicity-vectors"
    )
    fitted = vectors.repartition(1).mapInArrow(_fit, "feature int, weight double")
    return {r.feature: r.weight for r in stored(fitted, "toxicity-weights").collect()}


class Scorer:
    """Scores texts; keeps which weights a word has."""

    def __init__(self, weights: dict[int, float]):
        self.weights, self.bias = weights, weights.get(-1)
        self.known: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= _KNOWN_WORDS:
            self.known.clear()
        found = tuple(f for f in features(word) if f in self.weights)
        if len(word) <= 64:
            self.known[word] = found
        return found

    def score(self, text: str) -> float:
        if self.bias is None:
            return 0.0
        known, hits = self.known, set()
        for word in words(text):
            hits.update(known[word] if word in known else self._of(word))
        total = self.bias + sum(self.weights[f] for f in sorted(hits))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


_SCORERS: dict[int, Scorer] = {}


def _scorer(weights: Broadcast) -> Scorer:
    """The scorer of this worker process, kept between tasks."""
    key = id(weights.value)
    if key not in _SCORERS or _SCORERS[key].weights is not weights.value:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(weights.value)
    return _SCORERS[key]


def score_column(docs: DataFrame, weights: dict[int, float], text_col: str = "text") -> Column:
    """The score of each text as a column of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        one = _scorer(sent).score
        return pd.Series([one(t or "") for t in texts], dtype=float)

    return score(F.coalesce(F.col(text_col), F.lit("")))


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    weights = train(docs, labels, id_col, text_col, train_rows)
    return pairs.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        score_column(pairs, weights).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``docs`` without the rows scored at or above the threshold."""
    weights = train(docs, labels, id_col, text_col, train_rows)
    return docs.where(score_column(docs, weights, text_col) < threshold)


def accuracy(scored: DataFrame, labels: DataFrame) -> Counter:
    """Held-out rows by (label, predicted)."""
    truth = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = scored.where("held_out").join(truth, "doc_id").groupBy("toxic", "predicted").count()
    return Counter({(r["toxic"], r["predicted"]): r["count"] for r in counts.collect()})
