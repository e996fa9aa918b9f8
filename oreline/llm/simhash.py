"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints (64 bits) are made in Arrow batches. Two fingerprints at a distance of at most 2r
share a value within r bits of each, so each distinct fingerprint emits all variants within r bits
and pairs meet on equal variants. The largest distance here is odd, 3 = 2 * 1 + 1: the odd bit is
taken out by masking one of three bands that together hold all bits. For a pair that differs in
three bits, at least one masked copy leaves a distance of at most 2, so the radius-1 variants of
the three masked copies (131 rows a fingerprint) find every pair. Colliding pairs are verified on
all 64 bits, and each bucket gives a spanning forest of its verified links instead of all pairs.

Masked buckets have no bound. The fingerprints of a bucket with over ``BUCKET`` of them are
dealt again by unmasked balls: those of even parity emit radius 2, those of odd parity radius 1.
Pairs at distance 3 differ in parity, so that is exact too, and an unmasked bucket cannot hold more
than 2,081 distinct fingerprints.

Defined results: missing text has no words; a text without words has fingerprint zero, which is
linked like any other; rows with a missing id get a component like others, but never name it
unless it has no other id; repeated rows stay rows; empty tables give empty results; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import keep_one, stored, text_digest
from oreline.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
BITS = 64
# Distinct fingerprints of one masked bucket that are compared in one go.
BUCKET = 4_096
# Fingerprints whose variants one task emits, on average.
TASK_PRINTS = 100_000
# Shingles of a text that are counted in one go.
_BLOCK = 65_536


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    spans = zip(starts, ends[min(shingle_words, len(words)) - 1 :], strict=False)
    votes, shingles = np.zeros(BITS, np.int64), 0
    while block := [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in islice(spans, _BLOCK)]:
        rows = np.array(block, "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        shingles += len(block)
    bits = np.packbits(2 * votes > shingles, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle_words: int):
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        prints = np.array([fingerprint(t or b"", shingle_words) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]],
            ["doc_id", "fp", *batch.schema.names[2:]],
        )


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(
        partial(_fingerprints, shingle_words=shingle_words), f"doc_id {kind}, fp long"
    )


def _flips(bits: list[int], radius: int) -> list[int]:
    return [
        sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(bits, r)
    ]


def masked_balls(max_distance: int) -> list[tuple[int, int]]:
    """(bits kept, bits flipped) of every variant that a fingerprint emits."""
    radius, odd = divmod(max_distance, 2)
    if not odd:
        return [(_signed((1 << BITS) - 1), _signed(f)) for f in _flips(list(range(BITS)), radius)]
    variants = []
    for band in range(max_distance):
        low, high = BITS * band // max_distance, BITS * (band + 1) // max_distance
        kept = [b for b in range(BITS) if not low <= b < high]
        mask = sum(1 << b for b in kept)
        tag = (band + 1) << low  # tells the bands apart
        variants += [(_signed(mask), _signed(f | tag)) for f in _flips(kept, radius)]
    return variants


def _distance(prints: np.ndarray, others) -> np.ndarray:
    # bitwise_count takes the absolute value of signed numbers.
    return np.bitwise_count((prints ^ others).view(np.uint64))


def _forest(prints: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, compared one against the rest."""
    found = []
    left = prints
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = _distance(left, one) <= max_distance
            linked = left[near]
            found += [(one, other) for other in linked]
            queue += list(linked)
            left = left[~near]
    return found


def _bucket_links(batches: Iterator[pa.RecordBatch], max_distance: int, most: int | None):
    """Links (a, b) of the buckets; (a, null) for the fingerprints of a bucket that is too large.

    The rows come sorted by key, so a bucket is a run of rows; one open run is held at a time.
    """
    none = np.empty(0, np.int64)

    def out(a, b, hot=none):
        lone = pa.nulls(len(hot), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, hot]), pa.int64()),
             pa.chunked_array([pa.array(b, pa.int64()), lone]).combine_chunks()], ["a", "b"]
        )

    def links(prints, starts, sizes):
        i = starts[sizes == 2]
        a, b = prints[i], prints[i + 1]
        near = _distance(a, b) <= max_distance
        more = [
            pair
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True)
            for pair in _forest(prints[s : s + n], max_distance)
        ]
        c = np.array(more, np.int64).reshape(-1, 2)
        return out(np.concatenate([a[near], c[:, 0]]), np.concatenate([b[near], c[:, 1]]))

    keys, prints, flooded = none, none, None
    for batch in batches:
        new_keys, new_prints = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if flooded is not None:
            same = new_keys == flooded
            if same.any():
                yield out(none, none, new_prints[same])
                new_keys, new_prints = new_keys[~same], new_prints[~same]
            if len(new_keys):
                flooded = None
        keys, prints = np.concatenate([keys, new_keys]), np.concatenate([prints, new_prints])
        if not len(keys):
            continue
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        closed = np.arange(len(starts)) < len(starts) - 1
        if most is not None:
            for s, n in zip(starts[closed & (sizes > most)], sizes[closed & (sizes > most)],
                            strict=True):
                yield out(none, none, prints[s : s + n])
            closed &= sizes <= most
        yield links(prints, starts[closed], sizes[closed])
        keys, prints = keys[starts[-1] :], prints[starts[-1] :]
        if most is not None and len(keys) > most:
            yield out(none, none, prints)
            flooded, keys, prints = keys[0], none, none
    yield links(prints, np.array([0], np.int64), np.array([len(prints)], np.int64))


def _meet(variants: DataFrame, max_distance: int, most: int | None) -> DataFrame:
    """Variants (key, fp) shuffled and sorted by key; the distinct links of all buckets."""
    dealt = variants.repartition("key").sortWithinPartitions("key")
    compare = partial(_bucket_links, max_distance=max_distance, most=most)
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def ball_links(
    prints: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """Links (a, b) among distinct fingerprints (fp) that join every pair within the distance.

    Not every linked pair is named, but each is joined by a path of named links.
    """
    balls = F.array(
        *[
            F.struct(F.lit(kept).alias("kept"), F.lit(flip).alias("flip"))
            for kept, flip in masked_balls(max_distance)
        ]
    )
    dealt = prints.repartition(1 + prints.count() // TASK_PRINTS, "fp")
    variants = dealt.select("fp", F.inline(balls)).select(
        F.col("fp").bitwiseAND(F.col("kept")).bitwiseXOR(F.col("flip")).alias("key"), "fp"
    )
    found = stored(_meet(variants, max_distance, bucket), "simhash-links")
    links = found.where(F.col("b").isNotNull())
    flooded = found.where(F.col("b").isNull()).select(F.col("a").alias("fp"))
    if flooded.isEmpty():
        return links
    bits = list(range(BITS))
    wide, narrow = (
        F.array(*[F.lit(_signed(f)) for f in _flips(bits, r)])
        for r in (-(-max_distance // 2), max_distance // 2)
    )
    even = F.bit_count("fp") % 2 == 0
    flooded = flooded.repartition(1 + flooded.count() // (TASK_PRINTS // 10), "fp")
    again = flooded.select(
        "fp", F.explode(F.when(even, wide).otherwise(narrow)).alias("flip")
    ).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("key"), "fp")
    return links.unionByName(stored(_meet(again, max_distance, None), "simhash-flooded"))


def label_prints(
    prints: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """fp, component_id for rows (doc_id, fp): the smallest id that links reach."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    roots = components(ball_links(distinct.select("fp"), max_distance, bucket))
    linked = stored(distinct.join(roots.withColumnRenamed("node", "fp"), "fp"), "simhash-linked")
    least = stored(linked.groupBy("root").agg(F.min("first").alias("least")), "simhash-least")
    named = linked.join(least, "root").select("fp", "least")
    return stored(
        distinct.join(named, "fp", "left").select(
            "fp", F.coalesce("least", "first").alias("component_id")
        ),
        "simhash-labels",
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    labels = label_prints(prints, max_distance, bucket)
    return prints.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of equal ids the smallest digest."""
    marked = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        text_digest(F.col(text_col)).alias("digest"),
    )
    kind = marked.schema["doc_id"].dataType.simpleString()
    prints = stored(
        marked.mapInArrow(
            partial(_fingerprints, shingle_words=shingle_words),
            f"doc_id {kind}, fp long, digest string",
        ),
        "simhash",
    )
    labels = label_prints(prints.select("doc_id", "fp"), max_distance)
    # Without a digest of its own, a component of missing ids is named by the prints it holds.
    rows = prints.join(labels, "fp").groupBy(
        F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp")))
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    first = rows.agg(F.min(order).alias("first")).select("first.doc_id", "first.digest")
    copies = prints.groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    keepers = first.alias("f").join(
        copies.alias("c"),
        F.col("f.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("f.digest") == F.col("c.digest")),
    )
    return keep_one(
        docs, stored(keepers.select("f.doc_id", "f.digest", "c.copies"), "simhash-keepers"),
        id_col, text_col,
    )
