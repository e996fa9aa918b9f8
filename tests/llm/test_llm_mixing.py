"""Mixing sources: targets against repeated resharing, copies by their properties."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import fixture
import pytest
from pyspark.sql import functions as F

from oreline.llm import mixing, registry


def plain_targets(sizes):
    """Share by weight, stop at twice the size, reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while open_ and left > 1e-9:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in open_:
            target[s] += left * weight[s] / total
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                excess += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
        left = excess
    return target


def check(rows, docs):
    """``rows`` of a mix of ``docs`` (doc_id, source, text)."""
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(brute.words(text))
    want = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter(
        (i, s, len(brute.words(t))) for i, s, t in docs
    )
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert r.taken in (0, r.size, 2 * r.size)
        rate = r.target / r.source_size if r.source_size else 0
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.copies >= int(rate) or 64 * r.size <= r.source_size or not r.size
    for source, words in taken.items():
        assert abs(words - want[source]) <= largest[source]
    return taken, want


def frame(spark, docs, parts=3):
    some = spark.createDataFrame(docs, "doc_id long, source string, text string")
    more = [F.lit(k).alias(n) for k, n in enumerate(("size", "number", "rows", "p", "target"))]
    return some.select("*", *more).repartition(parts)


def test_query_over_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    query = registry.queries()["op13_source_mixing"]
    rows = query(spark, sf_dir).collect()
    check(rows, [tuple(r) for r in table.collect()])
    assert Counter(query(spark, sf_dir).collect()) == Counter(rows)


def test_many_documents_come_near_their_targets(spark):
    rng = random.Random(2)
    docs = [
        (k, rng.choice(["a", "b", "b", "b", "c", None]), "w " * rng.choice([1, 2, 3, 5, 9, 40, 400]))
        for k in range(3000)
    ]
    rows = mixing.mix(frame(spark, docs)).collect()
    taken, want = check(rows, docs)
    for source in taken:
        assert taken[source] == pytest.approx(want[source], rel=0.01)
    again = mixing.mix(frame(spark, docs[::-1], 7)).collect()
    assert Counter(again) == Counter(rows)


def test_odd_rows(spark):
    docs = [(i, None if i and i % 3 else "s", t) for i, t in fixture.rows()]
    docs += [(None, "hot", "one two three")] * 9000 + [(5, "hot", None)] * 3 + [(6, "none", " ")]
    docs += [(7, "", "empty name"), (8, "Z", "a"), (9, "a", "b c"), (10, "é", "d e f")]
    rows = mixing.mix(frame(spark, docs)).collect()
    taken, want = check(rows, docs)
    assert abs(taken["hot"] - want["hot"]) <= 3


def test_nothing_to_mix(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    rows = mixing.mix(frame(spark, [(1, "a", None), (2, None, " ")])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in rows) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_expectations_are_kept(spark):
    """Over many sources each document is taken about as often as its share says."""
    docs = [(k, "a" if k < 12 else "b", "w " * (k + 3)) for k in range(40)]
    items = frame(spark, docs).select(
        F.explode(F.sequence(F.lit(0), F.lit(29))).alias("number"),
        F.regexp_count("text", F.lit("w")).cast("long").alias("size"),
        "doc_id", F.lit(0.3).alias("p"), F.lit(0).cast("long").alias("copies"),
    )
    rows = mixing.rounded(items.withColumn("h", F.xxhash64("doc_id", "number"))).collect()
    assert len(rows) == 30 * 40
    seen = Counter(r.doc_id for r in rows if r.copies == 1)
    assert 0.2 < sum(seen.values()) / (30 * 40) < 0.4
    assert len(seen) > 30
