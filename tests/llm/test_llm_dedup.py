"""Exact dedup, SimHash near-dedup, connected components, substring dedup."""

from __future__ import annotations

import random
import re
from collections import Counter

import brute
import fixture
import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.llm import exact_dedup as ex
from oreline.llm import simhash as sh
from oreline.llm import substring_dedup as sub
from oreline.llm.components import components


@pytest.fixture(scope="module")
def pairs():
    return fixture.rows()


@pytest.fixture(scope="module")
def docs(spark, pairs):
    return fixture.frame(spark, pairs)


@pytest.fixture(scope="module")
def empty(spark):
    return fixture.frame(spark, [(1, "x")]).where("doc_id > 1")


@pytest.mark.parametrize("share", [4, 10_000])
def test_exact_dedup(docs, pairs, share):
    got = [tuple(r) for r in ex.dedup_rows(ex.digests(docs), share).collect()]
    groups = brute.exact_groups(pairs)
    assert len(got) == len(pairs)
    assert Counter((i, d) for i, _, _, _, d in got) == Counter(
        (i, brute.sha(_normal(t))) for i, t in pairs
    )
    for _doc_id, keep_id, size, _kept, digest in got:
        assert (keep_id, size) == groups[digest]
    kept = Counter(d for _, _, _, k, d in got if k)
    assert set(kept.values()) == {1} and set(kept) == set(groups)
    assert all(i == k for i, k, _, kept_, _ in got if kept_)


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_heavy_digests_are_verified_and_bounded(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    heavy = ex.heavy_digests(ex.digests(rows), share=100).collect()
    assert [(r.text_sha256, r.group_size, r["first"]["doc_id"]) for r in heavy] == [
        (brute.sha("hot"), 1000, 0)
    ]


def test_exact_dedup_main_path_is_native(docs):
    said = ex.exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in said for k in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_drop_copies_keeps_one_row_of_each_group(docs, pairs):
    kept = ex.drop_copies(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, brute.sha(_normal(r.text))) for r in kept.collect())
    assert got == Counter((k, d) for d, (k, _) in brute.exact_groups(pairs).items())


def test_simhash_equals_brute_force(docs, pairs):
    got = Counter(tuple(r) for r in sh.near_dedup(docs).collect())
    prints = [brute.fingerprint(t) for _, t in pairs]
    least = {}
    for root, (i, _) in zip(brute.classes(prints), pairs, strict=True):
        least[root] = min(least.get(root, i), i, key=brute.after)
    want = Counter(
        (i, f"{p:016x}", least[root])
        for (i, _), p, root in zip(pairs, prints, brute.classes(prints), strict=True)
    )
    assert got == want


def _near_prints(seed, n=300):
    """Fingerprints in clusters, so that many are linked, some only through others."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    out = {0, 1, (1 << 64) - 1}
    while len(out) < n:
        out.add(rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    return sorted(out)


@pytest.mark.parametrize("bucket", [sh.BUCKET, 3])
@pytest.mark.parametrize("most", [3, 2])
def test_ball_links_join_every_pair(spark, bucket, most):
    prints = _near_prints(most)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    links = sh.ball_links(frame, most, bucket)
    pairs = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= most for a, b in pairs)
    named = {r.node: r.root for r in components(links).collect()}
    root = [named.get(int(np.uint64(p).view(np.int64)), p) for p in prints]
    want = brute.classes(prints, most)
    assert len(set(zip(root, want, strict=True))) == len(set(root)) == len(set(want))


def test_masked_balls_are_few():
    assert len(sh.masked_balls(3)) == 131


def test_drop_near_copies_keeps_one_of_each_component(docs, pairs):
    kept = sh.drop_near_copies(docs)
    assert kept.columns == docs.columns
    prints = [brute.fingerprint(t) for _, t in pairs]
    best = {}
    for root, (i, t) in zip(brute.classes(prints), pairs, strict=True):
        row = (*brute.after(i), brute.sha(_normal(t)))
        best[root] = min(best.get(root, row), row)
    got = Counter((*brute.after(r.doc_id), brute.sha(_normal(r.text))) for r in kept.collect())
    assert got == Counter(best.values())


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(105, 105), (101, 100)]
    links = spark.createDataFrame(path + star, "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


@pytest.mark.parametrize("shard_bytes", [sub.SHARD_BYTES, 4_000])
def test_substring_dedup_equals_brute_force(docs, pairs, shard_bytes):
    got = Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
        for r in sub.substring_dedup(docs, shard_bytes=shard_bytes).collect()
    )
    found = zip(pairs, brute.stripped(pairs), strict=True)
    want = Counter((i, *rest) for (i, _), rest in found)
    assert got == want


def test_substring_dedup_of_one_common_passage(spark):
    rng, some = random.Random(3), fixture.vocabulary()
    common = " ".join(rng.choices(some, k=30))
    pairs = [(i, " ".join(rng.choices(some, k=10)) + " " + common) for i in range(60)]
    got = sub.substring_dedup(fixture.frame(spark, pairs), shard_bytes=900).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == [
        (i, *rest) for (i, _), rest in zip(pairs, brute.stripped(pairs), strict=True)
    ]


def test_substring_dedup_spreads_one_id_and_one_text(spark):
    """One id with many texts, one text with many rows: several shards, results as in one."""
    rng, some = random.Random(4), fixture.vocabulary()
    common = " ".join(rng.choices(some, k=26))
    pairs = [
        (7, " ".join(rng.choices(some, k=rng.randint(0, 9))) + " " + common + " " + rng.choice(some))
        for _ in range(80)
    ]
    pairs += [(None, "z " + common)] * 5_000 + [(9, common)] * 3 + [(None, None)] * 4
    got = Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
        for r in sub.substring_dedup(fixture.frame(spark, pairs), shard_bytes=1_000).collect()
    )
    want = zip(pairs, brute.stripped(pairs), strict=True)
    assert got == Counter((i, *rest) for (i, _), rest in want)


def test_equal_first_hashes_are_told_apart():
    hashes, more = (np.array(v, np.uint64) for v in ([5, 3, 5, 5, 3, 9], [1, 2, 7, 1, 2, 1]))
    first, times = sub._distinct(hashes, more)
    found = dict(zip(zip(hashes[first].tolist(), more[first].tolist()), zip(first.tolist(), times)))
    assert found == {(5, 1): (0, 2), (3, 2): (1, 2), (5, 7): (2, 1), (9, 1): (5, 1)}
    assert all(len(v) == 0 for v in sub._distinct(hashes[:0], more[:0]))


def test_run_hashes_tell_runs_apart():
    numbers = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    for width in (1, 2, 3, 5):
        hashes = sub.run_hashes(numbers, width)
        runs = [tuple(numbers[k : k + width]) for k in range(len(numbers) - width + 1)]
        assert len(hashes) == len(runs)
        assert len(set(hashes.tolist())) == len(set(runs))


def test_empty_tables(empty):
    assert ex.exact_dedup(empty).count() == ex.drop_copies(empty).count() == 0
    assert sh.near_dedup(empty).count() == sh.drop_near_copies(empty).count() == 0
    assert sub.substring_dedup(empty).count() == 0
