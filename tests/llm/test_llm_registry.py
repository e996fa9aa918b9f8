"""Registered queries: against their SQL, or against a plain version over the whole tables."""

from __future__ import annotations

import re
from collections import Counter

import brute
import numpy as np
import oracle_check
import pytest
from test_llm_tokens import check_packing

import __spark_entry__ as entry
import corpus_pipeline
from oreline.llm import decontamination, registry, toxicity
from oreline.llm.tokens import BYTE_BPE


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BYTE_BPE)
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


def test_all_operators_are_registered():
    named = {re.match(r"op(\d+)_|(pipeline)", n) and n for n in entry.queries()} - {None}
    assert {n.split("_")[0] for n in named} == {*(f"op{k}" for k in range(1, 14)), "pipeline"}
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle_check.compare(spark, oracle_check.connect(sf_dir), name, sf_dir) == ""


def test_op4(spark, sf_dir, texts):
    got = registry.queries()["op4_substring_dedup"](spark, sf_dir).collect()
    want = {i: rest for (i, _), rest in zip(texts, brute.stripped(texts), strict=True)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_op9(spark, sf_dir, texts):
    got = registry.queries()["op9_simhash_near_dedup"](spark, sf_dir).collect()
    prints = [brute.fingerprint(t) for _, t in texts]
    want = {
        i: (f"{p:016x}", texts[root][0])
        for (i, _), p, root in zip(texts, prints, brute.classes(prints), strict=True)
    }
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_op10(spark, sf_dir, texts, plain_ids):
    rows = registry.queries()["op10_best_fit_packing"](spark, sf_dir).collect()
    used = check_packing(rows, [(i, plain_ids(t)) for i, t in texts], 1024, 2)
    assert used <= 1.01 * brute.best_fit([r.length for r in rows], 1024) + 1


def contaminated(text, items):
    """By plain tiling against every item that shares five words."""
    numbers = decontamination._Numbers()
    found = numbers(text or "").tolist()
    runs = {tuple(found[k : k + 5]) for k in range(len(found) - 4)}
    for item in items:
        words = numbers(item or "").tolist()
        if any(tuple(words[k : k + 5]) in runs for k in range(len(words) - 4)):
            covered = sum(n for n, _, _ in brute.tiles(words, found))
            if covered >= 0.8 * len(words):
                return True
    return False


def test_op6(spark, sf_dir, texts):
    got = registry.queries()["op6_decontamination"](spark, sf_dir).collect()
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert {r.doc_id for r in got if r.contaminated} == {
        i for i, t in texts if contaminated(t, items)
    }
    assert len(got) == len(texts)


def test_pipeline_against_a_plain_version(spark, sf_dir, texts, plain_ids):
    """Each stage by brute force on its predecessor's rows; scores are the classifier's own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity.score_documents(docs, labels).where("predicted = 0")
    left = {r.doc_id for r in scores.collect()}
    rows = [(i, t) for i, t in texts if i in left]
    first = {}
    for i, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    rows = [(i, t) for i, t in rows if i in set(first.values())]
    roots = brute.classes([brute.fingerprint(t) for _, t in rows])
    rows = [row for k, row in enumerate(rows) if roots[k] == k]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not contaminated(t, items)]
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(packed, [(i, plain_ids(t)) for i, t in rows], 1024, 2)


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes


def test_stages_on_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_op8_on_held_out_labels(spark):
    """Held-out accuracy over the larger sample; the smallest one has a handful of toxic rows."""
    folder = "/root/testdata/sf0.01"
    scored = registry.queries()["op8_toxicity"](spark, folder)
    counts = toxicity.accuracy(scored, spark.read.parquet(f"{folder}/labels.parquet"))
    assert isinstance(counts, Counter)
    assert counts[0, 0] / (counts[0, 0] + counts[0, 1]) > 0.95
    assert counts[1, 1] / (counts[1, 0] + counts[1, 1]) > 0.6
    assert np.isclose(sum(counts.values()), 94, atol=60)
