"""Encoding, packing, token records, token counts."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import fixture
import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from oreline.llm import packing, records, registry, token_counts
from oreline.llm.tokens import BYTE_BPE, Encoder, blocks
from oreline.session import scratch_path

ODD = [
    "a", "B", "é", "'s", "'", "''", "\n", "\n\n", " ", "  ", "\t", "\r\n", "5", "²", "½", "Ⅷ", "_",
    "-", "!?", " ", "\x85", "\x1c", "你好", "\U0001f600", "é", "'ll", "don't", "ª", "ʰ",
    "<|endoftext|>", "x", "٣", "​", "　", "\xa0", ".", ",", ";:", "word", "Word",
]


@pytest.fixture(scope="module")
def pairs():
    return fixture.rows()


@pytest.fixture(scope="module")
def docs(spark, pairs):
    return fixture.frame(spark, pairs)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Path(BYTE_BPE).read_text(encoding="utf-8"))


@pytest.fixture(scope="module")
def plain_ids(encoder):
    def ids(text):
        return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids

    return ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library_on_odd_texts(encoder, plain_ids):
    rng = random.Random(8)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 9))) for _ in range(8000)]
    texts += [t for t in fixture.texts() if t is not None]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [plain_ids(t) for t in texts]


@pytest.fixture(scope="module")
def fresh_ids():
    """The plain call of the library, on a tokenizer that nobody has set anything on."""
    plain = tokenizers.Tokenizer.from_file(str(BYTE_BPE))
    return lambda text: plain.encode(text or "", add_special_tokens=False).ids


def test_special_tokens_have_their_ids(encoder, fresh_ids):
    end = "<|endoftext|>"
    assert fresh_ids(f"one {end} two") == [505, 220, 50256, 734]
    rng = random.Random(12)
    texts = [
        f"one {end} two", end, end + end, f"{end}start", f"the end{end}", f"a{end}b", f"a  {end}  b",
        f"{end} ", f" \n {end}\n", f"<|{end}|>", end[:-1], end[1:], end.upper(), f"é{end}你",
    ]
    texts += ["".join(rng.choices([*ODD, end, end, " "], k=rng.randint(0, 12))) for _ in range(4000)]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [fresh_ids(t) for t in texts]


def test_special_tokens_in_records_and_packing(spark, fresh_ids):
    texts = ["one <|endoftext|> two", "<|endoftext|>", "x<|endoftext|>", "<|endoftext|>y", "plain"]
    docs = fixture.frame(spark, list(enumerate(texts)))
    at = 0
    for r in sorted(records.round_trip(spark, docs).collect(), key=lambda r: r.doc_id):
        ids = [*fresh_ids(texts[r.doc_id]), records.END_ID]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    rows = packing.pack_documents(docs, capacity=4).collect()
    check_packing(rows, [(i, fresh_ids(t)) for i, t in enumerate(texts)], 4, 2)


def test_special_tokens_with_rules_of_their_own():
    own = tokenizers.Tokenizer.from_file(str(BYTE_BPE))
    own.add_special_tokens([tokenizers.AddedToken("<mask>", lstrip=True)])
    texts = ["a  <mask> b", "<|endoftext|> <mask>", "no"]
    got = [np.frombuffer(b, "<u4").tolist() for b in Encoder(own.to_str()).encode(texts)]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_forgets_and_stays_right(plain_ids):
    small = Encoder(Path(BYTE_BPE).read_text(encoding="utf-8"), kept=30)
    texts = [t for t in fixture.texts() if t]
    for _ in range(2):
        for text in texts:
            assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == plain_ids(text)
            assert small.known.held <= 30 + 2 * len(text)


def test_blocks_cover_all_texts():
    assert list(blocks(["aa", "", "bbb", "c"], 3)) == [(0, 3), (3, 4)]
    assert list(blocks([])) == []


def check_packing(rows, ids_of, capacity, end):
    """Pieces rebuild the documents; sequences are gapless and within the capacity."""
    by_doc = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = Counter()
    for doc_id, ids in ids_of:
        ids, at, length, piece = [*ids, end], 0, (len(ids) + 1) % capacity or capacity, 0
        while at < len(ids):
            want[doc_id, piece, at, length, crc(ids[at : at + length])] += 1
            at, length, piece = at + length, capacity, piece + 1
    assert by_doc == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 64, 7])
def test_packing(docs, pairs, plain_ids, capacity):
    rows = packing.pack_documents(docs, capacity=capacity).collect()
    used = check_packing(rows, [(i, plain_ids(t)) for i, t in pairs], capacity, 2)
    assert used <= 1.02 * brute.best_fit([r.length for r in rows], capacity) + 1


def pieces_of(spark, lengths):
    """Pieces as one task numbers them, without texts."""
    seen, rows = Counter(), []
    for i, length in enumerate(lengths):
        rows.append((i, 0, 0, length, 0, i % 3, seen[i % 3, length]))
        seen[i % 3, length] += 1
    return spark.createDataFrame(rows, f"doc_id long, {packing._PIECE_COLUMNS}")


@pytest.mark.parametrize("kind", ["uniform", "tiny", "equal", "halves", "two sizes", "none"])
def test_packing_takes_about_as_few_sequences_as_best_fit(spark, kind):
    rng = random.Random(4)
    lengths = {
        "uniform": [rng.randint(1, 100) for _ in range(600)],
        "tiny": [rng.randint(1, 3) for _ in range(500)] + [99] * 3,
        "equal": [34] * 200,
        "halves": [50] * 101 + [51] * 30,
        "two sizes": [60] * 80 + [20] * 190,
        "none": [],
    }[kind]
    rows = packing.pack(pieces_of(spark, lengths), 100).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for some in sequences.values():
        ends = np.cumsum([n for _, n in sorted(some)])
        assert [o for o, _ in sorted(some)] == [0, *ends[:-1]] and ends[-1] <= 100
    assert len(sequences) <= 1.02 * brute.best_fit(lengths, 100) + 1


def test_token_records_round_trip(spark, docs, pairs, plain_ids):
    got = records.round_trip(spark, docs).collect()
    order = sorted(got, key=lambda r: r.start)
    known = [r.doc_id for r in order if r.doc_id is not None]
    # Rows without an id first, then ascending ids.
    assert [r.doc_id for r in order] == [None] * (len(order) - len(known)) + sorted(known)
    at = 0
    for r in order:
        assert r.start == at
        at += r.n_tokens
    want = Counter((i, len(plain_ids(t)) + 1, crc([*plain_ids(t), 0])) for i, t in pairs)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def test_records_are_read_through_the_index_in_any_order(spark, docs):
    folder = scratch_path(spark, "records-test")
    manifest = records.write_records(docs, folder)
    rows = manifest.collect()
    assert sum(r.records for r in rows) == docs.count()
    one = max(rows, key=lambda r: r.records)
    path = one.path.removeprefix("file:")
    data = Path(f"{path}.records").read_bytes()
    index = np.fromfile(f"{path}.index", "<u8").reshape(-1, 2)
    assert len(index) == one.records and len(data) == one.bytes
    for place in random.Random(1).sample(index[:, 0].tolist(), len(index)):
        payload, behind = records.unframe(data, place)
        assert behind == len(data) or behind in index[:, 0]
        assert len(payload) >= 9


def test_damage_is_found():
    whole = records.frame(b"payload") + records.frame(b"")
    assert records.unframe(whole) == (b"payload", 23)
    assert records.unframe(whole, 23) == (b"", len(whole))
    for at in (0, 9, 14, 20):
        broken = bytearray(whole)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            records.unframe(bytes(broken))
    # The mask: rotated right by 15 bits, plus a constant.
    assert records.masked_checksum(b"") == 0xA282EAD8


def plain_counts(rows, scores):
    unknown, seen, out = min(scores.values()) - 10, {}, Counter()
    for doc_id, text in rows:
        found = ["▁" + w for w in (text or "").split()]
        for word in set(found) - set(seen):
            seen[word] = brute.unigram_tokens(word, scores, unknown)
        out[doc_id, len(found), sum(seen[w] for w in found)] += 1
    return out


def test_token_counts_equal_plain_dynamic_programming(docs, pairs):
    got = Counter(tuple(r) for r in token_counts.token_counts(docs, nodes=500).collect())
    assert got == plain_counts(pairs, token_counts.vocabulary())


def test_op3_over_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = Counter(map(tuple, registry.queries()["op3_token_counts"](spark, sf_dir).collect()))
    assert got == plain_counts(map(tuple, table.collect()), token_counts.vocabulary())


def test_op5_over_the_whole_table(spark, sf_dir, fresh_ids):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    at, want = 0, []
    for doc_id, text in sorted(map(tuple, table.collect())):
        ids = [*fresh_ids(text), 0]
        want.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    got = registry.queries()["op5_token_records"](spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == want


def test_frequent_words_stay_whole():
    trie = token_counts.Trie(token_counts.vocabulary())
    for word in ("the", "information", "children", "people", "government", "history"):
        assert trie.count("▁" + word) == 1


def test_an_unbroken_text_takes_bounded_memory():
    trie = token_counts.Trie(token_counts.vocabulary(), nodes=2000)
    long = "".join(random.Random(1).choices("abcdefgh", k=60_000))
    tracemalloc.start()
    count = trie.count(long)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1_000_000 and len(trie.best) == 1 and not trie.ends
    scores = token_counts.vocabulary()
    assert count == brute.unigram_tokens(long, scores, min(scores.values()) - 10)
    for k in range(200):
        trie.count(long[100 * k : 100 * k + 200])
        assert len(trie.best) <= 2000 + token_counts.LONG_WORD


def test_equal_rows_are_spread_over_shards(spark):
    docs = spark.range(40_000).selectExpr("cast(null AS long) AS doc_id", "'' AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = scratch_path(spark, "records-hot")
        shards = records.write_records(docs.repartition(8), folder).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r.records for r in shards) == 40_000
    assert len(shards) > 2 and max(r.records for r in shards) < 20_000


def test_trie_shares_prefixes():
    trie = token_counts.Trie({"a": -1.0, "ab": -1.5, "abc": -9.0, "c": -1.0})
    assert [trie.insert(w) for w in ("ab", "abc", "abd", "")] == [1, 2, 2, 0]
    assert len(trie.best) == 1 + len({"a", "ab", "abc", "abd"})


def test_empty_tables(spark):
    empty = fixture.frame(spark, [(1, "x")]).where(F.col("doc_id") > 1)
    assert packing.pack_documents(empty).count() == 0
    assert records.round_trip(spark, empty).count() == 0
    assert token_counts.token_counts(empty).count() == 0
