"""Alignment of two tokenizers against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import fixture
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from test_llm_tokens import ODD

from oreline.llm import alignment, registry
from oreline.llm.tokens import BYTE_BPE


@pytest.fixture(scope="module")
def plain():
    a = tokenizers.Tokenizer.from_file(str(BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(alignment.PIECE_BPE))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict(zip(map(chr, printable), printable, strict=True))
    hidden = [byte for byte in range(256) if byte not in printable]
    letters |= {chr(256 + k): byte for k, byte in enumerate(hidden)}

    def tokens(text):
        """(id, bytes) of A and of B."""
        of_a = [
            (i, bytes(letters[c] for c in a.id_to_token(i)))
            for i in a.encode(" " + text, add_special_tokens=False).ids
        ]
        of_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            data = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
            of_b.append((i, data))
        return of_a, of_b

    return tokens


def ends(tokens):
    at, out = 0, []
    for _, data in tokens:
        at += len(data)
        out.append(at)
    return out


def aligned(text, plain):
    """Groups and links of one text; None if it has no tokens."""
    if not text:
        return None
    a, b = plain(text)
    if any(b"".join(data for _, data in side) != (" " + text).encode() for side in (a, b)):
        return None
    ends_a, ends_b = ends(a), ends(b)
    common = sorted({*ends_a} & {*ends_b})
    links, groups, at = [], [], (0, 0)
    for e in common:
        i, k = ends_a.index(e, at[0]) + 1, ends_b.index(e, at[1]) + 1
        groups.append([[x for x, _ in a[at[0] : i]], [x for x, _ in b[at[1] : k]]])
        links.append((a[i - 1][0], b[k - 1][0]))
        at = (i, k)
    return len(a), len(b), groups, links


def report(rows, plain):
    known = {t: aligned(t, plain) for t in {t for _, t in rows}}
    counts = Counter(link for _, t in rows if known[t] for link in known[t][3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, text in rows:
        if known[text] is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = known[text]
        named = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), len(links),
            sum(counts[link] == best[link[1]] for link in links),
            sum(counts[link] for link in links), hashlib.sha256(named.encode()).hexdigest(),
        ))
    return Counter(out)


def got(df):
    return Counter(map(tuple, df.collect()))


MORE = ["a ▁b", "▁", "<s>", "</s> x", "<unk>", "<0x41>", " lead", "trail ", "a  b   c", "\x00", "x\x00 y", "ﬁ ½"]


def test_ids_equal_the_libraries(plain):
    """But for B on texts with its own sign for a space, which are not aligned."""
    pair = alignment.Pair(
        Path(BYTE_BPE).read_text(encoding="utf-8"), Path(alignment.PIECE_BPE).read_bytes()
    )
    rng = random.Random(4)
    texts = ["".join(rng.choices([*ODD, *MORE, " "], k=rng.randint(0, 9))) for _ in range(4000)]
    texts += [t for t in fixture.texts() if t]
    for side, encode in enumerate((pair.a.encode_batch, pair.ids_b)):
        ids, at = encode(pa.array(texts))
        for k, text in enumerate(texts):
            if side and "▁" in text:
                continue
            assert ids[at[k] : at[k + 1]].tolist() == [i for i, _ in plain(text)[side]], text


@pytest.mark.parametrize("most", [0, 10**6])
def test_alignment(spark, plain, most):
    rng = random.Random(9)
    rows = fixture.rows() + [(1000 + k, t) for k, t in enumerate(MORE)]
    rows += [
        (2000 + k, "".join(rng.choices([*ODD, *MORE, " "], k=rng.randint(0, 12)))) for k in range(150)
    ]
    found = alignment.alignment(fixture.frame(spark, rows), broadcast_pairs=most)
    assert got(found) == report(rows, plain)


def test_groups_rebuild_the_texts(spark, plain):
    rows = [(k, t) for k, t in enumerate([*fixture.texts(), *MORE])]
    texts = dict(rows)
    for r in alignment.align(fixture.frame(spark, rows)).collect():
        want = aligned(texts[r.doc_id], plain)
        if want is None:
            assert (r.a, r.b, r.groups, r.links) == ([], [], [], [])
            continue
        low, groups = (0, 0), []
        for g in r.groups:
            groups.append([r.a[low[0] : g.a_end], r.b[low[1] : g.b_end]])
            low = (g.a_end, g.b_end)
        assert groups == want[2]
        assert [tuple(x) for x in r.links] == want[3]


def test_query_over_the_whole_table(spark, sf_dir, plain):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    found = registry.queries()["op12_cross_tokenizer_alignment"](spark, sf_dir)
    assert got(found) == report(rows, plain)


def test_empty_table(spark):
    none = fixture.frame(spark, [])
    assert alignment.alignment(none).collect() == []
    assert alignment.align(none).collect() == []
