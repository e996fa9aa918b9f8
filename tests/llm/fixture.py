"""A small table with what real ones have: missing values, ties, repeats, long texts, other columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, digest string, fp long, shard int, rank int, length string, "
    "score double, item_id long, Row string, `_found` int, key string, h long, source string"
)


def vocabulary(n=400, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdeéß", k=rng.randint(1, 8))) for _ in range(n)]


def texts(seed=1):
    rng, some = random.Random(seed), vocabulary()
    prose = lambda n: " ".join(rng.choices(some, k=n))
    passage = prose(60)
    base = [prose(rng.randint(1, 90)) for _ in range(25)]
    out = [
        None, "", " \t\n", "one", "two words", "Now   three\twords",
        *base,
        *base[:6],  # copies
        base[0].replace(" ", "\n\x0b "),  # equal but for white space
        base[7] + " x", base[7].upper(), "y " + base[7],  # near copies
        *[prose(15) + " " + passage + "\n" + prose(9) for _ in range(5)],
        passage[: len(passage) // 2], passage + " " + passage,
        "la " * 70, "la " * 45 + "di " + "la " * 30,
        "a b c d", "<|endoftext|> x  y <|endoftext|>", "x" * 5000, "  lead and trail  ",
        prose(6000) + " " + passage,
        "emoji \U0001f600 你好 \x85 \x1c sep",
    ]
    return out


def rows(seed=1):
    some = texts(seed)
    ids = list(range(len(some)))
    random.Random(seed).shuffle(ids)
    pairs = [(i * 3, t) for i, t in zip(ids, some, strict=True)]
    pairs += [pairs[8], pairs[8], pairs[0]]  # repeated rows
    pairs += [(None, some[9]), (None, some[9]), (None, None), (None, "alone " * 25)]
    return pairs


def frame(spark, pairs):
    rest = ("d", 1, 2, 3, "l", 0.5, 7, "r", 9, "k", 4, None)
    return spark.createDataFrame([(i, t, *rest) for i, t in pairs], SCHEMA).repartition(3)
