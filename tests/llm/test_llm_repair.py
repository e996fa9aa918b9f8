"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from oreline.llm import registry, repair

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
LAST = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        named = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(named.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    def place(row):
        _, turn, role, text = row
        digest = hashlib.sha256(text.encode()).digest()
        return (turn is not None, turn or 0, role, text[:32], digest)

    return sorted(rows, key=place)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        if BLANK.match(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if LAST.search(text)[0] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Uniform-cost search over (rows done, last role); the queue orders by cost, then by audit."""
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, last, lines = heapq.heappop(queue)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, lines
        on = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}
        heapq.heappush(queue, (cost + 5, audit + "I", at, on, (*lines, f"{name[on]}:")))
        if at == len(rows):
            continue
        _, _, role, text = rows[at]
        heapq.heappush(queue, (cost + 2, audit + "D", at + 1, last, lines))
        if found[at] not in ("blank", "duplicate"):
            more = 5 if found[at] == "truncated" else 0
            if role[:1] == on or (role[:1] == "s" and last == ""):
                kept = (cost + more, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}"))
                heapq.heappush(queue, kept)
            changed = (*lines, f"{name[on]}:{text}")
            heapq.heappush(queue, (cost + 1 + more, audit + "R", at + 1, on, changed))


def report(rows):
    rows = in_order(rows)
    found = faults(rows)
    cost, audit, lines = cheapest(rows, found)
    turns = [r[1] for r in rows if r[1] is not None]
    starts = [r[2][:1] for r in rows]
    pairs = [a + b for a, b in zip(starts, starts[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(kind) for kind in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def reports(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((conv, turn, *(" " if x is None else x for x in (role, text))))
    return {conv: report(some) for conv, some in groups.items()}


SCHEMA = (
    "conv_id long, turn long, role string, text string, digest string, part int, n int, code int"
)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "d", 1, 2, 3) for r in rows], SCHEMA).repartition(parts)


def noisy(seed, conversations, most, roles="user assistant system tool u  usher".split(" ")):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No", "Why?", " ", "", "One two. ", "One two", "End!\n"]
    texts += ["x" * 40 + "a.", "x" * 40 + "b."]
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = rng.choice(texts) if rng.random() < 0.6 else f"Text {rng.random()}."
            rows.append((conv, turn * 2 if rng.random() < 0.8 else None, role, text))
    return rows


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_query_over_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = registry.queries()["op11_conversation_repair"](spark, sf_dir)
    want = dict.fromkeys((r[0] for r in rows), report([])) | reports(damage(rows))
    assert got(found) == want


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_repairs_equal_the_search(spark, block_rows):
    rows = noisy(1, 150, 9)
    rows += [(None, *r[1:]) for r in rows[:7]] + rows[20:40] + [rows[0]] * 5
    rows += [(900, None, None, None), (901, 3, None, "a")]
    rows += [(902, -5, "assistant", "ok."), (902, 2**40, "s", "s.")]
    assert got(repair.audits(frame(spark, rows), block_rows=block_rows)) == reports(rows)


@pytest.mark.parametrize("kind", ["noisy", "truncated", "alternating", "blank", "repeated"])
@pytest.mark.parametrize("fix_ups", [0, 3])
def test_one_long_conversation_over_many_partitions(spark, kind, fix_ups):
    rng = random.Random(3)
    if kind == "noisy":
        said = [("user", "a{}."), ("assistant", "b{}."), ("tool", "c{}"), ("system", "s.")]
        said = [rng.choice(said) for _ in range(300)]
        rows = [(7, i, role, text.format(i)) for i, (role, text) in enumerate(said)]
    elif kind == "truncated":
        roles = rng.choices(["user", "assistant", "tool"], k=300)
        rows = [(7, i, role, f"no end {i}") for i, role in enumerate(roles)]
    elif kind == "alternating":
        rows = [(7, i, ("user", "assistant")[i % 2], f"t{i}.") for i in range(301)]
    elif kind == "blank":
        rows = [(7, i, "user", " \n") for i in range(300)] + [(7, 901, "assistant", "ok.")]
    else:
        rows = [(7, 1, "user", "same.")] * 300 + [(7, 2, "assistant", "end.")]
    rows += [(6, 1, "user", "a."), (8, 1, "assistant", "b."), (8, 2, "user", "c")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = got(repair.audits(frame(spark, rows), block_rows=16, fix_ups=fix_ups))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == reports(rows)


def test_repaired_turns(spark):
    rows = noisy(5, 60, 8)
    lines, audits = defaultdict(list), defaultdict(str)
    for r in sorted(repair.repair(frame(spark, rows)).collect()):
        audits[r.conv_id] += r.edit
        assert (r.edit == "D") == (r.role is None) == (r.text is None)
        if r.role is not None:
            lines[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, (*_, audit, digest) in reports(rows).items():
        assert audits[conv] == audit
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == digest


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repaired_conversations(none).collect() == []
    assert repair.repair(none).collect() == []


def test_damage_and_conversations_of_which_nothing_is_left(spark):
    rows = [(c, t, "user", "Ask. Again!") for c in range(40) for t in range(2)]
    rows += [(c, 1, "user", "Alone.") for c in range(100, 160)]
    rows += [(None, None, None, None), (5, None, "assistant", None)]
    want = dict.fromkeys((r[0] for r in rows), report([])) | reports(damage(rows))
    assert got(repair.repaired_conversations(frame(spark, rows))) == want
    assert report([]) in want.values()


def test_long_text_and_hot_equal_rows(spark):
    rows = [(1, 0, "user", "w " * 500_000 + "."), (1, 1, "assistant", "ok.")]
    rows += [(None, None, "user", "again.")] * 5000
    assert got(repair.audits(frame(spark, rows))) == reports(rows)
