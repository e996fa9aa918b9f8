"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def after(doc_id):
    """Order of ids, missing ones last."""
    return (doc_id is None, doc_id or 0)


def exact_groups(rows):
    """digest -> (keep_id, size) of rows (doc_id, text)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[sha(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""))].append(doc_id)
    return {d: (min(ids, key=after), len(ids)) for d, ids in groups.items()}


def fingerprint(text, shingle=3):
    found = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(found[k : k + shingle]) for k in range(len(found) - shingle + 1)]
    if found and not shingles:
        shingles = [" ".join(found)]
    votes = [0] * 64
    for one in shingles:
        h = xxhash.xxh64_intdigest(one.encode(), 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def classes(prints, most=3):
    """For each fingerprint the index of the first one that links reach."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def stripped(rows, window=20):
    """(n_words, n_removed, digest of kept words) of rows (doc_id, text)."""

    def place(doc_id, text):
        if doc_id is not None:
            return (False, doc_id)
        # Spark's hash of a text: XXH64, seed 42, signed.
        h = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return (True, h - (1 << 64) if h >> 63 else h)

    first = {}
    for doc_id, text in rows:
        found = words(text)
        for k in range(len(found) - window + 1):
            key, at = tuple(found[k : k + window]), (place(doc_id, text), k)
            first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, text in rows:
        found = words(text)
        gone = set()
        for k in range(len(found) - window + 1):
            if first[tuple(found[k : k + window])] < (place(doc_id, text), k):
                gone.update(range(k, k + window))
        kept = " ".join(w for i, w in enumerate(found) if i not in gone)
        out.append((len(found), len(gone), sha(kept)))
    return out


def best_fit(lengths, capacity):
    """Sequences that best-fit decreasing takes."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, length)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        n += gap == capacity
        if gap > length:
            bisect.insort(gaps, gap - length)
    return n


def tiles(item, text, shortest=5):
    """Greedy string tiling: the longest unmarked common run first, leftmost in the item."""
    free_i, free_t, found = [True] * len(item), [True] * len(text), []
    while True:
        best = (shortest - 1, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (
                    i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n]
                    and free_i[i + n] and free_t[t + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < shortest:
            return found
        free_i[i : i + n] = [False] * n
        free_t[t : t + n] = [False] * n
        found.append(best)


def unigram_tokens(word, scores, unknown):
    """Tokens of the best segmentation of one pre-token."""
    best, longest = [(0.0, 0)], max(map(len, scores))
    for end in range(1, len(word) + 1):
        options = [
            (best[s][0] + scores[word[s:end]], best[s][1] - 1)
            for s in range(max(0, end - longest), end)
            if word[s:end] in scores
        ]
        if word[end - 1] not in scores:
            score, tokens = best[end - 1]
            options.append((score + unknown, tokens - len(word[end - 1].encode())))
        best.append(max(options))
    return -best[-1][1]
