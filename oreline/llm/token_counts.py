"""Token counts under a unigram model, by dynamic programming over a trie.

A text is cut into pre-tokens at white space, each with the vocabulary's word mark before it. The
tokens of a pre-token are those of its best segmentation: the pieces whose scores add up to the
most, the fewest of them if several segmentations do. The best score of a prefix depends on the
prefix alone, so distinct pre-tokens are inserted in a trie whose nodes keep their forward score and
token count; a prefix that many pre-tokens share is computed once, and a pre-token's count is read
off the node where it ends. Each task keeps a trie of its own over the texts it reads, a run of texts
at a time, of which each different pre-token is looked up once. A trie that has grown to ``nodes``
nodes is started anew, and a pre-token of over ``LONG_WORD`` characters gets no nodes: its prefixes
are kept only as far back as the longest piece. So memory is bounded and nothing is shuffled.

Pieces come from a public vocabulary file. Its scores are merge ranks, not probabilities, so a piece's
score is the logarithm of a probability that falls with its rank: ``1 / (rank + RANK_SHIFT)`` over the
sum of these (Zipf's law in Mandelbrot's form). A character that no piece holds costs the lowest score
minus ten and counts as one token per byte.

Defined results: missing and empty texts have no tokens; repeated rows and ids are counted row by
row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.tokens import text_runs

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_MARK = "▁"
NODES = 400_000
LONG_WORD = 256
# Flattens the probabilities of the very first pieces.
RANK_SHIFT = 2.7
_UNKNOWN_PENALTY = 10.0


def vocabulary(path: str = PIECES) -> dict[str, float]:
    """Log-probabilities of the ordinary pieces of a vocabulary file, as many as it has, read once."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    ordinary = [i for i in range(model.get_piece_size()) if not any(is_odd(i) for is_odd in odd)]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return unigram_scores([model.id_to_piece(i) for i in ordinary])


def unigram_scores(ranked: list[str], shift: float = RANK_SHIFT) -> dict[str, float]:
    """Log-probabilities of pieces that are given in the order of their ranks."""
    weights = [1.0 / (rank + shift) for rank in range(len(ranked))]
    total = math.log(sum(weights)) if weights else 0.0
    return {p: math.log(w) - total for p, w in zip(ranked, weights, strict=True)}


class Trie:
    """Forward scores and token counts of prefixes, computed as nodes are made."""

    def __init__(self, scores: dict[str, float], nodes: int = NODES):
        self.scores, self.most = scores, nodes
        self.longest = max(map(len, scores), default=0)
        self.unknown = min(scores.values(), default=0.0) - _UNKNOWN_PENALTY
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.best = [(0.0, 0)]  # (score, minus tokens) of each node; the root is the empty prefix
        self.ends: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """The token count of a word, stored at the node where it ends."""
        node, path = 0, [0]
        children, best = self.children, self.best
        for end, letter in enumerate(word, 1):
            below = children.get((node, letter))
            if below is None:
                below = children[node, letter] = len(best)
                best.append(self._forward(word, end, path))
            node = below
            path.append(node)
        count = self.ends[word] = -best[node][1]
        return count

    def _forward(self, word: str, end: int, path: list[int]) -> tuple[float, int]:
        """The best way to the prefix of ``end`` characters, from the prefixes on its path."""
        best, scores = self.best, self.scores
        score, tokens = best[path[end - 1]]
        one = word[end - 1]
        found = (score + self.unknown, tokens - len(one.encode("utf-8", "replace")))
        if one in scores:
            found = (score + scores[one], tokens - 1)
        for start in range(max(0, end - self.longest), end - 1):
            piece = scores.get(word[start:end])
            if piece is not None:
                score, tokens = best[path[start]]
                found = max(found, (score + piece, tokens - 1))
        return found

    def slide(self, word: str) -> int:
        """The token count of a long word, from the last few prefixes alone."""
        near, longest = deque([(0.0, 0)], maxlen=max(self.longest, 1)), self.longest
        get = self.scores.get
        for end in range(1, len(word) + 1):
            one = word[end - 1]
            score, tokens = near[-1]
            found = (score + self.unknown, tokens - len(one.encode("utf-8", "replace")))
            for back in range(1, min(end, longest) + 1):
                piece = get(word[end - back : end])
                if piece is not None:
                    score, tokens = near[-back]
                    found = max(found, (score + piece, tokens - 1))
            near.append(found)
        return -near[-1][1]

    def count(self, word: str) -> int:
        found = self.ends.get(word)
        if found is not None:
            return found
        if len(word) > LONG_WORD:
            return self.slide(word)
        if len(self.best) > self.most:
            self.clear()
        return self.insert(word)


def _counts(batches: Iterator[pa.RecordBatch], scores: Broadcast, nodes: int):
    trie = Trie(scores.value, nodes)
    for batch in batches:
        for low, texts in text_runs(batch.column(1)):
            lists = pc.utf8_split_whitespace(texts)
            flat = lists.flatten().dictionary_encode()
            # Texts that begin or end with white space give empty words.
            known = flat.dictionary.to_pylist()
            each = [trie.count(WORD_MARK + w) if w else 0 for w in known]
            words = np.array([w != "" for w in known], np.int64)
            codes, ends = np.array(flat.indices), np.array(lists.offsets, np.int64)
            columns = [
                np.diff(np.concatenate([[0], np.cumsum(n[codes])])[ends - ends[0]])
                for n in (words, np.array(each, np.int64))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, len(texts)), *map(pa.array, columns)],
                ["doc_id", "n_words", "n_tokens"],
            )


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str = PIECES,
    nodes: int = NODES,
) -> DataFrame:
    """Per document: doc_id, n_words (pre-tokens), n_tokens."""
    scores = docs.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(
        partial(_counts, scores=scores, nodes=nodes), f"doc_id {kind}, n_words long, n_tokens long"
    )
