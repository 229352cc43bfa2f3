"""Unigram token counts by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.bpe import read_ranks
from shelfwise.llm.common import map_slices, table
from shelfwise.llm.pretokens import splitter, units

#: Trie nodes and remembered units of a worker before it starts afresh.
MAX_NODES = 800_000
MAX_UNITS = 400_000


def unigram_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Zipf log probabilities of a ranked vocabulary: p(rank) proportional to 1 / (rank + 2.7).

    The public vocabularies carry ranks, not probabilities; this rule stands in for them.
    Scores are multiples of 2**-20, so that sums are exact and ties do not hang on order.
    """
    total = sum(1 / (r + 2.7) for r in ranks.values())
    return {b: round(-math.log((r + 2.7) * total) * 2**20) / 2**20 for b, r in ranks.items()}


class CountingTrie:
    """Best unigram segmentation of each distinct pre-token, one forward step per trie node.

    A node stands for a prefix and keeps its forward score: the highest, and among equal
    scores the fewest tokens. Pre-tokens with a common prefix share its nodes.
    """

    def __init__(self, scores: dict[bytes, float]) -> None:
        self.scores = scores
        self.longest = max(map(len, scores))
        self.counts: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        self.child: dict[int, int] = {}  # by node * 256 + byte
        self.score: list[float] = [0.0]
        self.tokens: list[int] = [0]
        self.terminal: dict[bytes, int] = {}

    def insert(self, piece: bytes) -> int:
        """Tokens of the best segmentation of ``piece``; the terminal keeps the count."""
        count = self.terminal.get(piece)
        if count is not None:
            return count
        if len(self.score) + len(piece) > MAX_NODES and len(self.score) > 1:
            self.reset()
        child, node, path = self.child, 0, [0]
        for depth, byte in enumerate(piece, 1):
            key = node << 8 | byte
            nxt = child.get(key)
            if nxt is None:
                nxt = child[key] = len(self.score)
                self.forward(piece, depth, path)
            node = nxt
            path.append(node)
        count = self.terminal[piece] = self.tokens[node]
        return count

    def forward(self, piece: bytes, depth: int, path: list[int]) -> None:
        """Append the best score and token count of the prefix that ends at ``depth``."""
        scores, best, fewest = self.scores, -math.inf, 0
        for start in range(max(0, depth - self.longest), depth):
            own = scores.get(piece[start:depth])
            if own is not None:
                before = path[start]
                total, n = self.score[before] + own, self.tokens[before] + 1
                if total > best or total == best and n < fewest:
                    best, fewest = total, n
        self.score.append(best)
        self.tokens.append(fewest)

    def unit(self, unit: str, split: Callable[[str], list[str]]) -> int:
        n = sum(self.insert(w.encode("utf-8")) for w in split(unit))
        if len(unit) <= 64:
            if len(self.counts) >= MAX_UNITS:
                self.counts.clear()
            self.counts[unit] = n
        return n

    def count(self, text: str) -> int:
        get, split = self.counts.get, splitter(text)
        return sum(get(u) or self.unit(u, split) for u in units(text, split))


@functools.lru_cache(maxsize=2)
def trie(path: str) -> CountingTrie:
    return CountingTrie(unigram_scores(read_ranks(path)))


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_chars) of each whole text under the unigram model; no shuffle.

    Each task keeps its own trie, bounded in nodes, so distinct pre-tokens are scored once per
    worker and nothing crosses the network. A null text counts as empty (0 tokens); null and
    repeated ids pass through; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        t = trie(vocabulary)
        return {
            "doc_id": cols["doc_id"],
            "n_tokens": [t.count(x) for x in cols["text"]],
            "n_chars": [len(x) for x in cols["text"]],
        }

    return map_slices(rows, run, f"doc_id {kind}, n_tokens long, n_chars long")


def op8_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
