"""Byte-level BPE: encoding by backtracking over longest matches, and decoding."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable

import ahocorasick
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import map_slices, table
from shelfwise.llm.pretokens import splitter, units

#: Most units whose ids a Python worker remembers; beyond that it starts a new memo.
MEMO_UNITS = 400_000
#: Most adjacent pairs whose compatibility a worker remembers.
MEMO_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _remember(memo: dict[str, tuple[int, ...]], key: str, ids: tuple[int, ...]) -> None:
    if len(key) <= 64:
        if len(memo) >= MEMO_UNITS:
            memo.clear()
        memo[key] = ids


class BacktrackingEncoder:
    """Exact BPE without running merges over the text.

    Bytes are mapped to Latin-1 characters, so that a string automaton finds all vocabulary
    entries. A token sequence is the BPE result exactly if each adjacent pair is compatible
    (the two tokens' joined bytes encode to those two tokens). The search takes the longest
    match first and backs out of positions that no compatible sequence reaches; a prefix has
    only one such sequence, so a dead position is dead for good and the walk is linear.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """BPE by its definition, for the few bytes of two tokens."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best = min(((r, i) for r, i in found if r is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            starts[end - match[0] + 1].append(match)  # of one start, short ones first
        known, compatible, dead = self.pairs, self.compatible, bytearray(n + 1)
        tokens: list[int] = []
        # open_at: (start, matches not yet tried) of each token chosen so far and of the next one
        open_at = [(0, starts[0])]
        last = -1
        while True:
            here, untried = open_at[-1]
            while untried:
                length, token = untried.pop()
                end = here + length
                if dead[end]:
                    continue
                fits = last < 0 or known.get((last, token))
                if fits is None:
                    fits = compatible(last, token)
                if fits:
                    tokens.append(token)
                    if end == n:
                        return tuple(tokens)
                    last = token
                    open_at.append((end, starts[end]))
                    break
            else:
                if not tokens:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[here] = 1
                open_at.pop()
                tokens.pop()
                last = tokens[-1] if tokens else -1

    def unit(self, unit: str, split: Callable[[str], list[str]]) -> tuple[int, ...]:
        get, out = self.pieces.get, []
        for w in split(unit):
            found = get(w)
            if found is None:
                found = self.piece(w.encode("utf-8"))
                _remember(self.pieces, w, found)
            out += found
        ids = tuple(out)
        _remember(self.memo, unit, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        get, out = self.memo.get, []
        split = splitter(text)
        for u in units(text, split):
            out += get(u) or self.unit(u, split)
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> BacktrackingEncoder:
    return BacktrackingEncoder(read_ranks(path))


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    return {i: b for b, i in read_ranks(path).items()}


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each whole text, one row per input row; no shuffle.

    A null text counts as empty and gives no ids; null and repeated ids pass through; other
    columns of ``docs`` are ignored. Strings of special tokens are ordinary text.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        enc = encoder(vocabulary)
        return {"doc_id": cols["doc_id"], "ids": [enc.encode(t) for t in cols["text"]]}

    return map_slices(rows, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``data``, the bytes the ids stand for; an id out of the vocabulary raises."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        get = token_bytes(vocabulary).__getitem__
        return {**cols, "data": [b"".join(map(get, ids)) for ids in cols["ids"]]}

    return map_slices(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids array<int>, data binary")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded bytes of each whole text.

    The ids are encoded and decoded in one pass over the texts; only digests leave the task.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        enc, get = encoder(vocabulary), token_bytes(vocabulary).__getitem__
        out: dict[str, list] = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in cols["text"]:
            ids = enc.encode(text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(b"".join(map(get, ids))).hexdigest())
        return out

    return map_slices(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
