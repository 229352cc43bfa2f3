"""Packing by concatenate and cut."""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.bpe import read_ranks
from shelfwise.llm.common import map_slices, table, work_table

#: The fast library takes quadratic time on a pre-token of this many characters; the other does not.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class LibraryEncoder:
    """Ids as the tokenizers library gives them, special strings as ordinary text.

    The two vocabulary files hold the same merges, and the libraries agree on every code point
    (tests/llm), so the faster one encodes all texts but those with very long runs.
    """

    def __init__(self, json_file: str, ranks_file: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(json_file)
        self.exact.encode_special_tokens = True
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_file), special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if LONG_RUN.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@functools.lru_cache(maxsize=1)
def library_encoder(json_file: str, ranks_file: str) -> LibraryEncoder:
    return LibraryEncoder(json_file, ranks_file)


@functools.lru_cache(maxsize=1)
def _counter() -> dict:
    return {"task": None, "next": 0}


def tokenise(docs: DataFrame, json_file: str, ranks_file: str, end_id: int = 0) -> DataFrame:
    """First pass: (part, doc_id, n, local_start, ids) with ``local_start`` the running total within the partition.

    ``ids`` holds little-endian unsigned 32-bit ids, ``end_id`` last. Null text counts as empty.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        enc, task, state = library_encoder(json_file, ranks_file), TaskContext.get(), _counter()
        if state["task"] != task.taskAttemptId():
            state.update(task=task.taskAttemptId(), next=0)
        out: dict[str, list] = {"doc_id": cols["doc_id"], "part": [], "n": [], "local_start": [], "ids": []}
        for text in cols["text"]:
            ids = np.array([*enc.encode(text), end_id], dtype="<u4")
            out["part"].append(task.partitionId())
            out["n"].append(len(ids))
            out["local_start"].append(state["next"])
            out["ids"].append(ids.tobytes())
            state["next"] += len(ids)
        return out

    return map_slices(rows, run, f"part int, doc_id {kind}, n long, local_start long, ids binary")


def partition_bases(tokens: DataFrame) -> tuple[DataFrame, int]:
    """Second pass's offsets: one row per partition of the token table, and the grand total."""
    totals = sorted((r["part"], r["total"]) for r in tokens.groupBy("part").agg(F.sum("n").alias("total")).collect())
    rows, base = [], 0
    for part, total in totals:
        rows.append((part, base))
        base += total
    return tokens.sparkSession.createDataFrame(rows, "part int, base long"), base


def pack(
    docs: DataFrame,
    json_file: str,
    ranks_file: str,
    length: int = 1024,
    end_id: int = 0,
) -> DataFrame:
    """Lay all documents end to end and cut the stream every ``length`` ids; one row per piece.

    Rows: doc_id, start (ids of the document before the piece), length, ids (array<int>),
    ids_crc32, doc_tokens, sequence_id, offset, continues (a boundary record: the document
    goes on in the next sequence), filled (ids in the sequence) and padded_length (``length``,
    or ``filled`` where that is a power of two). Only the last sequence can be short.

    Ids are kept once in the shared folder; only partition totals, one row per input partition,
    pass through the driver. No shuffle of texts or ids. Null text gives the end id alone;
    repeated and null doc_ids are separate documents; an empty table gives no rows.
    """
    tokens = work_table(tokenise(docs, json_file, ranks_file, end_id))
    bases, total = partition_bases(tokens)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    last, rest = divmod(total, length)

    def cut(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {
            k: []
            for k in (
                "doc_id start length ids ids_crc32 doc_tokens sequence_id offset continues filled padded_length"
            ).split()
        }
        for doc, n, base, local, data in zip(
            cols["doc_id"], cols["n"], cols["base"], cols["local_start"], cols["ids"], strict=True
        ):
            start = 0
            while start < n:
                sequence, offset = divmod(base + local + start, length)
                size = min(n - start, length - offset)
                piece = data[4 * start : 4 * (start + size)]
                filled = rest if sequence == last else length
                power = filled & (filled - 1) == 0
                for k, v in zip(
                    out,
                    (
                        doc, start, size, np.frombuffer(piece, "<u4").astype("i4"), zlib.crc32(piece), n,
                        sequence, offset, start + size < n, filled, filled if power else length,
                    ),
                    strict=True,
                ):
                    out[k].append(v)
                start += size
        return out

    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", "n", "base", "local_start", "ids")
    return map_slices(
        placed,
        cut,
        f"doc_id {kind}, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, continues boolean, filled long, padded_length long",
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path
    return pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


def op9_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document."""
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")
