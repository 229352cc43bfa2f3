"""Repeated passages: bytes covered by a long string that starts elsewhere too.

Every string of ``length`` bytes has an anchor, the smallest of its ANCHOR-byte pieces by hash, which
equal strings have at the same place. A document so falls into runs of starts with one anchor, and
only runs with equal anchors can hold equal strings. Anchors that occur once need no more work; where
all runs of an anchor are the same text they repeat as a whole. The rest, where texts begin to
differ, goes by its anchor to buckets. There the runs' texts get shard Burrows-Wheeler transforms,
which interleave refinement merges to the intervals of equal ``length``-byte prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bwt
from shelfwise.llm.common import drop_work_table, map_slices, ship, table, work_table

LENGTH = 200
ANCHOR = 80
#: Text in a bucket, in a shard, and most different runs of one anchor that a bucket takes whole.
BUCKET_BYTES = 800_000
SHARD_BYTES = 256_000
ANCHOR_RUNS = 4096
#: Starts of a document that are hashed at once.
BLOCK = 1 << 18
_LOW = np.uint64((1 << 24) - 1)

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]


def _powers(n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    up, down = [], []
    for base in _BASE:
        for out, b in ((up, base), (down, pow(base, -1, 2**64))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
    return up, down


_POWERS: list = []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def runs(data: bytes, length: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, run hash, first start, starts) of the runs of ``data``, a block at a time.

    The run hash covers the run's whole text and the anchor's place in it.
    """
    if not _POWERS:
        _POWERS.append(_powers(BLOCK + 4096))
    up, down = _POWERS[0]
    window = length - anchor + 1
    for at in range(0, len(data) - length + 1, BLOCK):
        part = np.frombuffer(data, np.uint8)[at : at + BLOCK + length - 1]
        n = len(part)
        sums = []
        for k in range(2):
            s = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[k][part] * up[k][:n], out=s[1:])
            sums.append(s)
        h = _mixed((sums[0][anchor:] - sums[0][:-anchor]) * down[0][: n - anchor + 1])
        low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= window:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if window > span:
            low = np.minimum(low[: len(h) - window + 1], low[window - span :])
        place = (low & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[first, len(place)])
        end = first + count + length - 1
        text = (sums[1][end] - sums[1][first]) * down[1][first]
        where = ((place[first] - first) << 32 | count).astype(np.uint64)
        yield h[place[first]], _mixed(_mixed(text) + where), first + at, count


def text_key(text: Column) -> list[Column]:
    """128 bits of a text as two numbers: equal texts have equal repeats."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return [F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long") for k in range(2)]


def _occurrences(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(h, x, k1, k2, start, n) of each run of each text."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        for text, k1, k2 in zip(cols["text"], cols["k1"], cols["k2"], strict=True):
            for h, x, start, n in runs(text.encode("utf-8"), length, anchor):
                for p, v in zip(parts, (h.view("i8"), x.view("i8"), np.full(len(h), k1), np.full(len(h), k2), start, n), strict=True):
                    p.append(v)
        return {
            c: np.concatenate(p) if p else np.empty(0, np.int64)
            for c, p in zip(("h", "x", "k1", "k2", "start", "n"), parts, strict=True)
        }

    return map_slices(texts, run, "h long, x long, k1 long, k2 long, start long, n long", rows=64)


def _cut_runs(mixed: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(h, x, n, weight, run): the text of each different run, taken from one document that has it."""
    places = mixed.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "x", "start", "n", "weight")).alias("runs"))
    one_each = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))  # combined before the shuffle
    met = one_each.join(places, ["k1", "k2"]).select("text", "runs")

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("h", "x", "n", "weight", "run")}
        for text, found in zip(cols["text"], cols["runs"], strict=True):
            data = text.encode("utf-8")
            for r in found:
                for c in ("h", "x", "n", "weight"):
                    out[c].append(r[c])
                out["run"].append(data[r["start"] : r["start"] + r["n"] + length - 1])
        return out

    return map_slices(met, run, "h long, x long, n long, weight long, run binary", rows=32)


_SPANS = "h long, x long, spans array<struct<a: long, b: long>>"


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return [{"a": int(a), "b": int(b)} for a, b in edge.reshape(-1, 2)]


def _by_transforms(cut: DataFrame, buckets: int, length: int, shard_bytes: int) -> DataFrame:
    """(h, x, spans): which starts of each run repeat, from the merged transforms of its bucket."""

    def bucket(table_: pa.Table) -> pa.Table:
        rows = table_.select(["h", "x", "n", "weight", "run"]).to_pydict()
        hits = bwt.repeated_starts(rows["run"], rows["weight"], rows["n"], length, shard_bytes)
        found = [(h, x, _spans(hit)) for h, x, hit in zip(rows["h"], rows["x"], hits, strict=True) if hit.any()]
        h, x, spans = zip(*found, strict=True) if found else ((), (), ())
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.table({"h": pa.array(h, pa.int64()), "x": pa.array(x, pa.int64()), "spans": pa.array(spans, kind)})

    ship(cut.sparkSession)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(bucket, _SPANS)


def _by_windows(cut: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many different runs for one bucket: their strings are dealt by content."""

    def windows(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("h", "x", "weight", "at", "w")}
        for h, x, n, weight, data in zip(*(cols[c] for c in ("h", "x", "n", "weight", "run")), strict=True):
            for k in range(n):
                for c, v in zip(out, (h, x, weight, k, xxhash.xxh3_128_digest(data[k : k + length])), strict=True):
                    out[c].append(v)
        return out

    each = work_table(map_slices(cut, windows, "h long, x long, weight long, at long, w binary", rows=256))
    many = each.groupBy("w").agg(F.sum("weight").alias("m")).where("m > 1").drop("m")
    hits = each.join(work_table(many), "w")
    spans = hits.select("h", "x", F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b")).alias("s"))
    return spans.groupBy("h", "x").agg(F.collect_list("s").alias("spans"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES,
                   bucket_bytes: int = BUCKET_BYTES, anchor_runs: int = ANCHOR_RUNS) -> DataFrame:
    """(k1, k2, spans): for each text with repeats the half-open byte ranges to remove, not yet merged.

    Hot keys: rows are dealt by anchor only for sums that Spark combines beforehand and for joins
    with one row per key, whose large partitions Spark splits.
    """
    texts = _keyed(docs)
    runs_ = work_table(_occurrences(texts, length, anchor))
    anchors = work_table(
        runs_.groupBy("h")
        .agg(F.count("*").alias("m"), (F.min("x") != F.max("x")).alias("mixed"))
        .where("m > 1")
        .drop("m")
    )
    found = work_table(runs_.join(anchors, "h"))
    drop_work_table(runs_)
    mixed = found.where("mixed")
    one = F.min(F.struct("k1", "k2", "start", "n")).alias("o")
    unlike = mixed.groupBy("h", "x").agg(F.count("*").alias("weight"), one).select("h", "x", "weight", "o.*")
    cut = work_table(_cut_runs(unlike, texts, length))
    large = work_table(cut.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > anchor_runs).drop("m"))
    size = cut.agg(F.sum(F.octet_length("run"))).first()[0] or 0
    buckets = 1 + size // bucket_bytes
    usual = _by_transforms(cut.join(large, "h", "left_anti"), buckets, length, shard_bytes)
    parts = usual
    if not large.isEmpty():
        parts = parts.unionByName(_by_windows(cut.join(large, "h"), length))
    partly = work_table(parts)
    span = F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n") + (length - 1)).alias("b"))
    whole = found.where("not mixed").select("k1", "k2", span.alias("s"))
    some = mixed.join(partly, ["h", "x"]).select("k1", "k2", "start", F.explode("spans").alias("r"))
    some = some.select(
        "k1",
        "k2",
        F.struct(
            (F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + (length - 1)).alias("b")
        ).alias("s"),
    )
    each = whole.unionByName(some).distinct()
    spans = work_table(each.groupBy("k1", "k2").agg(F.collect_list("s").alias("spans")))
    for t in (found, cut, partly):
        drop_work_table(t)
    return spans


def _keyed(docs: DataFrame, *keep: Column) -> DataFrame:
    k1, k2 = text_key(F.col("text"))
    return docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"), k1.alias("k1"), k2.alias("k2"))


def _without(data: bytes, spans: list[dict[str, int]] | None) -> tuple[bytes, int]:
    """What is left of ``data``, and the number of maximal removed runs."""
    if not spans:
        return data, 0
    out, at, n = [], 0, 0
    reach = -1
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if a > reach:
            n += 1
            out.append(data[at:a])
        reach = max(reach, b)
        at = reach
    out.append(data[at:])
    return b"".join(out), n


def _whole_characters(data: bytes, spans: list[dict[str, int]] | None) -> list[dict[str, int]]:
    """The spans widened to the edges of the UTF-8 characters that they cut."""
    out = []
    for s in spans or ():
        a, b = s["a"], s["b"]
        while a > 0 and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        out.append({"a": a, "b": b})
    return out


def cut_repeats(docs: DataFrame, spans: DataFrame, keep: dict[str, str], whole: bool = False) -> DataFrame:
    """``keep`` columns (new name: old name) of each row with kept (binary), n_bytes, n_removed, n_spans.

    With ``whole`` a character of which a part repeats goes as a whole, so kept is valid UTF-8.
    """
    rows = _keyed(docs, *[F.col(old).alias(new) for new, old in keep.items()])
    met = rows.join(spans, ["k1", "k2"], "left").drop("k1", "k2")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)

    def run(cols: dict[str, list]) -> dict[str, list]:
        data = [t.encode("utf-8") for t in cols["text"]]
        spans_ = [_whole_characters(d, s) if whole else s for d, s in zip(data, cols["spans"], strict=True)]
        left = [_without(d, s) for d, s in zip(data, spans_, strict=True)]
        return {c: cols[c] for c in keep} | {
            "kept": [k for k, _ in left],
            "n_bytes": [len(d) for d in data],
            "n_removed": [len(d) - len(k) for d, (k, _) in zip(data, left, strict=True)],
            "n_spans": [n for _, n in left],
        }

    return map_slices(met, run, f"{kinds}, kept binary, n_bytes long, n_removed long, n_spans long", rows=64)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every row with its repeated passages cut from ``text``; all columns stay.

    A character of which only a part was cut goes as a whole. Where there is an ``n_chars`` column it
    counts what is left. A null text becomes empty; no row goes.
    """
    keep = {f"__c{i}": c for i, c in enumerate(docs.columns) if c != "text"}
    out = cut_repeats(docs, repeated_spans(docs), keep, whole=True)
    out = out.withColumn("__text", F.expr("validate_utf8(cast(kept as string))"))
    names = {old: F.col(new) for new, old in keep.items()}
    names["text"] = F.col("__text")
    if "n_chars" in docs.columns:
        names["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[names[c].alias(c) for c in docs.columns])


def op4_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses, and the digest of what it keeps."""
    docs = table(spark, sf_dir, "documents")
    out = cut_repeats(docs, repeated_spans(docs), {"doc_id": "doc_id"})
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
