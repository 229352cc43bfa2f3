"""Fill-in-middle transformation by secondary-sort assembly.

A text becomes prefix, middle and suffix in another order, with markers between them. The texts are cut
into pieces of bounded length, each keyed by its document and its place in the output. One shuffle by
document (``repartitionAndSortWithinPartitions``) brings a document's pieces together in output order;
they stream into incremental digests one by one, so no task joins a whole output. Restoration reads the
same stream, knows the parts by their markers alone, keys them by their place in the original and sorts
again: the documents already lie together, so that sort moves nothing between tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby, islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwise.llm.common import ship, table

# The markers, the forms, and the shares of the forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
REWRITTEN_PERCENT, SPM_PERCENT = 90, 20
#: Parts in output order; where a part comes in the original is its place in ORIGINAL.
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
ORIGINAL = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
MARKER = len(PREFIX)

#: Code points in a piece.
PIECE = 16_384


class Plan(NamedTuple):
    """What a document becomes. ``first`` and ``second`` are the cuts, in code points; 0 where plain."""

    n: int
    form: str
    first: int
    second: int


def plan(doc_id: int | None, text: str) -> Plan:
    """Form and cuts, drawn from the hash of the id (null: of an empty one) and the length alone."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[a : a + 8], 16) for a in range(0, 32, 8))
    n = len(text)
    if not n or h3 % 100 >= REWRITTEN_PERCENT or any(m in text for m in ORIGINAL):
        return Plan(n, PLAIN, 0, 0)
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    return Plan(n, SPM if h4 % 100 < SPM_PERCENT else PSM, *cuts)


def pieces(text: str, p: Plan, length: int = PIECE) -> Iterator[str]:
    """The output in order: markers, and the parts in runs of at most ``length`` code points."""
    bounds = {PREFIX: (0, p.first), MIDDLE: (p.first, p.second), SUFFIX: (p.second, p.n)}
    for mark in ORDERS.get(p.form, ("",)):
        start, end = bounds.get(mark, (0, p.n))
        if mark:
            yield mark
        for at in range(start, end, length):
            yield text[at : min(at + length, end)]


def parts(form: str, stream: Iterator[str]) -> Iterator[tuple[int, str]]:
    """(place in the original, text) runs of an output that arrives in pieces cut anywhere.

    Nothing but the form and the characters is read. A marker begins with the only ``<`` in it and
    ends with its only ``>``, so no text before or after can form one together with a part of it;
    what may be the start of a marker waits for the next piece.
    """
    order = list(ORDERS.get(form, ()))
    part, held = 0, ""
    for piece in stream:
        held += piece
        while order and (at := held.find(order[0])) >= 0:
            if at:
                yield part, held[:at]
            held, part = held[at + MARKER :], ORIGINAL[order.pop(0)]
        ready = len(held) - (MARKER - 1 if order else 0)
        if ready > 0:
            yield part, held[:ready]
            held = held[ready:]
    if held:
        yield part, held


KEY = "home int, split int, at long, place int"
DESCRIBED = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def assembled(docs: DataFrame, length: int = PIECE, partitions: int | None = None) -> DataFrame:
    """Pieces (KEY, DESCRIBED, piece) sorted by document and place in the output within partitions.

    A document's key is made of its id and of the row's place in the input, so repeated rows and null
    ids stay apart. Its partition follows from the id and the number of the input partition: it is
    the same when a lost task runs again, and rows that share an id are spread as the input is. The
    description is on a document's first piece only. (``repartition`` and ``sortWithinPartitions``
    are the DataFrame form of repartitionAndSortWithinPartitions: pieces are sorted by Spark, which spills.)
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(part: dict[str, list]) -> Iterator[tuple]:
        for doc_id, text, split, at in zip(*(part[c] for c in ("doc_id", "text", "split", "at")), strict=True):
            text = text or ""
            p = plan(doc_id, text)
            key, told = (zlib.crc32(f"{doc_id}:{split}".encode()) & 0x7FFFFFFF, split, at), _told(doc_id, p)
            for place, piece in enumerate(pieces(text, p, length) if text else ("",)):
                yield *key, place, *told, piece
                told = (None,) * len(told)

    rows = docs.select(
        "doc_id", "text", F.spark_partition_id().alias("split"), F.monotonically_increasing_id().alias("at")
    )
    emitted = _stream(rows, lambda batches: (r for b in batches for r in cut(b)), f"{KEY}, {DESCRIBED}, piece string")
    return emitted.repartition(n, "home").sortWithinPartitions("home", "split", "at", "place")


def _told(doc_id: int | None, p: Plan) -> tuple:
    return (doc_id, p.n, p.form, None, None) if p.form == PLAIN else (doc_id, p.n, p.form, p.first, p.second - p.first)


#: Rows that a task gathers for Spark at once, and rows of a slice it looks at.
OUT_ROWS, IN_ROWS = 256, 256


def _stream(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` gets a partition's rows as column lists of at most IN_ROWS rows, in order, and yields rows."""
    ship(df.sparkSession)
    wanted = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(wanted)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, IN_ROWS):
                part = batch.slice(at, IN_ROWS)
                yield {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = fn(lists(batches))
        while held := list(islice(rows, OUT_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return df.mapInArrow(run, wanted)


def _documents(batches: Iterator[dict], *columns: str) -> Iterator[Iterator[tuple]]:
    """One iterator of rows (of ``columns``, after the key) for each document of a sorted partition."""
    rows = (r for b in batches for r in zip(*(b[c] for c in ("home", "split", "at", *columns)), strict=True))
    for _, run in groupby(rows, lambda r: r[:3]):
        yield run


def outputs(docs: DataFrame, length: int = PIECE, partitions: int | None = None) -> DataFrame:
    """The transformed texts: doc_id, n, form, prefix_chars, middle_chars, row, place, piece.

    One row for each piece of at most ``length`` code points; joined in the order of ``place`` they
    are the output of one input row (``row`` tells rows of one id apart). Plain and empty texts have
    null prefix_chars and middle_chars, an empty text one empty piece. A null text counts as empty,
    other columns are ignored, and the table may be empty.
    """
    told = [f.name for f in T.StructType.fromDDL(DESCRIBED)]

    def listed(batches: Iterator[dict]) -> Iterator[tuple]:
        for run in _documents(batches, "place", *told, "piece"):
            head = None
            for home, split, at, place, *its, piece in run:
                head = head or its
                yield *head, f"{home}:{split}:{at}", place, piece

    return _stream(assembled(docs, length, partitions), listed, f"{DESCRIBED}, row string, place int, piece string")


def digests(docs: DataFrame, length: int = PIECE, partitions: int | None = None) -> DataFrame:
    """Per input row what it became, and the SHA-256 of its output and of the text restored from that.

    Restoration gets the form and the output pieces, nothing else. Nulls, empty texts, repeated rows
    and further columns: see ``outputs``. The longest text bounds a task's memory in the scan that
    reads it; after that a task holds pieces.
    """
    told = [f.name for f in T.StructType.fromDDL(DESCRIBED)]

    def taken(batches: Iterator[dict]) -> Iterator[tuple]:
        """The pieces of the originals, keyed for the second sort, and at part -1 the output's digest."""
        for run in _documents(batches, *told, "piece"):
            sha, heads = hashlib.sha256(), []

            def passed(run=run, sha=sha, heads=heads) -> Iterator[str]:
                for *row, piece in run:
                    if not heads:
                        heads.append(row)
                        yield row[3 + told.index("form")]  # asked for before the first piece
                    sha.update(piece.encode())
                    yield piece

            stream = passed()
            form = next(stream)
            for at, (part, text) in enumerate(parts(form, stream)):
                yield *heads[0][:3], part, at, *(None,) * len(told), text
            yield *heads[0][:3], -1, 0, *heads[0][3:], sha.hexdigest()

    def restored(batches: Iterator[dict]) -> Iterator[tuple]:
        for run in _documents(batches, *told, "piece"):
            *row, output = next(run)
            sha = hashlib.sha256()
            for *_, text in run:
                sha.update(text.encode())
            yield *row[3:], output, sha.hexdigest()

    schema = f"home int, split int, at long, part int, place int, {DESCRIBED}, piece string"
    # a document's pieces stay in their partition: this sort moves nothing between tasks
    back = _stream(assembled(docs, length, partitions), taken, schema).sortWithinPartitions("home", "split", "at", "part", "place")
    return _stream(back, restored, f"{DESCRIBED}, output_sha256 string, restored_sha256 string")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cut lengths and both digests of every document."""
    return digests(table(spark, sf_dir, "documents"))


ORACLE = """
    with h as (
        select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
            sha256('1:' || coalesce(doc_id::varchar, '')) as d
        from documents
    ), u as (
        select *, ('0x' || substr(d, 1, 8))::bigint % (n + 1) as a, ('0x' || substr(d, 9, 8))::bigint % (n + 1) as b,
            ('0x' || substr(d, 17, 8))::bigint % 100 as h3, ('0x' || substr(d, 25, 8))::bigint % 100 as h4
        from h
    ), f as (
        select *, least(a, b) as p, greatest(a, b) - least(a, b) as m,
            case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 >= 90 then 'plain'
                 when h4 < 20 then 'spm' else 'psm' end as form
        from u
    ), s as (
        select *, substr(t, 1, p) as pre, substr(t, p + 1, m) as mid, substr(t, p + m + 1) as suf from f
    )
    select doc_id, n::bigint as n, form,
        case when form <> 'plain' then p::bigint end as prefix_chars,
        case when form <> 'plain' then m::bigint end as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
            else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
        sha256(t) as restored_sha256
    from s
"""
