"""Hard-negative mining by Fagin's threshold algorithm over blocks of candidates.

Rows are dealt over blocks of bounded size. A block keeps one sorted list per dimension (for positives,
one set of lists per label). An anchor reads each list from the end that its component's sign prefers,
fetches the whole vector of every row it meets and scores it exactly in integers. The best score that an
unmet row can still reach is the sum of the anchor's components times the list values at that depth, the
threshold. A window is settled once the threshold falls strictly below its kth score, or below the
window itself: ties with the kth score are all met before. Positives come first, since
their scores are the windows in which the negatives are looked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, table, work_table

# Fixed values of the task: components in 1/256, the rows with moved labels, list lengths, score window.
SCALE = 256
MOVED, LABELS, ANCHORS = 7, 10, 50
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95

#: Rows in a block, which one task holds with its lists (about 17 bytes a component). More rows, more blocks.
BLOCK_ROWS = 65_536
#: Blocks at least, so that small tables still use several tasks.
LEAST_BLOCKS = 6
#: Depth of the first look into the lists; it doubles until all windows are settled.
FIRST_DEPTH = 32
#: Sums below this are exact in doubles, where matrix products are fast; beyond it Python integers add up.
EXACT = 2.0**53


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (moved where the id asks for it), dim, v (integer components): the rows that take part.

    Null ids, labels and vectors, empty vectors and vectors with null or non-finite components are left
    out. An id names one row: of rows that share it the one with the smallest label, then the smallest
    vector stands for all, found by a partial aggregate, so a hot id does not travel.
    """
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    moved = F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = vectors.where("vec_id is not null and label is not null and size(embedding) > 0").where(sound)
    rows = rows.select("vec_id", F.struct(moved.cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v")).alias("r"))
    one = rows.groupBy("vec_id").agg(F.min("r").alias("r"))
    return one.select("vec_id", "r.label", F.size("r.v").alias("dim"), "r.v")


class Lists:
    """Rows of equal length: sorted access by dimension, random access by row."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        first = np.lexsort((ids,))
        self.ids, self.labels, self.v = ids[first], labels[first], v[first]
        self.order = np.argsort(self.v, axis=0, kind="stable").astype(np.int32)
        self.n, self.dim = self.v.shape
        self.most = float(np.abs(self.v).max(initial=0))
        self.f = self.v.astype(float)

    def depths(self, a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """(rows met for the first time, their scores, threshold for the others), deeper and deeper.

        The threshold is None once every row is met.
        """
        exact = float(np.abs(a).max(initial=0)) * self.most * self.dim < EXACT
        used = np.flatnonzero(a)
        weights, up = a[used], a[used] < 0
        met = np.zeros(self.n, bool)
        done, depth = 0, FIRST_DEPTH
        while done < self.n:
            end = min(depth, self.n) if len(used) else self.n
            low, high = self.order[done:end, used[up]], self.order[self.n - end : self.n - done, used[~up]]
            fresh = np.zeros(self.n, bool)
            fresh[low] = True
            fresh[high] = True
            if not len(used):
                fresh[:] = True
            fresh &= ~met
            met |= fresh
            rows = np.flatnonzero(fresh)
            if exact:
                scores = (self.f[rows] @ a.astype(float)).astype(np.int64)
            else:
                scores = (self.v[rows].astype(object) @ a.astype(object)) if len(rows) else np.zeros(0, object)
            if end == self.n or met.all():
                yield rows, scores, None
                return
            edge = np.where(up, self.order[end - 1, used], self.order[self.n - end, used])
            bound = sum(int(w) * int(x) for w, x in zip(weights, self.v[edge, used], strict=True))
            yield rows, scores, bound
            done, depth = end, depth * 2


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k``: higher scores first, ties by smaller id."""
    if len(ids) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= kth)
    else:
        keep = np.arange(len(ids))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def nearest(lists: Lists, own: int, a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best rows with another id than ``own``."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for rows, found, bound in lists.depths(a):
        other = lists.ids[rows] != own
        ids, scores = np.concatenate([ids, lists.ids[rows][other]]), np.concatenate([scores, found[other]])
        first = best(ids, scores, k)
        ids, scores = ids[first], scores[first]
        if bound is None or (len(ids) == k and bound < scores[-1]):
            break
    return ids, scores


def within(
    lists: Lists, own: int, label: int, a: np.ndarray, windows: list[tuple[int, int]], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (low, high) of 100 * score: ids and scores of the ``k`` best rows of another label in it."""
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
    if not open_:
        return held
    for rows, found, bound in lists.depths(a):
        other = (lists.labels[rows] != label) & (lists.ids[rows] != own)
        ids, scores = lists.ids[rows][other], found[other]
        still = []
        for w in open_:
            low, high = windows[w]
            fits = (100 * scores >= low) & (100 * scores <= high)
            near, its = np.concatenate([held[w][0], ids[fits]]), np.concatenate([held[w][1], scores[fits]])
            first = best(near, its, k)
            held[w] = near[first], its[first]
            if bound is not None and 100 * bound >= low and not (len(first) == k and bound < held[w][1][-1]):
                still.append(w)
        open_ = still
        if not open_:
            break
    return held


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column.to_numpy(zero_copy_only=False)])


def _by_block(
    rows: DataFrame, asked: DataFrame, blocks: int, schema: str, answer: Callable[[dict, pa.RecordBatch], pa.RecordBatch],
    split_labels: bool,
) -> DataFrame:
    """Deal ``rows`` over blocks and let ``asked`` pass each of them in batches; ``answer`` gets lists by label.

    A task holds one block and one batch of what is asked. With ``split_labels`` a block has rows and
    questions of one label only; else its lists hold all labels (under None).
    """
    by = ["block", "dim", "label"] if split_labels else ["block", "dim"]
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("asks", F.lit(False))
    sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(True))
    both = dealt.unionByName(sent, allowMissingColumns=True)
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lists = [], None
        for batch in batches:
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            first = int(np.argmax(asks)) if asks.any() else len(asks)
            if first:
                if lists is not None:
                    raise RuntimeError("a block's rows must come before its questions")
                held.append(batch.slice(0, first))
            if first < len(asks) and held:
                whole = pa.Table.from_batches(held).combine_chunks()
                lists = Lists(whole["vec_id"].to_numpy(), whole["label"].to_numpy(), _matrix(whole["v"].combine_chunks()))
                held = []
            if first < len(asks) and lists is not None:
                yield answer(lists, batch.slice(first))

    # Rows before questions: the group's order is that of its sorted partition.
    placed = both.repartition(*by).sortWithinPartitions(*by, "asks")
    return placed.groupBy(*by).applyInArrow(run, schema)


def _columns(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    rows = [[], [], [], []]
    for key, ids, scores in parts:
        for i, s in zip(ids.tolist(), scores.tolist(), strict=True):
            for column, value in zip(rows, (*key, i, s), strict=False):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows[: len(names)]], names=names)


def mine(vectors: DataFrame, anchors: str = f"vec_id % {ANCHORS} = 0") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is the condition on the usable rows that ask. All usable rows are candidates, in blocks
    whose number follows their count; what the blocks return is merged by rank. Rows that take no part,
    and what happens to repeated ids: see ``usable``. Vectors are compared with those of their length. An
    anchor without another row of its label, or positives whose window holds no row of
    another label (always so below a score of 0), give no rows. Scores are exact; one that no long
    can hold is an error. Other columns are ignored.
    """
    rows = work_table(usable(vectors))
    blocks = max(LEAST_BLOCKS, -(-rows.count() // BLOCK_ROWS))
    asked = rows.where(anchors)

    def positives(lists: Lists, batch: pa.RecordBatch) -> pa.RecordBatch:
        names = ["anchor_id", "positive_id", "positive_score"]
        ids = batch.column("vec_id").to_pylist()
        found = [nearest(lists, i, a, POSITIVES) for i, a in zip(ids, _matrix(batch.column("v")), strict=True)]
        return _columns([((i,), *f) for i, f in zip(ids, found, strict=True)], names)

    def negatives(lists: Lists, batch: pa.RecordBatch) -> pa.RecordBatch:
        names = ["anchor_id", "positive_id", "negative_id", "negative_score"]
        out = []
        columns = [batch.column(c).to_pylist() for c in ("vec_id", "label", "p_ids", "p_scores")]
        for i, label, p_ids, p_scores, a in zip(*columns, _matrix(batch.column("v")), strict=True):
            windows = [(LOW_PERCENT * s, HIGH_PERCENT * s) for s in p_scores]
            for p, f in zip(p_ids, within(lists, i, label, a, windows, NEGATIVES), strict=True):
                out.append(((i, p), *f))
        return _columns(out, names)

    near = _by_block(rows, asked, blocks, "anchor_id long, positive_id long, positive_score long", positives, True)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = work_table(near.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= POSITIVES).drop("__r"))

    pairs = F.array_sort(F.collect_list(F.struct("positive_id", "positive_score")))  # at most POSITIVES
    windows = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(pairs.alias("p"))
    asking = asked.join(windows, "vec_id").select(
        "vec_id", "label", "dim", "v", F.col("p.positive_id").alias("p_ids"), F.col("p.positive_score").alias("p_scores")
    )
    schema = "anchor_id long, positive_id long, negative_id long, negative_score long"
    far = _by_block(rows, asking, blocks, schema, negatives, False)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= NEGATIVES)
    return ranked.join(first, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor in ``embeddings``."""
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE = """
    with r as (
        select vec_id, min({'label': case when vec_id % 7 = 0 then (label + 1) % 10 else label end,
            'v': list_transform(embedding, lambda x: floor(256 * x::double)::bigint)}) as r
        from embeddings
        where vec_id is not null and label is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        group by vec_id
    ), s as (select vec_id, r.label as label, r.v as v from r),
    pairs as (
        select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
            list_inner_product(a.v::double[], b.v::double[])::bigint as score
        from s a join s b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    ), pos as (
        select anchor_id, other_id as positive_id, score as positive_score from pairs where same
        qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
    )
    select anchor_id, positive_id,
        (row_number() over (partition by anchor_id, positive_id order by n.score desc, n.other_id))::int as rank,
        n.other_id as negative_id, positive_score, n.score as negative_score
    from pos join pairs n using (anchor_id)
    where not n.same and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
    qualify row_number() over (partition by anchor_id, positive_id order by n.score desc, n.other_id) <= 3
"""
