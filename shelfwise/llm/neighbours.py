"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import ship, table

TABLES = 12
#: Signed axes of each table that a query looks up, of every 128 there are.
PROBES_OF_128 = 12
#: Vectors of a block, and the fewest blocks, over which the work is dealt.
BLOCK_ROWS = 500_000
LEAST_BLOCKS = 12
#: Greatest ratio of norms in a band, so that the component that fills them up stays small.
BAND = 1.1
QUERY_SLICE = 64


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix in n log n steps; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class Rotations:
    """TABLES pseudo-rotations, each three rounds of random signs and a Hadamard transform."""

    def __init__(self, width: int, tables: int = TABLES) -> None:
        self.width = 1 << max(0, (width - 1).bit_length())
        rng = np.random.default_rng(20240613)
        self.signs = rng.choice([-1.0, 1.0], (tables, 3, self.width))

    def __call__(self, table_: int, unit: np.ndarray) -> np.ndarray:
        x = np.zeros((len(unit), self.width))
        x[:, : unit.shape[1]] = unit
        for s in self.signs[table_]:
            x = hadamard(x * s)
        return x


def codes(rotated: np.ndarray) -> np.ndarray:
    """The nearest signed axis: 2 * axis, one more if negative."""
    axis = np.abs(rotated).argmax(axis=1)
    return 2 * axis + (rotated[np.arange(len(axis)), axis] < 0)


def probes(rotated: np.ndarray, count: int) -> np.ndarray:
    """Each row's ``count`` nearest signed axes, nearest first."""
    signed = np.stack((rotated, -rotated), axis=2).reshape(len(rotated), -1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :count]


class Band:
    """Rows of a block whose norms are within a factor BAND, with their tables: rows in order of their code.

    A band with no more rows than a query has bucket lookups goes without tables and is read whole.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, tables: int) -> None:
        self.ids, self.vectors, self.most = ids, vectors, float(sizes.max())
        self.spare = 0.0 if self.most - sizes.min() <= 1e-6 * self.most else self.most
        self.turn = Rotations(vectors.shape[1] + (self.spare > 0), tables)
        self.count = max(1, PROBES_OF_128 * 2 * self.turn.width // 128)
        self.order, self.bounds = [], []
        if len(ids) <= tables * self.count:
            return
        unit = _placed(vectors, self.spare)
        for t in range(tables):
            code = np.concatenate([codes(self.turn(t, unit[a : a + 4096])) for a in range(0, len(unit), 4096)])
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.bounds.append(np.searchsorted(code[order], np.arange(2 * self.turn.width + 1)))

    def candidates(self, own: int, wanted: list[np.ndarray], k: int) -> np.ndarray:
        """Rows in the probed buckets; further axes are probed in order until there are ``k`` rows or all."""
        rest = self.ids != own
        if not self.order:
            return np.flatnonzero(rest)
        hit = np.zeros(len(self.ids), bool)
        done, upto = 0, self.count
        while done < 2 * self.turn.width:
            for order, bounds, w in zip(self.order, self.bounds, wanted, strict=True):
                for code in w[done:upto]:
                    hit[order[bounds[code] : bounds[code + 1]]] = True
            if np.count_nonzero(hit & rest) >= k:
                break
            done, upto = upto, upto + 1
        return np.flatnonzero(hit & rest)


class BlockIndex:
    """One block of vectors in bands of similar norm, longest first, each with its own tables."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, tables: int = TABLES) -> None:
        size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=float))
        order = np.argsort(-size, kind="stable")
        falling, self.bands, at = -size[order], [], 0
        while at < len(order):
            end = int(np.searchsorted(falling, falling[at] / BAND, side="right"))
            rows = order[at:end]
            self.bands.append(Band(ids[rows], vectors[rows], size[rows], tables))
            at = end

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of each query's best ``k`` among the rows its probes collect.

        Every band yields ``k`` rows or all it has, so the block does; a band that not even its
        greatest norm could bring among the best so far is left out.
        """
        lengths = np.linalg.norm(queries, axis=1)
        unit = queries / lengths[:, None]
        wanted: dict[int, list[np.ndarray]] = {}
        for band in self.bands:
            if band.order and band.turn.width not in wanted:
                turn = band.turn
                wanted[turn.width] = [probes(turn(t, unit), 2 * turn.width) for t in range(len(band.order))]
        for i, q in enumerate(queries):
            near, score = np.empty(0, np.int64), np.empty(0)
            for band in self.bands:
                if len(near) == k and band.most * lengths[i] * (1 + 1e-9) < score[-1]:
                    break
                asked = [w[i] for w in wanted[band.turn.width]] if band.order else []
                rows = band.candidates(ids[i], asked, k)
                if len(rows) > 2 * k:
                    rough = band.vectors[rows] @ q
                    floor = np.partition(rough, len(rows) - k)[len(rows) - k]
                    rows = rows[rough >= floor - 1e-9 * max(1.0, abs(floor))]
                own = np.zeros(len(rows))
                for j in range(len(q)):  # one order of summation, so equal vectors have equal scores
                    own += band.vectors[rows, j].astype(float) * q[j]
                near, score = np.concatenate((near, band.ids[rows])), np.concatenate((score, own))
                best = np.lexsort((near, -score))[:k]
                near, score = near[best], score[best]
            yield near, score


def _placed(vectors: np.ndarray, spare: float) -> np.ndarray:
    """Unit vectors whose order by cosine is the order by inner product.

    Vectors of one length are only scaled. Others get a further component that fills them up to the
    greatest length ``spare``, which queries do not have.
    """
    size = np.linalg.norm(vectors, axis=1)
    if not spare:
        return vectors / size[:, None]
    return np.column_stack((vectors, np.sqrt(np.maximum(spare**2 - size**2, 0)))) / spare


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>, dim): rows whose vector has finite components and is not zero."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return rows.where(finite & F.exists(v, lambda x: x != 0)).select("vec_id", v.alias("v"), F.size(v).alias("dim"))


def _vectors_of(part: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    flat = part.column("v")
    flat = (flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat).flatten()
    return part.column("vec_id").to_numpy(), flat.to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def near_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One block's results: its rows come first and are indexed; the queries then pass a batch at a time."""
    held: list[pa.RecordBatch] = []
    index, late = None, False
    for batch in batches:
        asks = np.asarray(batch.column("asks"))
        first = int(np.argmax(asks)) if asks.any() else len(asks)
        if not asks[first:].all() or (late and first):
            raise RuntimeError("a block's rows must come before its queries")
        if first:
            held.append(batch.slice(0, first))
        if first == len(asks):
            continue
        late = True
        if held:
            index = BlockIndex(*_vectors_of(pa.Table.from_batches(held)))
            held = []
        if index is None:
            continue
        q_ids, q = _vectors_of(batch.slice(first))
        for a in range(0, len(q), QUERY_SLICE):
            part = q_ids[a : a + QUERY_SLICE], q[a : a + QUERY_SLICE].astype(float)
            found = list(index.search(*part, k))
            each = [len(near) for near, _ in found]
            columns = {
                "query_id": np.repeat(part[0], each),
                "probe": np.repeat(np.array([_mark(vec) for vec in part[1]], np.int64), each),
                "vec_id": np.concatenate([near for near, _ in found]),
                "score": np.concatenate([score for _, score in found]),
            }
            yield pa.RecordBatch.from_pydict(columns)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows found for each query, by inner product.

    Every usable row is indexed. Rows are dealt at random over blocks of bounded size, each with its
    own tables; the stated queries go to all blocks, where they pass in batches, so that a task holds
    one block and one batch of them. Each block returns its best ``k``, fewer
    only if it has fewer, so a query gets fewer than ``k`` rows only where fewer exist. Rows
    with the query's vec_id are its own. Null, zero, null-holding and non-finite vectors and null
    ids take no part; vectors of different length are not compared. Ties go to the smaller vec_id;
    an id with several vectors asks with each of them, and equal rows ask once.
    """
    rows = usable(vectors)
    n = rows.count()
    blocks = max(LEAST_BLOCKS, -(-n // BLOCK_ROWS))
    asked = usable(queries).distinct()
    dealt = rows.withColumns({"block": F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)), "asks": F.lit(False)})
    sent = asked.withColumns({"block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))), "asks": F.lit(True)})
    both = dealt.select("block", "dim", "asks", "vec_id", "v").unionByName(sent.select("block", "dim", "asks", "vec_id", "v"))
    single = both.withColumn("v", F.col("v").cast("array<float>")) if _is_single(vectors) else both
    ship(vectors.sparkSession)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return near_rows(batches, k)

    # Rows before queries: the group's order is that of its sorted partition.
    placed = single.repartition("block", "dim").sortWithinPartitions("block", "dim", "asks")
    near = placed.groupBy("block", "dim").applyInArrow(block, "query_id long, probe long, vec_id long, score double")
    order = Window.partitionBy("query_id", "probe").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _mark(vector: np.ndarray) -> int:
    """Tells the vectors of one id apart."""
    return zlib.crc32(vector.tobytes())


def _is_single(vectors: DataFrame) -> bool:
    return "float" in vectors.schema["embedding"].dataType.simpleString()


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))
