"""Helpers shared by the operators: work tables, batch mapping, skew-safe lookups."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent a local session takes a temporary folder (tests, a laptop);
    any other session must name the folder, since a machine-local one would lose data there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-llm-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark then deletes a finished query's shuffle files at once instead of when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, lost executors cost no rework.

    The shuffle files behind it are of no use afterwards and go with the write.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_work_table(df: DataFrame) -> None:
    """Delete the files of a work table that nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path.getParent(), True)


#: Most bytes that a checked broadcast may hold in each executor.
BROADCAST_BYTES = 64_000_000


def broadcast_if_small(written: DataFrame, row_bytes: int) -> DataFrame:
    """``written`` marked for broadcast if its counted rows take at most BROADCAST_BYTES; else as it is, for a shuffle join."""
    return F.broadcast(written) if written.count() * row_bytes <= BROADCAST_BYTES else written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=8)
def _ship(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    target = f"{tempfile.mkdtemp(prefix='shelfwise-code-')}/{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    SparkContext._active_spark_context.addPyFile(target)


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package's code to the executors, once per application."""
    _ship(spark.sparkContext.applicationId)


def map_slices(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: str | T.StructType,
    rows: int = 256,
) -> DataFrame:
    """Apply ``fn`` to column lists of at most ``rows`` rows; memory stays bounded by the slice."""
    return expand_slices(df, lambda part: (fn(part),), schema, rows)


def expand_slices(
    df: DataFrame,
    fn: Callable[[dict[str, list]], Iterable[dict[str, list]]],
    schema: str | T.StructType,
    rows: int = 256,
) -> DataFrame:
    """As ``map_slices`` where a slice may become much more rows: ``fn`` gives them in portions of its own size."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                for out in fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}):
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, wanted)


def salted_lookup(rows: DataFrame, by_key: DataFrame, key: str, salts: int, spread: Column) -> DataFrame:
    """Left join of ``rows`` with one row per ``key``, each key dealt over ``salts`` tasks.

    ``by_key`` is repeated ``salts`` times, so it should hold only keys that several rows share.
    ``spread`` is any well-mixed integer column of ``rows``. Null keys match nothing.
    """
    left = rows.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
    right = by_key.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "__salt"], "left").drop("__salt")


def skewed_lookup(rows: DataFrame, by_key: DataFrame, key: str, spread: Column, salts: int = 16, hot: int = 64) -> DataFrame:
    """Inner join of ``rows`` with one wide row per ``key``; keys with over ``hot`` rows are dealt over ``salts`` tasks.

    Only those keys' wide rows are repeated. ``rows`` is read twice, so it should be a written table.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > hot)
    hot_keys = counts.select(key, F.lit(True).alias("__hot"))
    left = salted_lookup(rows, hot_keys, key, salts, spread).withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0)
    )
    places = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = by_key.join(hot_keys, key, "left").withColumn("__salt", F.explode(places)).drop("__hot")
    return left.drop("__hot").join(right, [key, "__salt"]).drop("__salt")


def bounded_sample(df: DataFrame, key: list[str], rows: int) -> DataFrame:
    """Rows of ``df`` with the smallest hashes of ``key``, at most ``rows`` and nearly as many.

    The limit comes from counts in 1024 classes of the hash, so only counts reach the driver, not
    each task's candidates. Where single hashes repeat beyond ``rows`` any ``rows`` of them are taken.
    """
    hashed = df.withColumn("__hash", F.shiftrightunsigned(F.xxhash64(*key), 1))
    shift = 53
    while shift >= 0:
        part = hashed.where(F.col("__hash") <= F.lit((1 << (shift + 10)) - 1))
        counts = {r["k"]: r["count"] for r in part.groupBy(F.shiftright("__hash", shift).alias("k")).count().collect()}
        total, cut = 0, 0
        for k in range(1024):
            total += counts.get(k, 0)
            if total > rows:
                break
            cut = k + 1
        if cut:
            return part.where(F.shiftright("__hash", shift) < cut).drop("__hash")
        shift -= 10
    return hashed.limit(rows).drop("__hash")
