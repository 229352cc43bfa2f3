"""Keep the latest-row-per-SKU snapshot current while fact files arrive.

Structured Streaming reads new fact files (Parquet, fixed schema); each
micro-batch is reduced to one row per SKU (partial + final top-1) and merged
into the previous snapshot: the row with the newer date wins; for the same
(SKU, date) the row already in the snapshot wins, as the load's INSERT
IGNORE keeps the first row of a key.

Snapshots are versioned by batch id (``<snapshot>/epoch=<id>``).  A batch
re-run after a failure rewrites its own version from the previous one, so
replays are idempotent; readers use the highest version.  Each version is a
full SKU-grain table (one row per SKU); older versions are left for the
storage's retention policy to expire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.windowing import latest_per_key
from ..sources.files import has_files

SKU = list(schemas.SKU)
COLUMNS = schemas.INVENTORY.fieldNames()


def _versions(spark: SparkSession, snapshot_path: str) -> DataFrame | None:
    # a failing read raises: taken for an empty snapshot it would drop all earlier stock
    return spark.read.parquet(snapshot_path) if has_files(spark, snapshot_path) else None


def read_snapshot(spark: SparkSession, snapshot_path: str, before_epoch: int | None = None) -> DataFrame | None:
    """The newest snapshot version (older than ``before_epoch`` if given)."""
    all_versions = _versions(spark, snapshot_path)
    if all_versions is None:
        return None
    epochs = all_versions.select("epoch").distinct()
    if before_epoch is not None:
        epochs = epochs.filter(F.col("epoch") < before_epoch)
    last = epochs.agg(F.max("epoch")).first()[0]
    if last is None:
        return None
    return all_versions.filter(F.col("epoch") == last).drop("epoch")


def merge_latest(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Snapshot after applying a batch of fact rows."""
    batch_latest = latest_per_key(fresh.select(*COLUMNS), SKU, "date").withColumn("_src", F.lit(1))
    if current is None:
        both = batch_latest
    else:
        both = current.select(*COLUMNS).withColumn("_src", F.lit(0)).unionByName(batch_latest)
    w = Window.partitionBy(*SKU).orderBy(F.col("date").desc(), F.col("_src").asc())
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")


def start(
    spark: SparkSession,
    fact_source: str,
    snapshot_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the maintenance stream over files appearing in ``fact_source``."""
    stream = spark.readStream.schema(schemas.INVENTORY).parquet(fact_source)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        current = read_snapshot(batch.sparkSession, snapshot_path, before_epoch=epoch_id)
        merged = merge_latest(current, batch)
        merged.write.mode("overwrite").parquet(f"{snapshot_path}/epoch={epoch_id}")

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
