"""Continuous ingestion of the daily feed into a written warehouse.

Structured Streaming watches a folder of feed CSV files; every micro-batch
is loaded with ``warehouse.append`` (INSERT IGNORE on the existing tables:
new store locations and products are added, rows with a stored primary key
are skipped, the SKU-grain tables get a new version).

Because stored keys always win, re-running a micro-batch after a failure
adds nothing the first run already stored: the sink is idempotent, and the
stream's checkpoint gives the file-level bookkeeping.  A restarted driver
re-attaches to the newest complete version (``warehouse.open_written``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import feed, warehouse


def start(
    spark: SparkSession,
    feed_dir: str,
    location: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start loading feed files that appear in ``feed_dir`` into ``location``."""
    stream = feed.parse_feed(spark.readStream.options(**feed.CSV_OPTIONS).schema(feed.RAW_SCHEMA).csv(feed_dir))
    state: dict[str, warehouse.Warehouse] = {}

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        wh = state.get("wh") or warehouse.open_written(batch.sparkSession, location)
        state["wh"] = warehouse.append(wh, batch)

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
