"""CSV feed source and CSV sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..operators.etl import FEED_BLOCK, FEED_FILE
from .files import released_shuffles

# how the feed is written: header row, comma, optional quotes, \\N for NULL
NULL_MARK = "\\N"
CSV_OPTIONS = {"header": True, "sep": ",", "quote": '"', "escape": "\\", "mode": "FAILFAST", "enforceSchema": True}
#: The feed's columns as text; they bind by position.
RAW_SCHEMA = StructType([StructField(n, StringType()) for n in schemas.STAGING.fieldNames()])


def parse_feed(raw: DataFrame) -> DataFrame:
    """Typed staging rows of the text columns, with the file and block each came from.

    ``\\N`` is NULL. An empty text field is the empty string, an empty number is
    NULL (the load makes it 0). Text that is no number of the column's type
    fails the load.
    """
    columns = []
    for f in schemas.STAGING.fields:
        text = F.nullif(F.col(f.name), F.lit(NULL_MARK))
        if isinstance(f.dataType, StringType):
            text = F.when(F.col(f.name).isNull(), F.lit("")).otherwise(text)
        columns.append(text.cast(f.dataType).alias(f.name))
    place = [F.col("_metadata.file_path").alias(FEED_FILE), F.col("_metadata.file_block_start").alias(FEED_BLOCK)]
    return raw.select(*columns, *place)


def read_staging(spark: SparkSession, path: str, quarantine: str | None = None, header: bool = True) -> DataFrame:
    """Read the daily feed: one CSV file or a folder of them (see ``parse_feed``).

    By default a row with too many or too few fields fails the load (strict mode), as text does that
    is no number. With ``quarantine``, a folder, such lines are appended there as Parquet (see
    ``split_feed``) and the rest is returned; that reads the feed once more.
    """
    if quarantine is None:
        return parse_feed(spark.read.options(**CSV_OPTIONS | {"header": header}).schema(RAW_SCHEMA).csv(path))
    rows, bad = split_feed(spark, path, header)
    bad.write.mode("append").parquet(quarantine)
    return rows


CORRUPT = "_corrupt"


def split_feed(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(typed staging rows, malformed lines) of a feed read without failing.

    A malformed line has too many or too few fields, or text that is no number of its column. It
    is given as file, the start of its block in the file, reason (``fields`` or the column) and line.
    """
    options = CSV_OPTIONS | {"header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    schema = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT, StringType())])
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    raw = spark.read.options(**options).schema(schema).csv(path).select("*", "_metadata", *place)
    numbers = [f for f in schemas.STAGING.fields if not isinstance(f.dataType, StringType)]
    wrong = F.when(F.col(CORRUPT).isNotNull(), F.lit("fields"))
    for f in numbers:
        text = F.nullif(F.col(f.name), F.lit(NULL_MARK))
        wrong = wrong.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), F.lit(f.name))
    judged = raw.withColumn("reason", wrong)
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*RAW_SCHEMA.fieldNames())))
    bad = judged.filter(F.col("reason").isNotNull()).select("file", "block", "reason", line.alias("line"))
    return parse_feed(judged.filter(F.col("reason").isNull())), bad


#: Lines of a written feed file. The files are gzip, each is read by one task.
FILE_LINES = 1_000_000


def write_feed(staging: DataFrame, path: str, order: list[str]) -> None:
    """Write staging rows as feed files whose names and lines follow ``order``."""
    rows = staging.orderBy(*order).select(*schemas.STAGING.fieldNames())
    with released_shuffles(rows.sparkSession):
        _files(rows).options(header=True, nullValue=NULL_MARK, emptyValue="").csv(path)


def write_lines(staging: DataFrame, line: Column, path: str, order: list[str]) -> None:
    """Write ``line`` of each staging row to feed files without a header, which follow ``order``.

    The lines are made before the rows are sorted: one text moves with the order columns, not every column.
    """
    rows = staging.select(line.alias("value"), *order).orderBy(*order).select("value")
    with released_shuffles(rows.sparkSession):
        _files(rows).text(path)


def _files(rows: DataFrame) -> DataFrameWriter:
    return rows.write.options(compression="gzip", maxRecordsPerFile=FILE_LINES)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a report with a header row (one directory of part files)."""
    df.write.mode(mode).option("header", True).csv(path)
