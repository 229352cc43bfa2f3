"""Published versions of a written warehouse.

A load or an append writes only new folders. It becomes visible by one small file, the version
record, which names every folder that belongs to the version: whoever reads a version reads exactly these,
so a writer that dies earlier leaves nothing but folders that no record names. Records are
created under a number that must be free; of two writers that started from the same version the
second is refused and has to start again from what the first has published.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

FOLDER = "versions"
_NAME = re.compile(r"v-(\d{9})\.json")


class ConcurrentWriteError(RuntimeError):
    """Another writer published the version first; append again to add to its state."""


@dataclass(frozen=True)
class Part:
    """Folders of one load or append: which tables got rows, and the kind of its staging columns."""

    name: str
    tables: tuple[str, ...]
    staging: str | None = None


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[Part, ...]
    # folder of the SKU-grain tables, and what they were computed for
    derived: str
    latest_date: datetime.date | None
    windows: tuple[int, ...]
    # under which the keys of the feed are compared (None: as bytes)
    collation: str | None = None

    def holding(self, table: str) -> list[str]:
        return [p.name for p in self.parts if table in p.tables]


def new_name(number: int) -> str:
    """Name for the folders of a write that wants to become version ``number``."""
    return f"{number:09d}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, location: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    folder, system = _path(spark, f"{location}/{FOLDER}")
    if not system.exists(folder):
        return []
    found = (_NAME.fullmatch(s.getPath().getName()) for s in system.listStatus(folder))
    return sorted(int(m[1]) for m in found if m)


def read(spark: SparkSession, location: str, number: int | None = None) -> Version | None:
    """Version ``number``, by default the newest; None where nothing is published."""
    known = numbers(spark, location)
    if number is None:
        if not known:
            return None
        number = known[-1]
    text = spark.read.text(f"{location}/{FOLDER}/v-{number:09d}.json", wholetext=True).first()[0]
    x = json.loads(text)
    latest = x["latest_date"] and datetime.date.fromisoformat(x["latest_date"])
    parts = tuple(Part(p["name"], tuple(p["tables"]), p["staging"]) for p in x["parts"])
    return Version(x["number"], parts, x["derived"], latest, tuple(x["windows"]), x.get("collation"))


def publish(spark: SparkSession, location: str, v: Version) -> None:
    """Make ``v`` the newest version, or refuse if its number is taken.

    The record is written beside and renamed without overwriting, so a reader sees it whole or not at all.
    """
    context = spark.sparkContext
    final, system = _path(spark, f"{location}/{FOLDER}/v-{v.number:09d}.json")
    draft, _ = _path(spark, f"{location}/{FOLDER}/_{uuid.uuid4().hex}")
    record = asdict(v) | {"latest_date": v.latest_date and v.latest_date.isoformat()}
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), context._jsc.hadoopConfiguration())
    options = context._gateway.new_array(getattr(context._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(system.makeQualified(draft), system.makeQualified(final), options)
    except Exception as refused:
        system.delete(draft, False)
        if v.number in numbers(spark, location):
            raise ConcurrentWriteError(f"version {v.number} of {location} was published by another writer") from refused
        raise
