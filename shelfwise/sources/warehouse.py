"""The loaded tables: stores, products and the daily fact, in published versions.

``load()`` runs the load step lazily. ``materialize()`` and ``append()`` write new folders
(``<table>/part=<name>``, ``derived/<name>``) and then publish a version, the list of the folders that
belong to it (``sources.versions``). A reader opens one version and sees exactly its folders: a
writer that dies in between changes nothing for it, a replay starts from the published state, and of
two writers at once the second is refused.

Fact layout: partitioned by part and ``month_key`` (yyyymm), sorted by
(date, store_id, region, product_id) inside each file, so a trailing window
prunes whole months and Parquet min/max statistics skip row groups.
"""

from __future__ import annotations

import datetime
import json
import tempfile
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from .. import schemas
from ..functions.params import DEFAULT
from ..operators import etl, integrity, rejects, sku_months, sku_stats
from ..operators.windowing import latest_per_key
from . import tpch, versions
from .files import delete_folder, fingerprint, released_shuffles
from .versions import Part, Version

MONTH_KEY = "month_key"
# of the written tables; tables of another layout are not reopened
LAYOUT = "v4"
#: Tables that grow by a folder with every load and append.
FACT, STORES, PRODUCTS, STAGING = "inventory_data", "stores", "products", "staging_inventory_data"
MONTHS, LOAD_LOG = "sku_months", "load_log"
# days of the (sales, ABC, week) windows that the written statistics are for
DEFAULT_WINDOWS = (DEFAULT.sales_window_days, DEFAULT.abc_window_days, DEFAULT.kpi_window_days)
FACT_SCHEMA = StructType([*schemas.INVENTORY.fields]).add("part", StringType()).add(MONTH_KEY, IntegerType())


def month_key(date_col) -> Column:
    return F.year(date_col) * 100 + F.month(date_col)


@dataclass
class Warehouse:
    spark: SparkSession
    stores: DataFrame
    products: DataFrame
    fact: DataFrame
    staging: DataFrame | None = None
    # staging columns ordering duplicate rows for INSERT IGNORE (None: input order)
    load_order: list[str] | None = None
    # under which key texts were made alike (None: compared as bytes)
    collation: str | None = None
    location: str | None = None
    # MAX(date) of a written (immutable) fact, recorded when it was written
    latest: datetime.date | None = None
    # latest fact row per SKU, written with the fact (None: compute it)
    sku_latest: DataFrame | None = None
    # per-SKU trailing-window statistics written with the fact, and the
    # (sales, abc, week) window lengths they were computed for
    sku_stats: DataFrame | None = None
    sku_stats_windows: tuple[int, ...] | None = None
    # stock, reorder, turnover and ABC columns per SKU under the default parameters, written with the fact
    analysis: DataFrame | None = None
    # KPI row per SKU under the default parameters, written with the fact
    kpis: DataFrame | None = None
    # sums and last row per SKU and month, of every part
    months: DataFrame | None = None
    # what each load counted (see ``operators.rejects``)
    load_log: DataFrame | None = None
    # the published version this is a reader of
    published: Version | None = None
    # where a version under construction keeps its rank tables (see ``plans.core``)
    rank_folder: str | None = None
    # readers of earlier dates whose tables were written (see ``as_of``)
    earlier: dict = field(default_factory=dict, repr=False)
    _cache: dict = field(default_factory=dict, repr=False)

    @property
    def version(self) -> int:
        return self.published.number if self.published else 0

    # ------------------------------------------------------------------
    def latest_date(self) -> Column:
        """MAX(date) of the fact.

        For a written fact this is the value recorded at write time, a
        literal: month pruning and Parquet row-group skipping are then
        static.  For a lazy fact it is a scalar subquery over the fact.
        """
        if self.latest is not None:
            return F.lit(self.latest)
        if "latest" not in self._cache:
            self._cache["latest"] = self.fact.agg(F.max("date")).scalar()
        return self._cache["latest"]

    def between(self, start: Column, end: Column) -> DataFrame:
        """Fact rows with start <= date <= end; prunes months when partitioned."""
        f = self.fact
        cond = F.col("date").between(start, end)
        if MONTH_KEY in f.columns:
            cond = cond & F.col(MONTH_KEY).between(month_key(start), month_key(end))
        return f.filter(cond)

    def trailing_days(self, days: int) -> DataFrame:
        latest = self.latest_date()
        return self.between(F.date_sub(latest, days), latest)

    def trailing_months(self, months: int) -> DataFrame:
        latest = self.latest_date()
        return self.between(F.add_months(latest, -months), latest)

    def on_latest_date(self) -> DataFrame:
        latest = self.latest_date()
        return self.between(latest, latest)

    def forget_views(self) -> None:
        """Drop memoised analysis DataFrames (each is rebuilt, and recomputed, on next use)."""
        self._cache.clear()

    def memo(self, name: str, build):
        """Build a derived DataFrame once per warehouse (same plan object)."""
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]


# ----------------------------------------------------------------------
def load(spark: SparkSession, staging: DataFrame, order=None, key_collation: str | None = None) -> Warehouse:
    """Lazy load: dimensions and fact as DataFrames over the staging rows.

    ``key_collation`` (e.g. ``UNICODE_CI_AI``: neither case nor accents count) makes key texts that are equal
    under it one key, see ``_one_spelling``, for which the key texts are read once here; a written warehouse
    keeps it for its appends.
    """
    if key_collation is not None:
        if order is None:  # the input order must be read off before rows are joined
            staging, order = etl.with_row_order(staging), [etl.ROW_ORDER]
        staging = _one_spelling(spark, staging, key_collation)
    stores = etl.build_stores(staging)
    products = etl.build_products(staging)
    fact = etl.build_inventory(staging, stores, products, order=order)
    return Warehouse(spark, stores, products, fact, staging=staging, collation=key_collation,
                     load_order=list(order) if order is not None else None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Set here only when the session has none and runs in local mode (tests);
    on a cluster a missing setting is an error, never a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: the warehouse tables need a folder shared by all executors"
            )
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def materialize(
    wh: Warehouse, location: str, stats_windows: tuple[int, ...] = DEFAULT_WINDOWS, cluster_months: bool = True
) -> Warehouse:
    """Write stores, products, fact to ``location``, publish them as a version and return its reader.

    The staging rows are written first (columnar), then the dimensions; the
    fact's foreign-key filter joins against the written dimensions, whose
    file sizes let the planner decide on a broadcast by itself.  The
    SKU-grain tables follow (``_derive``). What an earlier version holds is no part of the new one.
    """
    spark = wh.spark
    known = versions.numbers(spark, location)
    number = known[-1] + 1 if known else 0
    name = versions.new_name(number)
    staging, order, kind, counted = _stage(wh.staging, wh.load_order, location, name)
    new_stores, new_products = (wh.stores, wh.products) if staging is None else (etl.build_stores(staging), etl.build_products(staging))
    _write(new_stores, location, STORES, name)
    _write(new_products, location, PRODUCTS, name)
    stores, products = (_read(spark, location, t, [name]) for t in (STORES, PRODUCTS))
    fact = wh.fact if staging is None else etl.build_inventory(staging, stores, products, order=order)
    write_fact(fact, f"{location}/{FACT}/part={name}", cluster_months)
    rows = _read(spark, location, FACT, [name])
    _write(sku_months.sums(rows, MONTH_KEY), location, MONTHS, name)
    tables = [STORES, PRODUCTS, FACT, MONTHS]
    if staging is not None:
        _log(staging, stores, products, rows, counted, location, name)
        tables += [STAGING, LOAD_LOG]
    v = Version(number, (Part(name, tuple(tables), kind),), name, read_latest_date(rows), stats_windows, wh.collation)
    out = _open(spark, location, v, derived=False)
    out.load_order = order
    _derive(out, latest_per_key(rows.select(*schemas.INVENTORY.fieldNames()), schemas.SKU, "date"), None)
    versions.publish(spark, location, v)
    return replace(_open(spark, location, v), load_order=order)


def _stage(staging: DataFrame | None, order, location: str, name: str):
    """Write staging rows as part ``name``; (reader, its order, digest of its columns, what the pass counted).

    The rows are written once, in columnar form: dimensions, fact and the key checks read them
    instead of re-deriving or re-parsing the raw feed; the input order is fixed here too.
    """
    if staging is None:
        return None, order, None, None
    if order is None:
        staging, order = etl.with_row_order(staging), [etl.ROW_ORDER]
    counted = Observation(f"load {name}")
    path = f"{location}/{STAGING}/part={name}"
    with released_shuffles(staging.sparkSession):
        staging.observe(counted, *rejects.counters(staging)).write.mode("overwrite").parquet(path)
    written = staging.sparkSession.read.parquet(path)
    return written, list(order), written.schema.json(), counted


def _log(staging, stores, products, accepted: DataFrame, counted: Observation, location: str, name: str) -> None:
    """Write what became of the staged rows: the pass's own counts, rows without a parent, duplicates."""
    orphans = integrity.fk_violations(etl.parse_staging(staging), stores, products, FACT)
    lines = rejects.lines(counted.get, rejects.orphan_rows(orphans), accepted.count())
    _write(staging.sparkSession.createDataFrame(lines, rejects.LOG_SCHEMA).coalesce(1), location, LOAD_LOG, name)


def _write(df: DataFrame, location: str, table: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{location}/{table}/part={name}")


def _read(spark: SparkSession, location: str, table: str, names: Sequence[str]) -> DataFrame:
    """The rows of the named parts of a table, with no look at any other folder."""
    schema = {FACT: FACT_SCHEMA, STORES: schemas.STORES, PRODUCTS: schemas.PRODUCTS, LOAD_LOG: rejects.LOG_SCHEMA}.get(table)
    if table == MONTHS:
        schema = sku_months.SCHEMA
    paths = [f"{location}/{table}/part={n}" for n in names]
    if not paths:
        return spark.createDataFrame([], schema).drop("part")
    reader = spark.read.option("basePath", f"{location}/{table}")
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths).drop("part")


def write_fact(fact: DataFrame, path: str, cluster_months: bool = True) -> None:
    """Write fact rows partitioned by month, sorted by key inside each file.

    A REBALANCE on the month goes before: one shuffle, after which adaptive execution splits large
    months and merges small ones, so each file holds one month at about the advisory partition
    size. Without ``cluster_months`` every write task writes one file per month it holds, which
    saves the shuffle and costs (tasks x months) files.
    """
    rows = fact.withColumn(MONTH_KEY, month_key(F.col("date")))
    if cluster_months:
        rows = rows.hint("rebalance", MONTH_KEY)
    rows = rows.sortWithinPartitions(MONTH_KEY, *schemas.INVENTORY_KEY)
    with released_shuffles(rows.sparkSession):
        rows.write.mode("overwrite").partitionBy(MONTH_KEY).parquet(path)


def _derive(out: Warehouse, latest_rows: DataFrame, stats: DataFrame | None) -> None:
    """Write the SKU-grain tables of the version that ``out`` is to become.

    ``sku_latest``: latest row per SKU (one row per SKU and map task is
    shuffled).  ``sku_window_stats``: ``stats``, or where None one aggregate over the longest trailing
    window.  ``sku_analysis``: stock, reorder, turnover and ABC columns, whose ranks are taken here once.
    ``inventory_kpis``: the KPI table, a projection of it.
    """
    from ..plans import core, kpis  # the tables are made of the analyses

    spark, base = out.spark, f"{out.location}/derived/{out.published.derived}"
    latest_rows.write.mode("overwrite").parquet(f"{base}/sku_latest")
    out.sku_latest = spark.read.parquet(f"{base}/sku_latest")
    if out.latest is None:
        return
    if stats is None:
        days = out.published.windows
        stats = sku_stats.window_stats(out.trailing_days(max(days)), out.latest_date(), days)
    stats.write.mode("overwrite").parquet(f"{base}/sku_window_stats")
    out.sku_stats, out.sku_stats_windows = spark.read.parquet(f"{base}/sku_window_stats"), out.published.windows
    out.rank_folder = f"{base}/ranks"
    core.sku_analysis(out).write.mode("overwrite").parquet(f"{base}/sku_analysis")
    delete_folder(spark, out.rank_folder)
    out.rank_folder = None
    out.forget_views()
    out.analysis = spark.read.parquet(f"{base}/sku_analysis")
    kpis.inventory_kpis(out).write.mode("overwrite").parquet(f"{base}/inventory_kpis")
    out.forget_views()
    out.kpis = spark.read.parquet(f"{base}/inventory_kpis")


def append(
    wh: Warehouse, staging: DataFrame, order=None, stats_windows: tuple[int, ...] | None = None
) -> Warehouse:
    """Load a new batch into a written warehouse with INSERT IGNORE semantics.

    Rows whose primary key is already stored are skipped (existing rows
    win); new store locations and products are added to the dimensions.
    The existing keys are read only for the months and dates the batch
    touches (static partition pruning plus row-group skipping on the sorted
    files), so a daily batch does not rescan the history. The latest rows of the new version are the
    old ones merged with the batch; the window statistics are the old ones plus the days that enter
    minus the days that leave, and only these days of the fact are read.

    The newest published version is what the batch is added to, however old the handle. Nothing of
    the batch can be read before its version is published, which is the last step; a batch that
    died before is simply loaded again. ``ConcurrentWriteError``: another append was published meanwhile.
    """
    spark, location = wh.spark, wh.location
    if location is None:
        raise ValueError("append needs a written warehouse")
    now = open_written(spark, location)
    old = now.published
    stats_windows = tuple(stats_windows or old.windows)
    stores_key, skey = list(schemas.STORES_KEY), list(schemas.INVENTORY_KEY)
    name = versions.new_name(old.number + 1)
    if old.collation is not None:
        if order is None:
            staging, order = etl.with_row_order(staging), [etl.ROW_ORDER]
        staging = _one_spelling(spark, staging, old.collation, _known_keys(now))
    staging, order, kind, counted = _stage(staging, order, location, name)
    _write(etl.build_stores(staging).join(now.stores.select(*stores_key), stores_key, "left_anti"), location, STORES, name)
    _write(etl.build_products(staging).join(now.products.select("product_id"), ["product_id"], "left_anti"), location, PRODUCTS, name)
    stores, products = (_read(spark, location, t, [*old.holding(t), name]) for t in (STORES, PRODUCTS))

    # bounds of the batch (one small aggregate): the months and dates it touches
    bounds = etl.parse_staging(staging).agg(
        F.collect_set(month_key(F.col("date"))).alias("months"), F.min("date").alias("lo"), F.max("date").alias("hi")
    ).first()
    batch = etl.build_inventory(staging, stores, products, order=order)
    if bounds["lo"] is not None:
        existing = now.fact.filter(
            F.col(MONTH_KEY).isin(sorted(bounds["months"])) & F.col("date").between(bounds["lo"], bounds["hi"])
        ).select(*skey)
        batch = batch.join(existing, skey, "left_anti")
    write_fact(batch, f"{location}/{FACT}/part={name}")
    new_rows = _read(spark, location, FACT, [name])
    _write(sku_months.sums(new_rows, MONTH_KEY), location, MONTHS, name)
    _log(staging, stores, products, new_rows, counted, location, name)

    fresh = read_latest_date(new_rows)
    latest = max((d for d in (old.latest_date, fresh) if d is not None), default=None)
    tables = [STORES, PRODUCTS, STAGING, LOAD_LOG, *([FACT, MONTHS] if fresh is not None else [])]
    parts = (*old.parts, Part(name, tuple(tables), kind))
    v = replace(old, number=old.number + 1, parts=parts, derived=name, latest_date=latest, windows=stats_windows)
    out = _open(spark, location, v, derived=False)
    stats = None
    if now.sku_stats is not None and stats_windows == old.windows:
        stats = sku_stats.slide(now.sku_stats, now.between, new_rows, old.latest_date, latest, stats_windows)
    _derive(out, _merge_latest(now.sku_latest, new_rows), stats)
    versions.publish(spark, location, v)
    return replace(_open(spark, location, v), load_order=wh.load_order)


def _one_spelling(spark: SparkSession, staging: DataFrame, collation: str, known: DataFrame | None = None) -> DataFrame:
    """Staging rows whose key texts that are equal under ``collation`` are spelt alike; the changes are written first and counted."""
    path = f"{shared_root(spark)}/shelfwise/spellings-{uuid.uuid4().hex}"
    changes = etl.other_spellings(staging, collation, known)
    changes.write.parquet(path)
    return etl.one_spelling(staging, spark.read.schema(changes.schema).parquet(path))


def _known_keys(wh: Warehouse) -> DataFrame:
    """The key texts of the dimensions, in the columns of the feed."""
    none = F.lit(None).cast("string")
    stores = wh.stores.select(F.col("store_id").alias("Store_ID"), F.col("region").alias("Region"), none.alias("Product_ID"), none.alias("Category"))
    goods = wh.products.select(none.alias("Store_ID"), none.alias("Region"), F.col("product_id").alias("Product_ID"), F.col("category").alias("Category"))
    return stores.unionByName(goods)


def compact(wh: Warehouse) -> Warehouse:
    """Rewrite the fact of the newest version as one part whose files hold one month each, and publish that.

    Many appends leave many small files; contents and SKU-grain tables stay as they are. The old
    folders remain until the owner of the location expires the versions that name them.
    """
    now = open_written(wh.spark, wh.location)
    old = now.published
    name = versions.new_name(old.number + 1)
    write_fact(now.fact.drop(MONTH_KEY), f"{wh.location}/{FACT}/part={name}")
    _write(sku_months.merged(now.months), wh.location, MONTHS, name)
    rest = tuple(replace(p, tables=tuple(t for t in p.tables if t not in (FACT, MONTHS))) for p in old.parts)
    v = replace(old, number=old.number + 1, parts=(*rest, Part(name, (FACT, MONTHS))))
    versions.publish(wh.spark, wh.location, v)
    return replace(_open(wh.spark, wh.location, v), load_order=wh.load_order)


def open_written(spark: SparkSession, location: str, number: int | None = None) -> Warehouse:
    """Reader of the newest published version (or of version ``number``) of ``location``."""
    v = versions.read(spark, location, number)
    if v is None:
        raise FileNotFoundError(f"no published version in {location}")
    return _open(spark, location, v)


def _open(spark: SparkSession, location: str, v: Version, derived: bool = True) -> Warehouse:
    """Reader of the folders that ``v`` names; without ``derived`` of the loaded tables alone."""
    tables = {t: _read(spark, location, t, v.holding(t)) for t in (STORES, PRODUCTS, FACT, MONTHS, LOAD_LOG)}
    out = Warehouse(spark, tables[STORES], tables[PRODUCTS], tables[FACT], staging=_staging(spark, location, v),
                    collation=v.collation, location=location, latest=v.latest_date, months=tables[MONTHS], load_log=tables[LOAD_LOG], published=v)
    if derived:
        base = f"{location}/derived/{v.derived}"
        out.sku_latest = spark.read.parquet(f"{base}/sku_latest")
        if v.latest_date is not None:
            out.sku_stats, out.sku_stats_windows = spark.read.parquet(f"{base}/sku_window_stats"), v.windows
            out.analysis = spark.read.parquet(f"{base}/sku_analysis")
            out.kpis = spark.read.parquet(f"{base}/inventory_kpis")
    return out


def _staging(spark: SparkSession, location: str, v: Version) -> DataFrame | None:
    """All staging rows of the version, parts with the same columns read together."""
    kinds: dict[str, list[str]] = {}
    for p in v.parts:
        if p.staging is not None:
            kinds.setdefault(p.staging, []).append(p.name)
    reads = []
    for kind, names in kinds.items():
        reader = spark.read.option("basePath", f"{location}/{STAGING}").schema(StructType.fromJson(json.loads(kind)))
        reads.append(reader.parquet(*[f"{location}/{STAGING}/part={n}" for n in names]).drop("part"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reads) if reads else None


def as_of(wh: Warehouse, day: datetime.date) -> Warehouse:
    """The warehouse as a load that ended with ``day`` would have left it: every analysis at that date.

    The fact is cut at ``day`` (later months are not even listed in a scan). Latest rows and window
    statistics come from the sums and last rows per SKU and month, of whole months, and from the fact
    only for the months that a window or ``day`` cuts; the SKU-grain tables of that day are then
    written beside the version's, once per handle; nothing but the returned reader names them. Stores and
    products are those of the version: the dimensions carry no history.
    """
    if day in wh.earlier:
        return wh.earlier[day]
    if wh.published is None:  # lazy: cut the fact, the rest follows from it
        return Warehouse(wh.spark, wh.stores, wh.products, wh.fact.filter(F.col("date") <= F.lit(day)))
    key = day.year * 100 + day.month
    fact = wh.fact.filter((F.col(MONTH_KEY) <= key) & (F.col("date") <= F.lit(day)))
    months = sku_months.merged(wh.months.filter(F.col(MONTH_KEY) <= key))
    earlier = months.filter(F.col(MONTH_KEY) < key)
    in_month = fact.filter(F.col(MONTH_KEY) == key)
    latest = in_month.agg(F.max("date")).first()[0]
    if latest is None:
        latest = earlier.agg(F.max("last.date")).first()[0]
    cols = schemas.INVENTORY.fieldNames()
    derived = f"as-of-{day.isoformat()}-{uuid.uuid4().hex[:12]}"
    then = replace(wh.published, derived=derived, latest_date=latest)
    out = Warehouse(wh.spark, wh.stores, wh.products, fact, location=wh.location, latest=latest, published=then)
    stats = None
    if latest is not None:  # a whole month of a window ends before or with ``day``
        stats = sku_months.window_stats(months, out.between, latest, then.windows, MONTH_KEY)
    _derive(out, _merge_latest(earlier.select(*schemas.SKU, "last.*").select(*cols), in_month), stats)
    wh.earlier[day] = out
    return out


def _merge_latest(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Latest row per SKU after adding ``fresh`` rows (newer date wins)."""
    cols = schemas.INVENTORY.fieldNames()
    both = current.select(*cols).unionByName(fresh.select(*cols))
    return latest_per_key(both, schemas.SKU, "date")


def read_latest_date(fact: DataFrame) -> datetime.date | None:
    """MAX(date) of a month-partitioned fact, reading only its last month."""
    last_month = fact.agg(F.max(MONTH_KEY)).first()[0]
    if last_month is None:
        return None
    return fact.filter(F.col(MONTH_KEY) == last_month).agg(F.max("date")).first()[0]


def _app_id(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id", None)
    if app:
        return app
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return str(id(spark))


_REGISTRY: dict[tuple, Warehouse] = {}
_REGISTRY_LOCK = threading.RLock()


def from_tpch(
    spark: SparkSession, sf_dir: str, product_modulus: int = 10, materialized: bool = True
) -> Warehouse:
    """Warehouse over the driver's tables (see ``sources.tpch``).

    With ``materialized`` the load runs once per source: the folder is named by
    the source files' names, lengths and write times, so later calls and later
    applications reopen the written tables, and a changed source is loaded anew.
    Folders of old sources belong to the owner of ``spark.checkpoint.dir``.
    """
    if not materialized:
        return load(spark, tpch.staging_from_tpch(spark, sf_dir, product_modulus), order=tpch.LOAD_ORDER)
    source = fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tpch.TABLES])
    key = (_app_id(spark), source, product_modulus)
    with _REGISTRY_LOCK:  # one load per source, also when called from several threads
        if key not in _REGISTRY:
            location = f"{shared_root(spark)}/shelfwise/{source[:16]}-{product_modulus}-{LAYOUT}"
            if versions.numbers(spark, location):
                _REGISTRY[key] = replace(open_written(spark, location), load_order=tpch.LOAD_ORDER)
            else:
                staging = tpch.staging_from_tpch(spark, sf_dir, product_modulus)
                _REGISTRY[key] = materialize(load(spark, staging, order=tpch.LOAD_ORDER), location)
        return _REGISTRY[key]
