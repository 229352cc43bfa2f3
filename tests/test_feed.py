"""Feed files: empty fields against NULL, the order of several files, staging after a second batch."""

from __future__ import annotations

import gzip
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.plans import kpis, registry
from shelfwise.sources import feed, files, warehouse

HEADER = ",".join(schemas.STAGING.fieldNames())


def _write(folder: str, name: str, *lines: str) -> str:
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = Path(folder) / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def _line(day="2024-01-01", store="S1", product="P1", region="North", level="5", season="Winter", weather="Sunny") -> str:
    return f"{day},{store},{product},Toys,{region},{level},1,0,1.00,2.00,0,{weather},None,2.10,{season}"


def test_empty_text_is_kept_and_the_mark_is_null(spark, tmp_dir):
    path = _write(tmp_dir, "a.csv", _line(season="", level=""), _line(product="P2", season="\\N", level="\\N", weather='"a, b"'))
    rows = {r["Product_ID"]: r for r in feed.read_staging(spark, path).collect()}
    assert (rows["P1"]["Seasonality"], rows["P1"]["Inventory_Level"]) == ("", None)
    assert (rows["P2"]["Seasonality"], rows["P2"]["Inventory_Level"]) == (None, None)
    assert rows["P2"]["Weather_Condition"] == "a, b"
    # an empty region is a region; a measure without a number becomes 0
    wh = warehouse.load(spark, feed.read_staging(spark, _write(tmp_dir, "b.csv", _line(region="", level=""))))
    assert [(r["region"], r["inventory_level"]) for r in wh.fact.collect()] == [("", 0)]


def test_text_that_is_no_number_fails_the_load(spark, tmp_dir):
    path = _write(tmp_dir, "a.csv", _line(level="many"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|many"):
        feed.read_staging(spark, path).collect()


def test_the_first_file_by_name_wins(spark, tmp_dir):
    # the larger file is read first by size, the other comes first by name
    extra = [_line(product=f"X{i}") for i in range(300)]
    _write(tmp_dir, "b.csv", _line(level="222"), *extra)
    _write(tmp_dir, "a.csv", _line(level="111"), _line(level="112"))
    fact = warehouse.load(spark, feed.read_staging(spark, tmp_dir)).fact
    assert fact.filter("product_id = 'P1'").first()["inventory_level"] == 111
    assert fact.count() == 301


def test_staging_and_kpis_follow_each_batch(spark, tmp_dir):
    first = feed.read_staging(spark, _write(f"{tmp_dir}/in1", "a.csv", _line(), _line(product="P2")))
    second = feed.read_staging(spark, _write(f"{tmp_dir}/in2", "a.csv", _line(day="2024-01-02", level="9"), _line()))
    wh = warehouse.materialize(warehouse.load(spark, first), f"{tmp_dir}/wh")
    wh = warehouse.append(wh, second)
    for now in (wh, warehouse.open_written(spark, f"{tmp_dir}/wh")):
        rows = {r["table_name"]: r["table_rows"] for r in registry.QUERIES["table_profile"](now, registry.DEFAULT).collect()}
        assert (rows["staging_inventory_data"], rows["inventory_data"], rows["inventory_kpis"]) == (4, 3, 2)
        assert kpis.inventory_kpis(now) is now.kpis
        assert {str(r["calculation_date"]) for r in now.kpis.collect()} == {"2024-01-02"}


def _rows(spark, n=900):
    """Staging rows in which each key comes three times; ``id`` falls as ``n`` rows are read."""
    day, goods = "CAST(date_add(DATE'2024-01-01', CAST(id % 300 AS INT)) AS STRING) AS Date", "'P1' AS Product_ID"
    texts = ["'S1' AS Store_ID", goods, "'Toys' AS Category", "'North' AS Region"]
    money = [f"CAST(1.5 AS DECIMAL(10,2)) AS {c}" for c in ("Demand_Forecast", "Price", "Competitor_Pricing")] + ["CAST(0 AS DECIMAL(5,2)) AS Discount"]
    rest = ["'Sunny' AS Weather_Condition", "'None' AS Holiday_Promotion", "CAST(NULL AS STRING) AS Seasonality"]
    units = ["CAST(id AS INT) AS Inventory_Level", "1 AS Units_Sold", "0 AS Units_Ordered"]
    return spark.range(n).orderBy(F.desc("id")).selectExpr("id", day, *texts, *units, *money, *rest)


def test_written_feed_files_are_small_and_in_order(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(feed, "FILE_LINES", 100, raising=False)
    rows, names = _rows(spark), schemas.STAGING.fieldNames()
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(feed.NULL_MARK)) for c in names])
    feed.write_feed(rows, f"{tmp_dir}/rows", ["id"])
    feed.write_lines(rows, line, f"{tmp_dir}/lines", ["id"])
    for folder, header in (("rows", True), ("lines", False)):
        parts = sorted(Path(tmp_dir, folder).glob("part-*"))
        texts = [gzip.decompress(p.read_bytes()).decode().splitlines()[int(header):] for p in parts]
        assert len(parts) >= 9 and max(map(len, texts)) <= 100
        assert [int(x.split(",")[names.index("Inventory_Level")]) for t in texts for x in t] == list(range(900))
        assert sum(p.stat().st_size for p in parts) < sum(len(x) for t in texts for x in t) / 3
        # of the copies of a key the first in the order of the files is loaded
        read = feed.read_staging(spark, f"{tmp_dir}/{folder}", quarantine=f"{tmp_dir}/bad-{folder}", header=header)
        got = warehouse.load(spark, read).fact.select("inventory_level", "seasonality").collect()
        assert sorted(map(tuple, got)) == [(i, None) for i in range(300)]


def _shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


def test_large_writes_leave_no_shuffle_files(spark, tmp_dir):
    rows = _rows(spark).repartition(3)
    typed = rows.withColumn("Date", F.to_date("Date"))
    lazy = warehouse.load(spark, typed, order=["id"])
    writes = {
        "feed": lambda: feed.write_feed(rows, f"{tmp_dir}/feed", ["id"]),
        "lines": lambda: feed.write_lines(rows, F.col("Date"), f"{tmp_dir}/lines", ["id"]),
        "staging": lambda: warehouse._stage(typed, ["id"], f"{tmp_dir}/wh", "one"),
        "fact": lambda: warehouse.write_fact(lazy.fact, f"{tmp_dir}/fact"),
    }
    own = spark.conf.get(files.RELEASE, None)
    for name, write in writes.items():
        before = _shuffle_files(spark)
        write()
        until = time.time() + 20  # they are deleted in the background
        while (left := _shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        assert not left, name
        assert spark.conf.get(files.RELEASE, None) == own
    assert spark.read.parquet(f"{tmp_dir}/fact").count() == 300


def test_the_session_keeps_its_own_setting_for_shuffles(spark):
    own = spark.conf.get(files.RELEASE, None)
    try:
        for value in ("false", None):
            spark.conf.unset(files.RELEASE) if value is None else spark.conf.set(files.RELEASE, value)
            with pytest.raises(ValueError), files.released_shuffles(spark):
                with files.released_shuffles(spark):
                    pass
                assert spark.conf.get(files.RELEASE) == "true"  # another write still runs
                raise ValueError
            assert spark.conf.get(files.RELEASE, None) == value and not files._WRITING
    finally:
        spark.conf.unset(files.RELEASE) if own is None else spark.conf.set(files.RELEASE, own)
