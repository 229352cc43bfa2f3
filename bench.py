"""Benchmark: load the warehouse once, then time every registered query.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_REPS (5 timed runs after one warm-up; the median is reported).
Each query is executed in full through the ``noop`` sink (no driver collect).

Per query it also reports, from Spark's event log (written to a fresh
scratch folder): shuffle bytes written, input bytes read and stages run
(per run), and the number of distinct fact-table scans in the physical plan.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _event_metrics(log_dir: str) -> dict[str, dict[str, float]]:
    """Shuffle-write / input bytes and stage counts per job group."""
    files = [os.path.join(r, f) for r, _, fs in os.walk(log_dir) for f in fs]
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path in files:
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for s in e.get("Stage IDs", []):
                            stage_group[s] = group
                elif kind == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if not group:
                        continue
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    m = out[group]
                    m["stages"] += 1
                    m["tasks"] += info.get("Number of Tasks", 0)
                    m["shuffle_write_bytes"] += float(acc.get("internal.metrics.shuffle.write.bytesWritten") or 0)
                    m["input_bytes"] += float(acc.get("internal.metrics.input.bytesRead") or 0)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    from shelfwise.plans import registry
    from shelfwise.session import local_session
    from shelfwise.sources import warehouse

    spark = local_session(
        cores=cpus,
        shuffle_partitions=cpus,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    sc = spark.sparkContext

    # session warm-up (JVM start, first codegen) so load_sec measures the load
    sc.setJobGroup("warmup", "warmup")
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()

    sc.setJobGroup("load", "load")
    t0 = time.perf_counter()
    wh = warehouse.from_tpch(spark, sf_dir)  # load: staging -> dims -> fact (written once)
    load_sec = time.perf_counter() - t0

    timings: dict[str, float] = {}
    fact_scans: dict[str, int] = {}
    for name in registry.QUERIES:
        runs = []
        for i in range(reps + 1):
            sc.setJobGroup(f"{name}#{i}" if i else f"warmup:{name}", name)
            wh.forget_views()  # every run plans and computes the whole query
            t = time.perf_counter()
            df = registry.run(name, spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t)
        plan = registry.run(name, spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        # distinct fact scans (same columns and filters = one reusable scan)
        scans = re.findall(r"FileScan parquet[^\n]*inventory_data[^\n]*", plan)
        fact_scans[name] = len({re.sub(r"#\d+L?|\[id=#\d+\]|subquery#\d+", "", x) for x in scans})
        timings[name] = round(statistics.median(runs), 4)

    # per-SKU statistics three ways, for queries needing both windows:
    # one aggregate per window / one fused aggregate / the tables written
    # with the fact
    from shelfwise.functions.params import Params

    variants = {
        "simple_from_fact": Params(read_snapshots=False),
        "fused_from_fact": Params(read_snapshots=False, fused_sku_stats=True),
        "snapshot_tables": Params(),
    }
    paths: dict[str, dict[str, float]] = {}
    for name in ("stockout_risk", "executive_kpi_dashboard", "category_performance"):
        for label, p in variants.items():
            runs = []
            sc.setJobGroup(f"path:{name}:{label}", label)
            for i in range(reps + 1):
                wh.forget_views()
                t = time.perf_counter()
                df = registry.run(name, spark, sf_dir, p=p, fused=p.fused_sku_stats)
                df.write.format("noop").mode("overwrite").save()
                if i:
                    runs.append(time.perf_counter() - t)
            paths.setdefault(name, {})[label] = round(statistics.median(runs), 4)

    # wide catalogue: product_id = l_partkey mod 1000 (25,000 SKUs instead of
    # 250), the ten analyses only; reported separately from the main metric
    wide_reps = max(1, reps // 2)
    sc.setJobGroup("wide:load", "wide load")
    t0 = time.perf_counter()
    wide_wh = warehouse.from_tpch(spark, sf_dir, product_modulus=1000)
    wide: dict[str, float] = {"load_sec": round(time.perf_counter() - t0, 3)}
    for name in list(registry.QUERIES)[:10]:
        runs = []
        sc.setJobGroup(f"wide:{name}", name)
        for i in range(wide_reps + 1):
            wide_wh.forget_views()
            t = time.perf_counter()
            registry.run(name, spark, sf_dir, product_modulus=1000).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t)
        wide[name] = round(statistics.median(runs), 4)
    spark.stop()

    per_group = _event_metrics(log_dir)
    per_query: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for group, m in per_group.items():
        if "#" in group:
            q = group.split("#")[0]
            for k, v in m.items():
                per_query[q][k] += v / reps

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "load_sec": round(load_sec, 3),
        "shuffle_write_bytes": {q: int(per_query[q]["shuffle_write_bytes"]) for q in timings},
        "input_bytes": {q: int(per_query[q]["input_bytes"]) for q in timings},
        "stages": {q: round(per_query[q]["stages"], 1) for q in timings},
        "distinct_fact_scans": fact_scans,
        "sku_stats_paths_sec": paths,
        "wide_catalogue_sec": wide,
        "load": {k: int(v) for k, v in per_group.get("load", {}).items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "reps": reps,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
