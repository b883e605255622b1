"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Prints one JSON line: total seconds, seconds per query, rows/s for the medallion steps and the
number of Spark jobs one pipeline run takes. With BENCH_EVENT_LOG=1, Spark's event log is written to
a fresh scratch folder and per-query stage counts, shuffle bytes and executor time are added.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlelake import queries as Q  # noqa: E402
from candlelake.session import local_session, new_path  # noqa: E402
from candlelake.operators.bronze import flatten  # noqa: E402
from candlelake.operators.gold import to_gold  # noqa: E402
from candlelake.operators.silver import dq_report, parse, to_silver  # noqa: E402
from candlelake.sources.landing import read_landing  # noqa: E402

HEADLINE = [
    "bronze_flatten",
    "dq_report",
    "gold_bars",
    "new_rows",
    "incremental_summary",
    "full_reload",
    "incremental_append",
    "stream_incremental",
]
SMOKE = "/root/testdata/sf0.001"


def run(spark, name: str, sf: str, group: str | None = None) -> tuple[float, int]:
    sc = spark.sparkContext
    if group:
        sc.setJobGroup(group, group)
    t0 = time.perf_counter()
    df = Q.QUERIES[name](spark, sf)
    n = df.count()
    elapsed = time.perf_counter() - t0
    if group:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return elapsed, n


def stage_metrics(event_dir: str) -> dict[str, dict]:
    """Per job group from Spark's event log: stages, shuffle bytes written, executor run time."""
    stage_group, out = {}, {}
    for path in sorted(glob.glob(os.path.join(event_dir, "**", "events_*"), recursive=True)):
        with open(path, "rb") as raw:
            data = raw.read()
        if path.endswith(".zstd"):
            import zstandard

            data = zstandard.ZstdDecompressor().stream_reader(data).read()
        for line in data.decode().splitlines():
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                group = stage_group.get(info["Stage ID"])
                if not group or "Completion Time" not in info:
                    continue
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                m = out.setdefault(group, {"stages": 0, "shuffle_write_bytes": 0, "executor_run_ms": 0})
                m["stages"] += 1
                m["shuffle_write_bytes"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
                m["executor_run_ms"] += int(acc.get("internal.metrics.executorRunTime", 0) or 0)
    return out


def jobs_for(spark, label: str, fn) -> int:
    sc = spark.sparkContext
    sc.setJobGroup(label, label)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(label))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # Optional: Spark's event log in a fresh scratch folder, for per-query stage metrics.
    event_dir = tempfile.mkdtemp(prefix="candlelake-events-") if os.environ.get("BENCH_EVENT_LOG") == "1" else None
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir} if event_dir else {}
    spark = local_session(
        cpus,
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
        app="candlelake-bench",
        conf=conf,
    )
    for name in HEADLINE:  # warm the JVM and the code caches on the smallest scale
        run(spark, name, SMOKE)

    times, rows = {}, {}
    for name in HEADLINE:
        times[name], rows[name] = run(spark, name, sf, group=f"q-{name}")
    n_orders = spark.read.parquet(f"{sf}/orders.parquet").count()

    # Library-only timings: loads from an already landed folder (no fixture building).
    sc = Q.Scenario(spark, sf)
    paths = sc.setup()
    landed = read_landing(spark, paths["landing"])
    lib = {
        "lib_bronze": lambda: flatten(landed),
        "lib_dq_report": lambda: dq_report(parse(flatten(landed))),
        "lib_gold": lambda: to_gold(to_silver(flatten(landed))),
    }
    lib_rows = {}
    for name, build in lib.items():
        build().write.format("noop").mode("overwrite").save()  # warm
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    for name in ("lib_bronze", "lib_gold"):
        lib_rows[name] = lib[name]().count()
    t0 = time.perf_counter()
    full_jobs = jobs_for(spark, "full", lambda: Q.run_full_reload(spark, landed, new_path(spark, "target")))
    times["load_full_reload"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    incr_jobs = jobs_for(spark, "incremental", lambda: sc.run(paths))
    times["load_incremental"] = time.perf_counter() - t0
    n_landed = landed.count()

    m = re.search(r"sf([0-9.]+)", sf)
    out = {
        "metric": "headline_total",
        "value": round(sum(times[k] for k in HEADLINE), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf,
        "rows": rows,
        "orders_rows_per_sec": {k: round(n_orders / v) for k, v in times.items() if k in HEADLINE},
        "landed_responses": n_landed,
        "library_rows_per_sec": {k: round(v / times[k]) for k, v in lib_rows.items()},
        "spark_jobs_per_run": {"full_reload": full_jobs, "incremental": incr_jobs},
        "cpus": cpus,
    }
    spark.stop()  # flushes the event log
    if event_dir:
        metrics = stage_metrics(event_dir)
        out["stages"] = {
            k[2:] if k.startswith("q-") else k: v
            for k, v in metrics.items()
            if k.startswith("q-") or k in ("full", "incremental")
        }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
