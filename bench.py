"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

The input is written once in many files before the clock starts.  Each query is executed to completion with the ``noop`` sink (all rows produced, nothing
collected to the driver).  One warm-up pass, then the best of ``$BENCH_REPEAT`` timed runs
per query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Tables that the headline queries read.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages", "documents", "conversations"]
HEADLINE = [
    "fw_vendor_daily", "fw_normalised", "fw_asset_enrich", "fw_new_assets",
    "asset_profile", "org_attribution",
    "sensor_alerts", "sensor_attack_labels",
    "endpoint_events",
    "inv_asset_snapshot", "inv_software_state", "inv_hardware",
    "report_daily_line", "presence_online",
]


def spread(spark, sf_dir: str, files: int) -> str:
    """The input tables written anew in many files, as a submitter lays out a table: the given ones have one row
    group each, which no number of cores can share.  Set BENCH_SPREAD=0 to time them as they are."""
    if os.environ.get("BENCH_SPREAD", "1") == "0":
        return sf_dir
    out = tempfile.mkdtemp(prefix="tidewatch-bench-")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tidewatch.plans import registry
    from tidewatch.session import get_session

    spark = get_session(f"local[{cpus}]", app="tidewatch-bench", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    names = only or HEADLINE
    given, sf_dir = sf_dir, spread(spark, sf_dir, int(cpus) * 2)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = registry.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        rows[name] = fn(spark, sf_dir).count()
    sf = os.path.basename(given.rstrip("/")).replace("sf", "")
    out = {"metric": "total_headline_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "rows": rows, "sf": sf, "cpus": int(cpus), "repeat": repeat, "layout": "one file" if sf_dir == given else "many files"}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
