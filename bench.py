"""Benchmark: headline purges on the driver's tables.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line. Each purge runs
on a fresh scratch copy of its table; the copy is set-up and not timed.

Queries (lineitem partitioned by ship month, orders by order month):
  purge_1_month     returned items shipped in 1996-03; key (order, line, shipdate)
  purge_10_months   returned items shipped 1996-01..1996-10; same key
  purge_all_months  returned items with the top discount; key (order, line)
  side_full         same keys, whole-table survivors to a side folder
  dry_run_all       same keys, counts only
  purge_customers   orders of AUTOMOBILE customers (the flagship)
  purge_shuffle     same as purge_customers with broadcast disabled (shuffle join + hot-key split)
  manifest          manifest over orders, events and documents
  restore           restore the purge_customers backup
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from keysweep import scenarios as S  # noqa: E402
from keysweep.plans.manifest import purge_manifest  # noqa: E402
from keysweep.plans.purge import dry_run, purge_table  # noqa: E402
from keysweep.plans.restore import restore_backup  # noqa: E402
from keysweep.scratch import Scratch  # noqa: E402
from keysweep.session import local_session  # noqa: E402


def returned_keys(spark, d, months=None, with_date=True):
    li = spark.read.parquet(f"{d}/lineitem.parquet").where(F.col("l_returnflag") == "R")
    if months:
        li = li.where(F.date_format("l_shipdate", "yyyy-MM").isin(months))
    else:
        li = li.where(F.col("l_discount") >= 0.095)
    cols = ["l_orderkey", "l_linenumber"] + (["l_shipdate"] if with_date else [])
    return li.select(*cols)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="keysweep-bench")
    sc = spark.sparkContext
    scratch = Scratch(spark)
    times, jobs, info = {}, {}, {}

    def run(name, fn):
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(name))
        sc.setJobGroup("setup", "setup")
        return out

    def li_copy():
        return scratch.table(S.lineitem_p(spark, sf_dir), "lineitem_p", ["ship_month"])

    def orders_copy():
        return scratch.table(S.orders_p(spark, sf_dir), "orders_p", ["order_month"])

    # warm-up (JVM JIT, code generation, catalog), not reported
    t = scratch.table(S.events_p(spark, sf_dir), "events_p", ["event_type"])
    purge_table(spark, t, S.k_errors(spark, sf_dir))
    t = scratch.table(S.lineitem_p(spark, sf_dir), "lineitem_p", ["ship_month"])
    purge_table(spark, t, returned_keys(spark, sf_dir, ["1997-05"]))

    t = li_copy()
    r = run("purge_1_month", lambda: purge_table(spark, t, returned_keys(spark, sf_dir, ["1996-03"])))
    info["purge_1_month"] = {"impacted": len(r.impacted), "deleted": r.rows_deleted, "steps": r.timings}
    t = li_copy()
    months = [f"1996-{m:02d}" for m in range(1, 11)]
    r = run("purge_10_months", lambda: purge_table(spark, t, returned_keys(spark, sf_dir, months)))
    info["purge_10_months"] = {"impacted": len(r.impacted), "deleted": r.rows_deleted}
    t = li_copy()
    r = run("purge_all_months", lambda: purge_table(spark, t, returned_keys(spark, sf_dir, with_date=False)))
    info["purge_all_months"] = {"impacted": len(r.impacted), "deleted": r.rows_deleted, "table_rows": r.rows_before,
                                "steps": r.timings}
    t = li_copy()
    run("side_full", lambda: purge_table(spark, t, returned_keys(spark, sf_dir, with_date=False), strategy="side_full"))
    run("dry_run_all", lambda: dry_run(spark, t, returned_keys(spark, sf_dir, with_date=False)))
    t = orders_copy()
    r = run("purge_customers", lambda: purge_table(spark, t, S.k_automobile(spark, sf_dir)))
    info["purge_customers"] = {"impacted": len(r.impacted), "deleted": r.rows_deleted}
    run("restore", lambda: restore_backup(spark, t, r.backup_dir).collect())
    t2 = orders_copy()
    run("purge_shuffle", lambda: purge_table(spark, t2, S.k_automobile(spark, sf_dir), broadcast_max_bytes=0))

    names = {}
    m = S.manifest_df(spark, sf_dir)
    for logical, fn, parts in (("orders_p", S.orders_p, ["order_month"]), ("events_p", S.events_p, ["event_type"]),
                               ("documents_p", S.documents_p, ["lang"])):
        names[logical] = scratch.table(fn(spark, sf_dir), logical, parts)
        m = m.withColumn("TABLE_NAME", F.when(F.col("TABLE_NAME") == logical, F.lit(names[logical].split(".")[1]))
                         .otherwise(F.col("TABLE_NAME")))
    path = scratch.path("manifest")
    m.write.option("header", True).csv(path)
    run("manifest", lambda: purge_manifest(spark, path))

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "purge_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "spark_jobs": jobs, "effect": info}))


if __name__ == "__main__":
    main()
