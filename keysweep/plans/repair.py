"""Finish or roll back a publish that broke off.

A publish leaves a journal record until its rows are verified (``sinks/journal.py``).
``repair_publish`` finishes it: staged strategies publish the kept stage again (every step may
be repeated), ``direct`` has no stage, so its partitions are counted: each must be wholly old or
wholly new, else the survivors can only come from a copy and the call fails. Nothing is
changed where a partition holds more rows than before the purge: another writer added some.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keysweep.session import new_run_id, work_root
from keysweep.sinks import journal, publish
from keysweep.sinks.lease import Lease
from keysweep.sources.catalog import TableInfo, describe_table, spec_predicate
from keysweep.sources.stage import read_stage

FINISHED, ROLLED_BACK = "FINISHED", "ROLLED_BACK"


class RepairError(RuntimeError):
    pass


def _counts(spark: SparkSession, info: TableInfo, specs: list[dict]) -> list[int]:
    parts = info.partition_cols
    if not parts:
        return [spark.table(info.name).count()]
    rows = spark.table(info.name).where(spec_predicate(specs, parts)).groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")).collect()
    found = {tuple(r[c] for c in parts): r["_n"] for r in rows}
    return [found.get(tuple(s[c] for c in parts), 0) for s in specs]


def repair_record(spark: SparkSession, info: TableInfo, base: str, record: dict) -> str:
    spark.catalog.refreshTable(info.name)
    impacted, parts = record["impacted"], info.partition_cols
    specs = journal.typed_specs(spark, info, impacted)
    now, before, kept = _counts(spark, info, specs), [r["before"] for r in impacted], [r["kept"] for r in impacted]
    what = f"publish {record['run_id']} of {info.name} broke off"
    if any(n > b for n, b in zip(now, before)):
        raise RepairError(f"{what} and rows were added since; stage {record['stage']}, backup {record['backup']} kept")
    surviving = [s for s, k in zip(specs, kept) if k]
    emptied = [s for s, k in zip(specs, kept) if not k]
    if record["stage"] is None:
        if any(n not in (k, b) for n, k, b in zip(now, kept, before)):
            raise RepairError(f"{what} and partitions are missing rows; there is no stage; backup {record['backup']} kept")
        publish.drop_emptied(spark, info, [s for s, n, k in zip(specs, now, kept) if n == k == 0])
        publish.refresh(spark, info)
        journal.end(spark, base, record["run_id"])
        return FINISHED if now == kept else ROLLED_BACK
    # a run that broke off may have dropped partitions and not their folders yet
    replaced = [*(record.get("old") or []), *(d for d in record.get("emptied_dirs") or [] if d)]
    if record["strategy"] == "move":
        publish.publish_move(spark, info, record["stage"], surviving, record["trash"], resume=True)
        replaced.append(record["trash"])
    elif record["strategy"] == "files":
        publish.publish_files(spark, spark.read.parquet(record["swaps"]))
    elif record["strategy"] in publish.STAGE_STAYS:
        publish.publish_pointer(spark, info, record["stage"], surviving)
    else:
        stage = read_stage(spark, record["stage"], info.schema)
        if stage.count() != sum(kept):
            raise RepairError(f"{what} and its stage {record['stage']} is not complete; backup {record['backup']} kept")
        publish.publish_dynamic(spark, info, stage)
    if parts:
        publish.drop_emptied(spark, info, emptied)
    publish.refresh(spark, info)
    if _counts(spark, info, specs) != kept:
        raise RepairError(f"{what}; publishing its stage {record['stage']} again did not give the expected rows")
    for path in replaced:
        publish.remove_folder(spark, path)
    if record["strategy"] == "pointer" and not parts:
        publish.remove_files(spark, spark.read.parquet(record["files"]))
    if record["strategy"] not in publish.STAGE_STAYS:
        publish.cleanup(spark, record["stage"])
    journal.end(spark, base, record["run_id"])
    return FINISHED


def repair_publish(spark: SparkSession, table: str, run_id: str | None = None, work_dir: str | None = None,
                   wait: float = 0.0) -> dict[str, str]:
    """Repair the unfinished publishes of a table (or the one of ``run_id``): {run id: outcome}.
    The caller vouches that no such purge still runs; one that holds the table's lease is waited for up to ``wait`` seconds."""
    info = describe_table(spark, table)
    base = f"{(work_dir or work_root(spark)).rstrip('/')}/{info.database}/{info.table}"
    records = [r for r in journal.unfinished(spark, base) if run_id in (None, r["run_id"])]
    if not records:
        return {}
    lease = Lease(spark, base, f"repair-{new_run_id(spark)}").take(wait)
    try:
        return {r["run_id"]: repair_record(spark, info, base, r) for r in records}
    finally:
        lease.release()
