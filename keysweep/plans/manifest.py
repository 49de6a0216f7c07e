"""Manifest-driven purge of several tables.

The manifest (``PK, PK_VALUE, DATABASE_NAME, TABLE_NAME, PARTITION_COL``) stays
a distributed DataFrame: it is validated (rejects kept, never dropped),
written once to the work folder, and grouped into targets. Only the target
list -- one row per (table, key column) -- reaches the driver. All groups of
one table are folded into a single purge (their keys are OR-ed), so two
groups can never overwrite each other's result.

The publishing strategy stands for the original variants: ``dynamic`` for
stage-then-append (O2), ``move`` (or ``set_location``) for moving staged
partition folders (O3), ``static`` for per-partition ``INSERT OVERWRITE`` (O4), ``side_impacted``
for rebuilding the impacted partitions into a side folder (O5) and
``side_full`` for the full refresh into a side folder (O6).
"""

from __future__ import annotations

from collections import OrderedDict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.operators.effect import group_manifest
from keysweep.plans.purge import KeySet, PurgeResult, purge_table
from keysweep.session import child_session, new_run_id, work_root
from keysweep.sinks.audit import STATUS_FAILED, audit_row, write_audit
from keysweep.sources.catalog import describe_table, manifest_partition_column
from keysweep.sources.keys import MANIFEST_SCHEMA, manifest_keys, read_manifest, split_manifest


@dataclass
class ManifestResult:
    run_id: str
    results: list[PurgeResult] = field(default_factory=list)
    failures: list[dict] = field(default_factory=list)
    rejects_path: str | None = None
    manifest_path: str | None = None
    n_rejects: int = 0

    def audit(self) -> DataFrame | None:
        frames = [r.audit for r in self.results if r.audit is not None]
        frames += [f["audit"] for f in self.failures if f.get("audit") is not None]
        return reduce(lambda a, b: a.unionByName(b), frames) if frames else None

    def rejects(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.rejects_path)

    def by_table(self) -> dict[str, PurgeResult]:
        return {r.table: r for r in self.results}


def _resolve(name: str, columns: list[str]) -> str | None:
    for c in columns:
        if c.lower() == name.lower():
            return c
    return None


def purge_manifest(spark: SparkSession, manifest: DataFrame | str, *, strategy: str = "auto",
                   work_dir: str | None = None, run_id: str | None = None, audit_dir: str | None = None,
                   parallelism: int = 4, **kwargs) -> ManifestResult:
    """Purge every table named in the manifest; returns one result per table
    (in target order). Up to ``parallelism`` tables are purged at once."""
    label = manifest if isinstance(manifest, str) else None
    m = read_manifest(spark, manifest) if isinstance(manifest, str) else manifest
    run_id = run_id or new_run_id(spark)
    root = (work_dir or work_root(spark)).rstrip("/")
    audit_dir = audit_dir or f"{root}/_AUDIT"
    mdir = f"{root}/_MANIFEST/{run_id}"
    valid, rejects = split_manifest(m.select(*MANIFEST_SCHEMA.fieldNames()))
    valid.write.mode("overwrite").parquet(f"{mdir}/valid")
    rejects.write.mode("overwrite").parquet(f"{mdir}/rejects")
    valid = spark.read.parquet(f"{mdir}/valid")
    out = ManifestResult(run_id=run_id, rejects_path=f"{mdir}/rejects", manifest_path=f"{mdir}/valid",
                         n_rejects=spark.read.parquet(f"{mdir}/rejects").count())

    targets: "OrderedDict[tuple[str, str], list]" = OrderedDict()
    for row in group_manifest(valid).collect():
        # names differ in case only: one table, one purge
        targets.setdefault((row["DATABASE_NAME"].lower(), row["TABLE_NAME"].lower()), []).append(row)

    def one(i: int, db: str, tbl: str, rows: list, session: SparkSession):
        name = f"{db}.{tbl}"
        try:
            info = describe_table(spark, name)
            key_sets, notes = [], []
            for row in rows:
                col = _resolve(row["PK"], info.columns)
                if col is None:
                    raise ValueError(f"{row['PK']!r} is not a column of {name}")
                _, agrees = manifest_partition_column(info, row["PARTITION_COL"])
                if not agrees:
                    notes.append(f"manifest partition column {row['PARTITION_COL']!r} ignored; "
                                 f"catalog has {info.partition_cols}")
                keys = manifest_keys(session.read.parquet(f"{mdir}/valid"), db, tbl, row["PK"]) \
                    .withColumnRenamed(row["PK"], col)
                key_sets.append(KeySet(keys, [col], "tuple", source=label))
            res = purge_table(session, name, key_sets=key_sets, strategy=strategy, work_dir=root,
                              run_id=f"{run_id}-t{i}", audit_dir=audit_dir, input_name=label, **kwargs)
            if notes:
                res.message = "; ".join([res.message] + notes) if res.message else "; ".join(notes)
            return "ok", res
        except Exception as exc:  # one bad target does not stop the others
            audit = write_audit(audit_row(session, {
                "spark_application_id": spark.sparkContext.applicationId, "input_file_name": label,
                "run_id": f"{run_id}-t{i}", "table_name": name, "status": STATUS_FAILED, "strategy": strategy,
                "message": " | ".join(str(exc).splitlines())}), audit_dir)
            return "failed", {"table": name, "error": str(exc), "audit": audit}

    jobs = [(i, db, tbl, rows) for i, ((db, tbl), rows) in enumerate(targets.items())]
    workers = max(1, min(parallelism, len(jobs)))
    if workers == 1:
        outcomes = [one(i, db, tbl, rows, spark) for i, db, tbl, rows in jobs]
    else:
        # Independent tables run as concurrent Spark jobs, each in its own child session.
        with ThreadPoolExecutor(max_workers=workers) as pool:
            futures = [pool.submit(one, i, db, tbl, rows, child_session(spark)) for i, db, tbl, rows in jobs]
            outcomes = [f.result() for f in futures]
    for kind, value in outcomes:
        (out.results if kind == "ok" else out.failures).append(value)
    if workers > 1:
        # Each session caches its own file listing of a table: refresh the caller's view of what changed.
        for r in out.results:
            spark.catalog.refreshTable(r.table)
    return out


def manifest_targets(manifest: DataFrame) -> DataFrame:
    """The target list of a manifest after validation (A8), for inspection."""
    valid, _ = split_manifest(manifest)
    return group_manifest(valid).withColumn("table", F.concat_ws(".", "DATABASE_NAME", "TABLE_NAME"))
