"""Key-based purge of one catalog table.

Job plan (each step is one Spark job; only partition specs and counts reach
the driver):

1. **keys** -- the key list is cast to the table's key types once, rejects are
   split off, and the distinct valid keys are written to the run folder. The
   written size bounds the broadcast decision.
2. **effect** -- one column-pruned pass over the key and partition columns
   flags matching rows and aggregates per (partition, found key): it yields
   rows before / deleted per partition, the impacted and emptied partitions,
   the table count and the found keys, all from one small detail table. When
   the key list is too large to broadcast, the table side is pre-aggregated
   by (partition, key) before the shuffle join, which collapses hot keys.
3. **found keys** -- written to the audit's keys side table; they, not the
   requested list, drive the rewrite (often far smaller, so broadcastable).
4. **split** -- one pass over the impacted partitions only (literal specs,
   static pruning) writes every row once: deleted rows become the backup,
   surviving rows the stage. Counts are observed during the write and must
   equal step 2's, otherwise nothing is published.
5. **publish** -- by the chosen strategy, under a journal; emptied
   partitions are dropped and their files deleted; then refresh and a
   partition-pruned re-count of the impacted partitions.

Strategies: ``auto`` (default: ``move`` where a folder rename is atomic, i.e. a partitioned
Parquet table on the same HDFS or file system as the work folder, else ``dynamic``; both keep
the survivors in a stage until the published rows are counted),
``direct`` (backup pass, then one dynamic partition overwrite that reads the table itself; no
stage, so a broken commit can only be detected),
``dynamic`` (split into backup + stage, verify, then dynamic partition
overwrite from the stage; also the non-partitioned path), ``static`` (one ``INSERT OVERWRITE ... PARTITION`` per
partition), ``move`` (staged partition folders renamed into the partitions'
own locations, no second copy), ``files`` (only the files that hold a match are
rewritten, each replaced under its own name by one rename; also for plain tables), ``set_location`` (repoint partitions at the
stage, no second copy), ``pointer`` (survivors written once into a version folder beside the table, then the
catalog is pointed at it: one statement for a plain table, one for each partition else; readers see no gap), ``side_impacted`` / ``side_full`` (survivors of the impacted partitions
/ of the whole table to a side folder; the live table is not changed).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from keysweep.functions.text import KEY_PART_SEPARATOR, key_text
from keysweep.operators.match import MATCH_MODES, KeySpec, flag_candidates, flag_matches, may_match
from keysweep.session import child_session, new_run_id, session_conf, work_root
from keysweep.plans.repair import RepairError, repair_record
from keysweep.sinks import fs, journal, publish
from keysweep.sinks.lease import SECONDS, Lease, LeaseError
from keysweep.sinks.observe import observed
from keysweep.sinks.audit import (STATUS_DONE, STATUS_DRY_RUN, STATUS_FAILED, STATUS_NOOP, STATUS_SIDE,
                                  audit_row, keys_location, write_audit)
from keysweep.sources.catalog import TableInfo, column_refs, describe_table, spec_predicate
from keysweep.sources.files import changed_files, files_fingerprint, folder_of, list_folders, with_file
from keysweep.sources.keys import read_key_list, type_keys
from keysweep.sources.stage import read_stage

STRATEGIES = ("auto", "dynamic", "direct", "static", "move", "files", "set_location", "pointer", "side_impacted", "side_full")
SIDE_STRATEGIES = ("side_impacted", "side_full")
# File systems whose folder rename is one atomic metadata operation.
ATOMIC_RENAME = ("hdfs", "file")
# The hot keys of a shuffle join are broadcast; they may take this much even where key lists may not be.
HOT_KEYS_BYTES = 8 << 20
# Size that compaction on rewrite (W16) packs files to.
TARGET_FILE_BYTES = 128 << 20
# Runs of this driver that are publishing now.
_ACTIVE: set[str] = set()
# Partition column that marks Type-2 history versions; by default only its
# closed versions (value 0) are erased.
ACTIVE_COLUMN = "active"


class PurgeError(RuntimeError):
    def __init__(self, message: str, result: "PurgeResult | None" = None):
        super().__init__(message)
        self.result = result


@dataclass
class KeySet:
    """Keys for one purge: a DataFrame, or the path of a CSV whose header
    names the key columns. Several key sets on one table are OR-ed."""
    keys: DataFrame | str
    key_cols: list[str] | None = None
    match: str = "tuple"
    source: str | None = None


@dataclass
class PreparedKeys:
    index: int
    key_cols: list[str]
    match: str
    path: str
    schema: StructType
    n_input: int
    n_rejected: int
    n_valid: int
    est_bytes: int
    broadcast: bool
    source: str | None

    def df(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


@dataclass
class PurgeResult:
    run_id: str
    table: str
    status: str
    strategy: str
    partition_cols: list[str]
    rows_before: int = 0
    rows_deleted: int = 0
    rows_after: int = 0
    keys_requested: int = 0
    keys_rejected: int = 0
    keys_found: int = 0
    impacted: list[dict] = field(default_factory=list)
    emptied: list[dict] = field(default_factory=list)
    run_dir: str | None = None
    backup_dir: str | None = None
    side_dir: str | None = None
    audit_dir: str | None = None
    found_paths: list[str] = field(default_factory=list)
    key_paths: list[tuple] = field(default_factory=list)
    audit: DataFrame | None = None
    message: str = ""
    timings: dict = field(default_factory=dict)
    plans: dict = field(default_factory=dict)

    def effect(self, spark: SparkSession) -> DataFrame:
        """A7 for the impacted partitions (bounded by the partition count)."""
        fields = [StructField(c, StringType(), True) for c in self.partition_cols]
        fields += [StructField(n, LongType(), True) for n in ("rows_before", "rows_deleted", "rows_after")]
        rows = [tuple(None if r["spec"][c] is None else str(r["spec"][c]) for c in self.partition_cols)
                + (r["rows_before"], r["rows_deleted"], r["rows_before"] - r["rows_deleted"]) for r in self.impacted]
        return spark.createDataFrame(rows, StructType(fields))

    def found_keys(self, spark: SparkSession, index: int = 0) -> DataFrame:
        return spark.read.parquet(self.found_paths[index])

    def requested_keys(self, spark: SparkSession, index: int = 0) -> DataFrame:
        path, schema = self.key_paths[index]
        return spark.read.schema(schema).parquet(path)

    def not_found(self, spark: SparkSession, index: int = 0) -> DataFrame:
        """Requested keys with no row in the table (within scope)."""
        req = self.requested_keys(spark, index)
        if not self.found_paths:
            return req
        found = self.found_keys(spark, index).select(*req.columns)
        return req.join(found, on=req.columns, how="left_anti")

    def forget(self, spark: SparkSession) -> None:
        """Delete the run folder with the requested keys and rejects (they name erased persons too). Afterwards
        ``requested_keys``, ``not_found`` and ``rejects`` have nothing to read; backup, audit and table stay. The
        stage of ``set_location`` is table data, so its run folder keeps that."""
        if self.status == STATUS_FAILED:
            raise PurgeError("a failed run keeps its folder for repair", self)
        for path, _ in self.key_paths:
            fs.delete(spark, path)
        for i in range(len(self.key_paths)):
            fs.delete(spark, f"{self.run_dir}/rejects_{i}")
        if self.strategy != "set_location":
            fs.delete(spark, self.run_dir)

    def rejects(self, spark: SparkSession, index: int = 0) -> DataFrame:
        """Key lines that were blank or did not cast to the key type, as text."""
        schema = StructType([StructField("key_text", StringType(), True)])
        return read_stage(spark, f"{self.run_dir}/rejects_{index}", schema)


def broadcast_limit(spark: SparkSession, explicit: int | None) -> int:
    """Largest key list (estimated in-memory bytes) joined by broadcast."""
    if explicit is not None:
        return int(explicit)
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def resolve_scope(scope, info: TableInfo) -> Column | None:
    """``"auto"`` erases only closed versions (``active = 0``) when the table
    is partitioned by ``active``; a Column is used as given; None = no scope."""
    if isinstance(scope, str):
        if scope != "auto":
            raise ValueError("scope must be 'auto', None or a Column")
        if ACTIVE_COLUMN in info.partition_cols:
            return F.col(ACTIVE_COLUMN).cast("string") == F.lit("0")
        return None
    return scope


def _fixed_width(dtype) -> int:
    return 8 if not isinstance(dtype, StringType) else 0


def prepare_keys(spark: SparkSession, ks: KeySet, index: int, info: TableInfo, run_dir: str,
                 limit: int) -> PreparedKeys:
    """Step 1: type, split rejects, de-duplicate and materialise one key set."""
    source = ks.source
    if isinstance(ks.keys, str):
        source = source or ks.keys
        raw = read_key_list(spark, ks.keys)
    else:
        raw = ks.keys
    by_lower = {c.lower(): c for c in info.columns}
    wanted = list(ks.key_cols or raw.columns)
    missing = [c for c in wanted if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"key columns {missing} are not columns of {info.name}")
    kc = [by_lower[c.lower()] for c in wanted]           # the table's spelling (names are case-insensitive)
    raw_cols = {c.lower(): c for c in raw.columns}
    raw = raw.select(*[F.col(raw_cols[c.lower()]).alias(c) for c in kc])
    if ks.match not in MATCH_MODES:
        raise ValueError(f"match must be one of {MATCH_MODES}")
    typed0 = type_keys(raw, kc, {c: info.dtype(c) for c in kc})
    obs_in = Observation(f"keys_in_{index}")
    typed = typed0.observe(obs_in, F.count(F.lit(1)).alias("n"), F.count_if(~F.col("_ok")).alias("bad"))
    str_cols = [c for c in kc if isinstance(info.dtype(c), StringType)]
    obs = Observation(f"keys_{index}")
    valid = typed.where(F.col("_ok")).select(*kc).distinct()
    valid = valid.observe(obs, F.count(F.lit(1)).alias("n"),
                          *([F.sum(sum(F.octet_length(c) for c in str_cols)).alias("chars")] if str_cols else
                            [F.lit(0).alias("chars")]))
    path = f"{run_dir}/keys_{index}"
    valid.write.mode("overwrite").parquet(path)          # one pass over the input
    got = observed(obs_in, n=0, bad=0)
    if int(got["bad"]):                                  # second pass only when there are rejects
        typed0.where(~F.col("_ok")).select(F.col("_raw").alias("key_text")).write.mode("overwrite") \
            .parquet(f"{run_dir}/rejects_{index}")
    out = observed(obs, n=0, chars=0)
    n_valid = int(out["n"])
    est = n_valid * (16 + sum(_fixed_width(info.dtype(c)) for c in kc) + 8 * len(str_cols)) + int(out["chars"] or 0)
    schema = StructType([StructField(c, info.dtype(c), True) for c in kc])
    return PreparedKeys(index, kc, ks.match, path, schema, int(got["n"]), int(got["bad"]), n_valid, est,
                        est <= limit, source)


def _key_sets(keys, key_cols, key_sets, match) -> list[KeySet]:
    sets = list(key_sets or [])
    if keys is not None:
        sets.insert(0, KeySet(keys, key_cols, match))
    if not sets:
        raise ValueError("no keys given")
    return sets


def _plan(df: DataFrame) -> str:
    """The formatted physical plan of a DataFrame (for ``explain=True``)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _spec(row, parts: list[str]) -> dict:
    return {c: row[c] for c in parts}


def _auto_strategy(spark: SparkSession, info: TableInfo, root: str) -> str:
    """``move`` writes the survivors once and swaps folders; it needs Parquet and a rename that is atomic."""
    if not info.partition_cols or (info.provider or "").lower() != "parquet" or not info.location:
        return "dynamic"
    here, there = (fs.file_system(spark, p) for p in (root, info.location))
    return "move" if here == there and here[0] in ATOMIC_RENAME else "dynamic"


def _recover(spark: SparkSession, info: TableInfo, base: str) -> None:
    """Finish or roll back earlier publishes of this driver that broke off; those of other
    drivers may still run, so they are left to ``repair_publish``."""
    records = journal.unfinished(spark, base)
    if not records:
        return
    for record in records:
        run, app = record["run_id"], record["app"]
        if run in _ACTIVE or app != spark.sparkContext.applicationId:
            raise PurgeError(f"publish {run} of {info.name} by application {app} is not finished; "
                             "when it no longer runs, call repair_publish first")
        try:
            repair_record(spark, info, base, record)
        except RepairError as exc:
            raise PurgeError(str(exc)) from exc


def _begin(spark: SparkSession, info: TableInfo, base: str, res: "PurgeResult", stage: str | None, **more) -> None:
    """Journal what a publish is about to do (before the first live file is touched)."""
    impacted = [{"spec": r["spec"], "before": r["rows_before"], "kept": r["rows_before"] - r["rows_deleted"]} for r in res.impacted] \
        if info.partition_cols else [{"spec": {}, "before": res.rows_before, "kept": res.rows_before - res.rows_deleted}]
    _ACTIVE.add(res.run_id)
    journal.begin(spark, base, {"run_id": res.run_id, "app": spark.sparkContext.applicationId, "strategy": res.strategy,
                                "stage": stage, "backup": res.backup_dir, "impacted": impacted, **more})


def purge_table(spark: SparkSession, table: str, keys: DataFrame | str | None = None, *,
                key_cols: list[str] | None = None, key_sets: list[KeySet] | None = None,
                match: str = "tuple", scope: Column | str | None = "auto", strategy: str = "auto",
                work_dir: str | None = None, run_id: str | None = None, dry_run: bool = False,
                backup: bool = True, audit_dir: str | None = None, side_dir: str | None = None,
                input_name: str | None = None, broadcast_max_bytes: int | None = None,
                verify: bool = True, rebalance: bool | None = None,
                hot_key_rows: int | None = None, compact: bool | None = None,
                target_file_bytes: int = TARGET_FILE_BYTES, lease_wait: float = 60.0,
                lease_seconds: float = SECONDS, explain: bool = False) -> PurgeResult:
    """O1: delete from ``table`` every row whose key is listed (see module doc).

    ``compact`` (W16) deals the rewritten rows into files of about ``target_file_bytes``, counted for each
    partition from the sizes of its files; by default where its files are more than twice as many.
    Publishing holds the table's lease (``sinks/lease.py``), renewed within ``lease_seconds``; another run's is
    waited for up to ``lease_wait`` seconds.

    Runs in a private child session (the caller's settings copied), so the
    session-scoped settings and temporary views a publish needs never touch
    the caller's session; the caller's view of the table is refreshed at the end.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    caller, spark = spark, child_session(spark)
    spark.catalog.refreshTable(table)              # start from the table's current files
    info = describe_table(spark, table)
    parts = info.partition_cols
    run_id = run_id or new_run_id(spark)
    root = (work_dir or work_root(spark)).rstrip("/")
    if strategy == "auto":
        strategy = _auto_strategy(spark, info, root)
    base = f"{root}/{info.database}/{info.table}"
    run_dir = f"{base}/run_{run_id}"
    audit_dir = audit_dir or f"{root}/_AUDIT"
    res = PurgeResult(run_id=run_id, table=info.name, status=STATUS_FAILED, strategy=strategy,
                      partition_cols=parts, run_dir=run_dir, audit_dir=audit_dir)
    if strategy in ("move", "files", *publish.STAGE_STAYS) and (info.provider or "").lower() != "parquet":
        raise ValueError(f"{strategy} puts Parquet folders into the table, but {info.name} is {info.provider}; use dynamic or direct")
    if not dry_run and strategy not in SIDE_STRATEGIES:
        _recover(spark, info, base)
    clock = [time.perf_counter()]

    def lap(step: str) -> None:
        now = time.perf_counter()
        res.timings[step] = round(now - clock[0], 3)
        clock[0] = now

    sets = _key_sets(keys, key_cols, key_sets, match)
    scope_col = resolve_scope(scope, info)
    limit = broadcast_limit(spark, broadcast_max_bytes)

    # Step 1: keys.
    prepared = [prepare_keys(spark, ks, i, info, run_dir, limit) for i, ks in enumerate(sets)]
    res.keys_requested = sum(p.n_input for p in prepared)
    res.keys_rejected = sum(p.n_rejected for p in prepared)
    res.key_paths = [(p.path, p.schema) for p in prepared]
    lap("keys")
    sources = [p.source for p in prepared if p.source]
    input_label = input_name or (", ".join(sources) if sources else None)

    # Step 2: effect detail, one pass over key + partition columns.
    all_keys = []
    for p in prepared:
        all_keys += [c for c in p.key_cols if c not in all_keys and c not in parts]
    in_scope = F.lit(True) if scope_col is None else F.coalesce(scope_col, F.lit(False))
    source = spark.table(info.name)
    # A scope over partition columns only (e.g. active = 0) prunes the effect scan itself.
    prune = bool(scope_col is not None and parts and column_refs(source, scope_col) <= set(parts))
    if prune:
        source = source.where(in_scope)
    slim = with_file(source).select(*parts, *all_keys, in_scope.alias("_in_scope"), "_file", "_size", "_mtime")
    of_file = [F.max("_size").alias("_size"), F.max("_mtime").alias("_mtime")]
    specs = [KeySpec(p.df(spark), p.key_cols, p.match, p.broadcast, distinct=False) for p in prepared]
    judged = None
    if all(p.broadcast for p in prepared):
        base_df = slim.withColumn("_n", F.lit(1).cast("long"))
    else:
        judged = may_match(slim, specs, [p.n_valid for p in prepared])
        base_df = (slim if judged is None else judged.where("_may")).groupBy(*parts, *all_keys, "_in_scope", "_file").agg(F.count(F.lit(1)).alias("_n"), *of_file)
    flagged = flag_matches(base_df, specs, scope=F.col("_in_scope"))
    hit_cols = [f"_hit_{i}" for i in range(len(prepared))]
    detail = (flagged.groupBy(*parts, "_file", "_hit", *hit_cols, *[F.when(F.col("_hit"), F.col(k)).alias(k) for k in all_keys])
              .agg(F.sum("_n").alias("_n"), *of_file))
    if judged is not None:      # rows that match nothing are only counted, not shuffled with their keys
        others = judged.where("not _may").groupBy(*parts, "_file").agg(F.count(F.lit(1)).alias("_n"), *of_file)
        rest = {"_hit": F.lit(False), **{c: F.lit(False) for c in hit_cols}, **{c: F.lit(None).cast(info.dtype(c)) for c in all_keys}}
        detail = detail.unionByName(others.select("*", *[value.alias(c) for c, value in rest.items()]))
    detail_path = f"{run_dir}/effect"
    if explain:
        res.plans["effect"] = _plan(detail)
    detail.write.mode("overwrite").parquet(detail_path)
    detail = spark.read.parquet(detail_path)
    lap("effect")

    counts = [F.sum("_n").alias("rows_before"),
              F.sum(F.when(F.col("_hit"), F.col("_n")).otherwise(0)).alias("rows_deleted")]
    if parts:   # impacted partitions and the table total in one job
        rows = (detail.groupingSets([parts, []], *parts).agg(*counts, F.grouping_id().alias("_gid"))
                .where((F.col("_gid") != 0) | (F.col("rows_deleted") > 0)).collect())
        impacted_rows = [r for r in rows if r["_gid"] == 0]
        totals = next((r for r in rows if r["_gid"] != 0), None)
    else:
        totals = detail.agg(*counts).first()
        impacted_rows = [totals] if totals and (totals["rows_deleted"] or 0) > 0 else []
    res.rows_before = int((totals["rows_before"] if totals else 0) or 0)
    if prune:   # rows of the partitions outside the scope: a count answered from file footers
        res.rows_before += spark.table(info.name).where(~in_scope).count()
    res.rows_deleted = int((totals["rows_deleted"] if totals else 0) or 0)
    res.rows_after = res.rows_before - res.rows_deleted
    res.impacted = [{"spec": _spec(r, parts), "rows_before": int(r["rows_before"]),
                     "rows_deleted": int(r["rows_deleted"])} for r in impacted_rows]
    res.emptied = [r["spec"] for r in res.impacted if r["rows_before"] == r["rows_deleted"]]
    impacted_specs = [r["spec"] for r in res.impacted]
    surviving_specs = [r["spec"] for r in res.impacted if r["rows_before"] > r["rows_deleted"]]
    lap("effect_collect")

    # Step 3: found keys -> audit keys side table.
    found_specs, found_counts = [], []
    scope_rows = sum(r["rows_before"] for r in res.impacted) if parts else res.rows_before
    shuffle_parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # A key is hot when its rows would overload one reducer of the shuffle join.
    hot_rows = hot_key_rows if hot_key_rows is not None else max(1, scope_rows // (2 * shuffle_parts))
    for p in prepared:
        loc = keys_location(audit_dir, run_id, p.index)
        found = (detail.where(F.col(f"_hit_{p.index}")).groupBy(*p.key_cols)
                 .agg(F.sum("_n").cast("bigint").alias("rows_deleted"))
                 .withColumn("key_text", key_text(*p.key_cols))
                 .withColumn("key_columns", F.lit(KEY_PART_SEPARATOR.join(p.key_cols))))
        obs = Observation(f"found_{p.index}")
        found.observe(obs, F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("rows_deleted") >= hot_rows).alias("hot")).write.mode("overwrite").parquet(loc)
        got_f = observed(obs, n=0, hot=0)
        n_found, n_hot = int(got_f["n"]), int(got_f["hot"])
        res.keys_found += n_found
        res.found_paths.append(loc)
        fdf = spark.read.parquet(loc)
        per_key = 16 + 8 * len(p.key_cols) + p.est_bytes // max(p.n_valid, 1)
        bcast = n_found * per_key <= limit
        hot = None
        if n_hot and not bcast:
            # Hot keys are broadcast, so their number must fit a bound of its own (the key limit may be 0): by default there are at most
            # scope_rows / hot_rows <= 2 x shuffle partitions of them; if an explicit threshold makes
            # more, only the heaviest that fit are split off (top-k) -- the others stay in the shuffle join.
            fit = max(limit, HOT_KEYS_BYTES) // per_key
            cut = hot_rows
            if n_hot > fit:
                top = fdf.orderBy(F.col("rows_deleted").desc()).limit(fit + 1).select("rows_deleted").collect()
                cut = (top[-1][0] + 1) if len(top) > fit else hot_rows
            buckets = F.ceil(F.col("rows_deleted") / F.lit(max(hot_rows, 1))).cast("bigint")
            hot = fdf.where(F.col("rows_deleted") >= cut).select(*p.key_cols, buckets.alias("_buckets")) if fit else None
        found_specs.append(KeySpec(fdf.select(*p.key_cols), p.key_cols, "tuple", bcast, distinct=False, hot=hot))
        found_counts.append(n_found)
    lap("found_keys")

    def finish(status: str, message: str = "") -> PurgeResult:
        lap("before_audit")
        res.status, res.message = status, message
        res.audit = write_audit(audit_row(spark, {
            "spark_application_id": spark.sparkContext.applicationId,
            "input_file_name": input_label,
            "total_records_before_deletion": res.rows_before,
            "total_records_deleted": res.rows_deleted if status in (STATUS_DONE, STATUS_SIDE) else 0,
            "deleted_records_directory_location": res.backup_dir,
            "deleted_keys_and_values": f"{audit_dir}/keys/{run_id}",
            "run_id": run_id, "table_name": info.name, "status": status, "strategy": strategy,
            "keys_requested": res.keys_requested, "keys_rejected": res.keys_rejected,
            "keys_found": res.keys_found, "partitions_impacted": len(res.impacted),
            "partitions_emptied": len(res.emptied),
            "total_records_after_deletion": res.rows_after if status == STATUS_DONE else res.rows_before,
            "deleted_keys_location": f"{audit_dir}/keys/{run_id}",
            "message": message or (f"{res.rows_deleted} rows would be deleted" if status == STATUS_DRY_RUN else ""),
        }), audit_dir)
        caller.catalog.refreshTable(info.name)
        if status != STATUS_FAILED:                # W14: what only this run needed; a failed one keeps all for repair
            for name in ("effect", "files", "swaps", "replaced"):
                fs.delete(spark, f"{run_dir}/{name}")
        lap("audit")
        return res

    if res.rows_deleted == 0:
        res.rows_after = res.rows_before
        return finish(STATUS_NOOP, "no listed key found in the table")
    if dry_run:
        return finish(STATUS_DRY_RUN)

    # Files of the impacted partitions with their rows (from the effect pass), and the partitions' folders.
    per_file = detail.groupBy(*parts, "_file").agg(
        F.sum("_n").alias("rows_before"), F.sum(F.when(F.col("_hit"), F.col("_n")).otherwise(0)).alias("rows_deleted"), *of_file)
    if parts:
        per_file = per_file.where(spec_predicate(impacted_specs, parts))
    per_file.write.mode("overwrite").parquet(f"{run_dir}/files")
    files = spark.read.parquet(f"{run_dir}/files")
    kept_bytes = F.col("_size") * (F.col("rows_before") - F.col("rows_deleted")) / F.col("rows_before")
    folder_rows = (files.groupBy(*parts, folder_of(F.col("_file")).alias("_folder"))
                   .agg(F.count(F.lit(1)).alias("files"), F.sum(kept_bytes).alias("bytes")).collect())   # bounded by partitions
    known: dict = {}
    for r in folder_rows:
        known.setdefault(tuple(r[c] for c in parts), []).append(fs.from_uri(spark, r["_folder"]))
    seen_folders = sorted({f for found in known.values() for f in found})
    known = {k: v[0] for k, v in known.items() if len(v) == 1}
    bins = _bins(spark, info, folder_rows, target_file_bytes, compact, limit) if strategy not in ("files", "direct", "side_full") else None
    lap("files")

    before_fp = files_fingerprint(files)

    def unchanged() -> bool:
        """Optimistic concurrency: the impacted partitions still hold exactly the files the effect pass read."""
        return files_fingerprint(seen_folders, spark) == before_fp or changed_files(spark, files, seen_folders) == 0

    # Step 4: one pass over the impacted partitions (or the whole table).
    table_df = spark.table(info.name)
    if parts and strategy != "side_full":
        source = table_df.where(spec_predicate(impacted_specs, parts))
    else:
        source = table_df
    any_shuffle = not all(s.broadcast for s in found_specs)
    expected_kept = sum(r["rows_before"] - r["rows_deleted"] for r in res.impacted)
    by_file = strategy == "files"
    reading: dict = {}
    if by_file:
        source, reading, stage_rows = _matched_file_rows(source, files)
    want_rebalance = not by_file and (bool(rebalance) if rebalance is not None else (any_shuffle and bool(parts)))
    rewritten, rebalanced = None, want_rebalance
    if any_shuffle and strategy != "direct":
        # rows that match nothing are written by the task that reads them, so only the others are put together by REBALANCE
        few = want_rebalance and not rebalance and bins is None
        rewritten = flag_candidates(source, found_specs, found_counts, scope_col, ["_hit", *parts] if few else None)
        rebalanced = want_rebalance and (rewritten is None or not few)
    if rewritten is None:
        rewritten = flag_matches(source, found_specs, scope_col)
    if by_file:
        if any_shuffle:      # else every file is read, and so written, by one task
            rewritten = rewritten.repartition(max(1, stage_rows["files"]), "_file")
        rewritten = rewritten.withColumn(publish.OF_FILE, F.when(~F.col("_hit"), F.md5("_file")))
    if bins is not None:
        rewritten = publish.into_bins(rewritten, *bins)

    if strategy in SIDE_STRATEGIES:
        res.side_dir = side_dir or f"{base}/side_{run_id}"
        out = rewritten.where(~F.col("_hit")).select(*info.columns)
        if bins is None and rebalanced:
            out = out.hint("rebalance", *parts)
        obs = Observation("side")                 # after the last exchange: exact (see write_split)
        out = out.observe(obs, F.count(F.lit(1)).alias("n"))
        with session_conf(spark, **publish.UNSORTED):
            out.write.mode("overwrite").partitionBy(*parts).parquet(res.side_dir)
        got = {"d": res.rows_deleted, "n": res.rows_deleted + int(observed(obs, n=0)["n"])}
        want = res.rows_after if (strategy == "side_full" or not parts) else expected_kept
        if int(got["d"]) != res.rows_deleted or int(got["n"]) - int(got["d"]) != want:
            return finish(STATUS_FAILED, f"side copy counts {got} differ from the effect ({res.rows_deleted} deleted)")
        return finish(STATUS_SIDE, f"survivors written to {res.side_dir}")

    split = publish.version_folder(info, run_id) if strategy == "pointer" else f"{run_dir}/split"
    lease = Lease(spark, base, run_id, lease_seconds)
    if strategy == "direct" and parts:
        try:
            lease.take(lease_wait)
        except LeaseError as exc:
            res.rows_after = res.rows_before
            return finish(STATUS_FAILED, f"{exc}; nothing published")
        try:
            return _direct(spark, info, res, source, found_specs, scope_col, impacted_specs, expected_kept,
                           unchanged, known, lease, backup, base, run_id, want_rebalance, explain, lap, finish)
        finally:
            lease.release()
    if explain:
        res.plans["rewrite"] = _plan(rewritten)
    with session_conf(spark, **reading):
        got = publish.write_split(rewritten, split, info, rebalance=rebalanced and bins is None)
    lap("split_write")
    want_all = expected_kept if parts else res.rows_after
    want_kept = stage_rows["kept"] if by_file else want_all
    if int(got["d"]) != res.rows_deleted or int(got["n"]) - int(got["d"]) != want_kept:
        publish.cleanup(spark, split)
        res.rows_after = res.rows_before
        return finish(STATUS_FAILED, f"rewrite counts {dict(got)} differ from the effect "
                                     f"({res.rows_deleted} deleted, {want_kept} kept): table changed, nothing published")

    stage_dir, swaps = publish.stage_path(split), f"{run_dir}/swaps"

    def publishing() -> PurgeResult:
        """From the look at the live files to the re-count, under the table's lease."""
        problem = None if unchanged() else "impacted partitions changed while the purge ran"
        if by_file and problem is None:
            problem = _write_swaps(spark, files, stage_dir, swaps, parts, res.emptied)
        if problem:
            publish.cleanup(spark, split)
            res.rows_after = res.rows_before
            return finish(STATUS_FAILED, f"{problem}; nothing published")
        if backup:
            res.backup_dir = f"{base}/_BACKUP/backup_{run_id}"
            if fs.exists(spark, res.backup_dir) or not fs.rename(spark, publish.deleted_path(split, by_file), res.backup_dir):
                publish.cleanup(spark, split)
                res.rows_after = res.rows_before
                return finish(STATUS_FAILED, f"no backup could be put at {res.backup_dir}; nothing published")
        stage = read_stage(spark, stage_dir, info.schema) if want_kept > 0 and not by_file else None

        # Step 5: publish.
        trash, replaced = f"{run_dir}/replaced", []
        old = publish.partition_locations(spark, info, surviving_specs, known) if strategy in publish.STAGE_STAYS and parts else []
        emptied_dirs = publish.partition_locations(spark, info, res.emptied, known) if parts else []
        try:
            _begin(spark, info, base, res, stage_dir, trash=trash, old=old, swaps=swaps, files=f"{run_dir}/files", emptied_dirs=emptied_dirs)
            if by_file:
                publish.publish_files(spark, spark.read.parquet(swaps), lease)
            elif strategy == "pointer":
                replaced = publish.publish_pointer(spark, info, stage_dir, surviving_specs, known, lease)
            elif strategy == "dynamic" or not parts:
                lease.check()
                publish.publish_dynamic(spark, info, stage)
            elif strategy == "static":
                lease.check()
                publish.publish_static(spark, info, stage, surviving_specs)
            elif strategy == "set_location":
                replaced = publish.publish_set_location(spark, info, stage_dir, surviving_specs, known, lease)
            elif strategy == "move":
                publish.publish_move(spark, info, stage_dir, surviving_specs, trash, known=known, lease=lease)
                replaced = [trash]
            lap("publish")
            if parts:
                publish.drop_emptied(spark, info, res.emptied, known)
            publish.refresh(spark, info)
            lap("drop_emptied")
        except Exception as exc:  # the journal, stage and backup stay: a rerun repairs the publish
            _ACTIVE.discard(run_id)
            finish(STATUS_FAILED, f"publish failed: {exc}")
            raise PurgeError(f"publish of {info.name} failed; stage {stage_dir} and backup {res.backup_dir} kept",
                             res) from exc

        if verify:
            now = publish.count_partitions(spark, info, impacted_specs if parts else None)
            if now != want_all:
                _ACTIVE.discard(run_id)
                finish(STATUS_FAILED, f"after publish the impacted partitions hold {now} rows, expected {want_all}")
                raise PurgeError(f"verification of {info.name} failed", res)
            lap("verify")
        for path in replaced:                          # the replaced folders hold the erased rows
            publish.remove_folder(spark, path)
        if strategy == "pointer" and not parts:
            publish.remove_files(spark, files)
        if not backup:
            fs.delete(spark, publish.deleted_path(split))
        if strategy not in publish.STAGE_STAYS:
            publish.cleanup(spark, split)
        journal.end(spark, base, run_id)
        _ACTIVE.discard(run_id)
        return finish(STATUS_DONE)

    try:
        lease.take(lease_wait)
    except LeaseError as exc:
        publish.cleanup(spark, split)
        res.rows_after = res.rows_before
        return finish(STATUS_FAILED, f"{exc}; nothing published")
    try:
        return publishing()
    finally:
        lease.release()


def _bins(spark: SparkSession, info: TableInfo, rows: list, target: int, compact: bool | None, limit: int) -> tuple | None:
    """How many files each impacted partition should have, from the bytes that stay of its present ones:
    (bins, partition columns, number of bins, whether the bins fit a broadcast); None to leave files as they fall."""
    parts = info.partition_cols
    if compact is False:
        return None
    found: dict = {}
    for r in rows:
        n, size = found.get(tuple(r[c] for c in parts), (0, 0.0))
        found[tuple(r[c] for c in parts)] = n + r["files"], size + float(r["bytes"] or 0)
    wanted = {k: max(1, -(-int(size) // target)) for k, (_, size) in found.items()}
    total = sum(wanted.values())
    if compact is None and sum(n for n, _ in found.values()) <= 2 * total:
        return None
    first, table = 0, []
    for k, n in wanted.items():
        table.append((*k, first, n))
        first += n
    schema = StructType([*[StructField(c, info.dtype(c), True) for c in parts], StructField("_first", LongType()), StructField("_bins", LongType())])
    return spark.createDataFrame(table, schema), parts, total, len(table) * (64 + 32 * len(parts)) <= max(limit, HOT_KEYS_BYTES)


def _matched_file_rows(source: DataFrame, files: DataFrame) -> tuple[DataFrame, dict, dict]:
    """Rows of the files that hold a match, the settings under which one task reads a file whole, and what the files hold.
    The filter is on file metadata, so other files are pruned from the listing and never opened."""
    hit = files.where(F.col("rows_deleted") > 0)
    paths = [r[0] for r in hit.select("_file").collect()]          # metadata: bounded by the number of files
    sums = hit.agg(F.max("_size").alias("largest"), F.sum("_size").alias("size"),
                   F.sum(F.col("rows_before") - F.col("rows_deleted")).alias("kept")).first()
    rows = with_file(source.where(F.col("_metadata.file_path").isin(paths)))
    spark = source.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    # a task reads whole files: at least the largest one, else as much as keeps every core busy
    share = (int(sums["size"]) + len(paths) * conf.filesOpenCostInBytes()) // spark.sparkContext.defaultParallelism + 1
    most = max(int(sums["largest"]), min(conf.filesMaxPartitionBytes(), share))
    reading = {"spark.sql.files.maxPartitionBytes": str(most), "spark.sql.files.minPartitionNum": "1"}
    return rows, reading, {"files": len(paths), "kept": int(sums["kept"])}


def _write_swaps(spark: SparkSession, files: DataFrame, stage_dir: str, path: str, parts: list[str], emptied: list[dict]) -> str | None:
    """Which staged file replaces which file of the table (written: ``file``, ``staged``; NULL for a file without a row left).
    Files of partitions that are dropped whole are left out. A text says what is wrong."""
    staged = list_folders(spark, [stage_dir]).select(F.regexp_extract("file_path", f"/{publish.OF_FILE}=([0-9a-f]{{32}})/", 1).alias("_of"),
                                                     F.col("file_path").alias("staged"))
    hit = files.where(F.col("rows_deleted") > 0)
    if parts and emptied:
        hit = hit.where(~F.coalesce(spec_predicate(emptied, parts), F.lit(False)))
    joined = hit.join(staged, F.md5("_file") == F.col("_of"), "left")
    joined.select(F.col("_file").alias("file"), (F.col("rows_before") > F.col("rows_deleted")).alias("stays"), "staged") \
        .write.mode("overwrite").parquet(path)
    wrong = (spark.read.parquet(path).groupBy("file").agg(F.count("staged").alias("n"), F.first("stays").alias("stays"))
             .where(F.col("n") != F.col("stays").cast("int")).count())
    return f"{wrong} files were not rewritten to one file each" if wrong else None


def _direct(spark, info: TableInfo, res: PurgeResult, source: DataFrame, found_specs, scope_col, specs,
            expected_kept: int, unchanged, known: dict, lease: Lease, backup: bool, base: str, run_id: str, rebalance: bool, explain: bool,
            lap, finish) -> PurgeResult:
    """``strategy="direct"``: survivors are written once, straight into the table.

    1. backup pass: the matched rows of the impacted partitions are written to
       the backup folder and counted (must equal the effect pass) -- nothing
       live has changed yet; skipped with ``backup=False``;
    2. concurrency check (file fingerprint of the impacted partitions);
    3. one dynamic partition overwrite reads the impacted partitions, drops the
       matched rows and replaces those partitions at job commit (Spark writes
       to a staging folder first, so reading the target is allowed). A
       failure before commit leaves the table unchanged.
    """
    parts = info.partition_cols
    if backup:
        res.backup_dir = f"{base}/_BACKUP/backup_{run_id}"
        matched = flag_matches(source, found_specs, scope_col).where(F.col("_hit")).select(*info.columns)
        if rebalance:
            matched = matched.hint("rebalance", *parts)
        obs = Observation("backup")
        matched = matched.observe(obs, F.count(F.lit(1)).alias("d"))
        with session_conf(spark, **publish.UNSORTED):
            matched.write.mode("errorifexists").partitionBy(*parts).parquet(res.backup_dir)
        lap("backup_write")
        n_backup = int(observed(obs, d=0)["d"])
        if n_backup != res.rows_deleted:
            fs.delete(spark, res.backup_dir)
            res.backup_dir, res.rows_after = None, res.rows_before
            return finish(STATUS_FAILED, f"backup holds {n_backup} rows, the effect found {res.rows_deleted}: "
                                         "table changed, nothing published")
    if not unchanged():
        res.rows_after = res.rows_before
        return finish(STATUS_FAILED, "impacted partitions changed while the purge ran; nothing published")
    kept = flag_matches(spark.table(info.name).where(spec_predicate(specs, parts)), found_specs, scope_col) \
        .where(~F.col("_hit")).select(*info.columns)
    if rebalance:
        kept = kept.hint("rebalance", *parts)
    if explain:
        res.plans["rewrite"] = _plan(kept)
    obs_k = Observation("kept")
    kept = kept.observe(obs_k, F.count(F.lit(1)).alias("n"))
    try:
        _begin(spark, info, base, res, None)
        lease.check()
        publish.publish_dynamic(spark, info, kept)
        lap("publish")
        emptied = [r["spec"] for r in res.impacted if r["rows_before"] == r["rows_deleted"]]
        publish.drop_emptied(spark, info, emptied, known)
        publish.refresh(spark, info)
    except Exception as exc:
        _ACTIVE.discard(run_id)
        finish(STATUS_FAILED, f"publish failed: {exc}")
        raise PurgeError(f"direct publish of {info.name} failed; backup {res.backup_dir} kept", res) from exc
    written = int(observed(obs_k, n=0)["n"])
    now = publish.count_partitions(spark, info, specs)
    lap("verify")
    _ACTIVE.discard(run_id)
    if written != expected_kept or now != expected_kept:
        res.rows_after = res.rows_before - (sum(r["rows_before"] for r in res.impacted) - now)
        return finish(STATUS_FAILED, f"impacted partitions hold {now} rows after publish ({written} written), "
                                     f"expected {expected_kept}: the table changed during the purge")
    journal.end(spark, base, run_id)
    return finish(STATUS_DONE)


def dry_run(spark: SparkSession, table: str, keys=None, **kwargs) -> PurgeResult:
    """Counts only -- before, keys found, rows to delete, impacted partitions."""
    kwargs["dry_run"] = True
    return purge_table(spark, table, keys, **kwargs)
