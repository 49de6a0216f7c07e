"""Restore a purge's backup into the live table.

The backup is read with the table's schema, and only rows that are missing
from the live table are put back: a multiset difference (restricted to the
backup's partitions), so restoring twice, or restoring after a purge that
never removed anything, adds no duplicate -- also when keys are not unique.
It is taken by counting: every row has a 128-bit hash of all its columns (maps
by their sorted entries, so a table of any shape can be restored); live rows are
counted by hash in the tasks that read them, only for hashes of the
backup, and of a backed-up row's n copies those beyond the live count are put back. Of live
rows only hashes are shuffled. The rows to restore are staged first, then
appended through the catalog (partitions dropped by the purge come back
registered).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StringType, StructField, StructType

from keysweep.session import new_run_id, work_root
from keysweep.sinks import fs, publish
from keysweep.sinks.observe import observed
from keysweep.sources.catalog import describe_table, scan_partitions
from keysweep.sources.stage import read_backup, read_stage

COPIES = 10_000      # copies of a row written out from one array
RESTORE_SCHEMA = StructType([
    StructField("table_name", StringType()), StructField("backup_dir", StringType()),
    StructField("rows_before", LongType()), StructField("rows_in_backup", LongType()),
    StructField("rows_restored", LongType()), StructField("rows_after", LongType()),
    StructField("status", StringType()),
])


def canonical(value: Column, dtype: DataType) -> Column:
    """``value`` in a form that can be hashed and is equal for equal values: maps become their entries, sorted by key."""
    if isinstance(dtype, MapType):
        entries = F.map_entries(value)
        whole = ArrayType(StructType([StructField("key", dtype.keyType), StructField("value", dtype.valueType)]))
        key = lambda x: canonical(x["key"], dtype.keyType)
        ordered = F.array_sort(F.transform(entries, lambda x: F.struct(F.xxhash64(key(x)).alias("by"), x.alias("entry"))),
                               lambda p, q: F.when(p["by"] < q["by"], -1).when(p["by"] > q["by"], 1).otherwise(0)) \
            if _has_map(dtype.valueType) else None
        if ordered is not None:
            return canonical(F.transform(ordered, lambda p: p["entry"]), whole)
        return F.sort_array(F.transform(entries, lambda x: F.struct(key(x).alias("key"), x["value"].alias("value"))))
    if not _has_map(dtype):
        return value
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda x: canonical(x, dtype.elementType))
    fields = [canonical(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _has_map(dtype: DataType) -> bool:
    if isinstance(dtype, MapType):
        return True
    if isinstance(dtype, StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _has_map(dtype.elementType)
    return False


def with_row_hash(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_h0, _h1``: a 128-bit hash of all columns. NULLs are told from absent values by their places."""
    values = [canonical(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema.fields]
    gaps = F.concat(*[F.when(F.col(f"`{f.name}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for f in rows.schema.fields])
    return rows.select("*", F.xxhash64(*values, gaps).alias("_h0"), F.xxhash64(F.lit(7919), *values[::-1], gaps).alias("_h1"))


def missing_rows(backup: DataFrame, live: DataFrame) -> DataFrame:
    """``backup`` minus ``live`` as multisets (both with the table's columns). Copies are counted, never gathered:
    a row that fills a third of the backup is one row until its missing copies are written out again."""
    ids = ["_h0", "_h1"]
    own = (with_row_hash(backup).groupBy(*ids)
           .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in backup.columns])).alias("_row"), F.count(F.lit(1)).alias("_n")))
    wanted = with_row_hash(backup).select(*ids).distinct()
    counts = with_row_hash(live).select(*ids).join(wanted, ids, "left_semi").groupBy(*ids).agg(F.count(F.lit(1)).alias("_live"))
    short = own.join(counts, ids, "left").withColumn("_n", F.col("_n") - F.coalesce("_live", F.lit(0))).where("_n > 0")
    chunks = short.select("_row", "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPIES})")).alias("_chunk"))
    copies = chunks.select("_row", F.explode(F.expr(f"sequence(1L, least({COPIES}L, _n - _chunk * {COPIES}))")).alias("_copy"))
    return copies.select("_row.*")


def restore_backup(spark: SparkSession, table: str, backup_dir: str, *, work_dir: str | None = None,
                   run_id: str | None = None, delete_backup: bool = True, guard: bool = True,
                   key_cols: list[str] | None = None) -> DataFrame:
    """Put a purge's backup back. ``guard`` (default) restores only rows missing
    from the live table (multiset difference over all columns); with
    ``key_cols`` it restores the backed-up rows of every (partition, key) that
    has no live row at all -- cheaper, as live rows are read by their keys only."""
    info = describe_table(spark, table)
    parts = info.partition_cols
    run_id = run_id or new_run_id(spark)
    root = (work_dir or work_root(spark)).rstrip("/")
    stage_dir = f"{root}/{info.database}/{info.table}/restore_{run_id}"
    before = spark.table(info.name).count()                       # A1
    backup = read_backup(spark, backup_dir, info.schema)          # S10
    in_backup = backup.count()                                    # A11
    rows = backup
    if guard and in_backup:
        if parts:
            specs = [r.asDict() for r in backup.select(*parts).distinct().collect()]
            live = scan_partitions(spark, info.name, specs, parts)
        else:
            live = spark.table(info.name)
        if key_cols:
            on = list(dict.fromkeys([*parts, *key_cols]))
            there = live.select(*[F.col(c).alias(f"_live_{i}") for i, c in enumerate(on)]).distinct()
            same = reduce(lambda a, b: a & b, [backup[c].eqNullSafe(F.col(f"_live_{i}")) for i, c in enumerate(on)])
            rows = backup.join(there, same, "left_anti").select(*info.columns)
        else:
            rows = missing_rows(backup, live.select(*info.columns))
    obs = Observation("restore")
    rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*parts).parquet(stage_dir)
    restored = int(observed(obs, n=0)["n"])
    if restored:
        publish.append(spark, info, read_stage(spark, stage_dir, info.schema))   # W6 / W7
    publish.refresh(spark, info)                                               # W15
    after = spark.table(info.name).count()
    fs.delete(spark, stage_dir)
    # by keys, rows left out may differ from what is live: their backup stays
    if delete_backup and after == before + restored and (not key_cols or restored == in_backup):
        fs.delete(spark, backup_dir)
    status = "DONE" if after == before + restored else "FAILED"
    return spark.createDataFrame([(info.name, backup_dir, before, in_backup, restored, after, status)], RESTORE_SCHEMA)
