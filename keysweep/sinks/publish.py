"""Publishing a purge through the catalog.

Order of a safe rewrite (nothing live is touched before the new data is
complete and counted):

1. one pass over the impacted partitions writes every row once, split into
   ``_deleted=true`` (the backup) and ``_deleted=false`` (the stage);
2. the stage is re-read with the table schema and swapped in -- per partition,
   through the catalog, so the metastore and the files always agree;
3. partitions that lost every row are dropped from the catalog and their folders deleted;
4. the table is refreshed and the impacted partitions re-counted; only then are replaced
   folders, the stage and the publish journal removed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.text import NULL_PARTITION_DIR, partition_path, partition_spec_sql, quote_ident, sql_literal
from keysweep.session import session_conf
from keysweep.sinks import fs
from keysweep.sinks.observe import observed
from keysweep.sources.catalog import TableInfo, spec_predicate

DELETED = "_deleted"
OF_FILE = "_of_file"
VERSIONS = "__versions"
STAGE_STAYS = ("set_location", "pointer")       # the stage becomes table data
# A task keeps this many partitions' files open and sorts its rows only where it meets more: else Spark sorts every row
# of a partitioned write, and a task's memory and spill grow with the rows it writes.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "16"}
DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic", **UNSORTED}


def into_bins(rows: DataFrame, bins: DataFrame, partition_cols: list[str], total: int, broadcast: bool) -> DataFrame:
    """Deal rows into the bins of their partition (``bins``: partition, ``_first``, ``_bins``), a task for each bin.

    A row's bin comes from a hash of its values, so a task that runs again writes the same rows; with
    ``repartitionById`` no two bins share a task, so a partition gets at most ``_bins`` files, and a
    partition of any size is spread over as many tasks as its bytes need."""
    cols = rows.columns
    named = bins.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(partition_cols)], "_first", "_bins")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(partition_cols)], F.lit(True))
    joined = rows.join(F.broadcast(named) if broadcast else named, same, "left")
    atomic = [c for c in cols if rows.schema[c].dataType.typeName() not in ("map", "array", "struct", "variant")]
    own = F.coalesce(F.col("_first") + F.pmod(F.xxhash64(*atomic), F.col("_bins")), F.lit(0)).cast("int")
    return joined.withColumn("_bin", own).repartitionById(total, "_bin").select(*cols)


def write_split(flagged: DataFrame, path: str, info: TableInfo, rebalance: bool = False) -> dict:
    """W1 + W3 in one write: rows of the impacted partitions, split by ``_deleted``.

    Partitioned by ``_deleted`` and then the table's own partition columns
    (W2: just ``_deleted`` for a non-partitioned table); with an ``OF_FILE`` column (rewrite by file) survivors lie
    below their file's folder. ``rebalance`` adds a REBALANCE on the partition columns so a shuffle-join output
    does not write one small file per task and partition.
    """
    of_file = [OF_FILE] if OF_FILE in flagged.columns else []
    out = flagged.select(*info.columns, F.col("_hit").alias(DELETED), *of_file)
    if rebalance:
        out = out.hint("rebalance", DELETED, *info.partition_cols)
    # Observed after the last exchange, i.e. in the write's result stage, where
    # Spark applies each partition's metric update exactly once (retries included).
    obs = Observation("split")
    out = out.observe(obs, F.count(F.lit(1)).alias("n"), F.count_if(F.col(DELETED)).alias("d"))
    with session_conf(flagged.sparkSession, **UNSORTED):
        (out.write.mode("overwrite").format("parquet")
            .partitionBy(DELETED, *of_file, *info.partition_cols).save(path))
    return observed(obs, n=0, d=0)


def stage_path(split_path: str) -> str:
    return f"{split_path}/{DELETED}=false"


def deleted_path(split_path: str, by_file: bool = False) -> str:
    return f"{split_path}/{DELETED}=true" + (f"/{OF_FILE}={NULL_PARTITION_DIR}" if by_file else "")


def refresh(spark: SparkSession, info: TableInfo) -> None:
    """W15."""
    spark.catalog.refreshTable(info.name)


DROP_BATCH = 500


def drop_emptied(spark: SparkSession, info: TableInfo, specs: list[dict], known: dict | None = None) -> list[str]:
    """W4 + W18 for partitions that lost every row.

    Dynamic overwrite never touches such a partition, so it would keep its
    deleted rows. Their locations are looked up (catalog metadata), the
    partitions are dropped in batched ``ALTER TABLE ... DROP PARTITION``
    statements, and any folder still present afterwards is deleted: on an
    external table ``DROP PARTITION`` keeps the files, and a later partition
    repair would bring the erased rows back. No Spark job is started.

    Returns the removed locations.
    """
    if not specs:
        return []
    locations = partition_locations(spark, info, specs, known)
    for i in range(0, len(specs), DROP_BATCH):
        chunk = specs[i:i + DROP_BATCH]
        body = ", ".join(f"PARTITION ({partition_spec_sql(spec)})" for spec in chunk)
        spark.sql(f"ALTER TABLE {info.quoted} DROP IF EXISTS {body}")
    removed = []
    for loc in locations:
        if loc and fs.exists(spark, loc):
            remove_folder(spark, loc)
            removed.append(loc)
    return removed


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with erased rows, or fail."""
    fs.delete(spark, path)
    if fs.exists(spark, path):
        raise RuntimeError(f"erased rows are still at {path}: the folder could not be deleted")


def publish_dynamic(spark: SparkSession, info: TableInfo, stage: DataFrame | None) -> None:
    """W4 + W6 as one catalog operation: dynamic partition overwrite from the stage.

    Only partitions present in the stage are replaced; the mode is set on the
    session for this statement only (``insertInto`` ignores the writer option).
    Non-partitioned tables (W5 + W7): a plain overwrite from the stage.
    """
    if info.partition_cols:
        if stage is None:
            return
        with session_conf(spark, **DYNAMIC):
            stage.select(*info.columns).write.insertInto(info.name, overwrite=True)
    else:
        data = stage if stage is not None else spark.createDataFrame([], info.schema)
        data.select(*info.columns).write.insertInto(info.name, overwrite=True)


def publish_static(spark: SparkSession, info: TableInfo, stage: DataFrame | None, specs: list[dict]) -> None:
    """W8 + W9: one static ``INSERT OVERWRITE ... PARTITION (spec)`` per surviving
    impacted partition, from a temporary view over the stage (P7: the partition
    columns are left out of the SELECT list)."""
    if not info.partition_cols:
        publish_dynamic(spark, info, stage)
        return
    if stage is None or not specs:
        return
    view = "_keysweep_stage"
    stage.createOrReplaceTempView(view)
    cols = ", ".join(quote_ident(c) for c in info.data_cols)
    try:
        for spec in specs:
            where = " AND ".join(f"{quote_ident(k)} <=> {sql_literal(v)}" for k, v in spec.items())
            spark.sql(f"INSERT OVERWRITE TABLE {info.quoted} PARTITION ({partition_spec_sql(spec)}) "
                      f"SELECT {cols} FROM {view} WHERE {where}")
    finally:
        spark.catalog.dropTempView(view)


def partition_locations(spark: SparkSession, info: TableInfo, specs: list[dict], known: dict | None = None) -> list[str | None]:
    """Folder of each listed (non-empty) partition: the parent directory of the partition's data files, as a purge's
    effect pass has ``known`` it, else from one pass over the partitions' rows that reads no column of them. A partition
    whose files sit in more than one folder, or that has none, is looked up in the catalog instead."""
    if not specs:
        return []
    parts = info.partition_cols
    if known is not None:
        return [known.get(tuple(spec[c] for c in parts)) or partition_location(spark, info, spec) for spec in specs]
    folders = (spark.table(info.name).where(spec_predicate(specs, parts))
               .select(*parts, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_dir"))
               .groupBy(*parts).agg(F.min("_dir").alias("_dir"), F.count_distinct("_dir").alias("_n")))
    found = {tuple(r[c] for c in parts): fs.from_uri(spark, r["_dir"]) for r in folders.collect() if r["_n"] == 1}
    return [found.get(tuple(spec[c] for c in parts)) or partition_location(spark, info, spec) for spec in specs]


def partition_location(spark: SparkSession, info: TableInfo, spec: dict) -> str | None:
    """A partition's location in the catalog; None where the catalog has no such partition (any more)."""
    try:
        rows = (spark.sql(f"DESCRIBE FORMATTED {info.quoted} PARTITION ({partition_spec_sql(spec)})")
                .where(F.col("col_name") == "Location").select("data_type").collect())
    except AnalysisException as exc:
        if exc.getCondition() != "PARTITIONS_NOT_FOUND":
            raise
        return None
    return rows[0][0] if rows else None


def publish_set_location(spark: SparkSession, info: TableInfo, stage_dir: str, specs: list[dict],
                         known: dict | None = None, lease=None) -> list[str]:
    """Zero-copy publish -- each surviving impacted partition is pointed at
    its staged directory. The stage becomes table data and must never be cleaned up.

    Returns the replaced locations. They still hold the erased rows: the caller
    deletes them once the published rows are verified.
    """
    pairs = list(zip(specs, partition_locations(spark, info, specs, known)))

    def point(item) -> None:
        spec, _ = item
        alter(spark, f"ALTER TABLE {info.quoted} PARTITION ({partition_spec_sql(spec)}) "
                     f"SET LOCATION {sql_literal(fs.qualify(spark, new_folder(spec)))}", lease)

    def new_folder(spec: dict) -> str:
        return f"{stage_dir}/{partition_path(spark, spec)}"

    fs.in_parallel(point, pairs)
    return [old for spec, old in pairs if old and fs.qualify(spark, old) != fs.qualify(spark, new_folder(spec))]


def alter(spark: SparkSession, statement: str, lease=None) -> None:
    """One catalog switch: readers see the state before it or after it."""
    if lease is not None:
        lease.check()
    spark.sql(statement)


def version_folder(info: TableInfo, run_id: str) -> str:
    """Where ``pointer`` writes a table's next version: beside the table's folder, on the same file system."""
    return f"{info.location.split(VERSIONS + '/')[0].rstrip('/').removesuffix(VERSIONS)}{VERSIONS}/{run_id}"


def publish_pointer(spark: SparkSession, info: TableInfo, stage_dir: str, specs: list[dict],
                    known: dict | None = None, lease=None) -> list[str]:
    """W5 / W10 by pointer: the survivors already lie in a version folder of their own; the catalog is pointed at it.
    A plain table is switched by one statement. A partitioned one by one statement for each partition, several at a
    time, as SQL has none for many: each partition is old or new at any moment, never absent, and the location in
    the catalog says which, so a repeated run only points again. No file is moved. Returns the replaced folders."""
    if info.partition_cols:
        return publish_set_location(spark, info, stage_dir, specs, known, lease)
    fs.mkdirs(spark, stage_dir)                        # no row may be left
    alter(spark, f"ALTER TABLE {info.quoted} SET LOCATION {sql_literal(fs.qualify(spark, stage_dir))}", lease)
    return []


def remove_files(spark: SparkSession, files: DataFrame) -> None:
    """Delete the listed files (``_file``, URIs) of a replaced version, and their folders where nothing else is left."""
    gone: set[str] = set()

    def remove(row) -> None:
        file = fs.from_uri(spark, row["_file"])
        fs.delete(spark, file)
        if fs.exists(spark, file):
            raise RuntimeError(f"erased rows are still at {file}: the file could not be deleted")
        gone.add(file.rsplit("/", 1)[0])

    fs.in_parallel(remove, files.select("_file").toLocalIterator())
    for folder in gone:
        if not fs.has_data_files(spark, folder):
            fs.delete(spark, folder)


def publish_move(spark: SparkSession, info: TableInfo, stage_dir: str, specs: list[dict], trash_dir: str,
                 resume: bool = False, known: dict | None = None, lease=None) -> None:
    """W10 as a file move: each surviving impacted partition's staged folder
    replaces the partition's own folder (rename old -> trash, stage -> old
    location), so the catalog entry stays valid and no second copy is
    written. The replaced folders hold the erased rows; the caller deletes
    ``trash_dir`` once the published rows are verified. With ``resume``, partitions
    whose staged folder is gone were swapped by an earlier attempt.
    Renames are metadata operations on HDFS; on object stores they copy. Partitions
    are swapped by several threads, each one on its own.
    """
    def swap(item) -> None:
        spec, loc = item
        rel = partition_path(spark, spec)
        staged = f"{stage_dir}/{rel}"
        if resume and not fs.exists(spark, staged):
            return
        if lease is not None:
            lease.check()
        if not loc or not fs.exists(spark, staged):
            raise RuntimeError(f"cannot move partition {spec}: location {loc}, stage {staged}")
        # an attempt that broke off between the two renames left the old folder in the trash
        if fs.exists(spark, loc) and not fs.rename(spark, loc, f"{trash_dir}/{rel}"):
            raise RuntimeError(f"could not move {loc} to {trash_dir}/{rel}")
        if not fs.rename(spark, staged, loc):
            fs.rename(spark, f"{trash_dir}/{rel}", loc)          # put the old data back
            raise RuntimeError(f"could not move {staged} to {loc}")

    fs.in_parallel(swap, zip(specs, partition_locations(spark, info, specs, known)))


def publish_files(spark: SparkSession, swaps: DataFrame, lease=None) -> None:
    """W5 / W10 by file: each rewritten file replaces the file it was made from, under the same name; a file that lost every
    row is deleted. A replacement is one rename over the old file: readers find either, never neither or both.
    ``swaps`` (written: URIs ``file``, ``staged`` or NULL) also serves a repeated run: a staged file that is gone was put in place."""
    def swap(row) -> None:
        file = fs.from_uri(spark, row["file"])
        if lease is not None:
            lease.check()
        if row["staged"] is None:
            fs.delete(spark, file)
        elif fs.exists(spark, staged := fs.from_uri(spark, row["staged"])):
            fs.replace(spark, staged, file)

    fs.in_parallel(swap, swaps.select("file", "staged").toLocalIterator())


def append(spark: SparkSession, info: TableInfo, rows: DataFrame) -> None:
    """W6 / W7 (restore): append through the catalog; new partitions are registered."""
    rows.select(*info.columns).write.insertInto(info.name, overwrite=False)


def count_partitions(spark: SparkSession, info: TableInfo, specs: list[dict] | None) -> int:
    """Rows now in the listed partitions (whole table when not partitioned).
    Needs no data columns, so Parquet answers it from file footers."""
    df = spark.table(info.name)
    if info.partition_cols and specs is not None:
        df = df.where(spec_predicate(specs, info.partition_cols))
    return df.count()


def cleanup(spark: SparkSession, path: str) -> bool:
    """Remove a stage after a successful publish."""
    return fs.delete(spark, path)


__all__ = ["write_split", "stage_path", "deleted_path", "refresh", "drop_emptied", "publish_dynamic",
           "publish_static", "publish_set_location", "append", "count_partitions", "cleanup",
           "partition_location", "partition_locations", "publish_move", "publish_files", "publish_pointer",
           "version_folder", "remove_files", "into_bins", "remove_folder"]
