"""Data files of a table (S14): their listing, what a purge does to each, and their fingerprint.

A listing is one row per *file*: the folders that hold the wanted partitions are listed with the
binary-file source, whose content column is never read, so no table row is touched and Spark lists
many folders in parallel. Folders come from the table's own (partition-pruned) file index, so
partitions at locations of their own are found too; hidden files are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.operators.match import KeySpec, flag_matches
from keysweep.session import session_conf
from keysweep.sinks import fs
from keysweep.sources.catalog import spec_predicate

LISTING = "file_path string, file_size bigint, modified timestamp"
# The binary-file source deals files to tasks by their size although no content is read here: a task may take any number of bytes.
_ANY_SIZE = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": "4096"}


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def folders(df: DataFrame) -> list[str]:
    """Folders of the files behind a DataFrame on a file table (after partition pruning), from its file index; no job."""
    spark = df.sparkSession
    found = sorted({p.rsplit("/", 1)[0] for p in df.inputFiles()})
    return [fs.from_uri(spark, p) for p in found]


def list_folders(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_path, file_size, modified`` of every visible file now in (and below) ``paths``; absent folders have none."""
    there = [p for p in paths if fs.exists(spark, p)]
    if not there:
        return spark.createDataFrame([], LISTING)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(there)
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def table_files(spark: SparkSession, name: str, specs: list[dict] | None = None,
                partition_cols: list[str] | None = None) -> DataFrame:
    """The files now in the folders of a table, or of its listed partitions."""
    df = spark.table(name)
    if specs is not None and partition_cols:
        df = df.where(spec_predicate(specs, partition_cols))
    return list_folders(spark, folders(df))


def with_file(df: DataFrame, path: str = "_file", size: str = "_size", modified: str = "_mtime") -> DataFrame:
    """The columns of a file table and the file each row comes from."""
    m = "_metadata"
    return df.select(*df.columns, F.col(f"{m}.file_path").alias(path), F.col(f"{m}.file_size").alias(size),
                     F.col(f"{m}.file_modification_time").alias(modified))


def matched_files(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None,
                  partition_cols: list[str] | None = None, match: str = "tuple", scope: Column | None = None,
                  broadcast_keys: bool | None = None, matched_only: bool = True) -> DataFrame:
    """S14 / A7 by file: partition, ``file_path``, its rows before, deleted and after (files with a match only).
    ``df`` reads a file table; only key and partition columns are read."""
    kc, pc = key_cols or keys.columns, partition_cols or []
    slim = with_file(df, "file_path")
    if scope is not None:
        slim = slim.withColumn("_in_scope", F.coalesce(scope, F.lit(False)))
    flagged = flag_matches(slim, [KeySpec(keys, kc, match, broadcast_keys)],
                           None if scope is None else F.col("_in_scope"))
    out = (flagged.groupBy(*pc, "file_path")
           .agg(F.count(F.lit(1)).alias("rows_before"), F.count_if("_hit").alias("rows_deleted"))
           .withColumn("rows_after", F.col("rows_before") - F.col("rows_deleted")))
    return out.where(F.col("rows_deleted") > 0) if matched_only else out


def files_fingerprint(files: DataFrame | list[str], spark: SparkSession | None = None) -> tuple[int, int]:
    """(number of files, hash of their paths, sizes and modification times) of a listing
    (``_file, _size, _mtime`` or ``file_path, file_size, modified``), or of what folders hold at the time of the call.
    Files are immutable, so an unchanged fingerprint means unchanged data."""
    if isinstance(files, list):
        files = list_folders(spark, files)
    names = ("_file", "_size", "_mtime") if "_file" in files.columns else ("file_path", "file_size", "modified")
    with session_conf(files.sparkSession, **_ANY_SIZE):
        row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64(*names), F.lit(2147483647))).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def changed_files(spark: SparkSession, seen: DataFrame, paths: list[str]) -> int:
    """How many files of the folders ``paths`` differ from ``seen(_file, _size, _mtime)``: gone, rewritten, or
    new and not empty. Files are immutable, so 0 means that the folders hold the rows that were read."""
    with session_conf(spark, **_ANY_SIZE):
        both = seen.select("_file", "_size", "_mtime").join(list_folders(spark, paths), F.col("_file") == F.col("file_path"), "full")
        differ = both.where(F.col("_file").isNull() | F.col("file_path").isNull() | (F.col("_size") != F.col("file_size"))
                            | (F.col("_mtime") != F.col("modified")))
        counts = differ.agg(F.count("_file").alias("known"), F.count_if(F.col("_file").isNull()).alias("unknown")).first()
        if counts["known"] or not counts["unknown"]:
            return int(counts["known"])
        unknown = [fs.from_uri(spark, r[0]) for r in differ.select("file_path").limit(1000).collect()]
    # files that gave the effect pass no row are no change as long as they have none
    if counts["unknown"] > len(unknown) or not all(p.endswith(".parquet") for p in unknown):
        return int(counts["unknown"])
    return 0 if spark.read.parquet(*unknown).count() == 0 else int(counts["unknown"])
