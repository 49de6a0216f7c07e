"""Audit trail (O11 / W13): one row per purge, appended as CSV with a header.

The eight fields of the original audit file are kept (same names, same
order), followed by the run id, the table, a status and the counts a reviewer
needs. The audit lives outside the table. Every found key tuple is written to
a keys side table under the audit folder, so the row itself never has to hold
an unbounded list: ``deleted_keys_and_values`` always names that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from keysweep.functions.text import KEY_PART_SEPARATOR, audit_timestamp, audit_user, key_text
from keysweep.sinks import fs
from keysweep.sinks.observe import observed

# Fixed audit columns: the original eight first, in their original order.
AUDIT_FIELDS = [
    ("spark_application_id", StringType()),
    ("input_file_name", StringType()),
    ("total_records_before_deletion", LongType()),
    ("total_records_deleted", LongType()),
    ("deleted_records_directory_location", StringType()),
    ("created_datetime", StringType()),
    ("created_by", StringType()),
    ("deleted_keys_and_values", StringType()),
    ("run_id", StringType()),
    ("table_name", StringType()),
    ("status", StringType()),
    ("strategy", StringType()),
    ("keys_requested", LongType()),
    ("keys_rejected", LongType()),
    ("keys_found", LongType()),
    ("partitions_impacted", LongType()),
    ("partitions_emptied", LongType()),
    ("total_records_after_deletion", LongType()),
    ("deleted_keys_location", StringType()),
    ("message", StringType()),
]
AUDIT_SCHEMA = StructType([StructField(n, t, True) for n, t in AUDIT_FIELDS])
# Fixed status values.
STATUS_DONE, STATUS_NOOP, STATUS_DRY_RUN, STATUS_FAILED, STATUS_SIDE = "DONE", "NOOP", "DRY_RUN", "FAILED", "SIDE_COPY"


def audit_row(spark: SparkSession, values: dict) -> DataFrame:
    """The audit record as a one-row DataFrame; time and user are Spark's."""
    row = tuple(values.get(n) for n, _ in AUDIT_FIELDS)
    df = spark.createDataFrame([row], AUDIT_SCHEMA)
    return (df.withColumn("created_datetime", audit_timestamp())
              .withColumn("created_by", audit_user())
              .select(*AUDIT_SCHEMA.fieldNames()))


def write_audit(row: DataFrame, audit_dir: str) -> DataFrame:
    """Write the row (one small CSV file with header) to
    ``<audit_dir>/log/<run_id>/``.

    One folder per run, so purges running at the same time never share a
    commit folder. The row is materialised first so that the file and the
    returned DataFrame agree on time and user."""
    local = row.collect()
    spark = row.sparkSession
    fixed = spark.createDataFrame(local, AUDIT_SCHEMA)
    run_id = local[0]["run_id"] if local and local[0]["run_id"] else "unknown"
    fixed.coalesce(1).write.mode("append").option("header", True).csv(f"{audit_dir}/log/{run_id}")
    return fixed


def read_audit(spark: SparkSession, audit_dir: str) -> DataFrame:
    """Every audit row written under ``audit_dir``."""
    return spark.read.schema(AUDIT_SCHEMA).option("header", True).csv(f"{audit_dir}/log/*")


_KEY_ROWS = "key_columns string, key_text string, rows_deleted bigint"
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("key_text"), F.lit(BUCKETS)).cast("int")


def _loose_keys(spark: SparkSession, audit_dir: str) -> DataFrame:
    """Found keys of the runs that no index holds yet: run, key columns, key text, rows deleted."""
    if not fs.has_data_files(spark, f"{audit_dir}/keys"):
        return spark.createDataFrame([], "run_id string, " + _KEY_ROWS)
    rows = spark.read.schema(_KEY_ROWS).option("recursiveFileLookup", True).parquet(f"{audit_dir}/keys")
    run = F.regexp_extract(F.col("_metadata.file_path"), "/keys/([^/]+)/set_[0-9]+/[^/]+$", 1)
    rows = rows.select(run.alias("run_id"), "key_columns", "key_text", "rows_deleted")
    index = _index(spark, audit_dir)
    return rows if index is None else rows.join(index.select("run_id").distinct(), "run_id", "left_anti")


def _index(spark: SparkSession, audit_dir: str) -> DataFrame | None:
    if not fs.has_data_files(spark, f"{audit_dir}/key_index"):
        return None
    return spark.read.schema("run_id string, " + _KEY_ROWS + ", bucket int").parquet(f"{audit_dir}/key_index")


def compact_audit_keys(spark: SparkSession, audit_dir: str) -> int:
    """Bring the found keys of finished runs into the key index, partitioned by a hash of the key text, so that a
    lookup opens only the buckets of its keys. Returns the number of keys added. A run is in the index wholly or not
    at all (one append job); a call that is repeated adds nothing. Calls are not meant to overlap."""
    done = read_audit(spark, audit_dir).where(F.col("status") == STATUS_DONE).select("run_id").distinct()
    rows = _loose_keys(spark, audit_dir).join(done, "run_id", "left_semi").withColumn("bucket", _bucket())
    obs = Observation("audit_index")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "key_text").observe(obs, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").partitionBy("bucket").parquet(f"{audit_dir}/key_index")
    return int(observed(obs, n=0)["n"])


def erased_when(spark: SparkSession, audit_dir: str, keys: DataFrame, table: str | None = None,
                key_cols: list[str] | None = None) -> DataFrame:
    """Which purges erased the given keys: the key columns, ``table_name``, ``run_id``, ``created_datetime``, ``created_by``,
    ``rows_deleted``; one row for each key, table and run that deleted rows with that key, none for keys never erased."""
    kc = key_cols or keys.columns
    text = keys.select(*kc, key_text(*kc).alias("key_text")).distinct()
    log = read_audit(spark, audit_dir).where(F.col("status") == STATUS_DONE)
    if table is not None:
        log = log.where(F.col("table_name") == table)
    same = F.lower("key_columns") == KEY_PART_SEPARATOR.join(kc).lower()
    found = _loose_keys(spark, audit_dir).where(same).join(text, "key_text").select(*kc, "run_id", "rows_deleted")
    index = _index(spark, audit_dir)
    if index is not None:
        asked = text.withColumn("bucket", _bucket())
        found = found.unionByName(index.where(same).join(asked, ["bucket", "key_text"]).select(*kc, "run_id", "rows_deleted"))
    out = found.join(log.select("run_id", "table_name", "created_datetime", "created_by"), "run_id")
    return out.groupBy(*kc, "table_name", "run_id", "created_datetime", "created_by").agg(F.sum("rows_deleted").alias("rows_deleted"))


def keys_location(audit_dir: str, run_id: str, index: int) -> str:
    return f"{audit_dir}/keys/{run_id}/set_{index}"

