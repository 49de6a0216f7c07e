"""Scratch catalog tables copied from the given Parquet tables.

Used by the registered scenarios, the tests and the benchmark: a purge needs
a catalog table it may rewrite, and the given tables are read-only. Copies go
into a database located in the session's shared work folder, under fresh
names, so runs never collide.
"""

from __future__ import annotations

import uuid

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StructField, StructType

from keysweep.session import session_conf, work_root
from keysweep.sinks.publish import UNSORTED, into_bins

SCRATCH_DB = "keysweep_scratch"
# Bytes of values that a task writing a copy gets (files may hold the same values in a small part of that).
TASK_BYTES = 192 << 20


class Scratch:
    def __init__(self, spark: SparkSession, database: str = SCRATCH_DB, root: str | None = None):
        self.spark = spark
        self.root = (root or work_root(spark)).rstrip("/")
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/{database}.db'")

    def path(self, name: str) -> str:
        return f"{self.root}/scratch/{name}_{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, base: str, partition_by: list[str] | tuple = (), external: bool = False,
              spread: int | None = None, cluster_by: list[str] | None = None) -> str:
        """Write ``df`` as a new catalog table; one file per partition value, or with ``spread`` up to that many
        (rows dealt by ranges of ``cluster_by``, or by hash). Partition values with more than ``TASK_BYTES`` get as
        many files as their bytes need, each written by a task of its own
        (setup only: the copy is sized for tests, not part of a purge)."""
        name = f"{self.database}.{base}_{uuid.uuid4().hex[:8]}"
        parts = list(partition_by)
        sizes = self._sizes(df, parts) if parts or spread else []
        size = sum(r["_bytes"] for r in sizes)
        if spread:
            out = self._spread(df, parts, spread, cluster_by, -(-size // TASK_BYTES))
        elif parts and size > TASK_BYTES:
            out = self._by_bytes(df, parts, sizes)
        else:
            out = df.repartition(*parts) if parts else df
        w = out.write.format("parquet").mode("error")
        if parts:
            w = w.partitionBy(*parts)
        if external:
            w = w.option("path", self.path(base))
        with session_conf(self.spark, **UNSORTED):
            w.saveAsTable(name)
        return name

    def _sizes(self, df: DataFrame, parts: list[str]) -> list:
        """Bytes of the values of each partition value (one row for each passes the driver)."""
        kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
        long = [c for c, kind in kinds.items() if kind in ("string", "binary", "map", "array", "struct")]
        width = sum((F.coalesce(F.octet_length(F.col(c) if kinds[c] in ("string", "binary") else F.col(c).cast("string")), F.lit(0)) for c in long), F.lit(8 * len(kinds)))
        return df.groupBy(*parts).agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("_bytes")).collect()

    def _by_bytes(self, df: DataFrame, parts: list[str], sizes: list) -> DataFrame:
        """Rows dealt into bins of about ``TASK_BYTES``, a task for each."""
        table, first = [], 0
        for r in sizes:
            n = max(1, -(-r["_bytes"] // TASK_BYTES))
            table.append((*[r[c] for c in parts], first, n))
            first += n
        schema = StructType([*[StructField(c, df.schema[c].dataType, True) for c in parts], StructField("_first", LongType()), StructField("_bins", LongType())])
        return into_bins(df, self.spark.createDataFrame(table, schema), parts, first, True)

    def _spread(self, df: DataFrame, parts: list[str], spread: int, cluster_by: list[str] | None, tasks: int) -> DataFrame:
        """Up to ``spread`` files for each partition value; tables too large for as many tasks are dealt to more of
        them by (range or hash, partition value), which leaves the number of files as it is."""
        ranged = bool(cluster_by) and len(cluster_by) == 1 and isinstance(df.schema[cluster_by[0]].dataType, NumericType)
        if tasks <= spread or (cluster_by and not ranged):
            return df.repartitionByRange(max(spread, tasks), *cluster_by) if cluster_by else df.repartition(spread, *[c for c in df.columns if c not in parts][:2])
        if not parts:
            return df.repartitionByRange(tasks, *cluster_by) if cluster_by else df.repartition(tasks, *df.columns[:2])
        if cluster_by:
            cuts = df.agg(F.percentile_approx(cluster_by[0], [i / spread for i in range(1, spread)]) if spread > 1 else F.array()).first()[0] or []
            group = reduce(lambda a, b: a + b, [F.coalesce((F.col(cluster_by[0]) > F.lit(c)).cast("int"), F.lit(0)) for c in cuts], F.lit(0))
        else:
            group = F.pmod(F.xxhash64(*[c for c in df.columns if c not in parts][:2]), F.lit(spread))
        cols = df.columns
        return df.withColumn("_group", group).repartition(tasks, "_group", *parts).select(*cols)
