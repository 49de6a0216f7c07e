"""Counts: what a purge does per partition (A1-A3, A5-A7), manifest groups.

The effect of a purge is one aggregation over the key and partition columns
only (column-pruned scan), with map-side partial aggregation, so it costs a
fraction of a table read and its shuffle is one row per (task, partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.operators.match import KeySpec, flag_matches


def effect_from_flags(flagged: DataFrame, partition_cols: list[str], weight: str | None = None) -> DataFrame:
    """Per partition: rows before, rows deleted, rows after, from a flagged
    DataFrame (``_hit``); ``weight`` names a pre-aggregated row-count column."""
    n = F.col(weight) if weight else F.lit(1)
    return (flagged.groupBy(*partition_cols)
            .agg(F.sum(n).cast("bigint").alias("rows_before"),
                 F.sum(F.when(F.col("_hit"), n).otherwise(0)).cast("bigint").alias("rows_deleted"))
            .withColumn("rows_after", F.col("rows_before") - F.col("rows_deleted")))


def purge_effect(df: DataFrame, keys: DataFrame, key_cols: list[str] | None = None,
                 partition_cols: list[str] | None = None, match: str = "tuple", scope: Column | None = None,
                 broadcast_keys: bool | None = None, impacted_only: bool = True) -> DataFrame:
    """A7 (with A1-A3): before / deleted / after per partition, one pass.

    Without partition columns the result is one row for the whole table.
    """
    kc = key_cols or keys.columns
    pc = partition_cols or []
    flagged = flag_matches(df, [KeySpec(keys, kc, match, broadcast_keys)], scope)
    eff = effect_from_flags(flagged, pc)
    return eff.where(F.col("rows_deleted") > 0) if impacted_only else eff


def impacted_partitions(effect: DataFrame, partition_cols: list[str]) -> DataFrame:
    """A5: partitions holding at least one row to delete."""
    return effect.where(F.col("rows_deleted") > 0).select(*partition_cols)


def emptied_partitions(effect: DataFrame, partition_cols: list[str]) -> DataFrame:
    """A6 (impacted minus surviving): partitions that lose every row."""
    return effect.where((F.col("rows_deleted") > 0) & (F.col("rows_after") == 0)).select(*partition_cols)


def surviving_partitions(effect: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Impacted partitions that still hold rows after the purge."""
    return effect.where((F.col("rows_deleted") > 0) & (F.col("rows_after") > 0)).select(*partition_cols)


def group_manifest(manifest: DataFrame) -> DataFrame:
    """A8 + A9: one row per purge target with its key counts, in a fixed order."""
    return (manifest.groupBy("DATABASE_NAME", "TABLE_NAME", "PK", "PARTITION_COL")
            .agg(F.count(F.lit(1)).alias("keys_requested"),
                 F.count_distinct("PK_VALUE").alias("keys_distinct"))
            .orderBy("DATABASE_NAME", "TABLE_NAME", "PK", "PARTITION_COL"))


def count_keys(keys: DataFrame) -> DataFrame:
    """Keys requested (all lines) and distinct key tuples."""
    return keys.agg(F.count(F.lit(1)).alias("keys_requested"),
                    F.count_distinct(*[F.col(c) for c in keys.columns]).alias("keys_distinct"))
