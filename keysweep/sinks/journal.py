"""Publish journal: one small file per publish that has begun and is not verified yet.

The file lies beside the table's stages (``<work>/<db>/<table>/_JOURNAL/<run_id>``) and says
where the survivors are staged and how many rows each partition holds before and after. It is
written before the first live file is touched and removed after verification, so a purge
that breaks off in between is always seen by the next one.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keysweep.sinks import fs
from keysweep.sources.catalog import TableInfo


def folder(base: str) -> str:
    return f"{base}/_JOURNAL"


def begin(spark: SparkSession, base: str, record: dict) -> None:
    fs.write_text(spark, f"{folder(base)}/{record['run_id']}", json.dumps(record, default=str))


def end(spark: SparkSession, base: str, run_id: str) -> None:
    fs.delete(spark, f"{folder(base)}/{run_id}")


def unfinished(spark: SparkSession, base: str) -> list[dict]:
    return [json.loads(fs.read_text(spark, p)) for p in sorted(fs.list_plain_files(spark, folder(base)))]


def typed_specs(spark: SparkSession, info: TableInfo, impacted: list[dict]) -> list[dict]:
    """Partition values of a record, back in the table's types."""
    parts = info.partition_cols
    if not parts or not impacted:
        return []
    rows = [(i, *[None if r["spec"][c] is None else str(r["spec"][c]) for c in parts]) for i, r in enumerate(impacted)]
    text = spark.createDataFrame(rows, ", ".join(["_i int", *[f"`{c}` string" for c in parts]]))
    typed = text.select("_i", *[F.col(f"`{c}`").cast(info.dtype(c)).alias(c) for c in parts])
    return [{c: r[c] for c in parts} for r in sorted(typed.collect(), key=lambda r: r["_i"])]
