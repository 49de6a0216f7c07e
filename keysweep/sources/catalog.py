"""Catalog lookups and scans of a target table.

Everything here asks the catalog, never the file system layout: partition
columns come with all their levels and types, and scans go through
``spark.table`` so that partition pruning, column pruning and filter pushdown
are Catalyst's.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keysweep.functions.text import quote_ident, split_partition
from keysweep.operators.match import rows_in_partitions

SESSION_CATALOG = "spark_catalog"


@dataclass
class TableInfo:
    name: str                      # qualified: db.table
    database: str
    table: str
    schema: StructType             # catalog order: data columns, then partition columns
    partition_cols: list[str] = field(default_factory=list)
    location: str | None = None
    provider: str | None = None
    table_type: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def data_cols(self) -> list[str]:
        return [c for c in self.columns if c not in self.partition_cols]

    def dtype(self, col: str):
        return self.schema[col].dataType

    @property
    def quoted(self) -> str:
        return f"{quote_ident(self.database)}.{quote_ident(self.table)}"


_NAME_PART = re.compile(r"`((?:[^`]|``)*)`|([^.`]+)")


def _split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """Database and table of ``table``, ``db.table`` or ``catalog.db.table`` (the session's own catalog only);
    parts may be quoted with back-quotes."""
    parts = [(quoted.replace("``", "`") if whole.startswith("`") else plain)
             for whole, quoted, plain in ((m.group(0), m.group(1), m.group(2)) for m in _NAME_PART.finditer(name))]
    if len(parts) == 3:
        if parts[0] != SESSION_CATALOG:
            raise ValueError(f"{name}: tables of catalog {parts[0]} are not purged, only those of {SESSION_CATALOG}")
        parts = parts[1:]
    if not 1 <= len(parts) <= 2:
        raise ValueError(f"{name!r} is no table name")
    return (parts[0], parts[1]) if len(parts) == 2 else (spark.catalog.currentDatabase(), parts[0])


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """All partition levels, in order, from the catalog (empty when not partitioned)."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def table_location(spark: SparkSession, name: str) -> str | None:
    """S11 + P9: storage location from ``DESCRIBE FORMATTED`` (row ``Location``)."""
    db, tbl = _split_name(spark, name)
    rows = (spark.sql(f"DESCRIBE FORMATTED {quote_ident(db)}.{quote_ident(tbl)}")
            .where(F.col("col_name") == "Location").select("data_type").collect())
    return rows[0][0] if rows else None


def describe_table(spark: SparkSession, name: str) -> TableInfo:
    db, tbl = _split_name(spark, name)
    qualified = f"{db}.{tbl}"
    meta = spark.catalog.getTable(qualified)
    schema = spark.table(qualified).schema
    info = TableInfo(
        name=qualified, database=db, table=tbl, schema=schema,
        partition_cols=partition_columns(spark, qualified),
        table_type=getattr(meta, "tableType", None),
    )
    rows = (spark.sql(f"DESCRIBE FORMATTED {info.quoted}")
            .where(F.col("col_name").isin("Location", "Provider")).collect())
    for r in rows:
        if r["col_name"] == "Location" and info.location is None:
            info.location = r["data_type"]
        elif r["col_name"] == "Provider":
            info.provider = r["data_type"]
    return info


def manifest_partition_column(info: TableInfo, declared: str | None) -> tuple[list[str], bool]:
    """The manifest's PARTITION_COL checked against the catalog; the catalog wins.

    Returns the catalog's partition columns and whether the declaration agreed
    (a blank declaration always agrees).
    """
    if declared is None or str(declared).strip() == "":
        return info.partition_cols, True
    wanted = [c.strip() for c in str(declared).split(",") if c.strip()]
    return info.partition_cols, wanted == info.partition_cols[: len(wanted)]


def column_refs(df: DataFrame, expr: Column) -> set[str]:
    """Names of the columns of ``df`` that an expression reads (from the analysed plan)."""
    refs = df.select(expr.alias("_e"))._jdf.queryExecution().analyzed().references().toSeq()
    return {refs.apply(i).name() for i in range(refs.size())}


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """The whole table, by catalog name."""
    return spark.table(name)


def spec_predicate(specs: list[dict], partition_cols: list[str]) -> Column:
    """Predicate selecting exactly the listed partitions.

    One level: ``p IN (...)`` plus ``p IS NULL`` when a NULL partition is listed.
    Several levels: ``struct(p1, p2) IN (...)`` for the non-NULL specs, and a
    null-safe conjunction for each spec holding a NULL. Both only reference
    partition columns, so the file index prunes with them (static pruning).
    """
    if not specs:
        return F.lit(False)
    if len(partition_cols) == 1:
        p = partition_cols[0]
        values = [s[p] for s in specs]
        present = [v for v in values if v is not None]
        pred = F.col(p).isin(present) if present else F.lit(False)
        if len(present) < len(values):
            pred = pred | F.col(p).isNull()
        return pred
    plain = [s for s in specs if all(s[c] is not None for c in partition_cols)]
    nullish = [s for s in specs if any(s[c] is None for c in partition_cols)]
    terms = []
    if plain:
        target = F.struct(*[F.col(c) for c in partition_cols])
        terms.append(target.isin([F.struct(*[F.lit(s[c]).alias(c) for c in partition_cols]) for s in plain]))
    for s in nullish:
        terms.append(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(s[c])) for c in partition_cols]))
    return reduce(lambda a, b: a | b, terms)


def scan_partitions(spark: SparkSession, name: str, specs: list[dict] | DataFrame,
                    partition_cols: list[str] | None = None, broadcast_specs: bool | None = None) -> DataFrame:
    """Only the listed partitions. A list becomes literals (static pruning); a table of specs stays
    one: it is joined and prunes when the query runs, so no literal per partition passes through the driver."""
    parts = partition_cols if partition_cols is not None else partition_columns(spark, name)
    df = spark.table(name)
    if not parts:
        return df
    if isinstance(specs, DataFrame):
        return rows_in_partitions(df, specs, parts, broadcast_specs)
    return df.where(spec_predicate(specs, parts))


def partition_list(spark: SparkSession, name: str) -> DataFrame:
    """A10: ``SHOW PARTITIONS`` as a DataFrame (column ``partition``), plus the column name."""
    db, tbl = _split_name(spark, name)
    return (spark.sql(f"SHOW PARTITIONS {quote_ident(db)}.{quote_ident(tbl)}").distinct()
            .withColumn("partition_column", split_partition("partition")))
