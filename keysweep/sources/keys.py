"""Key lists and manifests (S5-S8) and key typing.

Key files are read by Spark as text (no inference, no driver-side parsing),
then cast once to the target table's key types with ``try_cast``. A value that
is blank or does not cast is a *reject*: it is reported and never deletes
anything, and it never stops the other keys from being purged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from keysweep.functions.text import quote_ident

# Fixed manifest layout: key column, key value, database, table, partition column.
MANIFEST_COLUMNS = ["PK", "PK_VALUE", "DATABASE_NAME", "TABLE_NAME", "PARTITION_COL"]
MANIFEST_SCHEMA = StructType([StructField(c, StringType(), True) for c in MANIFEST_COLUMNS])
# Fixed name of the value column in single-key lists.
PK_VALUE = "PK_VALUE"
_CORRUPT = "_keysweep_corrupt"
# Key types that can be matched by equality.
_ATOMIC_KEY_TYPES = ("string", "varchar", "char", "bigint", "int", "smallint", "tinyint",
                     "decimal", "date", "timestamp", "timestamp_ntz", "boolean")


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose header names the key columns; every value read as text.

    Quotes follow RFC 4180. A line with too many or too few values becomes a row of
    nulls, so that :func:`type_keys` rejects it. Files of one folder must have
    the same header: another order is refused, never read by position.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
    columns = reader.csv(path).columns
    if not columns:
        return reader.csv(path)
    schema = StructType([StructField(c, StringType()) for c in [*columns, _CORRUPT]])
    rows = (reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
            .option("enforceSchema", False).option("columnPruning", False).csv(path))
    return rows.select(*[F.when(F.col(_CORRUPT).isNull(), F.col(quote_ident(c))).alias(c) for c in columns])


def read_key_values(spark: SparkSession, path: str, key_col: str) -> DataFrame:
    """CSV with a ``PK_VALUE`` column; the key column is named by the caller."""
    return read_key_list(spark, path).select(F.col(PK_VALUE).alias(key_col))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The multi-table manifest, by header name (any column order, extra columns ignored)."""
    return read_key_list(spark, path).select(*MANIFEST_COLUMNS)


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def split_manifest(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid manifest rows and rejects (blank key column, value, database or table).

    Unlike a pandas ``groupby``, no row disappears silently: every row is in
    exactly one of the two outputs. ``PARTITION_COL`` may be blank.
    """
    bad = reduce(lambda a, b: a | b, [_blank(F.col(c)) for c in ["PK", "PK_VALUE", "DATABASE_NAME", "TABLE_NAME"]])
    m = manifest.select(*[F.col(c) for c in MANIFEST_COLUMNS]).withColumn("_bad", bad)
    valid = m.where(~F.col("_bad")).drop("_bad").select(
        F.trim("PK").alias("PK"), F.col("PK_VALUE"), F.trim("DATABASE_NAME").alias("DATABASE_NAME"),
        F.trim("TABLE_NAME").alias("TABLE_NAME"), F.trim(F.coalesce("PARTITION_COL", F.lit(""))).alias("PARTITION_COL"))
    rejects = m.where(F.col("_bad")).drop("_bad").withColumn("reason", F.lit("blank PK, PK_VALUE, DATABASE_NAME or TABLE_NAME"))
    return valid, rejects


def manifest_keys(manifest: DataFrame, database: str, table: str, pk: str) -> DataFrame:
    """The key values of one manifest target as a one-column DataFrame named after the key.

    Stays distributed (no pandas group on the driver); typing happens in :func:`type_keys`.
    """
    return (manifest.where((F.lower("DATABASE_NAME") == database.lower())
                           & (F.lower("TABLE_NAME") == table.lower()) & (F.col("PK") == pk))
            .select(F.col("PK_VALUE").alias(pk)))


def check_key_type(name: str, dtype: DataType) -> None:
    if dtype.simpleString().split("(")[0] not in _ATOMIC_KEY_TYPES:
        raise ValueError(f"key column {name!r} has type {dtype.simpleString()}; only atomic types can be keys")


def _exact(src: Column, src_type: DataType, val: Column, to: DataType) -> Column:
    """True where the cast kept the value: a key that was rounded or cut is a key nobody listed."""
    if src_type == to or isinstance(to, StringType):
        return F.lit(True)
    if not isinstance(src_type, StringType):
        return val.cast(src_type) == src
    text, kind = F.trim(src), to.simpleString().split("(")[0]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return text.rlike(r"^[+-]?\d+$")
    if kind == "decimal":
        return F.length(F.rtrim(F.regexp_extract(text, r"\.(\d*?)0*$", 1))) <= to.scale
    if kind == "date":
        return text.rlike(r"^[+-]?\d+-\d{1,2}-\d{1,2}$")
    return F.lit(True)


def type_keys(keys: DataFrame, key_cols: list[str], types: dict[str, DataType]) -> DataFrame:
    """cast each key column to the table's type with ``try_cast``.

    Output: the typed key columns, ``_raw`` (the input tuple as text, for the
    rejects report) and ``_ok`` (False when a part is blank or does not cast).
    '001' for a bigint column becomes 1; for a string column it stays '001'.
    """
    typed, ok_terms = [], []
    for c in key_cols:
        check_key_type(c, types[c])
        src = keys[c]
        src_type = keys.schema[c].dataType
        if src_type == types[c]:
            val = src
        elif isinstance(src_type, StringType):
            val = F.trim(src).try_cast(types[c]) if not isinstance(types[c], StringType) else src
        else:
            val = src.try_cast(types[c])
        typed.append(val.alias(c))
        val = F.when(_exact(src, src_type, val, types[c]), val)
        blank = src.isNull() | ((F.trim(src.cast("string")) == "") if isinstance(src_type, StringType) else F.lit(False))
        ok_terms.append(~blank & val.isNotNull())
    raw = F.concat_ws("~", *[F.coalesce(keys[c].cast("string"), F.lit("")) for c in key_cols])
    ok = reduce(lambda a, b: a & b, ok_terms)
    return keys.select(*typed, raw.alias("_raw"), ok.alias("_ok"))
