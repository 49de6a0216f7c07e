"""Scalar functions used by the purge jobs and the audit.

All Column-valued helpers are built-in Spark expressions (JVM side, inside
whole-stage codegen); the SQL-literal helpers only format partition specs,
which are metadata.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _dec
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed audit text format: key parts joined by "~", each tuple wrapped in
# single quotes, tuples joined by "|" (e.g. '1~x'|'2~y').
KEY_PART_SEPARATOR = "~"
KEY_QUOTE = "'"
KEY_TUPLE_SEPARATOR = "|"
# Fixed audit timestamp format.
AUDIT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Spark's directory name for a NULL partition value.
NULL_PARTITION_DIR = "__HIVE_DEFAULT_PARTITION__"


def key_text(*cols: str | Column) -> Column:
    """one key tuple as audit text, e.g. ``'1~x'``. NULL parts print as ``null``."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("null"))
             for c in cols]
    return F.concat(F.lit(KEY_QUOTE), F.concat_ws(KEY_PART_SEPARATOR, *parts), F.lit(KEY_QUOTE))


def join_key_texts(texts: Sequence[str]) -> str:
    """Joins per-tuple texts into the one-cell form ``'a~b'|'c~d'`` (bounded lists only)."""
    return KEY_TUPLE_SEPARATOR.join(texts)


def audit_timestamp() -> Column:
    """current time as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.current_timestamp(), AUDIT_TIME_FORMAT)


def audit_user() -> Column:
    """the user running the job."""
    return F.current_user()


def split_partition(partition: str | Column) -> Column:
    """column name of a ``SHOW PARTITIONS`` entry (text before the first ``=``)."""
    c = F.col(partition) if isinstance(partition, str) else partition
    return F.split(c, "=", 2).getItem(0)


def sql_literal(value) -> str:
    """a Python value as a Spark SQL literal; strings are escaped, never pasted raw."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return repr(value) + "D"
    if isinstance(value, _dec.Decimal):
        return f"{value}BD"
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP'{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE'{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def partition_spec_sql(spec: dict) -> str:
    """``PARTITION (a = 1, b = 'x')`` body for DDL/DML on one partition."""
    return ", ".join(f"{quote_ident(k)} = {sql_literal(v)}" for k, v in spec.items())


def _value_text(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, _dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, _dt.date):
        return value.isoformat()
    return str(value)


def partition_path(spark: SparkSession, spec: dict) -> str:
    """``a=1/b=x`` as Spark names the directories (special characters escaped)."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = []
    for k, v in spec.items():
        text = _value_text(v)
        val = NULL_PARTITION_DIR if text in (None, "") else utils.escapePathName(text)
        parts.append(f"{utils.escapePathName(k)}={val}")
    return "/".join(parts)
