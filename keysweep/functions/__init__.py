"""Scalar helpers: key text, SQL literals, audit time/user, partition paths."""

from keysweep.functions.text import (  # noqa: F401
    audit_timestamp,
    audit_user,
    key_text,
    partition_path,
    partition_spec_sql,
    split_partition,
    sql_literal,
)
