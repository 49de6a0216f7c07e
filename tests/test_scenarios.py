"""A few registered scenarios against their DuckDB oracle, at sf0.001 (the driver runs all at sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

from keysweep import scenarios as S

FAST = ["scan_matched", "keys_per_column", "inactive_only", "survivors_composite", "keys_not_found",
        "purge_effect", "emptied_partitions", "key_text_found", "group_manifest", "read_key_list",
        "purge_documents", "purge_plain_table", "purge_without_backup", "write_audit"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "events", "documents", "labels", "conversations"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_scenario_matches_oracle(spark, sf, con, name):
    df = S.SCENARIOS[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(S.ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
