"""Registered scenarios: each operator of the inventory run on the given tables.

Every scenario reads the driver's Parquet tables (``sf_dir``), derives its key
list from them with a business predicate (a market segment, an order quarter,
a toxicity label, a message role), runs the real operator over the whole
tables and returns a DataFrame. ``ORACLE_SQL`` holds, for the same name, the
DuckDB statement that computes the expected rows directly from the tables.

Derived target tables (partition column appended last, as the catalog does):

==================  ==========================================  =====================
name                from                                        partitioned by
==================  ==========================================  =====================
orders_p            orders                                      order_month (yyyy-MM)
orders_active       orders                                      active ('1' if status O)
lineitem_p          lineitem                                    ship_month (yyyy-MM)
lineitem_ml         lineitem                                    l_returnflag, l_linestatus
events_p            events                                      event_type
documents_p         documents                                   lang
conversations_plain conversations                               (none)
orders_plain        orders                                      (none)
==================  ==========================================  =====================
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.text import key_text
from keysweep.operators import effect as E
from keysweep.operators import match as M
from keysweep.plans.manifest import purge_manifest
from keysweep.plans.purge import dry_run, purge_table
from keysweep.plans.restore import restore_backup
from keysweep.scratch import Scratch
from keysweep.sinks.audit import compact_audit_keys, erased_when
from keysweep.sources import catalog as C
from keysweep.sources import files as L
from keysweep.sources import keys as K
from keysweep.sources.stage import read_backup, read_stage

# ---------------------------------------------------------------- inputs


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_p(spark, d):
    return _t(spark, d, "orders").withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))


def orders_active(spark, d):
    return _t(spark, d, "orders").withColumn(
        "active", F.when(F.col("o_orderstatus") == "O", F.lit("1")).otherwise(F.lit("0")))


def lineitem_p(spark, d):
    return _t(spark, d, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))


def events_p(spark, d):
    e = _t(spark, d, "events")
    return e.select(*[c for c in e.columns if c != "event_type"], "event_type")


def documents_p(spark, d):
    t = _t(spark, d, "documents")
    return t.select(*[c for c in t.columns if c != "lang"], "lang")


def lineitem_ml(spark, d):
    t = _t(spark, d, "lineitem")
    parts = ["l_returnflag", "l_linestatus"]
    return t.select(*[c for c in t.columns if c not in parts], *parts)


# Key lists, each derived from the given tables.
def k_automobile(spark, d):
    """Customers of the AUTOMOBILE segment, as order keys' customer column."""
    return (_t(spark, d, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
            .select(F.col("c_custkey").alias("o_custkey")))


def k_building(spark, d):
    return (_t(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
            .select(F.col("c_custkey").alias("o_custkey")))


def k_q1_items(spark, d):
    """Line items (order, line) of orders placed in the first quarter of 1995."""
    q1 = (_t(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1995-04-01").cast("timestamp_ntz"))
          .select(F.col("o_orderkey").alias("l_orderkey")))
    return _t(spark, d, "lineitem").join(q1, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


def k_returned_jan95(spark, d):
    """Returned line items shipped in January 1995."""
    return (_t(spark, d, "lineitem")
            .where((F.col("l_returnflag") == "R") & (F.col("l_shipdate") < F.lit("1995-02-01").cast("timestamp_ntz")))
            .select("l_orderkey", "l_linenumber"))


def k_errors(spark, d):
    return _t(spark, d, "events").where(F.col("event_type") == "error").select("event_id")


def k_toxic(spark, d):
    return _t(spark, d, "labels").where(F.col("toxic") == 1).select("doc_id")


def k_system_turns(spark, d):
    return _t(spark, d, "conversations").where(F.col("role") == "system").select("conv_id", "turn")


SQL_KEYS = {
    "automobile": "SELECT c_custkey AS o_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE'",
    "building": "SELECT c_custkey AS o_custkey FROM customer WHERE c_mktsegment = 'BUILDING'",
    "q1_items": ("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN "
                 "(SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-04-01')"),
    "returned_jan95": ("SELECT l_orderkey, l_linenumber FROM lineitem "
                       "WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1995-02-01'"),
    "errors": "SELECT event_id FROM events WHERE event_type = 'error'",
    "toxic": "SELECT doc_id FROM labels WHERE toxic = 1",
    "system_turns": "SELECT conv_id, turn FROM conversations WHERE role = 'system'",
}
SQL_TABLES = {
    "orders_p": "SELECT *, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders",
    "orders_active": "SELECT *, CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END AS active FROM orders",
    "lineitem_p": "SELECT *, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem",
    "events_p": "SELECT * FROM events",
    "documents_p": "SELECT * FROM documents",
    "lineitem_ml": "SELECT * FROM lineitem",
    "conversations": "SELECT * FROM conversations",
    "orders": "SELECT * FROM orders",
}


def _with(**ctes: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in ctes.items()) + " "


def _survive_tuple(cols: list[str]) -> str:
    cond = " AND ".join(f"k.{c} = t.{c}" for c in cols)
    return f"NOT EXISTS (SELECT 1 FROM k WHERE {cond})"


def _match_tuple(cols: list[str]) -> str:
    cond = " AND ".join(f"k.{c} = t.{c}" for c in cols)
    return f"EXISTS (SELECT 1 FROM k WHERE {cond})"


def _survivors_sql(table: str, keys: str, cols: list[str]) -> str:
    return _with(t=SQL_TABLES[table], k=SQL_KEYS[keys]) + f"SELECT * FROM t WHERE {_survive_tuple(cols)}"


def _matched_sql(table: str, keys: str, cols: list[str]) -> str:
    return _with(t=SQL_TABLES[table], k=SQL_KEYS[keys]) + f"SELECT * FROM t WHERE {_match_tuple(cols)}"


# ---------------------------------------------------------------- pure operators
def scan_matched(spark, d):                                    # S3, P1, J1
    return M.match_rows(_t(spark, d, "orders"), k_automobile(spark, d), ["o_custkey"])


def scan_matched_keys(spark, d):                               # S4
    return M.match_keys(orders_p(spark, d), k_automobile(spark, d), ["o_custkey"], ["order_month"])


def keys_tuple(spark, d):                                      # P3
    return M.match_rows(_t(spark, d, "lineitem"), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"])


def keys_per_column(spark, d):                                 # P2
    return M.match_rows(_t(spark, d, "lineitem"), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"],
                        match="per_column")


def inactive_only(spark, d):                                   # P4
    return M.survivors(orders_active(spark, d), k_building(spark, d), ["o_custkey"],
                       scope=F.col("active") == "0")


def survivors_single(spark, d):                                # J2 (broadcast behind a measured size check)
    keys = k_automobile(spark, d)
    return M.survivors(_t(spark, d, "orders"), keys, ["o_custkey"],
                       broadcast_keys=M.keys_fit_broadcast(keys, ["o_custkey"]))


def survivors_unhinted(spark, d):                              # J4 (shuffle join)
    return M.survivors(_t(spark, d, "orders"), k_automobile(spark, d), ["o_custkey"], broadcast_keys=False)


def survivors_composite(spark, d):                             # J3
    return M.survivors(_t(spark, d, "lineitem"), k_q1_items(spark, d), ["l_orderkey", "l_linenumber"])


def _impacted_months(spark, d):
    keys = k_returned_jan95(spark, d)
    return M.match_keys(lineitem_p(spark, d), keys, ["l_orderkey", "l_linenumber"], ["ship_month"]) \
        .select("ship_month").distinct()


def rows_in_impacted(spark, d):                                # J5
    return M.rows_in_partitions(lineitem_p(spark, d), _impacted_months(spark, d), ["ship_month"])


def survivors_in_impacted(spark, d):                           # J6
    return M.survivors_in_partitions(lineitem_p(spark, d), k_returned_jan95(spark, d), _impacted_months(spark, d),
                                     ["ship_month"], ["l_orderkey", "l_linenumber"])


def keys_not_found(spark, d):                                  # J7 (within a scope)
    return M.keys_not_found(_t(spark, d, "orders"), k_automobile(spark, d), ["o_custkey"],
                            scope=F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))


def distinct_keys_found(spark, d):                             # A4
    return M.keys_found(_t(spark, d, "lineitem"), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"])


def purge_effect(spark, d):                                    # A7 with A1-A3
    return E.purge_effect(lineitem_p(spark, d), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"],
                          ["ship_month"])


def impacted_partitions(spark, d):                             # A5
    eff = E.purge_effect(lineitem_p(spark, d), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"],
                         ["ship_month"])
    return E.impacted_partitions(eff, ["ship_month"])


def emptied_partitions(spark, d):                              # A6
    eff = E.purge_effect(events_p(spark, d), k_errors(spark, d), ["event_id"], ["event_type"])
    return E.emptied_partitions(eff, ["event_type"])


def surviving_partitions(spark, d):                            # A6
    eff = E.purge_effect(lineitem_p(spark, d), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"],
                         ["ship_month"])
    return E.surviving_partitions(eff, ["ship_month"])


def key_text_found(spark, d):                                  # F1
    found = M.keys_found(_t(spark, d, "lineitem"), k_returned_jan95(spark, d), ["l_orderkey", "l_linenumber"])
    return found.select("l_orderkey", "l_linenumber", key_text("l_orderkey", "l_linenumber").alias("key_text"))


def manifest_df(spark, d):
    """A manifest derived from the tables: erase AUTOMOBILE customers' orders,
    urgent pending orders, error events and toxic documents."""
    rows = [
        k_automobile(spark, d).select(F.lit("o_custkey").alias("PK"), F.col("o_custkey").cast("string").alias("PK_VALUE"),
                                      F.lit("orders_p").alias("TABLE_NAME"), F.lit("order_month").alias("PARTITION_COL")),
        _t(spark, d, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
        .select(F.lit("o_orderkey").alias("PK"), F.col("o_orderkey").cast("string").alias("PK_VALUE"),
                F.lit("orders_p").alias("TABLE_NAME"), F.lit("order_month").alias("PARTITION_COL")),
        k_errors(spark, d).select(F.lit("event_id").alias("PK"), F.col("event_id").cast("string").alias("PK_VALUE"),
                                  F.lit("events_p").alias("TABLE_NAME"), F.lit("event_type").alias("PARTITION_COL")),
        k_toxic(spark, d).select(F.lit("doc_id").alias("PK"), F.col("doc_id").cast("string").alias("PK_VALUE"),
                                 F.lit("documents_p").alias("TABLE_NAME"), F.lit("lang").alias("PARTITION_COL")),
    ]
    m = rows[0]
    for r in rows[1:]:
        m = m.unionByName(r)
    return m.select("PK", "PK_VALUE", F.lit("keysweep_scratch").alias("DATABASE_NAME"), "TABLE_NAME", "PARTITION_COL")


MANIFEST_SQL = (
    "SELECT 'o_custkey' AS PK, CAST(c_custkey AS VARCHAR) AS PK_VALUE, 'keysweep_scratch' AS DATABASE_NAME, "
    "'orders_p' AS TABLE_NAME, 'order_month' AS PARTITION_COL FROM customer WHERE c_mktsegment = 'AUTOMOBILE' "
    "UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS VARCHAR), 'keysweep_scratch', 'orders_p', 'order_month' "
    "FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' "
    "UNION ALL SELECT 'event_id', CAST(event_id AS VARCHAR), 'keysweep_scratch', 'events_p', 'event_type' "
    "FROM events WHERE event_type = 'error' "
    "UNION ALL SELECT 'doc_id', CAST(doc_id AS VARCHAR), 'keysweep_scratch', 'documents_p', 'lang' "
    "FROM labels WHERE toxic = 1")


def group_manifest(spark, d):                                  # A8, A9
    return E.group_manifest(K.split_manifest(manifest_df(spark, d))[0])


def read_manifest(spark, d):                                   # S7
    path = Scratch(spark).path("manifest")
    manifest_df(spark, d).write.option("header", True).csv(path)
    return K.read_manifest(spark, path)


def manifest_to_df(spark, d):                                  # S8 + F7
    m = K.split_manifest(manifest_df(spark, d))[0]
    keys = K.manifest_keys(m, "keysweep_scratch", "orders_p", "o_orderkey")
    typed = K.type_keys(keys, ["o_orderkey"], {"o_orderkey": _t(spark, d, "orders").schema["o_orderkey"].dataType})
    return typed.where("_ok").select("o_orderkey").distinct()


def read_key_list(spark, d):                                   # S5 + F7
    path = Scratch(spark).path("keys")
    k_q1_items(spark, d).write.option("header", True).csv(path)
    raw = K.read_key_list(spark, path)
    li = _t(spark, d, "lineitem").schema
    typed = K.type_keys(raw, ["l_orderkey", "l_linenumber"],
                        {c: li[c].dataType for c in ["l_orderkey", "l_linenumber"]})
    return typed.where("_ok").select("l_orderkey", "l_linenumber").distinct()


def read_key_values(spark, d):                                 # S6 + F7
    path = Scratch(spark).path("pk_values")
    k_automobile(spark, d).select(F.col("o_custkey").alias("PK_VALUE")).write.option("header", True).csv(path)
    raw = K.read_key_values(spark, path, "o_custkey")
    typed = K.type_keys(raw, ["o_custkey"], {"o_custkey": _t(spark, d, "orders").schema["o_custkey"].dataType})
    return typed.where("_ok").select("o_custkey").distinct()


# ---------------------------------------------------------------- catalog tables
def _copy(spark, df, base, parts=(), external=False, **how):
    return Scratch(spark).table(df, base, list(parts), external=external, **how)


def scan_table(spark, d):                                      # S1
    return C.scan_table(spark, _copy(spark, orders_p(spark, d), "orders_p", ["order_month"]))


def scan_partitions(spark, d):                                 # S2, P5
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    specs = [r.asDict() for r in _impacted_months(spark, d).collect()]
    return C.scan_partitions(spark, t, specs)


def returned_p(spark, d):
    """Line items by ship month; those never returned are in the NULL partition."""
    month = F.when(F.col("l_returnflag") != "N", F.date_format("l_shipdate", "yyyy-MM"))
    return _t(spark, d, "lineitem").withColumn("ship_month", month)


def scan_partitions_table(spark, d):                           # S2 with a table of specs, NULL among them
    t = _copy(spark, returned_p(spark, d), "returned_p", ["ship_month"])
    specs = _impacted_months(spark, d).unionAll(spark.createDataFrame([(None,)], "ship_month string"))
    return C.scan_partitions(spark, t, specs)


def survivors_in_null_partition(spark, d):                     # J5, J6 with a NULL partition
    t = _copy(spark, returned_p(spark, d), "returned_p", ["ship_month"])
    keys = k_q1_items(spark, d)
    hit = M.match_keys(spark.table(t), keys, _LI_KEYS, ["ship_month"])
    return M.survivors_in_partitions(spark.table(t), keys, hit.select("ship_month").distinct(), ["ship_month"], _LI_KEYS)


def list_table_files(spark, d):                                # S14
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    month = F.regexp_extract("file_path", "/ship_month=([^/]+)/[^/]+[.]parquet$", 1)
    return L.table_files(spark, t).groupBy(month.alias("ship_month")).agg(F.count(F.lit(1)).alias("files"))


def list_matched_files(spark, d):                              # S14, A7 by file
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    found = L.matched_files(spark.table(t), k_returned_jan95(spark, d), _LI_KEYS, ["ship_month"])
    folder = F.regexp_extract("file_path", "/(ship_month=[^/]+)/[^/]+[.]parquet$", 1)
    return found.select("ship_month", folder.alias("folder"), "rows_before", "rows_deleted", "rows_after")


def partition_list(spark, d):                                  # A10, F5
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    return C.partition_list(spark, t)


def _purged(spark, table: str) -> DataFrame:
    return spark.table(table)


def purge_single_key(spark, d):                                # O1 / O7, dynamic
    t = _copy(spark, orders_p(spark, d), "orders_p", ["order_month"])
    purge_table(spark, t, k_automobile(spark, d))
    return _purged(spark, t)


def purge_without_backup(spark, d):                            # O1, single pass (retention clean-up)
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    purge_table(spark, t, k_q1_items(spark, d), backup=False)
    return _purged(spark, t)


def purge_external_table(spark, d):                            # O1 on an EXTERNAL table
    t = _copy(spark, orders_p(spark, d), "orders_p_ext", ["order_month"], external=True)
    purge_table(spark, t, k_automobile(spark, d))
    return _purged(spark, t)


def purge_composite_tuple(spark, d):                           # O8 / P3 / J3
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    purge_table(spark, t, k_returned_jan95(spark, d))
    return _purged(spark, t)


def purge_composite_per_column(spark, d):                      # O8 / P2
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    purge_table(spark, t, k_returned_jan95(spark, d), match="per_column")
    return _purged(spark, t)


def purge_inactive_only(spark, d):                             # P4 inside O1
    t = _copy(spark, orders_active(spark, d), "orders_active", ["active"])
    purge_table(spark, t, k_building(spark, d))
    return _purged(spark, t)


def purge_emptied_partition(spark, d):                         # section 4.4 step 5, W4, W18
    t = _copy(spark, events_p(spark, d), "events_p", ["event_type"], external=True)
    purge_table(spark, t, k_errors(spark, d))
    return _purged(spark, t)


def purge_documents(spark, d):                                 # O1, keys from another table
    t = _copy(spark, documents_p(spark, d), "documents_p", ["lang"])
    purge_table(spark, t, k_toxic(spark, d))
    return _purged(spark, t)


def purge_plain_table(spark, d):                               # W2, W5, W7: non-partitioned
    t = _copy(spark, _t(spark, d, "conversations"), "conversations_plain")
    purge_table(spark, t, k_system_turns(spark, d))
    return _purged(spark, t)


def purge_multilevel(spark, d):                                # two partition levels
    t = _copy(spark, lineitem_ml(spark, d), "lineitem_ml", ["l_returnflag", "l_linestatus"])
    purge_table(spark, t, k_q1_items(spark, d))
    return _purged(spark, t)


def purge_static_insert(spark, d):                             # O4, W8, W9
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    purge_table(spark, t, k_returned_jan95(spark, d), strategy="static")
    return _purged(spark, t)


def purge_set_location(spark, d):                              # O3, W10
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    purge_table(spark, t, k_returned_jan95(spark, d), strategy="set_location")
    return _purged(spark, t)


def purge_move(spark, d):                                      # O3 as a folder move, W10
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"], external=True)
    purge_table(spark, t, k_returned_jan95(spark, d), strategy="move")
    return _purged(spark, t)


def purge_file_level(spark, d):                                # O1 by file: S14, W1, W5, W10
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"], spread=8, cluster_by=["l_orderkey"])
    purge_table(spark, t, k_q1_items(spark, d), strategy="files")
    return _purged(spark, t)


def purge_plain_by_file(spark, d):                             # W5: a plain table by file
    t = _copy(spark, _t(spark, d, "conversations"), "conversations_plain", spread=4, cluster_by=["conv_id"])
    purge_table(spark, t, k_system_turns(spark, d), strategy="files")
    return _purged(spark, t)


def purge_plain_pointer(spark, d):                             # W5, W10: a plain table switched by its location
    t = _copy(spark, _t(spark, d, "conversations"), "conversations_plain")
    purge_table(spark, t, k_system_turns(spark, d), strategy="pointer")
    return _purged(spark, t)


def purge_pointer(spark, d):                                   # W10: partitions switched by their locations, twice
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    purge_table(spark, t, k_returned_jan95(spark, d), strategy="pointer")
    purge_table(spark, t, k_q1_items(spark, d), strategy="pointer")
    return _purged(spark, t)


def restore_map_column(spark, d):                              # O10 on a table with a map column
    e = events_p(spark, d)
    e = e.withColumn("tags", F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string")))
    t = _copy(spark, e.select(*[c for c in e.columns if c != "event_type"], "event_type"), "events_map", ["event_type"])
    r = purge_table(spark, t, k_errors(spark, d))
    restore_backup(spark, t, r.backup_dir).collect()
    now = spark.table(t)
    return now.select(*[c for c in now.columns if c != "tags"], F.col("tags")["kind"].alias("kind"), F.col("tags")["user"].alias("user_tag"))


def restore_report(spark, d):                                  # O10, A11: the report, run twice
    t = _copy(spark, orders_p(spark, d), "orders_p", ["order_month"])
    r = purge_table(spark, t, k_automobile(spark, d))
    cols = ["rows_before", "rows_in_backup", "rows_restored", "rows_after", "status"]
    first = restore_backup(spark, t, r.backup_dir, delete_backup=False).select(F.lit(1).alias("call"), *cols)
    return first.unionByName(restore_backup(spark, t, r.backup_dir).select(F.lit(2).alias("call"), *cols))


def audit_lookup(spark, d):                                    # O11, W13: when was a key erased (two runs, one compacted)
    t = _copy(spark, events_p(spark, d), "events_p", ["event_type"])
    audit = Scratch(spark).path("audit")
    events = _t(spark, d, "events")
    first = purge_table(spark, t, k_errors(spark, d), audit_dir=audit)
    compact_audit_keys(spark, audit)
    purge_table(spark, t, events.where(F.col("event_type").isin("signup", "error")).select("event_id"), audit_dir=audit)
    found = erased_when(spark, audit, events.select("event_id"), t)
    run = F.when(F.col("run_id") == first.run_id, 1).otherwise(2)
    return found.select("event_id", run.alias("run"), "rows_deleted")


def compact_on_rewrite(spark, d):                              # W16: files and rows of the rewritten partitions
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"], spread=6)
    r = purge_table(spark, t, k_returned_jan95(spark, d))
    months = [x["spec"]["ship_month"] for x in r.impacted]
    month = F.regexp_extract("file_path", "/ship_month=([^/]+)/[^/]+[.]parquet$", 1)
    files = L.table_files(spark, t, [x["spec"] for x in r.impacted], ["ship_month"]).groupBy(month.alias("ship_month")).agg(F.count(F.lit(1)).alias("files"))
    rows = spark.table(t).where(F.col("ship_month").isin(months)).groupBy("ship_month").agg(F.count(F.lit(1)).alias("rows_after"))
    return files.join(rows, "ship_month").select("ship_month", "files", "rows_after")


def rebuild_impacted_side(spark, d):                           # O5, W12
    t = _copy(spark, lineitem_p(spark, d), "lineitem_p", ["ship_month"])
    r = purge_table(spark, t, k_returned_jan95(spark, d), strategy="side_impacted")
    return read_stage(spark, r.side_dir, spark.table(t).schema)


def full_refresh_side(spark, d):                               # O6, W11
    t = _copy(spark, orders_p(spark, d), "orders_p", ["order_month"])
    r = purge_table(spark, t, k_automobile(spark, d), strategy="side_full")
    return read_stage(spark, r.side_dir, spark.table(t).schema)


def backup_matched(spark, d):                                  # W3, S10
    t = _copy(spark, orders_p(spark, d), "orders_p", ["order_month"])
    r = purge_table(spark, t, k_automobile(spark, d))
    return read_backup(spark, r.backup_dir, spark.table(t).schema)


def restore_after_purge(spark, d):                             # O10
    t = _copy(spark, orders_p(spark, d), "orders_p", ["order_month"])
    r = purge_table(spark, t, k_automobile(spark, d))
    restore_backup(spark, t, r.backup_dir).collect()
    return _purged(spark, t)


_LI_KEYS = ["l_orderkey", "l_linenumber"]
_AUDIT_COLS = ["status", "total_records_before_deletion", "total_records_deleted", "total_records_after_deletion",
               "keys_requested", "keys_rejected", "keys_found", "partitions_impacted", "partitions_emptied"]


def write_audit(spark, d):                                     # O11, W13, F3, F4
    t = _copy(spark, events_p(spark, d), "events_p", ["event_type"])
    r = purge_table(spark, t, k_errors(spark, d))
    return r.audit.select(*_AUDIT_COLS)


def dry_run_report(spark, d):                                  # O9
    t = _copy(spark, orders_p(spark, d), "orders_p", ["order_month"])
    r = dry_run(spark, t, k_automobile(spark, d))
    rows_now = spark.table(t).count()
    return r.audit.select(*_AUDIT_COLS).withColumn("rows_in_table_after", F.lit(rows_now).cast("bigint"))


_MANIFEST_TABLES = {"orders_p": (orders_p, ["order_month"], "o_orderkey"),
                    "events_p": (events_p, ["event_type"], "event_id"),
                    "documents_p": (documents_p, ["lang"], "doc_id")}


def _manifest_purge(spark, d, strategy, stream=False, survivors=False):
    sc = Scratch(spark)
    names = {}
    m = manifest_df(spark, d)
    for logical, (fn, parts, _) in _MANIFEST_TABLES.items():
        names[logical] = sc.table(fn(spark, d), logical, parts)
        m = m.withColumn("TABLE_NAME", F.when(F.col("TABLE_NAME") == logical, F.lit(names[logical].split(".", 1)[1]))
                         .otherwise(F.col("TABLE_NAME")))
    path = sc.path("manifest")
    m.write.option("header", True).csv(path)
    if stream:
        from keysweep.streaming.requests import purge_requests_stream
        q = purge_requests_stream(spark, path, checkpoint_location=sc.path("stream_checkpoint"), strategy=strategy)
        q.awaitTermination()
    else:
        purge_manifest(spark, path, strategy=strategy)
    out = None
    for logical, (_, parts, key) in _MANIFEST_TABLES.items():
        if survivors:
            s = spark.table(names[logical]).select(F.lit(logical).alias("target"), F.col(parts[0]).alias("partition"), F.col(key).alias("key"))
            out = s if out is None else out.unionByName(s)
            continue
        s = spark.table(names[logical]).agg(F.lit(logical).alias("target"), F.count(F.lit(1)).alias("rows_after"),
                                            F.sum(key).cast("bigint").alias("key_sum"))
        out = s if out is None else out.unionByName(s)
    return out


def purge_manifest_stream(spark, d):                           # O2 fed by a file-arrival stream
    return _manifest_purge(spark, d, "dynamic", stream=True)


def purge_manifest_append(spark, d):                           # O2
    return _manifest_purge(spark, d, "dynamic")


def purge_manifest_insert(spark, d):                           # O4 from a manifest
    return _manifest_purge(spark, d, "static")


def purge_manifest_move(spark, d):                             # O3 from a manifest
    return _manifest_purge(spark, d, "move")


def purge_manifest_survivors(spark, d):                        # O2: every surviving row of every table
    return _manifest_purge(spark, d, "auto", survivors=True)


def purge_manifest_by_file(spark, d):                          # O3 by file: every surviving row of every table
    return _manifest_purge(spark, d, "files", survivors=True)


# ---------------------------------------------------------------- oracle SQL
_IMPACTED = (_with(t=SQL_TABLES["lineitem_p"], k=SQL_KEYS["returned_jan95"])
             + f"SELECT DISTINCT ship_month FROM t WHERE {_match_tuple(_LI_KEYS)}")
_EFFECT = (_with(t=SQL_TABLES["lineitem_p"], k=SQL_KEYS["returned_jan95"])
           + "SELECT ship_month, count(*) AS rows_before, "
           f"CAST(sum(CASE WHEN {_match_tuple(_LI_KEYS)} THEN 1 ELSE 0 END) AS BIGINT) AS rows_deleted, "
           f"CAST(sum(CASE WHEN {_match_tuple(_LI_KEYS)} THEN 0 ELSE 1 END) AS BIGINT) AS rows_after "
           "FROM t GROUP BY ship_month")
_MANIFEST_AFTER = (
    _with(a=SQL_KEYS["automobile"], e=SQL_KEYS["errors"], x=SQL_KEYS["toxic"])
    + "SELECT 'orders_p' AS target, count(*) AS rows_after, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders "
      "WHERE o_custkey NOT IN (SELECT o_custkey FROM a) "
      "AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') "
      "UNION ALL SELECT 'events_p', count(*), CAST(sum(event_id) AS BIGINT) FROM events "
      "WHERE event_id NOT IN (SELECT event_id FROM e) "
      "UNION ALL SELECT 'documents_p', count(*), CAST(sum(doc_id) AS BIGINT) FROM documents "
      "WHERE doc_id NOT IN (SELECT doc_id FROM x)")

_RETURNED_P = "SELECT *, CASE WHEN l_returnflag <> 'N' THEN strftime(l_shipdate, '%Y-%m') END AS ship_month FROM lineitem"

_MANIFEST_ROWS = (
    _with(a=SQL_KEYS["automobile"], e=SQL_KEYS["errors"], x=SQL_KEYS["toxic"])
    + "SELECT 'orders_p' AS target, strftime(o_orderdate, '%Y-%m') AS partition, o_orderkey AS key FROM orders "
      "WHERE o_custkey NOT IN (SELECT o_custkey FROM a) AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') "
      "UNION ALL SELECT 'events_p', event_type, event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM e) "
      "UNION ALL SELECT 'documents_p', lang, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM x)")

ORACLE_SQL: dict[str, str] = {
    "scan_matched": _matched_sql("orders", "automobile", ["o_custkey"]),
    "scan_matched_keys": _with(t=SQL_TABLES["orders_p"], k=SQL_KEYS["automobile"])
    + f"SELECT o_custkey, order_month FROM t WHERE {_match_tuple(['o_custkey'])}",
    "keys_tuple": _matched_sql("lineitem_ml", "returned_jan95", _LI_KEYS),
    "keys_per_column": _with(t=SQL_TABLES["lineitem_ml"], k=SQL_KEYS["returned_jan95"])
    + "SELECT * FROM t WHERE l_orderkey IN (SELECT l_orderkey FROM k) AND l_linenumber IN (SELECT l_linenumber FROM k)",
    "inactive_only": _with(t=SQL_TABLES["orders_active"], k=SQL_KEYS["building"])
    + f"SELECT * FROM t WHERE NOT ({_match_tuple(['o_custkey'])} AND active = '0')",
    "survivors_single": _survivors_sql("orders", "automobile", ["o_custkey"]),
    "survivors_unhinted": _survivors_sql("orders", "automobile", ["o_custkey"]),
    "survivors_composite": _survivors_sql("lineitem_ml", "q1_items", _LI_KEYS),
    "rows_in_impacted": _with(t=SQL_TABLES["lineitem_p"]) + f"SELECT * FROM t WHERE ship_month IN ({_IMPACTED})",
    "survivors_in_impacted": _with(t=SQL_TABLES["lineitem_p"], k=SQL_KEYS["returned_jan95"])
    + f"SELECT * FROM t WHERE ship_month IN ({_IMPACTED}) AND {_survive_tuple(_LI_KEYS)}",
    "keys_not_found": _with(k=SQL_KEYS["automobile"])
    + "SELECT o_custkey FROM k WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = k.o_custkey "
      "AND o.o_orderdate >= TIMESTAMP '2001-01-01')",
    "distinct_keys_found": _with(t=SQL_TABLES["lineitem_ml"], k=SQL_KEYS["returned_jan95"])
    + f"SELECT DISTINCT l_orderkey, l_linenumber FROM t WHERE {_match_tuple(_LI_KEYS)}",
    "purge_effect": f"SELECT * FROM ({_EFFECT}) WHERE rows_deleted > 0",
    "impacted_partitions": _IMPACTED,
    "emptied_partitions": _with(k=SQL_KEYS["errors"]) + "SELECT event_type FROM events GROUP BY event_type "
                          "HAVING count(*) FILTER (WHERE event_id NOT IN (SELECT event_id FROM k)) = 0",
    "surviving_partitions": f"SELECT ship_month FROM ({_EFFECT}) WHERE rows_deleted > 0 AND rows_after > 0",
    "key_text_found": _with(t=SQL_TABLES["lineitem_ml"], k=SQL_KEYS["returned_jan95"])
    + "SELECT DISTINCT l_orderkey, l_linenumber, "
      "'''' || CAST(l_orderkey AS VARCHAR) || '~' || CAST(l_linenumber AS VARCHAR) || '''' AS key_text "
      f"FROM t WHERE {_match_tuple(_LI_KEYS)}",
    "group_manifest": "SELECT DATABASE_NAME, TABLE_NAME, PK, PARTITION_COL, count(*) AS keys_requested, "
                      f"count(DISTINCT PK_VALUE) AS keys_distinct FROM ({MANIFEST_SQL}) "
                      "GROUP BY DATABASE_NAME, TABLE_NAME, PK, PARTITION_COL",
    "read_manifest": MANIFEST_SQL,
    "manifest_to_df": "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'",
    "read_key_list": f"SELECT DISTINCT l_orderkey, l_linenumber FROM ({SQL_KEYS['q1_items']})",
    "read_key_values": f"SELECT DISTINCT o_custkey FROM ({SQL_KEYS['automobile']})",
    "scan_table": SQL_TABLES["orders_p"],
    "scan_partitions": _with(t=SQL_TABLES["lineitem_p"]) + f"SELECT * FROM t WHERE ship_month IN ({_IMPACTED})",
    "scan_partitions_table": _with(t=_RETURNED_P) + f"SELECT * FROM t WHERE ship_month IN ({_IMPACTED}) OR ship_month IS NULL",
    "survivors_in_null_partition": _with(t=_RETURNED_P, k=SQL_KEYS["q1_items"])
    + "SELECT * FROM t WHERE EXISTS (SELECT 1 FROM t m WHERE m.ship_month IS NOT DISTINCT FROM t.ship_month "
      "AND EXISTS (SELECT 1 FROM k WHERE k.l_orderkey = m.l_orderkey AND k.l_linenumber = m.l_linenumber)) "
      f"AND {_survive_tuple(_LI_KEYS)}",
    "list_table_files": "SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, CAST(1 AS BIGINT) AS files FROM lineitem "
                        "GROUP BY strftime(l_shipdate, '%Y-%m')",
    "list_matched_files": f"SELECT ship_month, 'ship_month=' || ship_month AS folder, rows_before, rows_deleted, rows_after FROM ({_EFFECT}) "
                          "WHERE rows_deleted > 0",
    "purge_file_level": _survivors_sql("lineitem_p", "q1_items", _LI_KEYS),
    "purge_plain_by_file": _survivors_sql("conversations", "system_turns", ["conv_id", "turn"]),
    "purge_plain_pointer": _survivors_sql("conversations", "system_turns", ["conv_id", "turn"]),
    "purge_pointer": _with(t=SQL_TABLES["lineitem_p"], k=f"{SQL_KEYS['returned_jan95']} UNION {SQL_KEYS['q1_items']}")
    + f"SELECT * FROM t WHERE {_survive_tuple(_LI_KEYS)}",
    "restore_map_column": "SELECT *, event_type AS kind, CAST(user_id AS VARCHAR) AS user_tag FROM events",
    "restore_report": _with(k=SQL_KEYS["automobile"], t="SELECT count(*) AS n FROM orders",
                            b="SELECT count(*) AS n FROM orders WHERE o_custkey IN (SELECT o_custkey FROM k)")
    + "SELECT 1 AS call, t.n - b.n AS rows_before, b.n AS rows_in_backup, b.n AS rows_restored, t.n AS rows_after, 'DONE' AS status FROM t, b "
      "UNION ALL SELECT 2, t.n, b.n, CAST(0 AS BIGINT), t.n, 'DONE' FROM t, b",
    "audit_lookup": "SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS run, CAST(1 AS BIGINT) AS rows_deleted "
                    "FROM events WHERE event_type IN ('error', 'signup')",
    "compact_on_rewrite": f"SELECT ship_month, CAST(1 AS BIGINT) AS files, rows_after FROM ({_EFFECT}) WHERE rows_deleted > 0 AND rows_after > 0",
    "partition_list": "SELECT DISTINCT 'ship_month=' || strftime(l_shipdate, '%Y-%m') AS partition, "
                      "'ship_month' AS partition_column FROM lineitem",
    "purge_single_key": _survivors_sql("orders_p", "automobile", ["o_custkey"]),
    "purge_external_table": _survivors_sql("orders_p", "automobile", ["o_custkey"]),
    "purge_without_backup": _survivors_sql("lineitem_p", "q1_items", _LI_KEYS),
    "purge_composite_tuple": _survivors_sql("lineitem_p", "returned_jan95", _LI_KEYS),
    "purge_composite_per_column": _with(t=SQL_TABLES["lineitem_p"], k=SQL_KEYS["returned_jan95"])
    + "SELECT * FROM t WHERE NOT (l_orderkey IN (SELECT l_orderkey FROM k) "
      "AND l_linenumber IN (SELECT l_linenumber FROM k))",
    "purge_inactive_only": _with(t=SQL_TABLES["orders_active"], k=SQL_KEYS["building"])
    + f"SELECT * FROM t WHERE NOT ({_match_tuple(['o_custkey'])} AND active = '0')",
    "purge_emptied_partition": _survivors_sql("events_p", "errors", ["event_id"]),
    "purge_documents": _survivors_sql("documents_p", "toxic", ["doc_id"]),
    "purge_plain_table": _survivors_sql("conversations", "system_turns", ["conv_id", "turn"]),
    "purge_multilevel": _survivors_sql("lineitem_ml", "q1_items", _LI_KEYS),
    "purge_static_insert": _survivors_sql("lineitem_p", "returned_jan95", _LI_KEYS),
    "purge_set_location": _survivors_sql("lineitem_p", "returned_jan95", _LI_KEYS),
    "purge_move": _survivors_sql("lineitem_p", "returned_jan95", _LI_KEYS),
    "rebuild_impacted_side": _with(t=SQL_TABLES["lineitem_p"], k=SQL_KEYS["returned_jan95"])
    + f"SELECT * FROM t WHERE ship_month IN ({_IMPACTED}) AND {_survive_tuple(_LI_KEYS)}",
    "full_refresh_side": _survivors_sql("orders_p", "automobile", ["o_custkey"]),
    "backup_matched": _matched_sql("orders_p", "automobile", ["o_custkey"]),
    "restore_after_purge": SQL_TABLES["orders_p"],
    "write_audit": _with(k=SQL_KEYS["errors"])
    + "SELECT 'DONE' AS status, (SELECT count(*) FROM events) AS total_records_before_deletion, "
      "(SELECT count(*) FROM events WHERE event_id IN (SELECT event_id FROM k)) AS total_records_deleted, "
      "(SELECT count(*) FROM events WHERE event_id NOT IN (SELECT event_id FROM k)) AS total_records_after_deletion, "
      "(SELECT count(*) FROM k) AS keys_requested, CAST(0 AS BIGINT) AS keys_rejected, "
      "(SELECT count(DISTINCT event_id) FROM events WHERE event_id IN (SELECT event_id FROM k)) AS keys_found, "
      "(SELECT count(DISTINCT event_type) FROM events WHERE event_id IN (SELECT event_id FROM k)) AS partitions_impacted, "
      "CAST(1 AS BIGINT) AS partitions_emptied",
    "dry_run_report": _with(k=SQL_KEYS["automobile"], t=SQL_TABLES["orders_p"])
    + "SELECT 'DRY_RUN' AS status, (SELECT count(*) FROM t) AS total_records_before_deletion, "
      "CAST(0 AS BIGINT) AS total_records_deleted, (SELECT count(*) FROM t) AS total_records_after_deletion, "
      "(SELECT count(*) FROM k) AS keys_requested, CAST(0 AS BIGINT) AS keys_rejected, "
      "(SELECT count(DISTINCT o_custkey) FROM t WHERE o_custkey IN (SELECT o_custkey FROM k)) AS keys_found, "
      "(SELECT count(DISTINCT order_month) FROM t WHERE o_custkey IN (SELECT o_custkey FROM k)) AS partitions_impacted, "
      "CAST(0 AS BIGINT) AS partitions_emptied, (SELECT count(*) FROM t) AS rows_in_table_after",
    "purge_manifest_append": _MANIFEST_AFTER,
    "purge_manifest_insert": _MANIFEST_AFTER,
    "purge_manifest_move": _MANIFEST_AFTER,
    "purge_manifest_stream": _MANIFEST_AFTER,
    "purge_manifest_survivors": _MANIFEST_ROWS,
    "purge_manifest_by_file": _MANIFEST_ROWS,
}

SCENARIOS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: globals()[name] for name in ORACLE_SQL
}
