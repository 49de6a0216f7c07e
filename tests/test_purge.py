"""End-to-end purges on scratch catalog tables: the invariants of the build plan."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from keysweep import scenarios as S
from keysweep.plans.manifest import purge_manifest
from keysweep.plans.purge import purge_table
from keysweep.plans.restore import restore_backup
from keysweep.sinks import fs
from tests.conftest import rows


def _local(path):
    return path.replace("file:", "")


def _files(spark, table):
    return sorted(r[0] for r in spark.table(table).select(F.input_file_name()).distinct().collect())


def test_invariants_orders(spark, sf, scratch):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    original = rows(spark.table(t))
    keys = S.k_automobile(spark, sf)
    r = purge_table(spark, t, keys)
    assert r.status == "DONE"
    assert r.rows_before == len(original) == r.rows_after + r.rows_deleted
    assert spark.table(t).count() == r.rows_after
    backup = spark.read.schema(spark.table(t).schema).parquet(r.backup_dir)
    assert backup.count() == r.rows_deleted                                   # backup = deleted
    assert not fs.exists(spark, f"{r.run_dir}/split/_deleted=false")           # no stage left
    assert r.strategy == "move" and not fs.exists(spark, f"{r.run_dir}/replaced")  # no replaced folder left
    audit = r.audit.first()
    assert audit.total_records_deleted == r.rows_deleted and audit.status == "DONE"
    again = purge_table(spark, t, S.k_automobile(spark, sf))                  # purge twice = once
    assert again.status == "NOOP" and spark.table(t).count() == r.rows_after
    out = restore_backup(spark, t, r.backup_dir).first()                      # restore = original
    assert out.status == "DONE" and out.rows_restored == r.rows_deleted
    assert rows(spark.table(t)) == original
    out2 = restore_backup(spark, t, r.backup_dir, delete_backup=False)        # backup already gone -> 0
    assert out2.first().rows_restored == 0 and rows(spark.table(t)) == original


def test_untouched_partitions_keep_files(spark, sf, scratch):
    t = scratch.table(S.lineitem_p(spark, sf), "lineitem_p", ["ship_month"])
    before = _files(spark, t)
    r = purge_table(spark, t, S.k_returned_jan95(spark, sf))
    impacted = {x["spec"]["ship_month"] for x in r.impacted}
    after = _files(spark, t)
    kept = [f for f in before if not any(f"ship_month={m}/" in f for m in impacted)]
    assert kept and set(kept) <= set(after)
    assert all(f not in after for f in before if f not in kept)


def test_emptied_partition_external(spark, sf, scratch):
    t = scratch.table(S.events_p(spark, sf), "events_p", ["event_type"], external=True)
    r = purge_table(spark, t, S.k_errors(spark, sf))
    assert r.emptied == [{"event_type": "error"}]
    parts = [x.partition for x in spark.sql(f"SHOW PARTITIONS {t}").collect()]
    assert "event_type=error" not in parts
    loc = _local(spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first().data_type)
    assert not glob.glob(f"{loc}/event_type=error/*.parquet")                 # files really gone
    spark.sql(f"MSCK REPAIR TABLE {t}")
    assert spark.table(t).where("event_type = 'error'").count() == 0


def test_dry_run_and_noop(spark, sf, scratch):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    n = spark.table(t).count()
    r = purge_table(spark, t, S.k_automobile(spark, sf), dry_run=True)
    assert r.status == "DRY_RUN" and r.rows_deleted > 0 and spark.table(t).count() == n
    none = spark.table(t).select((F.col("o_custkey") + 1_000_000).alias("o_custkey"))
    r2 = purge_table(spark, t, none)
    assert r2.status == "NOOP" and r2.keys_found == 0 and r2.keys_requested == n       # every input line
    assert r2.not_found(spark).count() == none.distinct().count()                      # distinct tuples
    assert r2.audit.first().status == "NOOP"


def test_rejects_do_not_block(spark, sf, scratch, tmp_path):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    some = [r.o_custkey for r in spark.table(t).select("o_custkey").distinct().orderBy("o_custkey").limit(2).collect()]
    p = tmp_path / "keys.csv"
    p.write_text("o_custkey\n" + f"{some[0]}\n00{some[1]}\n\nabc\n1.0\n{some[0]}\n")
    n_match = spark.table(t).where(F.col("o_custkey").isin(some)).count()
    r = purge_table(spark, t, str(p))
    assert r.status == "DONE" and r.rows_deleted == n_match
    assert r.keys_rejected == 2 and sorted(x.key_text for x in r.rejects(spark).collect()) == ["1.0", "abc"]
    assert r.audit.first().input_file_name == str(p)


def test_strategies_agree(spark, sf, scratch):
    expected = None
    for strategy in ("dynamic", "direct", "static", "move", "set_location"):
        t = scratch.table(S.lineitem_p(spark, sf), "lineitem_p", ["ship_month"])
        r = purge_table(spark, t, S.k_returned_jan95(spark, sf), strategy=strategy)
        got = rows(spark.table(t))
        expected = expected or got
        assert r.status == "DONE" and got == expected
    t = scratch.table(S.lineitem_p(spark, sf), "lineitem_p", ["ship_month"])
    r = purge_table(spark, t, S.k_returned_jan95(spark, sf), strategy="side_full")
    side = spark.read.schema(spark.table(t).schema).parquet(r.side_dir)
    assert r.status == "SIDE_COPY" and rows(side) == expected and spark.table(t).count() == r.rows_before


def test_set_location_removes_old_files(spark, sf, scratch):
    t = scratch.table(S.lineitem_p(spark, sf), "lineitem_p", ["ship_month"])
    loc = _local(spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first().data_type)
    r = purge_table(spark, t, S.k_returned_jan95(spark, sf), strategy="set_location")
    for x in r.impacted:
        if x["rows_before"] > x["rows_deleted"]:
            assert not os.path.exists(f"{loc}/ship_month={x['spec']['ship_month']}")


def test_shuffle_path_with_hot_keys(spark, sf, scratch):
    t1 = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    t2 = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    a = purge_table(spark, t1, S.k_automobile(spark, sf))
    # 100 bytes: too small for the found keys (so the rewrite shuffles), room for the three heaviest keys
    b = purge_table(spark, t2, S.k_automobile(spark, sf), broadcast_max_bytes=100, hot_key_rows=2, explain=True)
    assert "_salt_0" in b.plans["rewrite"] and "SortMergeJoin" in b.plans["rewrite"]
    assert a.rows_deleted == b.rows_deleted and rows(spark.table(t1)) == rows(spark.table(t2))


def test_zero_padded_and_null_partitions(spark, scratch):
    df = spark.createDataFrame([(1, "a", "007"), (2, "b", "008"), (3, "c", "010"), (4, "d", None), (5, "e", None),
                                (None, "f", "007")], "k long, v string, p string")
    t = scratch.table(df, "zero_padded", ["p"])
    keys = spark.createDataFrame([(1,), (4,), (3,)], "k long")
    r = purge_table(spark, t, keys)
    assert r.status == "DONE"
    assert rows(spark.table(t), ["k", "p"]) == [(2, "008"), (5, None), (None, "007")]
    parts = sorted(x.partition for x in spark.sql(f"SHOW PARTITIONS {t}").collect())
    assert "p=7" not in parts and "p=010" not in parts and "p=007" in parts


def test_multilevel_and_plain(spark, sf, scratch):
    t = scratch.table(S.lineitem_ml(spark, sf), "lineitem_ml", ["l_returnflag", "l_linestatus"])
    r = purge_table(spark, t, S.k_q1_items(spark, sf))
    assert r.status == "DONE" and spark.table(t).count() == r.rows_after
    t2 = scratch.table(spark.read.parquet(f"{sf}/conversations.parquet"), "conversations_plain")
    r2 = purge_table(spark, t2, S.k_system_turns(spark, sf))
    assert r2.status == "DONE" and spark.table(t2).where("role = 'system'").count() == 0


def test_active_scope(spark, sf, scratch):
    t = scratch.table(S.orders_active(spark, sf), "orders_active", ["active"])
    open_before = spark.table(t).where("active = '1'").count()
    n = spark.table(t).count()
    r = purge_table(spark, t, S.k_building(spark, sf), explain=True)
    assert r.status == "DONE" and spark.table(t).where("active = '1'").count() == open_before
    assert [x["spec"] for x in r.impacted] == [{"active": "0"}] and r.rows_before == n
    pf = [ln for ln in r.plans["effect"].splitlines() if ln.startswith("PartitionFilters")]
    assert pf and "active" in pf[0]                                          # scope prunes the effect scan


def test_manifest_two_groups_and_bad_row(spark, sf, scratch, tmp_path):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    db, name = t.split(".")
    o = spark.table(t).orderBy("o_orderkey").limit(3).collect()
    p = tmp_path / "m.csv"
    p.write_text("PK,PK_VALUE,DATABASE_NAME,TABLE_NAME,PARTITION_COL\n"
                 f"o_custkey,{o[0].o_custkey},{db},{name},order_month\n"
                 f"o_orderkey,{o[1].o_orderkey},{db},{name},\n"
                 f"o_orderkey,{o[2].o_orderkey},{db},,\n"
                 f"o_orderkey,1,{db},no_such_table,\n")
    res = purge_manifest(spark, str(p))
    assert res.n_rejects == 1 and len(res.failures) == 1
    r = res.by_table()[t]
    expect = spark.read.parquet(f"{sf}/orders.parquet").where(
        (F.col("o_custkey") == o[0].o_custkey) | (F.col("o_orderkey") == o[1].o_orderkey)).count()
    assert r.rows_deleted == expect and spark.table(t).count() == r.rows_before - expect
    assert res.audit().count() == 2


@pytest.mark.parametrize("strategy", ["auto", "dynamic"])
def test_publish_failure_keeps_live_data(spark, sf, scratch, monkeypatch, strategy):
    from keysweep.plans import purge as P
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    original = rows(spark.table(t))

    def boom(*a, **k):
        raise RuntimeError("simulated publish failure")
    monkeypatch.setattr(P.publish, "publish_move" if strategy == "auto" else "publish_dynamic", boom)
    with pytest.raises(P.PurgeError) as err:
        purge_table(spark, t, S.k_automobile(spark, sf), strategy=strategy)
    assert err.value.result.status == "FAILED"
    assert rows(spark.table(t)) == original


def test_null_partition_emptied(spark, scratch):
    df = spark.createDataFrame([(1, "007"), (4, None), (5, None)], "k long, p string")
    t = scratch.table(df, "null_keys", ["p"], external=True)
    r = purge_table(spark, t, spark.createDataFrame([(4,), (5,)], "k long"))
    assert r.emptied == [{"p": None}]
    assert rows(spark.table(t), ["k", "p"]) == [(1, "007")]
    spark.sql(f"MSCK REPAIR TABLE {t}")
    assert spark.table(t).count() == 1


def test_key_header_case_insensitive(spark, sf, scratch, tmp_path):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    k = spark.table(t).select("o_custkey").first()[0]
    p = tmp_path / "keys.csv"
    p.write_text(f"O_CUSTKEY\n{k}\n")
    r = purge_table(spark, t, str(p))
    assert r.status == "DONE" and spark.table(t).where(F.col("o_custkey") == k).count() == 0


def test_restore_by_keys(spark, sf, scratch):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    original = rows(spark.table(t))
    r = purge_table(spark, t, S.k_automobile(spark, sf))
    out = restore_backup(spark, t, r.backup_dir, key_cols=["o_custkey"], delete_backup=False).first()
    assert out.rows_restored == r.rows_deleted and rows(spark.table(t)) == original
    again = restore_backup(spark, t, r.backup_dir, key_cols=["o_custkey"]).first()
    assert again.rows_restored == 0 and rows(spark.table(t)) == original


def test_typed_multilevel_partitions(spark, sf, scratch):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    df = (o.withColumn("o_year", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("int"))
                       .otherwise(F.year("o_orderdate")))
          .withColumn("o_day", F.to_date(F.date_trunc("month", "o_orderdate"))))
    t = scratch.table(df, "orders_typed", ["o_year", "o_day"])
    assert dict(spark.table(t).dtypes)["o_year"] == "int" and dict(spark.table(t).dtypes)["o_day"] == "date"
    keys = S.k_automobile(spark, sf)
    expected = rows(df.join(keys, "o_custkey", "left_anti").select(*spark.table(t).columns))
    r = purge_table(spark, t, keys)
    assert r.status == "DONE" and any(x["spec"]["o_year"] is None for x in r.impacted)
    assert rows(spark.table(t)) == expected


def test_concurrent_change_aborts(spark, sf, scratch, monkeypatch):
    from keysweep.sinks import publish as PB
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    real = PB.write_split

    def write_then_interfere(flagged, path, info, rebalance=False):
        got = real(flagged, path, info, rebalance)
        extra = spark.table(t).limit(1)                     # another writer appends to an impacted partition
        rows_ = extra.collect()
        spark.createDataFrame(rows_, spark.table(t).schema).write.insertInto(t)
        return got
    monkeypatch.setattr(PB, "write_split", write_then_interfere)
    n = spark.table(t).count()
    r = purge_table(spark, t, S.k_automobile(spark, sf), strategy="dynamic")
    assert r.status == "FAILED" and spark.table(t).count() == n + 1      # nothing published


def test_concurrent_change_aborts_direct(spark, sf, scratch, monkeypatch):
    from keysweep.plans import purge as P
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    real, calls = P.files_fingerprint, []

    def fingerprint_with_interference(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:                                  # after the backup pass, before the overwrite
            rows_ = spark.table(t).limit(1).collect()
            spark.createDataFrame(rows_, spark.table(t).schema).write.insertInto(t)
        return real(*args, **kwargs)
    monkeypatch.setattr(P, "files_fingerprint", fingerprint_with_interference)
    n = spark.table(t).count()
    r = purge_table(spark, t, S.k_automobile(spark, sf), strategy="direct")
    assert r.status == "FAILED" and spark.table(t).count() == n + 1


def test_header_only_key_list_is_noop(spark, sf, scratch, tmp_path):
    t = scratch.table(S.orders_p(spark, sf), "orders_p", ["order_month"])
    p = tmp_path / "empty.csv"
    p.write_text("o_custkey\n")
    r = purge_table(spark, t, str(p))
    assert r.status == "NOOP" and r.keys_requested == 0 and r.audit.first().status == "NOOP"


def test_string_keys_with_quotes_and_padding(spark, scratch, tmp_path):
    df = spark.createDataFrame([("O'Neil", 1, "a"), ("001", 2, "a"), ("1", 3, "b"), ("x", 4, "b")],
                               "name string, v int, p string")
    t = scratch.table(df, "names", ["p"])
    p = tmp_path / "k.csv"
    p.write_text('name\n"O\'Neil"\n001\n')
    r = purge_table(spark, t, str(p))
    assert r.status == "DONE" and r.rows_deleted == 2
    assert rows(spark.table(t), ["name"]) == [("1",), ("x",)]
    where = r.audit.first().deleted_keys_and_values                            # the keys side table, whatever the number
    assert rows(spark.read.parquet(f"{where}/*").select("key_text")) == [("'001'",), ("'O'Neil'",)]


def test_nothing_written_inside_table_folder(spark, sf, scratch):
    for strategy in ("direct", "dynamic", "move"):
        t = scratch.table(S.events_p(spark, sf), "events_p", ["event_type"], external=True)
        loc = _local(spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first().data_type)
        early = spark.read.parquet(f"{sf}/events.parquet").where(
            (F.col("event_type") == "error") & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
        r = purge_table(spark, t, early.select("event_id"), strategy=strategy)   # error partition keeps rows
        assert r.status == "DONE"
        entries = sorted(e for e in os.listdir(loc) if not e.startswith((".", "_")))   # hidden, as Spark reads
        assert entries and all(e.startswith("event_type=") for e in entries), (strategy, entries)
        assert not r.backup_dir.startswith(loc)


@pytest.mark.parametrize("strategy, how, backup", [("pointer", "tuple", True), ("files", "tuple", True),
                                                   ("dynamic", "tuple", False), ("move", "per_column", True)])
def test_rows_without_a_match_are_not_shuffled(spark, scratch, strategy, how, backup):
    df = spark.range(2000).select((F.col("id") % 900).alias("k"), (F.col("id") % 4).cast("int").alias("n"),
                                  F.when(F.col("id") % 5 > 0, F.col("id") % 5).cast("string").alias("p"))
    df = df.unionAll(spark.createDataFrame([(None, 1, "1"), (5, None, None)], "k long, n int, p string"))
    keys = df.where("k % 40 = 0").select("k", "n").distinct()
    want = sorted((r for r in df.collect() if r.k is None or r.n is None or r.k % 40), key=repr)
    t = scratch.table(df, "no_shuffle", ["p"])
    r = purge_table(spark, t, keys, match=how, strategy=strategy, backup=backup, broadcast_max_bytes=0, explain=True)
    assert r.status == "DONE" and "getbit" in r.plans["effect"] and "getbit" in r.plans["rewrite"]
    assert sorted(spark.table(t).collect(), key=repr) == want
