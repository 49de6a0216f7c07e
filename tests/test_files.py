"""Rewrite by file, file listings, compaction on rewrite and pruning by a table of partitions."""

import pytest
from pyspark.sql import functions as F

from keysweep.operators.match import rows_in_partitions, survivors_in_partitions
from keysweep.plans import purge as P
from keysweep.plans.purge import purge_table
from keysweep.plans.restore import restore_backup
from keysweep.session import session_conf
from keysweep.sinks import fs, publish
from keysweep.sources import catalog as C
from keysweep.sources.files import files_fingerprint, list_folders, matched_files, table_files, with_file
from tests.conftest import rows


def _keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "k long")


def _table(spark, scratch, name, parts=("p",), n=400, spread=5):
    """Keys 0..n-1 in ``spread`` ranges; partitions a, b and NULL, each with a file for each range."""
    values = ["a", "b", None]
    df = spark.createDataFrame([(i, f"v{i}", values[i % 3]) for i in range(n)] + [(5000, "v", "gone")], "k long, v string, p string")
    return scratch.table(df, name, list(parts), spread=spread, cluster_by=["k"])


def _ids(df):
    return sorted(r[0] for r in df.select("k").collect())


def _listing(spark, t):
    return {r.file_path: (r.file_size, r.modified) for r in table_files(spark, t).collect()}


@pytest.mark.parametrize("parts", [("p",), ()])
@pytest.mark.parametrize("shuffle", [False, True])
def test_other_files_keep_name_size_and_time(spark, scratch, parts, shuffle):
    t = _table(spark, scratch, f"by_file_{len(parts)}_{shuffle}", parts)
    before, original = _listing(spark, t), rows(spark.table(t))
    gone = [0, 1, 2, 3, 5000]                             # first range only, and a partition that loses its only row
    hit = {r.file_path: r.rows_after for r in matched_files(spark.table(t), _keys(spark, *gone), ["k"], list(parts)).collect()}
    r = purge_table(spark, t, _keys(spark, *gone, 9999), strategy="files", broadcast_max_bytes=0 if shuffle else None)
    assert r.status == "DONE" and r.rows_deleted == 5
    after = _listing(spark, t)
    assert 0 < len(hit) < len(before)
    assert {f: x for f, x in after.items() if f not in hit} == {f: x for f, x in before.items() if f not in hit}
    assert set(after) == {f for f in before if hit.get(f, 1) > 0}               # same names; emptied files are gone
    assert _ids(spark.table(t)) == [i for i in range(400) if i not in gone]
    assert not fs.exists(spark, f"{r.run_dir}/split")
    out = restore_backup(spark, t, r.backup_dir).first()
    assert out.rows_restored == 5 and rows(spark.table(t)) == original


def test_a_file_of_many_row_groups_stays_one_file(spark, scratch):
    df = spark.range(0, 20000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a").alias("p"))
    t = scratch.table(df, "one_file", ["p"], spread=1)
    before = _listing(spark, t)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")              # the caller's setting would split the file
    try:
        r = purge_table(spark, t, _keys(spark, 7, 19999), strategy="files")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    assert r.status == "DONE" and set(_listing(spark, t)) == set(before) and spark.table(t).count() == 19998


@pytest.mark.parametrize("broken", [1, 2])
def test_broken_file_publish_is_finished(spark, scratch, monkeypatch, broken):
    t = _table(spark, scratch, f"broken_files_{broken}")
    gone = list(range(0, 400, 40)) + [5000]
    want = [i for i in range(400) if i not in gone]
    real, calls = publish.fs.replace, []

    def dies(*a):
        calls.append(1)
        if len(calls) == broken:
            raise RuntimeError("connection lost")
        return real(*a)

    with monkeypatch.context() as m:
        m.setattr(publish.fs, "replace", dies)
        with pytest.raises(P.PurgeError):
            purge_table(spark, t, _keys(spark, *gone), strategy="files")
    again = purge_table(spark, t, _keys(spark, *gone), strategy="files")
    assert again.status == "NOOP" and _ids(spark.table(t)) == want


def test_changed_file_aborts(spark, scratch, monkeypatch):
    t = _table(spark, scratch, "changed_files")
    real = publish.write_split

    def interfere(*a, **k):
        got = real(*a, **k)
        spark.createDataFrame([(1, "new", "a")], "k long, v string, p string").write.insertInto(t)
        return got

    monkeypatch.setattr(publish, "write_split", interfere)
    r = purge_table(spark, t, _keys(spark, 0, 3), strategy="files")
    assert r.status == "FAILED" and spark.table(t).count() == 402


def test_files_without_rows_are_no_change(spark, scratch):
    t = _table(spark, scratch, "empty_file")
    folder = C.describe_table(spark, t).location.replace("file:", "") + "/p=a"
    spark.createDataFrame([], "k long, v string").coalesce(1).write.mode("append").parquet(folder)
    spark.catalog.refreshTable(t)
    for strategy in ("files", "move"):
        assert purge_table(spark, t, _keys(spark, 0 if strategy == "files" else 3), strategy=strategy).status == "DONE"


def test_listing_is_one_row_a_file(spark, scratch):
    t = _table(spark, scratch, "listing")
    listed = table_files(spark, t)
    assert listed.count() == len(spark.table(t).inputFiles()) == 16
    assert files_fingerprint(listed) == files_fingerprint(table_files(spark, t))
    some = table_files(spark, t, [{"p": "a"}, {"p": None}], ["p"])
    assert some.count() == 10
    assert list_folders(spark, ["/no/such/folder"]).count() == 0
    per_file = matched_files(spark.table(t), _keys(spark, 0, 3, 4), ["k"], ["p"], scope=F.col("p") == "a", matched_only=False)
    assert per_file.agg(F.sum("rows_before"), F.sum("rows_deleted")).first()[:] == (401, 2)


def test_partition_at_its_own_location(spark, scratch):
    t = _table(spark, scratch, "elsewhere")
    assert purge_table(spark, t, _keys(spark, 0), strategy="set_location").status == "DONE"
    assert purge_table(spark, t, _keys(spark, 3), strategy="files").status == "DONE"
    assert rows(spark.table(t).where("k < 6"), ["k"]) == [(1,), (2,), (4,), (5,)]


@pytest.mark.parametrize("strategy", ["move", "dynamic", "static", "set_location", "side_impacted"])
def test_compaction(spark, scratch, strategy):
    t = _table(spark, scratch, f"small_{strategy}", spread=8)
    want = rows(spark.table(t).where("k not in (0, 2)"))                       # partitions a and NULL
    r = purge_table(spark, t, _keys(spark, 0, 2), strategy=strategy)
    if strategy == "side_impacted":
        files = [f.file_path for f in list_folders(spark, [r.side_dir]).collect()]
        assert len(files) == 2
        return
    assert r.status == "DONE" and rows(spark.table(t)) == want
    found = {x["spec"]["p"]: table_files(spark, t, [x["spec"]], ["p"]).count() for x in r.impacted}
    assert found == {"a": 1, None: 1} and table_files(spark, t, [{"p": "b"}], ["p"]).count() == 8


def test_compaction_by_bytes(spark, scratch):
    df = spark.range(0, 6000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"),
                                     F.when(F.col("id") < 5000, "big").otherwise("small").alias("p"))
    t = scratch.table(df, "by_bytes", ["p"], spread=12)
    size = {p: table_files(spark, t, [{"p": p}], ["p"]).agg(F.sum("file_size")).first()[0] for p in ("big", "small")}
    target = size["big"] // 4 + 1
    r = purge_table(spark, t, _keys(spark, 1, 5999), compact=True, target_file_bytes=target)
    assert r.status == "DONE" and spark.table(t).count() == 5998
    n = {p: table_files(spark, t, [{"p": p}], ["p"]).count() for p in ("big", "small")}
    assert n == {"big": 4, "small": 1}
    left = purge_table(spark, t, _keys(spark, 2), compact=False)
    assert left.status == "DONE"


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_partition_table_prunes_the_scan(spark, scratch):
    t = _table(spark, scratch, "pruned")
    for values in (["a"], ["a", None], [None], []):
        specs = spark.createDataFrame([(v,) for v in values], "p string")
        got = C.scan_partitions(spark, t, specs)
        assert rows(got, ["k"]) == rows(C.scan_partitions(spark, t, [{"p": v} for v in values]), ["k"])
    specs = spark.createDataFrame([("a",), (None,)], "p string")
    df = rows_in_partitions(spark.table(t), specs, ["p"], broadcast_partitions=True)
    plan = _plan(df)
    assert "dynamicpruning" in plan and "isnull(p" in plan.split("PartitionFilters", 2)[2].split("\n")[0]
    assert "SortMergeJoin" not in plan
    kept = survivors_in_partitions(spark.table(t), _keys(spark, 0, 2), specs, ["p"], ["k"], broadcast_partitions=True)
    assert _ids(kept) == [i for i in range(400) if i % 3 != 1 and i not in (0, 2)]


def test_rows_in_partitions_two_levels(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, None, 1), (4, None, None), (5, "b", 1)], "k int, p string, q int")
    specs = spark.createDataFrame([("a", None), (None, None), ("b", 1), ("b", 1), ("z", 9)], "p string, q int")
    assert rows(rows_in_partitions(df, specs, ["p", "q"]), ["k"]) == [(2,), (4,), (5,)]


def test_names_of_tables(spark, scratch):
    t = _table(spark, scratch, "names")
    db, tbl = t.split(".")
    for name in (t, f"`{db}`.`{tbl}`", f"spark_catalog.{t}", f"spark_catalog.`{db}`.{tbl}"):
        assert C.describe_table(spark, name).name == t
        assert C.table_location(spark, name) == C.describe_table(spark, t).location
        assert C.partition_list(spark, name).count() == 4
    with pytest.raises(ValueError):
        C.describe_table(spark, f"other.{t}")
    assert purge_table(spark, f"spark_catalog.{t}", _keys(spark, 0)).status == "DONE"


def test_copies_of_large_partitions_are_dealt_to_many_tasks(spark, scratch, monkeypatch):
    import keysweep.scratch as scratch_module

    monkeypatch.setattr(scratch_module, "TASK_BYTES", 20_000)
    df = spark.range(4000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10).alias("text"),
                                  F.when(F.col("id") % 10 < 8, "big").when(F.col("id") % 10 == 8, "small").alias("p"))
    t = scratch.table(df, "dealt", ["p"])
    per_file = with_file(spark.table(t)).groupBy("p", "_file").count().collect()
    files = {p: [r["count"] for r in per_file if r.p == p] for p in ("big", "small", None)}
    assert len(files["big"]) == 6 and max(files["big"]) < 800 and len(files["small"]) == len(files[None]) == 1
    assert sorted(map(tuple, spark.table(t).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    for how in ({"spread": 3}, {"spread": 3, "cluster_by": ["k"]}):
        t = scratch.table(df, "spread", ["p"], **how)
        per_file = with_file(spark.table(t)).groupBy("p", "_file").count().collect()
        assert all(1 <= sum(r.p == p for r in per_file) <= 3 for p in ("big", "small", None))
        assert spark.table(t).count() == 4000 and spark.table(t).select("k").distinct().count() == 4000


def test_partitioned_writes_do_not_sort_every_row(spark, scratch):
    from keysweep.sinks.publish import UNSORTED

    assert int(UNSORTED["spark.sql.maxConcurrentOutputFileWriters"]) > 0
    t = _table(spark, scratch, "unsorted", spread=2)
    r = purge_table(spark, t, spark.range(50).select(F.col("id").alias("k")), explain=True)
    assert r.status == "DONE" and spark.table(t).count() == 351
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_rows_of_the_null_partition_are_not_shuffled(spark, scratch):
    t = _table(spark, scratch, "null_rows")
    specs = spark.createDataFrame([(None,), ("a",)], "p string").repartition(2)
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        got = rows_in_partitions(spark.table(t), specs, ["p"])
        plan = P._plan(got)
        assert plan.count("SortMergeJoin LeftSemi") <= 2 and "Broadcast" in plan
        assert _ids(got) == [i for i in range(400) if i % 3 != 1]
