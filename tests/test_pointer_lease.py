"""Publishing by pointer, leases, restore by counts, and the audit's key index."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from keysweep.plans import purge as P
from keysweep.plans.purge import purge_table
from keysweep.plans.repair import repair_publish
from keysweep.plans.restore import missing_rows, restore_backup
from keysweep.session import work_root
from keysweep.sinks import fs, publish
from keysweep.sinks.audit import compact_audit_keys, erased_when
from keysweep.sinks.lease import Lease, LeaseError, LeaseLost
from keysweep.sources import catalog as C
from tests.conftest import rows


def _keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "k long")


def _table(spark, scratch, name, parts=("p",), n=30):
    df = spark.createDataFrame([(i, f"v{i}", "ab"[i % 2]) for i in range(n)] + [(500, "v", "gone")], "k long, v string, p string")
    return scratch.table(df, name, list(parts))


def _ids(df):
    return sorted(r[0] for r in df.select("k").collect())


@pytest.mark.parametrize("parts", [("p",), ()])
def test_pointer_leaves_no_erased_row_behind(spark, scratch, parts):
    t = _table(spark, scratch, f"pointer_{len(parts)}", parts)
    old = [fs.from_uri(spark, p) for p in spark.table(t).inputFiles()]
    first = purge_table(spark, t, _keys(spark, 0, 1, 500), strategy="pointer")
    assert first.status == "DONE" and _ids(spark.table(t)) == list(range(2, 30))
    assert not any(fs.exists(spark, f) for f in old)
    middle = [fs.from_uri(spark, p) for p in spark.table(t).inputFiles()]
    second = purge_table(spark, t, _keys(spark, 2), strategy="pointer", backup=False)
    assert second.status == "DONE" and _ids(spark.table(t)) == list(range(3, 30))
    now = [fs.from_uri(spark, p) for p in spark.table(t).inputFiles()]
    assert sum(p.count(publish.VERSIONS) for p in now) <= len(now)      # versions do not nest
    assert not any(fs.exists(spark, f) for f in set(middle) - set(now))
    assert restore_backup(spark, t, first.backup_dir).first().rows_restored == 3
    assert _ids(spark.table(t)) == [0, 1, *range(3, 30), 500]


def test_pointer_of_a_plain_table_that_loses_every_row(spark, scratch):
    t = _table(spark, scratch, "pointer_all", ())
    r = purge_table(spark, t, _keys(spark, *range(30), 500), strategy="pointer")
    assert r.status == "DONE" and spark.table(t).count() == 0
    assert restore_backup(spark, t, r.backup_dir).first().rows_restored == 31


@pytest.mark.parametrize("parts", [("p",), ()])
def test_pointer_killed_at_every_step(spark, scratch, monkeypatch, parts):
    """Each call that changes files or the catalog dies once; readers see every partition old or new, and a rerun ends it."""
    before, after = {"a": list(range(0, 30, 2)), "b": list(range(1, 30, 2)), "gone": [500]}, {"a": list(range(2, 30, 2)), "b": list(range(3, 30, 2)), "gone": []}
    for step in range(1, 40):
        t = _table(spark, scratch, f"killed_{len(parts)}_{step}", parts)
        calls = []

        def dying(real):
            def call(*a, **k):
                calls.append(1)
                if len(calls) == step:
                    raise RuntimeError("driver lost")
                return real(*a, **k)
            return call

        with monkeypatch.context() as m:
            m.setattr(publish, "alter", dying(publish.alter))
            m.setattr(publish, "remove_folder", dying(publish.remove_folder))
            m.setattr(publish, "remove_files", dying(publish.remove_files))
            m.setattr(publish, "drop_emptied", dying(publish.drop_emptied))
            m.setattr(P.journal, "begin", dying(P.journal.begin))
            m.setattr(P.journal, "end", dying(P.journal.end))
            try:
                assert purge_table(spark, t, _keys(spark, 0, 1, 500), strategy="pointer").status == "DONE"
                finished = True
            except (P.PurgeError, RuntimeError):
                finished = False
        spark.catalog.refreshTable(t)
        seen = {p: _ids(spark.table(t).where(F.col("p") == p)) for p in before}
        for p in before:
            assert seen[p] in (before[p], after[p]), (step, p)
        if not parts:
            assert seen in (before, after)
        P._ACTIVE.clear()
        again = purge_table(spark, t, _keys(spark, 0, 1, 500), strategy="pointer")
        assert again.status in ("NOOP", "DONE") and _ids(spark.table(t)) == list(range(2, 30))
        if finished:
            break
    assert finished and step >= 4


def test_second_run_waits_or_fails_before_a_live_file_moves(spark, scratch, monkeypatch):
    t = _table(spark, scratch, "leased")
    info = C.describe_table(spark, t)
    base = f"{work_root(spark)}/{info.database}/{info.table}"
    held = Lease(spark, base, "other-driver", seconds=30).take()
    files = sorted(spark.table(t).inputFiles())
    for strategy in ("move", "dynamic", "direct", "files", "pointer"):
        r = purge_table(spark, t, _keys(spark, 0), strategy=strategy, lease_wait=0)
        assert r.status == "FAILED" and "other-driver" in r.message
        spark.catalog.refreshTable(t)
        assert sorted(spark.table(t).inputFiles()) == files
    threading.Timer(1.5, held.release).start()
    assert purge_table(spark, t, _keys(spark, 0), lease_wait=60).status == "DONE"


def test_lease_numbers_fence(spark, scratch):
    base = scratch.path("leases")
    one = Lease(spark, base, "one", seconds=0.6).take()
    with pytest.raises(LeaseError):
        Lease(spark, base, "two", seconds=30).take(wait=0)
    time.sleep(1.2)
    with pytest.raises(LeaseError):                     # renewed meanwhile
        Lease(spark, base, "two", seconds=30).take(wait=0)
    one._stop.set()                                     # the driver hangs: nothing renews
    two = Lease(spark, base, "two", seconds=30).take(wait=30)
    assert two.number == one.number + 1
    with pytest.raises(LeaseLost):
        one.check()
    one.release()                                       # must not end the lease of the other
    with pytest.raises(LeaseError):
        Lease(spark, base, "three", seconds=30).take(wait=0)
    two.check()
    two.release()
    Lease(spark, base, "three", seconds=30).take(wait=0).release()


def test_one_of_many_takes_the_lease(spark, scratch):
    base, got = scratch.path("race"), []

    def run(i):
        try:
            got.append(Lease(spark, base, f"r{i}", seconds=60).take(wait=0).number)
        except LeaseError:
            pass

    threads = [threading.Thread(target=run, args=(i,)) for i in range(6)]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    assert got == [1]


def test_lost_lease_stops_a_publish_and_the_next_run_ends_it(spark, scratch, monkeypatch):
    t = _table(spark, scratch, "lost_lease")
    real = Lease.check

    def taken_over(self):
        other = Lease(spark, self.base, "other", seconds=30)
        fs.write_text(spark, f"{self.base}/_LEASE/{self.number + 1:012d}", other._text(0.0))
        return real(self)

    with monkeypatch.context() as m:
        m.setattr(Lease, "check", taken_over)
        with pytest.raises(P.PurgeError):
            purge_table(spark, t, _keys(spark, 0, 1))
    assert list(repair_publish(spark, t).values()) == ["FINISHED"]
    assert _ids(spark.table(t)) == [*range(2, 30), 500]


# ---------------------------------------------------------------- restore
KINDS = "k int, m map<string,int>, s struct<a:int,n:map<string,array<map<string,int>>>>, x array<map<string,double>>, f double, p string"


def test_missing_rows_is_a_multiset_difference(spark):
    nan = float("nan")
    a = (1, {"x": 1, "y": 2}, (1, {"q": [{"i": 1, "j": 2}]}), [{"d": 0.5}], nan, "a")
    swapped = (1, {"y": 2, "x": 1}, (1, {"q": [{"j": 2, "i": 1}]}), [{"d": 0.5}], nan, "a")
    b = (2, None, None, None, None, None)
    c = (3, {}, (None, None), [], 0.0, "a")
    d = (3, {}, (None, None), None, 0.0, "a")
    backup = spark.createDataFrame([a, a, swapped, b, b, c, d, c], KINDS)
    live = spark.createDataFrame([swapped, b, c, (4, {"x": 9}, None, None, 1.0, "z")], KINDS)
    got = sorted(((r.k, r.x is None, r.m) for r in missing_rows(backup, live).collect()), key=repr)
    assert got == sorted([(1, False, {"x": 1, "y": 2})] * 2 + [(2, True, None), (3, True, {}), (3, False, {})], key=repr)
    assert missing_rows(backup, backup).count() == 0 and missing_rows(backup, backup.limit(0)).count() == 8
    assert missing_rows(backup.limit(0), backup).count() == 0


def test_missing_rows_of_many_copies(spark, monkeypatch):
    from keysweep.plans import restore

    monkeypatch.setattr(restore, "COPIES", 7)
    same = spark.range(0, 100).select(F.lit(1).alias("k"), F.lit("v").alias("v"))
    assert missing_rows(same, same.limit(23)).count() == 77
    assert missing_rows(same, same.unionAll(same)).count() == 0


def test_restore_of_a_map_table_twice(spark, scratch):
    df = spark.createDataFrame([(i, {"a": i, "b": -i}, "pq"[i % 2]) for i in range(10)] * 2, "k long, m map<string,long>, p string")
    t = scratch.table(df, "maps", ["p"])
    original = rows(spark.table(t))
    r = purge_table(spark, t, _keys(spark, 1, 2))
    assert r.rows_deleted == 4
    assert restore_backup(spark, t, r.backup_dir, delete_backup=False).first().rows_restored == 4
    assert restore_backup(spark, t, r.backup_dir).first().rows_restored == 0
    assert rows(spark.table(t)) == original


# ---------------------------------------------------------------- audit
def test_erased_when_over_runs(spark, scratch):
    audit = scratch.path("audit")
    assert erased_when(spark, audit, _keys(spark, 1)).count() == 0 if fs.exists(spark, f"{audit}/log") else True
    t, other = _table(spark, scratch, "looked_up"), _table(spark, scratch, "other")
    first = purge_table(spark, t, _keys(spark, 0, 1), audit_dir=audit)
    assert compact_audit_keys(spark, audit) == 2 and compact_audit_keys(spark, audit) == 0
    second = purge_table(spark, t, _keys(spark, 1, 2), audit_dir=audit)
    third = purge_table(spark, other, _keys(spark, 1), audit_dir=audit)
    purge_table(spark, t, _keys(spark, 3), audit_dir=audit, dry_run=True)

    def found(**kw):
        return sorted((r.k, r.run_id, r.rows_deleted) for r in erased_when(spark, audit, _keys(spark, 0, 1, 2, 3, 9, 9), **kw).collect())

    want = sorted([(0, first.run_id, 1), (1, first.run_id, 1), (2, second.run_id, 1), (1, third.run_id, 1)])
    assert found() == want and found(table=t) == [w for w in want if w[1] != third.run_id]
    assert compact_audit_keys(spark, audit) == 2
    assert found() == want
    assert erased_when(spark, audit, spark.createDataFrame([("0",)], "v string")).count() == 0     # another key column


def test_audit_time_and_user(spark, scratch):
    from datetime import datetime, timedelta, timezone

    t = _table(spark, scratch, "who_and_when")
    start = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    row = purge_table(spark, t, _keys(spark, 0)).audit.first()
    assert row.created_by == spark.sql("SELECT current_user()").first()[0] != ""
    at = datetime.strptime(row.created_datetime, "%Y-%m-%d %H:%M:%S")           # the session's zone is UTC
    assert start <= at <= start + timedelta(minutes=10)


def test_a_finished_run_leaves_no_keys(spark, scratch):
    t = _table(spark, scratch, "forgotten")
    r = purge_table(spark, t, spark.createDataFrame([("0",), ("77",), ("x",)], "k string"))
    assert r.keys_rejected == 1 and [x.k for x in r.not_found(spark).collect()] == [77]
    for name in ("effect", "files", "swaps", "replaced", "split"):
        assert not fs.exists(spark, f"{r.run_dir}/{name}"), name
    r.forget(spark)
    assert not fs.exists(spark, r.run_dir)
    assert restore_backup(spark, t, r.backup_dir).first().rows_restored == 1
    located = purge_table(spark, t, _keys(spark, 1), strategy="set_location")
    located.forget(spark)
    assert _ids(spark.table(t)) == [0, *range(2, 30), 500]
