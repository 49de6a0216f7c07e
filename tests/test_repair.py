"""Publishes that break off: journal, rerun and repair; special partition values."""

import pytest

from keysweep.plans import purge as P
from keysweep.plans.repair import repair_publish
from keysweep.plans.purge import purge_table
from keysweep.sinks import publish
from tests.conftest import rows


def _keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "k long")


def _table(spark, scratch, name, parts=("p",)):
    df = spark.createDataFrame([(i, f"v{i}", "ab"[i % 2]) for i in range(20)] + [(100, "v", "gone")], "k long, v string, p string")
    return scratch.table(df, name, list(parts))


@pytest.mark.parametrize("strategy", ["dynamic", "static", "move", "set_location"])
def test_rerun_finishes_a_broken_publish(spark, scratch, monkeypatch, strategy):
    """The publish dies after the first partition statement; the rerun restores every survivor."""
    t = _table(spark, scratch, f"broken_{strategy}")
    want = rows(spark.table(t).where("k not in (0, 1, 100)"))
    real = publish.partition_path if strategy in ("move", "set_location") else None
    calls = []

    def dies(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return real(*a, **k)

    def empties(session, info, stage, *more):
        session.sql(f"TRUNCATE TABLE {info.quoted} PARTITION (p = 'a')")
        raise RuntimeError("job aborted")

    with monkeypatch.context() as m:
        if real:
            m.setattr(publish, "partition_path", dies)
        else:
            m.setattr(publish, f"publish_{strategy}", empties)
        with pytest.raises(P.PurgeError):
            purge_table(spark, t, _keys(spark, 0, 1, 100), strategy=strategy)
    again = purge_table(spark, t, _keys(spark, 0, 1, 100), strategy=strategy)
    assert again.status == "NOOP"
    assert rows(spark.table(t)) == want


def test_default_keeps_survivors_between_two_renames(spark, scratch, monkeypatch):
    """Each rename of the default publish is made to fail once; the rerun has every survivor."""
    for broken in (1, 2, 3, 4, 5):
        t = _table(spark, scratch, f"renames_{broken}")
        want = rows(spark.table(t).where("k not in (0, 1, 100)"))
        real, calls = publish.fs.rename, []

        def dies(*a, real=real, calls=calls, broken=broken):
            calls.append(1)
            if len(calls) == broken:
                raise RuntimeError("connection lost")
            return real(*a)

        with monkeypatch.context() as m:
            m.setattr(publish.fs, "rename", dies)
            with pytest.raises((P.PurgeError, RuntimeError)):
                purge_table(spark, t, _keys(spark, 0, 1, 100))
        assert len(calls) >= broken
        assert purge_table(spark, t, _keys(spark, 0, 1, 100)).status == ("DONE" if broken == 1 else "NOOP")
        assert rows(spark.table(t)) == want


def test_default_strategy_by_table(spark, scratch):
    t = _table(spark, scratch, "auto_parquet")
    assert purge_table(spark, t, _keys(spark, 0), dry_run=True).strategy == "move"
    plain = _table(spark, scratch, "auto_plain", ())
    assert purge_table(spark, plain, _keys(spark, 0), dry_run=True).strategy == "dynamic"
    orc = f"{t}_orc"
    spark.table(t).write.format("orc").partitionBy("p").saveAsTable(orc)
    assert purge_table(spark, orc, _keys(spark, 0), dry_run=True).strategy == "dynamic"


def test_plain_table_rerun(spark, scratch, monkeypatch):
    t = _table(spark, scratch, "broken_plain", ())
    want = rows(spark.table(t).where("k <> 3"))

    def empties(session, info, stage):
        session.sql(f"TRUNCATE TABLE {info.quoted}")
        raise RuntimeError("job aborted")

    with monkeypatch.context() as m:
        m.setattr(publish, "publish_dynamic", empties)
        with pytest.raises(P.PurgeError):
            purge_table(spark, t, _keys(spark, 3))
    assert spark.table(t).count() == 0
    assert list(repair_publish(spark, t).values()) == ["FINISHED"]
    assert rows(spark.table(t)) == want
    assert repair_publish(spark, t) == {}


def test_direct_without_stage_never_reports_done(spark, scratch, monkeypatch):
    t = _table(spark, scratch, "broken_direct")

    def empties(session, info, stage):
        session.sql(f"TRUNCATE TABLE {info.quoted} PARTITION (p = 'a')")
        raise RuntimeError("job aborted")

    with monkeypatch.context() as m:
        m.setattr(publish, "publish_dynamic", empties)
        with pytest.raises(P.PurgeError):
            purge_table(spark, t, _keys(spark, 0, 1), strategy="direct")
    with pytest.raises(P.PurgeError, match="missing rows"):
        purge_table(spark, t, _keys(spark, 0, 1))


@pytest.mark.parametrize("strategy", ["direct", "dynamic", "move", "set_location"])
def test_special_partition_values(spark, scratch, strategy):
    values = ["a b", "c/d", "50%", "x=y", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 2)], "k long, p string")
    t = scratch.table(df, f"special_{strategy}", ["p"], external=True)
    gone = [0, 5, 1, 6, 2, 3, 4]  # two partitions wholly, the others by half
    r = purge_table(spark, t, _keys(spark, *gone), strategy=strategy, backup=False)
    assert r.status == "DONE"
    want = [(7, "50%"), (8, "x=y"), (9, None)]
    assert rows(spark.table(t), ["k", "p"]) == want
    spark.sql(f"MSCK REPAIR TABLE {t}")
    assert rows(spark.table(t), ["k", "p"]) == want


def test_boolean_partition_and_orc(spark, scratch):
    df = spark.createDataFrame([(1, True), (2, True), (3, False)], "k long, p boolean")
    t = scratch.table(df, "flags", ["p"], external=True)
    assert purge_table(spark, t, _keys(spark, 1), strategy="set_location").status == "DONE"
    assert rows(spark.table(t), ["k", "p"]) == [(2, True), (3, False)]
    orc = f"{t}_orc"
    df.write.format("orc").partitionBy("p").saveAsTable(orc)
    for strategy in ("move", "set_location"):
        with pytest.raises(ValueError, match="use dynamic or direct"):
            purge_table(spark, orc, _keys(spark, 1), strategy=strategy)
    assert purge_table(spark, orc, _keys(spark, 1), strategy="dynamic").status == "DONE"
    assert rows(spark.table(orc), ["k", "p"]) == [(2, True), (3, False)]
