"""Matching semantics (P1-P4, J1-J7) on small literal fixtures."""

from pyspark.sql import functions as F

from keysweep.operators import effect as E
from keysweep.operators import match as M
from tests.conftest import rows


def _table(spark):
    return spark.createDataFrame(
        [(1, "x", "a", "0"), (1, "y", "a", "0"), (2, "x", "b", "1"), (2, "y", "b", "0"), (3, "z", "c", "0"),
         (None, "x", "c", "0")],
        "k long, s string, p string, active string")


def test_tuple_vs_per_column(spark):
    t = _table(spark)
    keys = spark.createDataFrame([(1, "x"), (2, "y")], "k long, s string")
    assert M.match_rows(t, keys).count() == 2
    assert M.match_rows(t, keys, match="per_column").count() == 4        # cross product over-deletes
    assert M.survivors(t, keys).count() == 4
    assert M.survivors(t, keys, match="per_column").count() == 2


def test_duplicates_counted_once_and_null_survives(spark):
    t = _table(spark)
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert M.match_rows(t, keys).count() == 2
    assert M.survivors(t, keys).where(F.col("k").isNull()).count() == 1
    eff = E.purge_effect(t, keys, ["k"], ["p"]).collect()
    assert [(r.p, r.rows_before, r.rows_deleted, r.rows_after) for r in eff] == [("a", 2, 2, 0)]


def test_scope_and_not_found(spark):
    t = _table(spark)
    keys = spark.createDataFrame([(2,), (9,)], "k long")
    closed = F.col("active") == "0"
    assert rows(M.match_rows(t, keys, scope=closed), ["k", "s"]) == [(2, "y")]
    assert rows(M.keys_not_found(t, keys)) == [(9,)]
    assert rows(M.keys_found(t, keys)) == [(2,)]


def test_broadcast_and_shuffle_agree(spark):
    t = _table(spark)
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    a = rows(M.survivors(t, keys, broadcast_keys=True))
    b = rows(M.survivors(t, keys, broadcast_keys=False))
    assert a == b and len(a) == 3


def test_hot_key_salting_matches_plain_join(spark):
    t = _table(spark)
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    hot = spark.createDataFrame([(1,)], "k long")
    spec = M.KeySpec(keys, ["k"], "tuple", broadcast=False, hot=hot, salt_buckets=4)
    got = M.flag_matches(t, [spec]).where("_hit").select("k", "s")
    assert rows(got) == [(1, "x"), (1, "y"), (3, "z")]
    plan = M.flag_matches(t, [spec])._jdf.queryExecution().executedPlan().toString()
    assert "_salt_0" in plan


def test_rows_in_partitions_null_safe(spark):
    t = _table(spark)
    parts = spark.createDataFrame([("a",), (None,)], "p string")
    assert M.rows_in_partitions(t, parts, ["p"]).count() == 2


def _odd_rows(spark):
    """3,000 rows with null keys and rows that occur twice."""
    df = spark.range(3000).select((F.col("id") % 2000).alias("a"), F.when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("int")).alias("b"),
                                  F.concat(F.lit("k"), F.col("id") % 11).alias("c"), (F.col("id") % 3).alias("p"))
    return df.unionAll(df.where("a % 10 = 0"))


def test_candidates_are_flagged_as_all_rows_are(spark):
    df = _odd_rows(spark)
    pairs = df.where("a < 60").select("a", "b").where("b is not null").distinct()
    texts = spark.createDataFrame([("k3",), ("none",)], "c string")
    for specs in ([M.KeySpec(pairs, ["a", "b"], broadcast=False)], [M.KeySpec(pairs, ["a", "b"], "per_column", False)],
                  [M.KeySpec(pairs, ["a", "b"], broadcast=False), M.KeySpec(texts, ["c"], broadcast=False)]):
        counts = [s.keys.count() for s in specs]
        for scope in (None, F.col("p") != 1):
            want = M.flag_matches(df, specs, scope)
            got = M.flag_candidates(df, specs, counts, scope, rebalance=["_hit", "p"])
            assert got.columns == want.columns and rows(got) == rows(want)


def test_few_rows_without_a_match_are_candidates(spark):
    df = _odd_rows(spark).where("b is not null")
    pairs = df.where("a < 60").select("a", "b").distinct()
    judged = M.may_match(df, [M.KeySpec(pairs, ["a", "b"], broadcast=False)], [pairs.count()])
    match = M.match_rows(df, pairs, ["a", "b"]).count()
    assert 0 < match <= judged.where("_may").count() < match + df.count() // 5
    assert rows(M.match_rows(judged.where("_may"), pairs, ["a", "b"]).drop("_may")) == rows(M.match_rows(df, pairs, ["a", "b"]))


def test_no_bitmap_for_floats_or_too_many_keys(spark):
    keys = spark.createDataFrame([(0.0,)], "x double")
    assert M.may_match(keys, [M.KeySpec(keys, ["x"])], [1]) is None
    keys = spark.range(3)
    assert M.may_match(keys, [M.KeySpec(keys, ["id"])], [M.BITMAP_BYTES * 8]) is None
