"""Key typing (F7), key-list and manifest readers (S5-S8), rejects."""

from pyspark.sql.types import LongType, StringType

from keysweep.functions.text import key_text, partition_spec_sql, sql_literal
from keysweep.operators.effect import group_manifest
from keysweep.sources import keys as K


def test_type_keys_bigint_rejects(spark):
    raw = spark.createDataFrame([("1",), ("001",), ("",), ("abc",), ("1.0",), (None,), (" 7 ",)], "k string")
    out = K.type_keys(raw, ["k"], {"k": LongType()})
    got = sorted((r["_raw"], r["k"], r["_ok"]) for r in out.collect())
    assert ("001", 1, True) in got and ("1", 1, True) in got and (" 7 ", 7, True) in got
    bad = [g for g in got if not g[2]]
    assert sorted(b[0] for b in bad) == ["", "", "1.0", "abc"]   # blank and NULL both report as ''


def test_type_keys_string_keeps_text(spark):
    raw = spark.createDataFrame([("001",), ("O'Neil",)], "k string")
    out = K.type_keys(raw, ["k"], {"k": StringType()})
    assert sorted(r["k"] for r in out.collect()) == ["001", "O'Neil"]


def test_read_key_list_and_values(spark, tmp_path):
    p = tmp_path / "keys.csv"
    p.write_text("l_orderkey,l_linenumber\n35,7\n35,7\n36,1\n")
    df = K.read_key_list(spark, str(p))
    assert df.columns == ["l_orderkey", "l_linenumber"] and df.count() == 3
    q = tmp_path / "pk.csv"
    q.write_text("PK_VALUE\n10\n11\n")
    assert K.read_key_values(spark, str(q), "o_custkey").columns == ["o_custkey"]


def test_manifest_rejects_not_dropped(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("PK,PK_VALUE,DATABASE_NAME,TABLE_NAME,PARTITION_COL\n"
                 "o_custkey,10,db,orders_p,order_month\n"
                 "o_custkey,11,db,,order_month\n"
                 "event_id,17,db,events_p,\n")
    m = K.read_manifest(spark, str(p))
    valid, rejects = K.split_manifest(m)
    assert valid.count() == 2 and rejects.count() == 1
    g = group_manifest(valid).collect()
    assert [(r.TABLE_NAME, r.keys_requested) for r in g] == [("events_p", 1), ("orders_p", 1)]


def test_key_text_and_literals(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a long, b string")
    assert sorted(r[0] for r in df.select(key_text("a", "b")).collect()) == ["'1~x'", "'2~null'"]
    assert sql_literal("O'Neil") == "'O\\'Neil'"
    assert partition_spec_sql({"p": "007", "n": 3}) == "`p` = '007', `n` = 3"
    assert spark.sql(f"SELECT {sql_literal(chr(92) + chr(39))} AS v").first().v == chr(92) + chr(39)


def test_key_csv_quotes_and_malformed_lines(spark, tmp_path):
    from pyspark.sql.types import StringType

    from keysweep.sources.keys import read_key_list, type_keys
    (tmp_path / "k.csv").write_text('name\n"say ""hi"""\nSmith, John\n"Smith, John"\n')
    keys = type_keys(read_key_list(spark, str(tmp_path / "k.csv")), ["name"], {"name": StringType()})
    assert sorted(r.name for r in keys.where("_ok").collect()) == ["Smith, John", 'say "hi"']
    assert keys.where("not _ok").count() == 1


def test_manifest_by_header_name(spark, tmp_path):
    from keysweep.sources.keys import read_manifest
    (tmp_path / "m.csv").write_text("TABLE_NAME,extra,PK,PARTITION_COL,PK_VALUE,DATABASE_NAME\nt,x,id,p,7,db\n")
    assert [tuple(r) for r in read_manifest(spark, str(tmp_path / "m.csv")).collect()] == [("id", "7", "db", "t", "p")]


def test_lossy_casts_are_rejects(spark):
    from pyspark.sql.types import DateType, DecimalType, LongType

    from keysweep.sources.keys import type_keys
    cases = [(LongType(), ["1.9", "7", "1e2"], [7]), (DecimalType(10, 2), ["1.005", "1.500", "3"], [1.5, 3.0]), (DateType(), ["2024-01-01 10:00:00", "2024-01-02"], ["2024-01-02"])]
    for kind, values, kept in cases:
        keys = type_keys(spark.createDataFrame([(v,) for v in values], "k string"), ["k"], {"k": kind})
        got = [r.k for r in keys.where("_ok").collect()]
        assert [float(g) if isinstance(k, float) else str(g) if isinstance(k, str) else g for g, k in zip(got, kept)] == kept and len(got) == len(kept)
    doubles = type_keys(spark.createDataFrame([(1.9,), (2.0,)], "k double"), ["k"], {"k": LongType()})
    assert [r.k for r in doubles.where("_ok").collect()] == [2]


def test_unqualified_name_means_the_callers_database(spark):
    from keysweep import purge_table
    spark.sql("CREATE DATABASE IF NOT EXISTS cur_db")
    for t in ("default.same_name", "cur_db.same_name"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        spark.sql(f"CREATE TABLE {t} USING parquet AS SELECT id FROM range(5)")
    spark.sql("USE cur_db")
    try:
        res = purge_table(spark, "same_name", spark.createDataFrame([(1,)], "id long"))
        assert res.status == "DONE"
        assert spark.table("cur_db.same_name").count() == 4 and spark.table("default.same_name").count() == 5
    finally:
        spark.sql("USE default")
