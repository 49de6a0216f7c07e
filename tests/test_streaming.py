"""Manifests applied by the file-arrival stream."""

from pyspark.sql import functions as F

from keysweep import scenarios as S
from keysweep.streaming import purge_requests_stream


def test_stream_applies_manifest_once(spark, sf, scratch, tmp_path):
    t = scratch.table(S.events_p(spark, sf), "events_p", ["event_type"])
    db, name = t.split(".")
    n = spark.table(t).count()
    errors = spark.table(t).where("event_type = 'error'").count()
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (spark.table(t).where("event_type = 'error'")
     .select(F.lit("event_id").alias("PK"), F.col("event_id").cast("string").alias("PK_VALUE"),
             F.lit(db).alias("DATABASE_NAME"), F.lit(name).alias("TABLE_NAME"), F.lit("").alias("PARTITION_COL"))
     .toPandas().to_csv(inbox / "m1.csv", index=False))
    ckpt = str(tmp_path / "ckpt")
    purge_requests_stream(spark, str(inbox), checkpoint_location=ckpt).awaitTermination()
    assert spark.table(t).count() == n - errors
    purge_requests_stream(spark, str(inbox), checkpoint_location=ckpt).awaitTermination()   # file already applied
    assert spark.table(t).count() == n - errors
