"""Apply purge manifests as they arrive in a folder.

The original jobs are started by a scheduler with a manifest file. Here the
manifest folder is a Structured Streaming file source and each micro-batch of
manifest rows is one manifest purge, run through ``foreachBatch``. The stream's
checkpoint records which files were applied; a batch that fails is retried
with the same rows, which is safe because a purge is idempotent (the second
run finds nothing and records NOOP). A batch with a failed table fails the stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keysweep.plans.manifest import purge_manifest
from keysweep.session import work_root
from keysweep.sources.keys import MANIFEST_SCHEMA


def purge_requests_stream(spark: SparkSession, manifest_dir: str, *, checkpoint_location: str | None = None,
                          available_now: bool = True, processing_time: str | None = None,
                          name: str = "keysweep_requests", max_files_per_trigger: int | None = None,
                          **purge_kwargs) -> StreamingQuery:
    """Start the stream; returns the ``StreamingQuery`` (``awaitTermination`` to wait).

    ``available_now=True`` applies every file present and stops (batch-like);
    otherwise the folder is polled every ``processing_time``.
    """
    root = work_root(spark)
    ckpt = checkpoint_location or f"{root}/_STREAM/{name}"
    app = spark.sparkContext.applicationId

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # each attempt has a run id of its own: a retry must not write over the first one's backups
        run_id = f"{app}-{name}-{epoch_id}-{uuid.uuid4().hex[:8]}"
        res = purge_manifest(batch.sparkSession, batch, run_id=run_id, **purge_kwargs)
        failed = [f["table"] for f in res.failures] + [r.table for r in res.results if r.status == "FAILED"]
        if failed:
            raise RuntimeError(f"manifest batch {epoch_id}: purge failed for {', '.join(failed)}")

    reader = spark.readStream.schema(MANIFEST_SCHEMA).option("header", True).option("escape", '"').option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.csv(manifest_dir)
    writer = source.writeStream.queryName(name).foreachBatch(apply).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
