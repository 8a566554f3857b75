"""Validate batches as they arrive: a Structured Streaming file source, one suite run per
micro-batch, verdicts in a results store with a folder per micro-batch.

This is the checkpoint-over-batches model (a new file is a new batch) driven by Spark's file
source instead of a scheduler: the stream's checkpoint location records which files were
validated, so a restart after a lost driver or executor neither skips nor repeats a batch.
"""

from __future__ import annotations

from typing import Any, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.checks import run_checks
from ..operators.expectations import validate
from ..session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: Any, fmt: str = "csv", max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """Streaming read of files landing in ``path`` (schema fixed up front), with the file name."""
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withColumn("_file", F.col("_metadata.file_name"))


def validate_stream(stream: DataFrame, results_path: str, suite: Any = None, column: Any = None, table: Any = None,
                    by: Iterable[str] = ("_file",), checkpoint_location: str | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Start a query that validates every micro-batch and stores its verdicts by ``batch_id``.

    Each micro-batch is validated per ``by`` group (by default per source file) in one fused
    aggregation; result rows carry the batch id.  ``available_now`` processes what is there and
    stops (batch-style runs); otherwise the query keeps running.
    """
    by = list(by)
    spark = stream.sparkSession
    ckpt = checkpoint_location or scratch_path(spark, "stream-ckpt")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if suite is not None:
            res = validate(batch, suite, by=by)
        else:
            res = run_checks(batch, column=column, table=table, by=by)
        # a batch that is tried again replaces its own folder: its verdicts are there once
        (res.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(results_path))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
