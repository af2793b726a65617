"""Structured Streaming: land new source files as they arrive, and keep the
fact and reports current on a trigger.

Both use ``foreachBatch`` so each micro-batch is an ordinary batch write
(idempotent per batch id: the batch id becomes ``_batch_id`` and the
checkpoint location records progress, so a restarted query resumes without
re-landing files).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from finmart.functions.metadata import with_ingestion_metadata
from finmart.sources.storage import is_folder


STREAM_BATCH_COL = "stream_batch"


def _file_stream(spark: SparkSession, source_dir: str, table: str, schema,
                 max_files: int | None) -> DataFrame:
    """New files of a table: ``<source_dir>/<table>`` is a folder of part files,
    or a single file (or name pattern) in ``source_dir``.  ``max_files`` limits
    the files of one micro-batch (throughput only, no result depends on it)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    folder = f"{source_dir.rstrip('/')}/{table}"
    if is_folder(spark, folder):
        return reader.option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").parquet(folder)
    return reader.option("pathGlobFilter", table).parquet(source_dir)


def _schema(spark: SparkSession, source_dir: str, table: str):
    folder = f"{source_dir.rstrip('/')}/{table}"
    if is_folder(spark, folder):
        return spark.read.parquet(folder).schema
    return spark.read.option("pathGlobFilter", table).parquet(source_dir).schema


def stream_ingest(spark: SparkSession, source_dir: str, pattern: str, schema,
                  target_path: str, checkpoint: str, source_system: str = "stream",
                  available_now: bool = True, processing_time: str | None = None,
                  max_files: int | None = None):
    """Land the files of table ``pattern`` under ``source_dir`` into ``target_path``
    (parquet, one ``stream_batch=<id>`` directory per micro-batch) with load
    metadata.  Returns the finished/started query."""
    def land(batch: DataFrame, batch_id: int):
        # One directory per micro-batch, written with overwrite: a batch that
        # is re-run after a failure replaces its own output (exactly once).
        (with_ingestion_metadata(batch, source_system, f"stream-{batch_id}")
         .write.mode("overwrite").parquet(f"{target_path}/{STREAM_BATCH_COL}={batch_id}"))

    w = (_file_stream(spark, source_dir, pattern, schema, max_files).writeStream
         .foreachBatch(land).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 hour")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def refresh_on_new_lines(spark: SparkSession, source_dir: str, checkpoint: str,
                         on_batch: Callable[[DataFrame, int], None],
                         lag: str | None = None, pattern: str = "lineitem*.parquet",
                         max_files: int | None = None):
    """Run ``on_batch(new_lineitem_rows, batch_id)`` whenever new lineitem
    files arrive — e.g. merge the touched fact months and rebuild a report
    table.  ``lag`` is the refresh cadence (processing-time trigger); without
    it the query drains what is there and stops (availableNow)."""
    schema = _schema(spark, source_dir, pattern)
    w = (_file_stream(spark, source_dir, pattern, schema, max_files).writeStream
         .foreachBatch(on_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(processingTime=lag) if lag else w.trigger(availableNow=True)
    q = w.start()
    if not lag:
        q.awaitTermination()
    return q
