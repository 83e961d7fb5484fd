"""Incremental landing of a growing source folder with Structured Streaming.

The batch job re-reads every file on each run; when files keep arriving
(one JSON document file per export), a file-source stream lands only new
ones: the stream's checkpoint records which files were taken. A micro-batch
may be written again after a failure between its write and its commit; it is
a partition of its own, named by the stream and the batch, and a second write
replaces it, so every file's rows are in the table once. ``availableNow`` processes what is there and stops, so
the same code runs from a scheduler like the batch stages.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from auric.context import checkpoint_dir
from auric.sinks.tables import append_batch


def land_stream(spark: SparkSession, source_dir: str, schema: StructType, table: str,
                fmt: str = "json", checkpoint: str | None = None,
                max_files_per_trigger: int | None = None, **options: str) -> StreamingQuery:
    """Append every new file of ``source_dir`` to ``table`` with audit columns.

    ``_ingest_ts`` is the micro-batch time, ``_source_file`` the file path and
    ``_batch_id`` the partition: the stream (a hash of its checkpoint) and the
    micro-batch, so streams never share one and rows of one file share a batch.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.load(source_dir).select(
        "*", F.col("_metadata.file_path").alias("_source_file"))
    location = checkpoint or os.path.join(checkpoint_dir(spark), "streams", table)

    stream = hashlib.sha256(location.encode()).hexdigest()[:16]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.select("*", F.current_timestamp().alias("_ingest_ts")), table,
                     f"stream-{stream}-{batch_id}", column="_batch_id")

    return (rows.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", location)
            .trigger(availableNow=True)
            .start())


def land_available(spark: SparkSession, source_dir: str, schema: StructType, table: str,
                   **kwargs) -> DataFrame:
    """Run ``land_stream`` to completion and return the table."""
    q = land_stream(spark, source_dir, schema, table, **kwargs)
    q.awaitTermination()
    # The batches were written through the stream's own session; drop this
    # session's cached file listing of the table before reading it.
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
    return spark.table(table)
