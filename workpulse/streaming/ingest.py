"""Incremental bronze ingestion with Structured Streaming.

New extract files landing in a folder are read as a file stream (all-string
schema, the extract dialect), stamped with lineage, split into clean rows and
quarantined rows with a reason, and appended to two parquet tables.  The
``foreachBatch`` writer is idempotent per micro-batch (each batch writes a
``batch_id=<n>`` partition in overwrite mode), and the stream checkpoint makes
a restarted query continue after the last committed batch, so an executor or
driver loss neither drops nor duplicates rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from workpulse.operators import quarantine
from workpulse.sources.io import EXTRACT_OPTIONS


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_extract_stream(spark: SparkSession, folder: str, columns: Sequence[str],
                        max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """File stream over ``folder`` with the extract dialect and lineage columns."""
    opts = {k: v for k, v in EXTRACT_OPTIONS.items() if k != "inferSchema"}
    opts.update(options)
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    df = spark.readStream.schema(string_schema(columns)).options(**opts).csv(folder)
    return df.withColumns({"_source_file": F.col("_metadata.file_path"),
                           "_ingested_at": F.current_timestamp()})


def start_bronze_ingest(spark: SparkSession, folder: str, columns: Sequence[str], out_root: str,
                        checkpoint: str, reasons: Mapping[str, Column],
                        available_now: bool = True, name: str = "timesheet") -> StreamingQuery:
    """Start the stream: clean rows -> ``out_root/bronze/<name>``, rejects ->
    ``out_root/bronze/<name>_quarantine`` (both partitioned by ``_batch_id``)."""
    stream = read_extract_stream(spark, folder, columns)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("_batch_id", F.lit(f"stream_{batch_id:08d}"))
        good, bad = quarantine.split_quarantine(tagged, reasons)
        for frame, suffix in ((good, ""), (bad, "_quarantine")):
            (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_batch_id").parquet(f"{out_root}/bronze/{name}{suffix}"))

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint).queryName(f"bronze_{name}"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
