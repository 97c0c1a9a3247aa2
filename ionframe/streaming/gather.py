"""Incremental gather of per-dataset result tables.

In the workflow every raw file is processed on its own and a barrier waits
for all of them before quantification. Here the per-dataset tables (reporter
ions, identifications, chromatogram statistics) are picked up as files land,
with a Structured Streaming file source, and appended to one Parquet table
partitioned by dataset; reporter intensities can also be summed incrementally
per (dataset, scan, channel). ``availableNow`` runs process what is there and
stop, so the same code serves a batch re-run and a long-running stream; the
checkpoint location makes restarts exactly-once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import decode_path
from pyspark.sql.streaming import StreamingQuery


def stream_dataset_tables(spark: SparkSession, folder: str, suffix: str, schema: str,
                          sep: str = "\t", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over ``<dataset><suffix>`` files arriving in
    ``folder``, with the ``dataset`` column taken from the file name."""
    r = spark.readStream.schema(schema).option("sep", sep).option("header", "true") \
        .option("pathGlobFilter", f"*{suffix}")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(folder)
    return df.withColumn("dataset", F.regexp_replace(decode_path(F.col("_metadata.file_name")), re.escape(suffix) + "$", ""))


def gather_to_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                      partition_by: str = "dataset") -> StreamingQuery:
    """Append the stream to a Parquet table partitioned by dataset."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .partitionBy(partition_by).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def reporter_totals(stream: DataFrame, keys: list[str], channel: str = "channel",
                    intensity: str = "intensity") -> DataFrame:
    """Running sum of reporter intensity per (keys, channel): a stateful
    streaming aggregation (state grows with the distinct keys, not rows)."""
    return stream.groupBy(*keys, channel).agg(F.sum(intensity).alias("intensity"),
                                              F.count(F.lit(1)).alias("n"))


def upsert_totals(totals: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the running totals: each micro-batch replaces the table with the
    complete, current result (``complete`` output mode via ``foreachBatch``)."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    w = totals.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
