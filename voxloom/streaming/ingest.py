"""Streaming ingest of new metadata files. Our own addition: the same grammar as the batch reader, file by file as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.metadata import acquisition_table


def new_files(spark: SparkSession, folder: str, pattern: str = "*_meta.txt", files_per_batch: int = 100) -> DataFrame:
    """A stream of (path, value): whole texts of files that match, as they appear."""
    s = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    return s.load(folder).select(F.input_file_name().alias("path"), "value")


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, pattern: str = "*_meta.txt") -> None:
    """Parse all files not seen yet into the acquisition table at `out`, then stop. A batch that is run again replaces its own part."""

    def batch(files: DataFrame, number: int) -> None:
        lines = files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
        table = acquisition_table(lines).withColumn("batch", F.lit(number))
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    q = new_files(spark, folder, pattern).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def arrivals(chunks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Per minute and channel of a stream of chunks (seen timestamp, c, data): chunks and bytes that arrived, late ones up to the delay."""
    return chunks.withWatermark("seen", delay).groupBy(F.window("seen", "1 minute"), "c").agg(F.count("*").alias("chunks"), F.sum(F.length("data")).alias("bytes"))
