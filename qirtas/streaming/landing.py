"""Pages that land in a folder, as a stream: the batch operators run on each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions.metrics import quality_score, token_stats


def landed(spark: SparkSession, path: str, schema: str, fmt: str = "json", files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_a_batch).load(path)


def scored(pages: DataFrame, text: str = "text") -> DataFrame:
    """Works on streams and tables alike."""
    return pages.withColumn("stats", token_stats(F.col(text))).withColumn("score", F.round(quality_score(F.col(text)), 6))


def event_counts(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Progress events by type and window of event time; later ones than ``late`` are left out."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def each_batch(pages: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], once: bool = True):
    """Run ``work`` on every batch; a batch seen again after a restart has the same number."""
    writer = pages.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
