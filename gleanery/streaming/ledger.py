"""Streaming forms: a ledger that is followed as it grows, and the download queue kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def follow_ledger(spark: SparkSession, path: str, ddl: str, files_per_batch: int = 100) -> DataFrame:
    """Predictions as they are appended."""
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_batch).json(path)


def status_by_window(predictions: DataFrame, at: str = "ts", size: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Predictions by status in windows of time; rows later than ``late`` are left out."""
    return predictions.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), "status").agg(F.count("*").alias("n")).select("w.start", "w.end", "status", "n")


def first_of_each(predictions: DataFrame, key: str = "task_id", at: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each task's first prediction within the watermark: repeats of a resumed run are dropped."""
    return predictions.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
