"""Streaming progress for the reconciliation checks.

Every finished micro-batch adds one row to a progress table in the shared folder, however long a
query runs: ``recorder`` gives a ``StreamingQueryListener`` that appends the progress JSON, and
``progress_frame`` reads the table for ``quality.progress_offsets`` / ``batch_metrics`` for
``quality.falling_behind``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class ProgressRecorder(StreamingQueryListener):
    """Appends each progress event to the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.spark.createDataFrame([(event.progress.json,)], "json string").coalesce(1).write.mode("append").text(self.path)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def attach(spark: SparkSession, path: str) -> ProgressRecorder:
    rec = ProgressRecorder(spark, path)
    spark.streams.addListener(rec)
    return rec


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """Recorded progress events as a one-column (``json``) DataFrame."""
    return spark.read.text(path).withColumnRenamed("value", "json")


def batch_metrics(progress: DataFrame) -> DataFrame:
    """(name, batch_ts, duration_ms, checked_at) per batch for ``quality.falling_behind``."""
    p = F.from_json("json", "name string, id string, timestamp string, durationMs map<string, bigint>")
    return progress.select(p.alias("p")).select(
        F.coalesce("p.name", "p.id").alias("name"), F.col("p.timestamp").try_cast("timestamp").alias("batch_ts"),
        F.coalesce(F.try_element_at("p.durationMs", F.lit("triggerExecution")), F.lit(0)).alias("duration_ms"),
        F.current_timestamp().alias("checked_at"))
