"""Alert stream and its sinks.

The same ``alerts.all_alerts`` transform runs on a streaming DataFrame: the four
stateless rules pass straight through; velocity is a watermarked tumbling-window
aggregate emitted once per final window in append mode (``update`` mode emits every
change of the running count, like ``EMIT CHANGES``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.functions.scalars import lower_columns
from kerbside.operators import alerts, windows


def alert_stream(transactions: DataFrame, time_col: str = "transaction_time",
                 watermark: str = windows.WATERMARK) -> DataFrame:
    """U1 on a stream: event-time watermark first (R1), then the five rules."""
    return alerts.all_alerts(windows.with_event_time(transactions, time_col, watermark), time_col)


def as_records(alert_df: DataFrame) -> DataFrame:
    """K3: keyed JSON records for the shared alert topic (key = card number)."""
    return alert_df.select(F.col("card_number").alias("key"), F.to_json(F.struct(*alert_df.columns)).alias("value"))


def start_alert_topic(alert_df: DataFrame, checkpoint: str, options: dict[str, str] | None = None,
                      path: str | None = None, topic: str = "flagged_transactions",
                      available_now: bool = False) -> StreamingQuery:
    """K3/K5: write alert records to the Kafka topic, or as JSON files under ``path``."""
    rec = as_records(alert_df)
    w = rec.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if path is None:
        w = w.format("kafka").options(**(options or {})).option("topic", topic)
    else:
        w = w.format("json").option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def document_writer(path: str):
    """K4 + P14 as ``foreachBatch``: lower-case field names, add ingest time and the
    record's partition/offset, write one JSON folder per batch (idempotent replays)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        doc = lower_columns(batch).withColumn("ingested_at", F.current_timestamp())
        doc = doc.withColumnRenamed("partition", "kafka_partition").withColumnRenamed("offset", "kafka_offset")
        doc.write.mode("overwrite").json(os.path.join(path, f"batch_id={batch_id}"))
    return write


def start_document_sink(records: DataFrame, schema, path: str, checkpoint: str,
                        available_now: bool = False) -> StreamingQuery:
    """S5 + K4: a second query consuming the alert records with its own checkpoint.
    Records from a file sink carry no partition/offset; those columns are then null."""
    for c, t in (("partition", "int"), ("offset", "bigint")):
        if c not in records.columns:
            records = records.withColumn(c, F.lit(None).cast(t))
    parsed = records.select(F.from_json(F.col("value").cast("string"), schema).alias("d"),
                            "partition", "offset").select("d.*", "partition", "offset")
    w = parsed.writeStream.foreachBatch(document_writer(path)).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_preview(df: DataFrame, name: str, rows: int = 10, mode: str = "append") -> StreamingQuery:
    """K6: an in-memory table to peek at (query it with ``LIMIT rows``) -- the stream
    itself is not truncated."""
    return df.writeStream.outputMode(mode).format("memory").queryName(name).option("numRows", rows).start()
