"""Windowed analytics as Structured Streaming queries.

``append`` emits a window once the watermark passes its end (final windows only; at
the end of an ``availableNow`` run the windows newer than max(event time) - 10 s stay
open); ``update`` emits every change; ``complete`` re-emits the whole result table and
is the only mode in which the category ranking (T1) may sort a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators import windows

QUERIES: dict[str, Callable[..., DataFrame]] = {
    "window_stats": windows.window_stats,
    "location_hotspots": windows.location_hotspots,
    "category_breakdown": windows.category_breakdown,
    "fraud_rings": windows.fraud_rings,
    "fast_cards": windows.fast_cards,
}


def windowed(transactions: DataFrame, name: str, time_col: str = "transaction_time", **kw) -> DataFrame:
    """One analytics query over a watermarked stream (or a batch DataFrame)."""
    src = windows.with_event_time(transactions, time_col) if transactions.isStreaming else transactions
    return QUERIES[name](src, time_col=time_col, **kw)


def processing_time(transactions: DataFrame, name: str, **kw) -> DataFrame:
    """The same query keyed by arrival time (results are not reproducible)."""
    src = windows.with_processing_time(transactions, "proc_time")
    return QUERIES[name](src, time_col="proc_time", **kw)


def final_window_cut(batch_result: DataFrame, max_event_time, delay_seconds: int = 10) -> DataFrame:
    """Restrict a batch result to the windows an append-mode stream has emitted at
    the end of input (window end <= max event time - watermark delay)."""
    return batch_result.where(F.col("window_end") <= F.lit(max_event_time) - F.expr(f"INTERVAL {delay_seconds} SECONDS"))


def start(df: DataFrame, name: str, mode: str = "append", sink: str = "memory", path: str | None = None,
          checkpoint: str | None = None, trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).queryName(name)
    if sink == "memory":
        w = w.format("memory")
    else:
        w = w.format(sink).option("path", path)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
