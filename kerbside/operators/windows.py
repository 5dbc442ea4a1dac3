"""Tumbling-window transaction analytics.

Each query is a ``DataFrame -> DataFrame`` usable in batch and in Structured Streaming
(add ``with_event_time`` first to get the 10 s watermark). ``per_window=True`` groups
by the window as the comments of the reference describe; ``per_window=False`` is the
literal reading of its SQL (queries 2-5 group by key only: an unbounded running
aggregate, A8).

Amounts are decimal(10,2); their sums keep decimal(20,2), so that no total turns null however
many payments a window holds [ours]; averages are the exact decimal ``sum / count`` rounded once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import MONEY, WIDE_MONEY, money_avg

# Window sizes, watermark and HAVING thresholds of the analytics queries.
WATERMARK = "10 seconds"
STATS_WINDOW = "10 seconds"
HOTSPOT_WINDOW = "30 seconds"
CATEGORY_WINDOW = "30 seconds"
RING_WINDOW = "60 seconds"
FAST_CARD_WINDOW = "60 seconds"
RING_MIN_CARDS = 3
FAST_CARD_MIN_TXNS = 3


def with_event_time(df: DataFrame, time_col: str = "transaction_time", delay: str = WATERMARK) -> DataFrame:
    """Event-time watermark. The column must be TIMESTAMP (not TIMESTAMP_NTZ)."""
    return df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, delay)


def _group(df: DataFrame, keys: list, window: str, time_col: str, per_window: bool):
    if per_window:
        return df.groupBy(F.window(time_col, window).alias("w"), *keys)
    return df.groupBy(*keys)


def _bounds(per_window: bool) -> list:
    return [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")] if per_window else []


def window_stats(df: DataFrame, time_col: str = "transaction_time", window: str = STATS_WINDOW) -> DataFrame:
    """A3: count, sum, avg, min, max per 10 s tumbling window."""
    return (df.groupBy(F.window(time_col, window).alias("w"))
              .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("s"),
                   F.min("amount").alias("mn"), F.max("amount").alias("mx"))
              .select(*_bounds(True), "transaction_count",
                      F.col("s").try_cast(WIDE_MONEY).alias("total_amount"),
                      money_avg("s", "transaction_count").alias("avg_amount"),
                      F.col("mn").cast(MONEY).alias("min_amount"),
                      F.col("mx").cast(MONEY).alias("max_amount")))


def location_hotspots(df: DataFrame, time_col: str = "transaction_time", window: str = HOTSPOT_WINDOW,
                      per_window: bool = True, with_avg: bool = True) -> DataFrame:
    """A4 (A8 when ``per_window=False``): volume per city/state. ``with_avg=False`` is the
    second variant of the reference, which omits the average."""
    to = MONEY if per_window else WIDE_MONEY
    out = (_group(df, [F.col("location.city").alias("city"), F.col("location.state").alias("state")],
                  window, time_col, per_window)
           .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("s")))
    cols = [*_bounds(per_window), "city", "state", "txn_count", F.col("s").try_cast(WIDE_MONEY).alias("total_amount")]
    if with_avg:
        cols.append(money_avg("s", "txn_count", to).alias("avg_amount"))
    return out.select(*cols)


def category_breakdown(df: DataFrame, time_col: str = "transaction_time", window: str = CATEGORY_WINDOW,
                       per_window: bool = True) -> DataFrame:
    """A5: spend per merchant category."""
    to = MONEY if per_window else WIDE_MONEY
    return (_group(df, ["merchant_category"], window, time_col, per_window)
            .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("s"))
            .select(*_bounds(per_window), "merchant_category", "txn_count",
                    F.col("s").try_cast(WIDE_MONEY).alias("total_spend"),
                    money_avg("s", "txn_count", to).alias("avg_spend")))


def order_by_spend(breakdown: DataFrame) -> DataFrame:
    """Categories by spend, descending, category as tie-break (batch / complete mode)."""
    keys = ["window_start"] if "window_start" in breakdown.columns else []
    return breakdown.orderBy(*keys, F.col("total_spend").desc(), "merchant_category")


def fraud_rings(df: DataFrame, time_col: str = "transaction_time", window: str = RING_WINDOW,
                per_window: bool = True, min_cards: int = RING_MIN_CARDS, exact: bool = True,
                streaming_distinct: str = "chained") -> DataFrame:
    """Merchants seen with >= 3 distinct cards in a window.

    Batch: exact ``count(DISTINCT)``, planned by Catalyst as two aggregates (first on
    merchant+card, then merchant) so a hot merchant is pre-reduced map-side.
    Streaming (Spark refuses ``count(DISTINCT)`` there):
    * ``streaming_distinct="chained"`` (exact, default for windows): two chained
      stateful aggregates -- per (window, merchant, card), then per (window, merchant)
      re-windowed on ``window_time`` -- so a hot merchant's cards spread over the first
      aggregate's partitions and the second keeps only counters (append mode);
    * ``"set"`` (exact): ``size(collect_set)``, state holds the window's distinct cards
      in one row per merchant (also the running form, which chained aggregates cannot
      serve in update mode);
    * ``exact=False``: HyperLogLog++ (``approx_count_distinct``).
    """
    if df.isStreaming and exact and per_window and streaming_distinct == "chained":
        per_card = (df.groupBy(F.window(time_col, window).alias("w"), "merchant", "card_number")
                      .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")))
        out = (per_card.groupBy(F.window(F.window_time("w"), window).alias("w"), "merchant")
                       .agg(F.count(F.lit(1)).alias("unique_cards"), F.sum("n").alias("total_txns"),
                            F.sum("s").alias("s")))
    else:
        if df.isStreaming:
            distinct = (F.size(F.collect_set("card_number")) if exact
                        else F.approx_count_distinct("card_number"))
        else:
            distinct = F.count_distinct("card_number")
        out = (_group(df, ["merchant"], window, time_col, per_window)
               .agg(distinct.alias("unique_cards"), F.count(F.lit(1)).alias("total_txns"), F.sum("amount").alias("s")))
    return (out.where(F.col("unique_cards") >= min_cards)
               .select(*_bounds(per_window), "merchant", F.col("unique_cards").cast("bigint").alias("unique_cards"),
                       F.col("total_txns").cast("bigint").alias("total_txns"), F.col("s").try_cast(WIDE_MONEY).alias("total_amount")))


def fast_cards(df: DataFrame, time_col: str = "transaction_time", window: str = FAST_CARD_WINDOW,
               per_window: bool = True, min_txns: int = FAST_CARD_MIN_TXNS) -> DataFrame:
    """Cards with >= 3 transactions in a window."""
    to = MONEY if per_window else WIDE_MONEY
    return (_group(df, ["card_number"], window, time_col, per_window)
            .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("s"),
                 F.max("amount").alias("mx"))
            .where(F.col("txn_count") >= min_txns)
            .select(*_bounds(per_window), "card_number", "txn_count",
                    F.col("s").try_cast(WIDE_MONEY).alias("total_spend"),
                    F.col("mx").try_cast(to).alias("max_single_txn")))


def with_processing_time(df: DataFrame, col: str = "proc_time") -> DataFrame:
    """Arrival-time column for processing-time windows (not reproducible)."""
    return df.withColumn(col, F.current_timestamp())
