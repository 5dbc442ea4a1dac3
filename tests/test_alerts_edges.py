"""Edge cases of the alert rules and windowed analytics on literal fixtures."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from kerbside.operators import alerts, windows
from kerbside.sources.schemas import TRANSACTION_SCHEMA


def _tx(spark, rows):
    """rows: (card, amount, iso time, city, state, category)."""
    data = [(c, Decimal(a), t, (city, st), "m-1", cat, "USD", "pos") for c, a, t, city, st, cat in rows]
    df = spark.createDataFrame(data, TRANSACTION_SCHEMA)
    return df.withColumn("transaction_time", F.col("timestamp").try_cast("timestamp"))


def _rules(df):
    return sorted((r.card_number, r.fraud_rule) for r in alerts.stateless_alerts(df).collect())


def test_amount_bounds_and_lists(spark):
    df = _tx(spark, [
        ("a", "500.00", "2024-01-01T00:00:00", "X", "CA", "grocery"),
        ("b", "500.01", "2024-01-01T00:00:00", "X", "CA", "grocery"),
        ("c", "300.00", "2024-01-01T00:00:00", "X", "CA", "jewelry"),
        ("d", "300.01", "2024-01-01T00:00:00", "X", "CA", "jewelry"),
        ("e", "10.00", "2024-01-01T00:00:00", "X", None, "grocery"),
        ("f", "10.00", "2024-01-01T00:00:00", "Lagos", "NG", "gambling"),
    ])
    got = _rules(df)
    assert ("a", "HIGH_AMOUNT") not in got and ("b", "HIGH_AMOUNT") in got
    assert ("c", "MULTI_FACTOR") not in got and ("d", "MULTI_FACTOR") in got
    # jewelry is high-risk only for the multi-factor rule
    assert ("d", "HIGH_RISK_MERCHANT") not in got
    # a null state is not flagged (three-valued NOT IN)
    assert not [r for r in got if r[0] == "e"]
    assert ("f", "UNUSUAL_LOCATION") in got and ("f", "HIGH_RISK_MERCHANT") in got


def test_reason_texts(spark):
    df = _tx(spark, [("d", "300.01", "2024-01-01T00:00:00", "Moscow", "RU", "jewelry")])
    reasons = {r.fraud_rule: r.fraud_reason for r in alerts.stateless_alerts(df).collect()}
    assert reasons["MULTI_FACTOR"] == "HIGH SEVERITY: Amount $300.01 at jewelry"
    assert reasons["UNUSUAL_LOCATION"] == "Transaction from unusual location: Moscow, RU"


def test_velocity_exactly_three_and_boundary(spark):
    rows = [("v", "1.00", f"2024-01-01T00:00:{s:02d}", "X", "CA", "grocery") for s in (0, 30, 59)]
    rows += [("w", "1.00", t, "X", "CA", "grocery") for t in
             ("2024-01-01T00:01:59", "2024-01-01T00:02:00", "2024-01-01T00:02:01")]
    vel = alerts.card_velocity(_tx(spark, rows)).collect()
    assert [(r.card_number, r.txn_count) for r in vel] == [("v", 3)]
    assert vel[0].window_start == dt.datetime(2024, 1, 1, 0, 0)
    assert vel[0].window_end == dt.datetime(2024, 1, 1, 0, 2)


def test_money_average_rounds_half_up(spark):
    rows = [("x", a, "2024-01-01T00:00:01", "X", "CA", "grocery") for a in ("0.01", "0.02")]
    r = windows.window_stats(_tx(spark, rows)).collect()[0]
    assert r.avg_amount == Decimal("0.02") and r.total_amount == Decimal("0.03")


def test_running_vs_windowed(spark):
    rows = [("x", "5.00", t, "X", "CA", "grocery") for t in
            ("2024-01-01T00:00:01", "2024-01-01T00:00:31", "2024-01-01T00:01:01")]
    df = _tx(spark, rows)
    assert windows.fast_cards(df).count() == 0
    assert windows.fast_cards(df, per_window=False).collect()[0].txn_count == 3


def test_totals_beyond_the_amounts_range(spark):
    """Three payments of 90,000,000 sum up beyond decimal(10,2)."""
    from kerbside.operators import windows
    rows = [("c", "90000000.00", f"2024-01-01T00:00:0{i}", "X", "CA", "grocery") for i in range(3)]
    df = spark.createDataFrame(rows, "card_number string, amount string, timestamp string, city string, state string, "
                               "merchant_category string").select(
        "card_number", F.col("amount").cast("decimal(10,2)").alias("amount"), "timestamp",
        F.to_timestamp("timestamp").alias("transaction_time"), F.struct("city", "state").alias("location"),
        "merchant_category", F.lit("m").alias("merchant"))
    assert str(alerts.card_velocity(df).first().total_amount) == "270000000.00"
    assert str(windows.window_stats(df).first().total_amount) == "270000000.00"
    assert str(windows.fast_cards(df).first().total_spend) == "270000000.00"
    assert str(windows.location_hotspots(df).first().total_amount) == "270000000.00"
