"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracle SQL.

Keys follow SURVEY §2 ids. Every query reads the given test tables (through the
projections in ``kerbside.sources.testbed``) in full.
"""

from __future__ import annotations

from kerbside.operators import alerts, windows
from kerbside.plans import alert_sql, oracle as O
from kerbside.plans.registry import ORACLE, QUERIES, register  # noqa: F401  (re-exported)
from kerbside.sources import testbed


# ---------------------------------------------------------------- alerts
_TX, _VELOCITY_SQL, _ALL_ALERTS_SQL = alert_sql.TX, alert_sql.VELOCITY, alert_sql.ALL_ALERTS


def _tx(spark, sf_dir):
    return testbed.transactions(spark, sf_dir)


for _key, _rule, _cond_sql, _reason_sql in alert_sql.RULES:
    register(_key, f"{_TX}\n {alert_sql.rule(_rule, _cond_sql, _reason_sql)}")(
        (lambda r: lambda spark, sf_dir: alerts.single_rule(_tx(spark, sf_dir), r))(_rule))


@register("a1_card_velocity", f"{_TX}\n{_VELOCITY_SQL}")
def a1_card_velocity(spark, sf_dir):
    return alerts.card_velocity(_tx(spark, sf_dir))


@register("a2_velocity_alerts", f"""{_TX}, vel AS ({_VELOCITY_SQL})
 SELECT card_number, txn_count, total_amount, window_start, window_end, 'VELOCITY' AS fraud_rule,
  'Card used ' || CAST(txn_count AS VARCHAR) || ' times in 2-minute window' AS fraud_reason FROM vel""")
def a2_velocity_alerts(spark, sf_dir):
    return alerts.velocity_alerts(alerts.card_velocity(_tx(spark, sf_dir)))


@register("u1_all_alerts", _ALL_ALERTS_SQL)
def u1_all_alerts(spark, sf_dir):
    return alerts.all_alerts(_tx(spark, sf_dir))


@register("a9_hits_per_rule", f"SELECT fraud_rule, count(*) AS hits FROM ({_ALL_ALERTS_SQL}) GROUP BY fraud_rule")
def a9_hits_per_rule(spark, sf_dir):
    return alerts.hits_per_rule(alerts.all_alerts(_tx(spark, sf_dir)))


@register("a10_total_alerts", f"SELECT count(*) AS total_alerts FROM ({_ALL_ALERTS_SQL})")
def a10_total_alerts(spark, sf_dir):
    return alerts.total_alerts(alerts.all_alerts(_tx(spark, sf_dir)))


@register("t2_alert_samples", f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY fraud_rule ORDER BY
  "timestamp" ASC NULLS LAST, window_start ASC NULLS LAST, card_number, amount ASC NULLS LAST, fraud_reason) AS INT) AS rn
  FROM ({_ALL_ALERTS_SQL})) WHERE rn <= 5""")
def t2_alert_samples(spark, sf_dir):
    return alerts.samples_per_rule(alerts.all_alerts(_tx(spark, sf_dir)), 5)


# ---------------------------------------------------------------- windows
def _win(seconds: int) -> str:
    return (f"{O.bucket('transaction_time', seconds)} AS window_start, "
            f"{O.bucket_end('transaction_time', seconds)} AS window_end")


@register("a3_window_stats", f"""{_TX}
 SELECT {_win(10)}, count(*) AS transaction_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount,
  {O.money_avg('sum(amount)', 'count(*)')} AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount
 FROM txn GROUP BY 1, 2""")
def a3_window_stats(spark, sf_dir):
    return windows.window_stats(_tx(spark, sf_dir))


@register("a4_location_hotspots", f"""{_TX}
 SELECT {_win(30)}, location.city AS city, location.state AS state, count(*) AS txn_count,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount, {O.money_avg('sum(amount)', 'count(*)')} AS avg_amount
 FROM txn GROUP BY 1, 2, 3, 4""")
def a4_location_hotspots(spark, sf_dir):
    return windows.location_hotspots(_tx(spark, sf_dir))


@register("a5_category_breakdown", f"""{_TX}
 SELECT {_win(30)}, merchant_category, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_spend,
  {O.money_avg('sum(amount)', 'count(*)')} AS avg_spend
 FROM txn GROUP BY 1, 2, 3 ORDER BY window_start, total_spend DESC, merchant_category""")
def a5_category_breakdown(spark, sf_dir):
    return windows.order_by_spend(windows.category_breakdown(_tx(spark, sf_dir)))


@register("a6_fraud_rings", f"""{_TX}
 SELECT {_win(60)}, merchant, count(DISTINCT card_number) AS unique_cards, count(*) AS total_txns,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount
 FROM txn GROUP BY 1, 2, 3 HAVING count(DISTINCT card_number) >= 3""")
def a6_fraud_rings(spark, sf_dir):
    return windows.fraud_rings(_tx(spark, sf_dir))


@register("a7_fast_cards", f"""{_TX}
 SELECT {_win(60)}, card_number, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_spend,
  CAST(max(amount) AS DECIMAL(10,2)) AS max_single_txn
 FROM txn GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def a7_fast_cards(spark, sf_dir):
    return windows.fast_cards(_tx(spark, sf_dir))


@register("a8_running_hotspots", f"""{_TX}
 SELECT location.city AS city, location.state AS state, count(*) AS txn_count,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount, {O.money_avg('sum(amount)', 'count(*)', 'DECIMAL(20,2)')} AS avg_amount
 FROM txn GROUP BY 1, 2""")
def a8_running_hotspots(spark, sf_dir):
    return windows.location_hotspots(_tx(spark, sf_dir), per_window=False)


@register("a8_running_categories", f"""{_TX}
 SELECT merchant_category, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_spend,
  {O.money_avg('sum(amount)', 'count(*)', 'DECIMAL(20,2)')} AS avg_spend
 FROM txn GROUP BY 1""")
def a8_running_categories(spark, sf_dir):
    return windows.category_breakdown(_tx(spark, sf_dir), per_window=False)


@register("a8_running_rings", f"""{_TX}
 SELECT merchant, count(DISTINCT card_number) AS unique_cards, count(*) AS total_txns,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount
 FROM txn GROUP BY 1 HAVING count(DISTINCT card_number) >= 3""")
def a8_running_rings(spark, sf_dir):
    return windows.fraud_rings(_tx(spark, sf_dir), per_window=False)


@register("a8_running_fast_cards", f"""{_TX}
 SELECT card_number, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_spend,
  CAST(max(amount) AS DECIMAL(20,2)) AS max_single_txn
 FROM txn GROUP BY 1 HAVING count(*) >= 3""")
def a8_running_fast_cards(spark, sf_dir):
    return windows.fast_cards(_tx(spark, sf_dir), per_window=False)


# race layers register themselves on import
from kerbside.plans import enrich, ingest, race, streams  # noqa: E402,F401
