"""DuckDB SQL of the alert rules."""

from __future__ import annotations

from kerbside.operators import alerts
from kerbside.plans import oracle as O

TX = O.with_fixtures("transactions")


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# The stateless rules (key, rule, condition, reason) as SQL; the lists are those of the alert rules.
RULES = [
    ("p5_high_amount", "HIGH_AMOUNT", "amount > 500", "'Transaction amount exceeds $500 threshold'"),
    ("p6_unusual_location", "UNUSUAL_LOCATION", f"location.state NOT IN {_in(alerts.DOMESTIC_STATES)}",
     "'Transaction from unusual location: ' || location.city || ', ' || location.state"),
    ("p7_high_risk_merchant", "HIGH_RISK_MERCHANT", f"merchant_category IN {_in(alerts.HIGH_RISK_CATEGORIES)}",
     "'Transaction at high-risk merchant category: ' || merchant_category"),
    ("p8_multi_factor", "MULTI_FACTOR", f"amount > 300 AND merchant_category IN {_in(alerts.MULTI_FACTOR_CATEGORIES)}",
     "'HIGH SEVERITY: Amount $' || CAST(amount AS VARCHAR) || ' at ' || merchant_category"),
]


def rule(name: str, cond: str, reason: str, more: str = "") -> str:
    """Alerts of one stateless rule; ``more`` adds columns."""
    return (f"SELECT card_number, amount, location.city AS city, location.state AS state, merchant_category, \"timestamp\", "
            f"'{name}' AS fraud_rule, {reason} AS fraud_reason{more} FROM txn WHERE {cond}")


VELOCITY = f"""
 SELECT card_number, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount,
  {O.bucket('transaction_time', 120)} AS window_start, {O.bucket_end('transaction_time', 120)} AS window_end
 FROM txn GROUP BY card_number, 4, 5 HAVING count(*) >= 3"""


def all_alerts(more: str = "", none: str = "", pick: str = "") -> str:
    """All alerts with their severity; ``more``, ``none`` and ``pick`` add columns to the stateless rules, to the
    velocity rule and to the union."""
    stateless = "\n UNION ALL ".join(rule(*r[1:], more) for r in RULES)
    severity = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in alerts.SEVERITY.items())
    return f"""{TX},
 stateless AS ({stateless}),
 vel AS ({VELOCITY}),
 u AS (
  SELECT card_number, amount, city, state, merchant_category, "timestamp", fraud_rule, fraud_reason,
   NULL::BIGINT AS txn_count, NULL::DECIMAL(20,2) AS total_amount, NULL::TIMESTAMP AS window_start,
   NULL::TIMESTAMP AS window_end{pick}
  FROM stateless
  UNION ALL
  SELECT card_number, NULL, NULL, NULL, NULL, NULL, 'VELOCITY',
   'Card used ' || CAST(txn_count AS VARCHAR) || ' times in 2-minute window', txn_count, total_amount, window_start,
   window_end{none}
  FROM vel)
 SELECT *, CASE fraud_rule {severity} END AS severity FROM u"""


ALL_ALERTS = all_alerts()
