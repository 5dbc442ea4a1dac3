"""DuckDB SQL text for the independent oracle.

The fixture CTEs below are the DuckDB forms of the projections in
``kerbside.sources.testbed``; each oracle query is ``WITH <fixtures> SELECT ...``.
"""

from __future__ import annotations

TRANSACTIONS = """transactions AS (
 SELECT event_id, 'card-'||user_id AS card_number, CAST(round(value*5,2) AS DECIMAL(10,2)) AS amount,
  make_timestamp(1704067200000000+(epoch_us(ts)-1704067200000000)//60) AS transaction_time,
  {'city': (['San Jose','San Francisco','Los Angeles','New York','Chicago','Houston','Lagos','Moscow','Shenzhen'])[1+event_id%9],
   'state': (['CA','CA','CA','NY','IL','TX','NG','RU','CN'])[1+event_id%9]} AS location,
  'merchant-'||(CAST(json_extract(props,'$.k') AS INT)%40) AS merchant,
  (['grocery','restaurant','gas_station','online_retail','electronics','travel','entertainment','healthcare','jewelry','gambling','crypto_exchange','wire_transfer'])[1+(event_id//9)%12] AS merchant_category
 FROM events),
 txn AS (SELECT *, strftime(transaction_time, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp" FROM transactions)"""

LAPS = """n AS (SELECT count(*) // 1000 AS ns FROM lineitem),
 b AS (SELECT l_orderkey%ns AS sn, CAST(l_suppkey%20 AS INT) AS dn, CAST(row_number() OVER (PARTITION BY l_orderkey%ns, l_suppkey%20 ORDER BY l_orderkey,l_linenumber,l_partkey,l_suppkey,l_shipdate,l_extendedprice) AS INT) AS lap_number,
  count(*) OVER (PARTITION BY l_orderkey%ns, l_suppkey%20) AS last_lap,
  CAST(round(l_extendedprice*100) AS BIGINT)%3000 AS jitter FROM lineitem CROSS JOIN n),
 laps AS (SELECT concat('S',sn) AS session_id, concat('D',dn) AS driver_id, concat('T',dn%10) AS team_id, lap_number, 80000+dn*150+jitter AS lap_time_ms,
  CASE (dn+((lap_number-1) // 10))%3 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' ELSE 'HARD' END AS tyre_compound,
  (lap_number%10=0 AND lap_number<last_lap) AS pit, CASE WHEN lap_number%10=0 AND lap_number<last_lap THEN 20000+jitter END AS pit_duration_ms,
  CAST(sum(80000+dn*150+jitter) OVER (PARTITION BY sn,dn ORDER BY lap_number ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_ms
 FROM b)"""

TELEMETRY = """telemetry AS (
 SELECT CASE WHEN lap_time_ms%101=0 THEN NULL ELSE session_id END AS session_id, driver_id, lap_number, i AS sample_no,
  cum_ms-lap_time_ms+(lap_time_ms*i) // 8 AS t_ms, CASE WHEN lap_time_ms%97=0 THEN -1.0 ELSE CAST(120+(lap_time_ms+37*i)%200 AS DOUBLE) END AS speed_kph,
  CAST((i*13+lap_time_ms)%101 AS DOUBLE) AS throttle_pct, CAST(CASE WHEN i%4=3 THEN 1 ELSE 0 END AS DOUBLE) AS brake, CASE WHEN i%3=0 THEN '12' ELSE '0' END AS drs_state,
  CAST(110-lap_number*1.5-i*0.125 AS DOUBLE) AS fuel_mass_kg, CAST(50+(lap_time_ms+11*i)%50 AS DOUBLE) AS battery_pct, tyre_compound, r AS copy_no
 FROM laps CROSS JOIN (SELECT unnest(range(8)) AS i) CROSS JOIN (SELECT unnest(range(2)) AS r) WHERE r=0 OR lap_time_ms%50=0)"""


def with_fixtures(*names: str) -> str:
    parts = []
    if "transactions" in names:
        parts.append(TRANSACTIONS)
    if "laps" in names or "telemetry" in names:
        parts.append(LAPS)
    if "telemetry" in names:
        parts.append(TELEMETRY)
    return "WITH " + ",\n ".join(parts)


def money_avg(total: str, count: str, to: str = "DECIMAL(10,2)") -> str:
    """Exact half-up (away from zero) rounding of total/count to 2 decimals, matching
    Spark's decimal division followed by a cast to decimal(10,2)."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return (f"CAST(CAST(sign({cents}) * ((2 * abs({cents}) + ({count})) // (2 * ({count}))) AS DECIMAL(38,0))"
            f" * CAST(0.01 AS DECIMAL(3,2)) AS {to})")


def bucket(ts: str, seconds: int) -> str:
    us = seconds * 1000000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


def bucket_end(ts: str, seconds: int) -> str:
    us = seconds * 1000000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us} + {us})"
