"""Registered ingest (bronze) and data-quality queries over message envelopes that Spark
derives from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.scalars import lower_columns, made_once, mask_last4
from kerbside.operators import alerts, laps as L, quality
from kerbside.plans import oracle as O
from kerbside.plans.registry import register, round_doubles
from kerbside.sources import envelope, testbed
from kerbside.sources.schemas import RACE_EVENT_SCHEMA, TELEMETRY_SCHEMA

_TEL_COLS = ["session_id", "driver_id", "car_number", "lap_number", "timestamp_utc", "speed_kph", "throttle_pct",
             "brake_pressure_bar", "drs_state", "battery_pct", "fuel_mass_kg", "tyre_compound", "tyre_age_laps",
             "source", "ingest_id", "kafka_key", "topic", "partition", "offset"]

_MSG_SQL = O.with_fixtures("laps", "telemetry") + """,
 tel_o AS (SELECT CASE WHEN lap_time_ms%101=0 THEN NULL ELSE session_id END AS session_id, session_id AS origin_session, driver_id,
   lap_number, i AS sample_no, r AS copy_no, lap_time_ms, cum_ms-lap_time_ms+(lap_time_ms*i) // 8 AS t_ms,
   CASE WHEN lap_time_ms%97=0 THEN -1.0 ELSE CAST(120+(lap_time_ms+37*i)%200 AS DOUBLE) END AS speed_kph,
   CAST((i*13+lap_time_ms)%101 AS DOUBLE) AS throttle_pct, CAST(CASE WHEN i%4=3 THEN 1 ELSE 0 END AS DOUBLE) AS brake,
   CASE WHEN i%3=0 THEN '12' ELSE '0' END AS drs_state, CAST(110-lap_number*1.5-i*0.125 AS DOUBLE) AS fuel_mass_kg,
   CAST(50+(lap_time_ms+11*i)%50 AS DOUBLE) AS battery_pct, tyre_compound
  FROM laps CROSS JOIN (SELECT unnest(range(8)) AS i) CROSS JOIN (SELECT unnest(range(2)) AS r) WHERE r=0 OR lap_time_ms%50=0),
 msg AS (SELECT *, 1709294400000 + CAST(substr(origin_session, 2) AS BIGINT) * 3600000 + t_ms AS event_ms,
   CAST(CAST(substr(driver_id, 2) AS BIGINT) % 3 AS INT) AS partition,
   ((CAST(substr(origin_session, 2) AS BIGINT) * 20 + CAST(substr(driver_id, 2) AS BIGINT)) * 1048576 + lap_number) * 16 + sample_no * 2 + copy_no AS "offset"
  FROM tel_o)"""

_ISO = ("CASE WHEN event_ms % 1000 = 0 THEN strftime(make_timestamp(event_ms * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00' "
        "ELSE strftime(make_timestamp(event_ms * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END")


def _topic(log, schema, name, rendered):
    """(parsed, raw) of a log. Messages are rendered in a step of their own before they are parsed, which takes less than one
    step that does both; ``rendered=False`` for who reads no field of a message, and so need not render it."""
    raw = envelope.raw_view(log)
    return envelope.parsed_view(made_once(raw) if rendered else raw, schema, name), raw


def _telemetry_topic(spark, sf_dir, rendered=True):
    return _topic(testbed.telemetry_log(spark, sf_dir), TELEMETRY_SCHEMA, testbed.TELEMETRY_TOPIC, rendered)


def _events_topic(spark, sf_dir, rendered=True):
    return _topic(testbed.event_messages(spark, sf_dir), RACE_EVENT_SCHEMA, testbed.EVENTS_TOPIC, rendered)


@register("p2_parsed_telemetry", f"""{_MSG_SQL}
 SELECT session_id, driver_id, substr(driver_id, 2) AS car_number, lap_number, {_ISO} AS timestamp_utc,
  CAST(speed_kph AS FLOAT) AS speed_kph, CAST(throttle_pct AS FLOAT) AS throttle_pct, CAST(brake AS FLOAT) AS brake_pressure_bar,
  drs_state, CAST(battery_pct AS FLOAT) AS battery_pct, CAST(fuel_mass_kg AS FLOAT) AS fuel_mass_kg, tyre_compound,
  CAST(((lap_number - 1) % 10) + 1 AS INT) AS tyre_age_laps, 'testbed' AS source,
  sha256(concat_ws('|', 'telemetry.raw', CAST(partition AS VARCHAR), CAST("offset" AS VARCHAR))) AS ingest_id,
  driver_id || '_' || CAST(lap_number AS VARCHAR) AS kafka_key, 'telemetry.raw' AS topic, partition, "offset"
 FROM msg""")
def p2_parsed_telemetry(spark, sf_dir):
    return _telemetry_topic(spark, sf_dir)[0].select(*_TEL_COLS)


@register("p1_raw_envelope", f"""{_MSG_SQL}
 SELECT driver_id || '_' || CAST(lap_number AS VARCHAR) AS kafka_key, 'telemetry.raw' AS topic, partition, "offset",
  make_timestamp((event_ms + (lap_time_ms % 13) * 200) * 1000) AS kafka_timestamp FROM msg""")
def p1_raw_envelope(spark, sf_dir):
    return _telemetry_topic(spark, sf_dir)[1].select("kafka_key", "topic", "partition", "offset", "kafka_timestamp")


_EVT_SQL = O.with_fixtures("laps") + """,
 ev AS (SELECT session_id, driver_id, lap_number, 'LAP_COMPLETION' AS event_type, 0 AS k FROM laps
  UNION ALL SELECT session_id, driver_id, lap_number, 'PIT_STOP', 1 FROM laps WHERE pit),
 evm AS (SELECT *, CAST(CAST(substr(driver_id, 2) AS BIGINT) % 3 AS INT) AS partition,
   ((CAST(substr(session_id, 2) AS BIGINT) * 20 + CAST(substr(driver_id, 2) AS BIGINT)) * 1048576 + lap_number) * 2 + k AS "offset" FROM ev)"""


@register("q1_topic_partition_counts", f"""SELECT topic, partition, count(*) AS messages, min("offset") AS min_offset,
  max("offset") AS max_offset FROM (
  SELECT 'telemetry.raw' AS topic, partition, "offset" FROM ({_MSG_SQL} SELECT * FROM msg)
  UNION ALL SELECT 'race.events', partition, "offset" FROM ({_EVT_SQL} SELECT * FROM evm)) GROUP BY 1, 2""")
def q1_topic_partition_counts(spark, sf_dir):
    raw = _telemetry_topic(spark, sf_dir)[1].unionByName(_events_topic(spark, sf_dir)[1])
    return quality.topic_partition_counts(raw)


# Q2 reads a log with damage: messages that are no JSON, and messages that the parsed table lacks
_DAMAGED, _MISSING = 211, (1009, 5)


def _loss_sql(topic: str, rows: str) -> str:
    gone = f'("offset" % {_MISSING[0]} = {_MISSING[1]})'
    return f"""SELECT '{topic}' AS topic, count(*) AS raw, count(*) FILTER (NOT {gone}) AS parsed,
  count(*) FILTER ("offset" % {_DAMAGED} = 0 AND NOT {gone}) AS unparsed, count(*) FILTER ({gone}) AS lost FROM ({rows})"""


@register("q2_parse_loss", f"""{_loss_sql('telemetry.raw', f'{_MSG_SQL} SELECT * FROM msg')}
 UNION ALL {_loss_sql('race.events', f'{_EVT_SQL} SELECT * FROM evm')}""")
def q2_parse_loss(spark, sf_dir):
    def topic(raw, schema, name):
        raw = raw.withColumn("kafka_value", F.when(F.col("offset") % _DAMAGED == 0, F.concat(F.lit("#"), "kafka_value"))
                             .otherwise(F.col("kafka_value")))
        parsed = envelope.parsed_view(made_once(raw), schema, name).where(F.col("offset") % _MISSING[0] != _MISSING[1])
        return quality.parse_loss(raw, parsed, [f.name for f in schema.fields])

    return (topic(_telemetry_topic(spark, sf_dir)[1], TELEMETRY_SCHEMA, testbed.TELEMETRY_TOPIC)
            .unionByName(topic(_events_topic(spark, sf_dir)[1], RACE_EVENT_SCHEMA, testbed.EVENTS_TOPIC)))


_NULL_COLS = [f.name for f in TELEMETRY_SCHEMA.fields]


NULL_RATES_SQL = round_doubles.sql(f"""{_MSG_SQL},
 parsed AS (SELECT session_id, driver_id, substr(driver_id, 2) AS car_number, lap_number, NULL::INT AS micro_sector_id,
   'x' AS timestamp_utc, speed_kph, throttle_pct, brake AS brake_pressure_bar, NULL AS steering_angle_deg, NULL AS gear,
   NULL AS engine_rpm, drs_state, NULL AS ers_mode, battery_pct, fuel_mass_kg, tyre_compound, 1 AS tyre_age_laps,
   NULL AS tyre_surface_temp_c, NULL AS tyre_inner_temp_c, NULL AS tyre_pressure_bar, NULL AS gps_lat, NULL AS gps_lon,
   NULL AS gps_alt, NULL AS track_status_code, NULL AS flag_state, NULL AS weather_air_temp_c, NULL AS weather_track_temp_c,
   NULL AS weather_humidity_pct, NULL AS weather_wind_speed_kph, NULL AS weather_wind_direction_deg, 'testbed' AS source,
   'x' AS ingest_id FROM msg)
 SELECT column_name, null_rate FROM (UNPIVOT (SELECT {', '.join(f'avg(({c} IS NULL)::DOUBLE) AS {c}' for c in _NULL_COLS)} FROM parsed)
  ON {', '.join(_NULL_COLS)} INTO NAME column_name VALUE null_rate)""", ["null_rate"])


@register("a18_null_rates", NULL_RATES_SQL)
def a18_null_rates(spark, sf_dir):
    return round_doubles(quality.null_rates(_telemetry_topic(spark, sf_dir)[0], _NULL_COLS))


@register("a18_late_arrivals", round_doubles.sql(f"""{_MSG_SQL}
 SELECT 'telemetry.raw' AS topic, count(*) AS records, avg(((lap_time_ms % 13) * 200 > 1000)::DOUBLE) AS late_rate FROM msg""",
                                                 ["late_rate"]))
def a18_late_arrivals(spark, sf_dir):
    tp, _ = _telemetry_topic(spark, sf_dir)
    # ISO-8601 with offset, with or without a fraction: a plain cast parses both
    event_ms = F.unix_millis(F.col("timestamp_utc").try_cast("timestamp"))
    return round_doubles(quality.late_arrival_rate(tp, event_ms))


@register("w8_zscore_anomalies", round_doubles.sql(O.with_fixtures("laps", "telemetry") + """,
 valid AS (SELECT * FROM telemetry WHERE session_id IS NOT NULL AND NOT (speed_kph < 0)),
 clean AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY session_id, driver_id, t_ms ORDER BY copy_no) AS rn FROM valid) WHERE rn = 1),
 z AS (SELECT session_id, driver_id, lap_number, t_ms, speed_kph, avg(speed_kph) OVER w AS rolling_mean, stddev_samp(speed_kph) OVER w AS rolling_sd
  FROM clean WINDOW w AS (PARTITION BY session_id, driver_id, lap_number ORDER BY t_ms ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
 z2 AS (SELECT *, CASE WHEN rolling_sd > 0 THEN (speed_kph - rolling_mean) / rolling_sd END AS zscore FROM z)
 SELECT * FROM z2 WHERE abs(zscore) > 2""", ["rolling_mean", "rolling_sd", "zscore"]))
def w8_zscore_anomalies(spark, sf_dir):
    lp = testbed.stored_laps(spark, sf_dir)
    return round_doubles(quality.zscore_anomalies(L.clean_telemetry(testbed.stored_telemetry(spark, sf_dir))))


@register("w10_latest_message_per_key", f"""{_MSG_SQL},
 m2 AS (SELECT driver_id || '_' || CAST(lap_number AS VARCHAR) AS kafka_key,
   make_timestamp((event_ms + (lap_time_ms % 13) * 200) * 1000) AS kafka_timestamp, partition, "offset" FROM msg)
 SELECT kafka_key, kafka_timestamp, partition, "offset" FROM m2
 QUALIFY row_number() OVER (PARTITION BY kafka_key ORDER BY kafka_timestamp DESC, partition DESC, "offset" DESC) = 1""")
def w10_latest_message_per_key(spark, sf_dir):
    """W10 on the log: the latest record per message key (compacted-topic view), ordered
    by (record time, partition, offset)."""
    _, raw = _telemetry_topic(spark, sf_dir)
    x = raw.select("kafka_key", "kafka_timestamp", "partition", "offset")
    return L.latest_per_key(x, ["kafka_key"], ["kafka_timestamp", "partition", "offset"])


# ------------------------------------------------------------------ transactions log and alert sinks
from kerbside.plans.alert_sql import ALL_ALERTS, TX, all_alerts as _alerts_sql  # noqa: E402

_ALERT_FIELDS = ("card_number string, amount decimal(10,2), city string, state string, merchant_category string, "
                 "timestamp string, fraud_rule string, fraud_reason string, txn_count bigint, total_amount decimal(20,2), "
                 "window_start timestamp, window_end timestamp, severity string")


def _logged_transactions(spark, sf_dir):
    """Transactions parsed from the messages of their log, with the record's coordinates."""
    raw = envelope.raw_view(testbed.transaction_messages(spark, sf_dir)).select("kafka_value", "partition", "offset")
    return envelope.transactions_from_json(raw)


@register("s4_transactions_from_json", f"""{TX}
 SELECT card_number, amount, location.city AS city, location.state AS state, merchant, merchant_category, "timestamp",
  date_trunc('millisecond', transaction_time) AS transaction_time, CAST(event_id % 3 AS INT) AS partition, event_id AS "offset" FROM txn""")
def s4_transactions_from_json(spark, sf_dir):
    return _logged_transactions(spark, sf_dir).select(
        "card_number", F.col("amount").cast("decimal(10,2)").alias("amount"), "location.city", "location.state", "merchant",
        "merchant_category", "timestamp", "transaction_time", "partition", "offset")


@register("k3_alert_records", f"SELECT card_number AS key, * FROM ({ALL_ALERTS})")
def k3_alert_records(spark, sf_dir):
    """K3: alerts as keyed JSON records for the shared alert topic, read back as a consumer does."""
    a = alerts.all_alerts(testbed.transactions(spark, sf_dir))
    records = a.select(F.col("card_number").alias("key"), F.to_json(F.struct(*a.columns)).alias("value"))
    return records.select("key", F.from_json("value", _ALERT_FIELDS).alias("v")).select("key", "v.*")


_RECORD = ", CAST(event_id % 3 AS INT) AS kafka_partition, event_id AS kafka_offset"


@register("k4_alert_documents", f"""SELECT *, '...' || right(card_number, 4) AS card_masked, true AS stamped FROM (
 {_alerts_sql(_RECORD, ", NULL::INT, NULL::BIGINT", ", kafka_partition, kafka_offset")})""")
def k4_alert_documents(spark, sf_dir):
    """K4 + P14 + F14: alerts as documents: fields in lower case, the partition and offset of the
    transaction's record (a velocity alert has several records, so none), a masked card for
    display and the time of ingestion, of which only the presence can be compared."""
    tx = (_logged_transactions(spark, sf_dir).withColumn("amount", F.col("amount").cast("decimal(10,2)"))
          .withColumnsRenamed({"partition": "kafka_partition", "offset": "kafka_offset"}))
    a = alerts.all_alerts(tx, carry=("kafka_partition", "kafka_offset"))
    doc = lower_columns(a.toDF(*[c.upper() for c in a.columns])).withColumn("ingested_at", F.current_timestamp())
    return (doc.withColumn("card_masked", mask_last4("card_number"))
            .withColumn("stamped", F.col("ingested_at").isNotNull()).drop("ingested_at"))


# ------------------------------------------------------------------ gold from bronze
from kerbside.plans.race import _ASOF, _FACT_LAP, _LT, _VALID  # noqa: E402


@register("s6_gold_fact_lap_from_bronze", round_doubles.sql(f"{_LT},\n {_VALID},\n {_ASOF},\n {_FACT_LAP}\n SELECT * FROM fact_lap",
                                                            ["avg_speed_kph", "min_speed_kph", "max_speed_kph", "fuel_used_kg",
                                                             "battery_delta_pct"]))
def s6_gold_fact_lap_from_bronze(spark, sf_dir):
    """fact_lap computed from the parsed bronze topics (JSON messages), not from the
    projections: must equal ``a12_fact_lap``."""
    tp, _ = _telemetry_topic(spark, sf_dir)
    ep, _ = _events_topic(spark, sf_dir)
    return round_doubles(L.gold_fact_lap(tp, ep))
