"""Registered queries of enrichment, selection and conversions (SURVEY §2.1 S9, §2.3 P3/P10, §2.4
J2/J4/J5, §2.5 A20, §2.6 W7, §2.10 F1/F9/F13/F18, §2.14 X4, §2.2 K10).

What the given tables do not hold (weather, safety cars, penalties, plans) is derived from laps
by the same rule in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions.scalars import add_ms, harmonised, iso_to_ts, kph_to_ms, ms_between
from kerbside.operators import laps as L, serve
from kerbside.plans.ingest import _EVT_SQL, _MSG_SQL, _events_topic, _telemetry_topic
from kerbside.plans.race import _ASOF, _FACT_LAP, _L, _LT, _VALID, _gold_fact_lap, _laps
from kerbside.plans.registry import register, round_doubles
from kerbside.sources import testbed
from kerbside.sources.schemas import LAP_METRICS_SCHEMA
from kerbside.sources.tables import load

WEATHER_BUCKET_MS = 600_000


def _weather(spark, sf_dir):
    """Readings on every fifth lap of one driver."""
    return (_laps(spark, sf_dir).where("driver_id = 'D1' AND lap_number % 5 = 0")
            .select("session_id", F.col("cum_ms").alias("read_ms"), (F.lit(20) + F.col("lap_time_ms") % 97 / 10).alias("air_temp_c"),
                    (F.lit(30) + F.col("lap_time_ms") % 61 / 10).alias("track_temp_c")))


_WEATHER = f"""{_LT},
 weather AS (SELECT session_id, cum_ms AS read_ms, 20 + lap_time_ms % 97 / 10 AS air_temp_c, 30 + lap_time_ms % 61 / 10 AS track_temp_c
  FROM laps WHERE driver_id = 'D1' AND lap_number % 5 = 0)"""
_SAMPLE = ["session_id", "driver_id", "lap_number", "sample_no", "copy_no", "t_ms"]


@register("j2_weather_last", round_doubles.sql(f"""{_WEATHER},
 w AS (SELECT session_id, arg_max(air_temp_c, read_ms) AS air_temp_c, arg_max(track_temp_c, read_ms) AS track_temp_c FROM weather GROUP BY 1)
 SELECT {", ".join("t." + c for c in _SAMPLE)}, air_temp_c, track_temp_c FROM telemetry t LEFT JOIN w USING (session_id)""",
                                               ["air_temp_c", "track_temp_c"]))
def j2_weather_last(spark, sf_dir):
    tel = testbed.read_telemetry(spark, sf_dir).select(*_SAMPLE)
    return round_doubles(L.attach_last_reading(tel, _weather(spark, sf_dir), "session_id", "read_ms", ["air_temp_c", "track_temp_c"]))


@register("j2_weather_asof", round_doubles.sql(f"""{_WEATHER}
 SELECT {", ".join("t." + c for c in _SAMPLE)}, w.air_temp_c, w.track_temp_c FROM telemetry t
  ASOF LEFT JOIN weather w ON t.session_id = w.session_id AND t.t_ms >= w.read_ms""", ["air_temp_c", "track_temp_c"]))
def j2_weather_asof(spark, sf_dir):
    tel = testbed.stored_telemetry(spark, sf_dir).select(*_SAMPLE)
    return round_doubles(L.attach_asof_reading(tel, _weather(spark, sf_dir), "session_id", "t_ms", "read_ms",
                                               ["air_temp_c", "track_temp_c"], WEATHER_BUCKET_MS))


@register("j4_team_and_circuit", f"""{_L},
 team AS (SELECT concat('T', n_nationkey) AS team_id, n_name AS team_name, n_regionkey AS engine_key FROM nation WHERE n_nationkey < 10),
 circuit AS (SELECT n_nationkey AS circuit_key, n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)
 SELECT session_id, driver_id, lap_number, lap_time_ms, team_name, engine_key, country, region FROM
  (SELECT *, CAST(substr(session_id, 2) AS BIGINT) % 25 AS circuit_key FROM laps) LEFT JOIN team USING (team_id) LEFT JOIN circuit USING (circuit_key)""")
def j4_team_and_circuit(spark, sf_dir):
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    team = nation.where("n_nationkey < 10").select(F.concat(F.lit("T"), F.col("n_nationkey")).alias("team_id"),
                                                   F.col("n_name").alias("team_name"), F.col("n_regionkey").alias("engine_key"))
    circuit = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("circuit_key"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    lp = _laps(spark, sf_dir).withColumn("circuit_key", testbed.session_no("session_id") % 25)
    return L.lookup(L.lookup(lp, team, "team_id"), circuit, "circuit_key").select(
        "session_id", "driver_id", "lap_number", "lap_time_ms", "team_name", "engine_key", "country", "region")


@register("j5_safety_car_laps", f"""{_L},
 sc AS (SELECT session_id, cum_ms AS s, cum_ms + pit_duration_ms AS e, lap_number AS period FROM laps WHERE driver_id = 'D2' AND pit)
 SELECT l.session_id, l.driver_id, l.lap_number, l.cum_ms, sc.period FROM laps l LEFT JOIN sc
  ON l.session_id = sc.session_id AND l.cum_ms >= sc.s AND l.cum_ms < sc.e""")
def j5_safety_car_laps(spark, sf_dir):
    """Laps that end inside a safety-car period (here: while one car stands in the pits)."""
    lp = _laps(spark, sf_dir)
    sc = lp.where("driver_id = 'D2' AND pit").select("session_id", F.col("cum_ms").alias("s"),
                                                     (F.col("cum_ms") + F.col("pit_duration_ms")).alias("e"),
                                                     F.col("lap_number").alias("period"))
    return L.interval_join(lp.select("session_id", "driver_id", "lap_number", "cum_ms"), sc, ["session_id"], "cum_ms", "s", "e",
                           ["period"], 30_000)


@register("j5_penalties", f"""{_L}
 SELECT session_id, driver_id, lap_number, CAST(1 + CASE WHEN pit THEN 1 ELSE 0 END + CASE WHEN lap_time_ms % 211 = 0 THEN 1 ELSE 0 END AS BIGINT) AS events,
  CASE WHEN lap_time_ms % 211 = 0 THEN 5.0::DOUBLE END AS penalty_seconds FROM laps""")
def j5_penalties(spark, sf_dir):
    lp = _laps(spark, sf_dir)
    ev = testbed.race_events(spark, sf_dir, lp)
    more = lp.where("lap_time_ms % 211 = 0").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("session_id", "driver_id", "lap_number") else F.col(f.name)
          for f in ev.schema.fields]).withColumns({
              "event_id": F.concat_ws("_", "session_id", F.lit("penalty"), "driver_id", F.col("lap_number").cast("string")),
              "event_type": F.lit("PENALTY"), "penalty_seconds": F.lit(5.0).cast("float")})
    x = L.laps_with_events(lp.select("session_id", "driver_id", "lap_number"), ev.unionByName(more))
    return x.select("session_id", "driver_id", "lap_number", "events", "penalty_seconds")


@register("a20_blue_flag", f"""{_LT},
 f AS (SELECT session_id, driver_id, lap_number, t_ms, (sample_no + lap_number) % 7 = 0 AS blue FROM telemetry WHERE copy_no = 0),
 d AS (SELECT *, lead(t_ms) OVER (PARTITION BY session_id, driver_id, lap_number ORDER BY t_ms) - t_ms AS dt FROM f)
 SELECT session_id, driver_id, lap_number, CAST(coalesce(sum(dt) FILTER (blue), 0) AS BIGINT) AS blue_flag_ms FROM d
  WHERE session_id IS NOT NULL GROUP BY 1, 2, 3""")
def a20_blue_flag(spark, sf_dir):
    tel = testbed.read_telemetry(spark, sf_dir).where("copy_no = 0 AND session_id IS NOT NULL").withColumn(
        "flag_state", F.when((F.col("sample_no") + F.col("lap_number")) % 7 == 0, "BLUE"))
    return serve.blue_flag_exposure(tel)


@register("x4_plan_vs_actual", f"""{_L},
 plan AS (SELECT DISTINCT session_id, driver_id, k AS stop_no, 12 * k AS planned_lap FROM laps, unnest([1, 2, 3]) AS u(k)),
 act AS (SELECT session_id, driver_id, lap_number AS actual_lap, row_number() OVER (PARTITION BY session_id, driver_id ORDER BY lap_number) AS stop_no
  FROM laps WHERE pit)
 SELECT session_id, driver_id, CAST(stop_no AS INT) AS stop_no, planned_lap, actual_lap, abs(actual_lap - planned_lap) AS lap_diff
 FROM plan FULL JOIN act USING (session_id, driver_id, stop_no)""")
def x4_plan_vs_actual(spark, sf_dir):
    lp = _laps(spark, sf_dir)
    plan = lp.select("session_id", "driver_id").distinct().select(
        "session_id", "driver_id", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])).alias("stop_no")).withColumn(
        "planned_lap", F.col("stop_no") * 12)
    return serve.plan_vs_actual(plan, lp.where("pit"))


_SESSIONS = """sess AS (SELECT session_id, 2023 + no % 3 AS year, no % 25 + 1 AS round, n_name || ' Grand Prix' AS event_name,
   CASE no % 2 WHEN 0 THEN 'Race' ELSE 'Qualifying' END AS session_name
  FROM (SELECT DISTINCT session_id, CAST(substr(session_id, 2) AS BIGINT) AS no FROM laps) JOIN nation ON n_nationkey = no % 25)"""


def _sessions(spark, sf_dir):
    no = testbed.session_no("session_id")
    s = _laps(spark, sf_dir).select("session_id").distinct().withColumn("no", no)
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), "n_name")
    return s.join(n, s["no"] % 25 == n["k"]).select(
        "session_id", (F.lit(2023) + F.col("no") % 3).alias("year"), (F.col("no") % 25 + 1).alias("round"),
        F.concat("n_name", F.lit(" Grand Prix")).alias("event_name"),
        F.when(F.col("no") % 2 == 0, "Race").otherwise("Qualifying").alias("session_name"))


@register("s9_laps_by_event_name", f"""{_L},\n {_SESSIONS}
 SELECT l.session_id, l.driver_id, l.lap_number FROM laps l SEMI JOIN (SELECT * FROM sess WHERE year >= 2023
  AND lower(event_name) LIKE '%an%' AND lower(session_name) = 'race') s USING (session_id)""")
def s9_laps_by_event_name(spark, sf_dir):
    lp = _laps(spark, sf_dir).select("session_id", "driver_id", "lap_number")
    return L.select_laps(lp, _sessions(spark, sf_dir), event="AN", session="RACE")


@register("s9_laps_by_round", f"""{_L},\n {_SESSIONS}
 SELECT l.session_id, l.driver_id, l.lap_number FROM laps l SEMI JOIN (SELECT * FROM sess WHERE round = 2 AND year = 2024) s USING (session_id)
 WHERE driver_id = 'D3'""")
def s9_laps_by_round(spark, sf_dir):
    lp = _laps(spark, sf_dir).select("session_id", "driver_id", "lap_number")
    return L.select_laps(lp, _sessions(spark, sf_dir), year=2024, event="2", driver="D3")


@register("p3_ingest_stamps", f"""SELECT topic, topic AS bronze_topic, count(*) AS records, count(*) AS stamped FROM (
  SELECT 'telemetry.raw' AS topic FROM ({_MSG_SQL} SELECT * FROM msg) UNION ALL SELECT 'race.events' FROM ({_EVT_SQL} SELECT * FROM evm)) GROUP BY 1, 2""")
def p3_ingest_stamps(spark, sf_dir):
    """Every parsed row carries its topic's name and the time it was read."""
    t, e = _telemetry_topic(spark, sf_dir, rendered=False)[0], _events_topic(spark, sf_dir, rendered=False)[0]
    cols = ["topic", "bronze_topic", "ingested_at"]
    return t.select(*cols).unionByName(e.select(*cols)).groupBy("topic", "bronze_topic").agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(F.col("ingested_at") <= F.current_timestamp(), 1)).alias("stamped"))


@register("p10_required_fields", f"""{_LT}
 SELECT driver_id, lap_number, sample_no, copy_no, t_ms, 'MISSING_SESSION_ID' AS reject_reason FROM telemetry WHERE session_id IS NULL""")
def p10_required_fields(spark, sf_dir):
    tel = testbed.read_telemetry(spark, sf_dir)
    return L.split_required(tel, ["session_id", "driver_id", "t_ms"])[1].select(
        "driver_id", "lap_number", "sample_no", "copy_no", "t_ms", "reject_reason")


@register("f9_pit_times", f"""{_L}
 SELECT session_id, driver_id, lap_number, pit_duration_ms AS stop_ms,
  make_timestamp((1709294400000 + CAST(substr(session_id, 2) AS BIGINT) * 3600000 + cum_ms + pit_duration_ms) * 1000) AS out_time FROM laps WHERE pit""")
def f9_pit_times(spark, sf_dir):
    """The stop's length from its two times, and the out time from the in time and the length."""
    ev = testbed.race_events(spark, sf_dir, _laps(spark, sf_dir)).where("event_type = 'PIT_STOP'")
    p = F.from_json("payload", "pit_in_time string, pit_out_time string")
    x = ev.withColumn("i", iso_to_ts(p["pit_in_time"])).withColumn("o", iso_to_ts(p["pit_out_time"]))
    x = x.withColumn("stop_ms", ms_between("o", "i"))
    return x.select("session_id", "driver_id", "lap_number", "stop_ms", add_ms("i", "stop_ms").alias("out_time"))


@register("f18_speed_in_metres", round_doubles.sql(f"""{_LT},\n {_VALID}
 SELECT session_id, driver_id, lap_number, avg(speed_kph) / 3.6 AS avg_speed_ms, max(speed_kph) / 3.6 AS max_speed_ms FROM clean GROUP BY 1, 2, 3""",
                                                   ["avg_speed_ms", "max_speed_ms"]))
def f18_speed_in_metres(spark, sf_dir):
    tel = L.clean_telemetry(testbed.stored_telemetry(spark, sf_dir))
    return round_doubles(tel.groupBy("session_id", "driver_id", "lap_number").agg(
        kph_to_ms(F.avg("speed_kph")).alias("avg_speed_ms"), kph_to_ms(F.max("speed_kph")).alias("max_speed_ms")))


@register("f18_harmonised_units", round_doubles.sql(f"""{_LT},\n {_VALID}
 SELECT session_id, driver_id, lap_number, avg(speed_kph / 1.609344) AS speed, avg(fuel_mass_kg / 0.45359237) AS fuel, max(t_ms * 0.001) AS t FROM clean
 GROUP BY 1, 2, 3""", ["speed", "fuel", "t"]))
def f18_harmonised_units(spark, sf_dir):
    """speed in miles per hour, fuel in pounds, time in seconds."""
    tel = L.clean_telemetry(testbed.stored_telemetry(spark, sf_dir))
    x = harmonised(tel, {"speed_kph": ("kph", "mph"), "fuel_mass_kg": ("kg", "lb"), "t_ms": ("ms", "s")})
    return round_doubles(x.groupBy("session_id", "driver_id", "lap_number").agg(
        F.avg("speed_kph").alias("speed"), F.avg("fuel_mass_kg").alias("fuel"), F.max("t_ms").alias("t")))


@register("w7_rolling_trends", round_doubles.sql(f"""{_LT},\n {_VALID},\n {_ASOF},\n {_FACT_LAP},
 d AS (SELECT *, lap_time_ms - lag(lap_time_ms) OVER w AS step FROM fact_lap WINDOW w AS (PARTITION BY session_id, driver_id ORDER BY lap_number))
 SELECT session_id, driver_id, lap_number, avg(step) OVER r AS degradation_ms_per_lap, avg(fuel_used_kg) OVER r AS fuel_per_lap_kg
 FROM d WINDOW r AS (PARTITION BY session_id, driver_id ORDER BY lap_number ROWS 2 PRECEDING)""",
                                                 ["degradation_ms_per_lap", "fuel_per_lap_kg"]))
def w7_rolling_trends(spark, sf_dir):
    return round_doubles(L.rolling_trends(_gold_fact_lap(spark, sf_dir)))


@register("k10_lap_metrics", f"""{_LT},\n {_VALID},\n {_ASOF},\n {_FACT_LAP},
 st0 AS (SELECT *, CASE WHEN lag(tyre_compound) OVER w IS NULL OR lag(tyre_compound) OVER w <> tyre_compound
   OR coalesce(lag(pit) OVER w, false) THEN 1 ELSE 0 END AS nw FROM laps WINDOW w AS (PARTITION BY session_id, driver_id ORDER BY lap_number)),
 st AS (SELECT session_id, driver_id, lap_number, concat_ws('_', session_id, driver_id, CAST(sum(nw) OVER (PARTITION BY session_id, driver_id
   ORDER BY lap_number ROWS UNBOUNDED PRECEDING) AS VARCHAR)) AS stint_id FROM st0)
 SELECT f.session_id, f.driver_id, f.lap_number, CAST(lap_time_ms AS BIGINT) AS lap_time_ms, sector1_ms, sector2_ms, sector3_ms,
  CAST(avg_speed_kph AS FLOAT) AS avg_speed_kph, CAST(max_speed_kph AS FLOAT) AS max_speed_kph, CAST(min_speed_kph AS FLOAT) AS min_speed_kph,
  tyre_compound, CAST(fuel_used_kg AS FLOAT) AS fuel_used_kg, CAST(battery_delta_pct AS FLOAT) AS battery_delta_pct, stint_id,
  CASE WHEN samples < 8 THEN 'PARTIAL' ELSE 'COMPLETE' END AS tag
 FROM fact_lap f LEFT JOIN st USING (session_id, driver_id, lap_number)""")
def k10_lap_metrics(spark, sf_dir):
    """Lap facts in the declared lap-metrics layout; ``generated_at`` cannot be compared, ``metadata`` holds one tag."""
    m = L.lap_metrics(_gold_fact_lap(spark, sf_dir), L.with_stints(_laps(spark, sf_dir)))
    assert [(f.name, f.dataType) for f in m.schema] == [(f.name, f.dataType) for f in LAP_METRICS_SCHEMA]
    return m.drop("generated_at").withColumn("tag", F.element_at("metadata", 1)).drop("metadata")


ACCELERATION = (150, 250)


@register("f17_acceleration", f"""{_LT},\n {_VALID},
 a AS (SELECT *, last_value(CASE WHEN speed_kph <= {ACCELERATION[0]} THEN t_ms END IGNORE NULLS) OVER (PARTITION BY session_id, driver_id, lap_number
   ORDER BY t_ms ROWS UNBOUNDED PRECEDING) AS slow FROM clean)
 SELECT session_id, driver_id, lap_number, min(t_ms - slow) AS acceleration_ms FROM a WHERE speed_kph >= {ACCELERATION[1]} AND slow IS NOT NULL
 GROUP BY 1, 2, 3""")
def f17_acceleration(spark, sf_dir):
    """From 150 to 250 kph: the derived samples never stand still."""
    return L.acceleration_times(L.clean_telemetry(testbed.stored_telemetry(spark, sf_dir)), *ACCELERATION)
