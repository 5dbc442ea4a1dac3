"""Operators whose inputs do not exist in the test tables (weather readings, strategy
plans, flag channel), checked on literal fixtures."""

import json

from kerbside.operators import laps as L, serve
from kerbside.streaming import gold
from kerbside.streaming.alerts import as_records


def test_last_reading_attached_to_every_sample(spark):
    samples = spark.createDataFrame([("S1", 1), ("S1", 2), ("S2", 3), ("S3", 4)], "session_id string, t_ms int")
    weather = spark.createDataFrame([("S1", 10, 20.0, 30.0), ("S1", 30, 21.5, 31.0), ("S2", 5, 18.0, 25.0)],
                                    "session_id string, ts int, air_temp double, track_temp double")
    got = {(r.session_id, r.t_ms): r.air_temp
           for r in L.attach_last_reading(samples, weather, "session_id", "ts", ["air_temp", "track_temp"]).collect()}
    assert got == {("S1", 1): 21.5, ("S1", 2): 21.5, ("S2", 3): 18.0, ("S3", 4): None}


def test_plan_vs_actual(spark):
    plan = spark.createDataFrame([("S", "A", 1, 18), ("S", "A", 2, 40), ("S", "B", 1, 25)],
                                 "session_id string, driver_id string, stop_no int, planned_lap int")
    pits = spark.createDataFrame([("S", "A", 20), ("S", "B", 22), ("S", "B", 45)],
                                 "session_id string, driver_id string, lap_number int")
    got = sorted((r.driver_id, r.stop_no, r.planned_lap, r.actual_lap, r.lap_diff)
                 for r in serve.plan_vs_actual(plan, pits).collect())
    assert got == [("A", 1, 18, 20, 2), ("A", 2, 40, None, None), ("B", 1, 25, 22, 3), ("B", 2, None, 45, None)]


def test_blue_flag_exposure(spark):
    rows = [("S", "A", 1, 0, None), ("S", "A", 1, 100, "BLUE"), ("S", "A", 1, 250, "BLUE"), ("S", "A", 1, 400, None),
            ("S", "A", 2, 500, "BLUE")]
    df = spark.createDataFrame(rows, "session_id string, driver_id string, lap_number int, t_ms int, flag_state string")
    got = {r.lap_number: r.blue_flag_ms for r in serve.blue_flag_exposure(df).collect()}
    assert got == {1: 300, 2: 0}


def test_null_guards_and_keyed_records(spark):
    df = spark.createDataFrame([("S", "A", 1), (None, "A", 2), ("S", None, 3)], "session_id string, driver_id string, n int")
    assert [r.n for r in L.non_null(df, ["session_id", "driver_id"]).collect()] == [1]
    rec = gold.lap_metrics_records(spark.createDataFrame([("S", "A", 3, 91000)],
                                                         "session_id string, driver_id string, lap_number int, lap_time_ms long"))
    r = rec.first()
    assert r.key == "S_A_3" and json.loads(r.value)["lap_time_ms"] == 91000
    alerts = spark.createDataFrame([("c1", "HIGH_AMOUNT")], "card_number string, fraud_rule string")
    a = as_records(alerts).first()
    assert a.key == "c1" and json.loads(a.value) == {"card_number": "c1", "fraud_rule": "HIGH_AMOUNT"}


def test_asof_reading_without_look_ahead(spark):
    samples = spark.createDataFrame([("S1", t) for t in (0, 5, 10, 29, 30, 1000)] + [("S2", 7)],
                                    "session_id string, t_ms long")
    weather = spark.createDataFrame([("S1", 5, 20.0), ("S1", 30, 22.0), ("S2", 8, 18.0)],
                                    "session_id string, ts long, air_temp double")
    got = sorted((r.session_id, r.t_ms, r.air_temp) for r in
                 L.attach_asof_reading(samples, weather, "session_id", "t_ms", "ts", ["air_temp"], bucket=10).collect())
    assert got == [("S1", 0, None), ("S1", 5, 20.0), ("S1", 10, 20.0), ("S1", 29, 20.0), ("S1", 30, 22.0),
                   ("S1", 1000, 22.0), ("S2", 7, None)]
