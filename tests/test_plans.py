"""Plan guards: no registered query plans a Cartesian product, a nested-loop join or a
Python UDF, and scans read only the columns they need."""

import pytest

import __spark_entry__ as entry
from paths import SMALL
from kerbside.plans.catalog import QUERIES as BASE

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(BASE))
def test_no_banned_operators(spark, name):
    df = entry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BANNED if b in plan], plan[:2000]


def test_alert_scan_is_pruned(spark):
    df = entry.queries()["p5_high_amount"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_every_lineitem_row_is_a_lap(spark):
    from kerbside.sources import testbed
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    laps = testbed.laps(spark, SMALL)
    assert laps.count() == rows == laps.select("session_id", "driver_id", "lap_number").distinct().count()
    log = testbed.telemetry_messages(spark, SMALL)
    assert log.count() == log.select("offset").distinct().count()


def test_trend_over_sessions_spans_ranges(spark, monkeypatch):
    from kerbside.operators import serve
    monkeypatch.setattr(serve, "SESSIONS_PER_RANGE", 4)
    rows = [(f"S{i}", d, 1000 + i * i) for i in range(0, 30, 3) for d in ("A", "B")]
    df = spark.createDataFrame(rows, "session_id string, driver_id string, lap_time_ms bigint")
    got = {(r.driver_id, r.session_id): r.delta_vs_prev_session_ms for r in serve.multi_session_trend(df).collect()}
    for d in ("A", "B"):
        for i in range(0, 30, 3):
            assert got[d, f"S{i}"] == (None if i == 0 else i * i - (i - 3) ** 2)


@pytest.mark.parametrize("name,parses", [("p2_parsed_telemetry", 1), ("q2_parse_loss", 2)])
def test_messages_are_parsed_once(spark, name, parses):
    df = entry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == parses, plan[:3000]
