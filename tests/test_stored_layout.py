"""Stored laps and samples: what goes by (session, driver) reads them without a shuffle, and messages are not stored."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paths import SMALL
from kerbside.operators import graph, laps as L, serve
from kerbside.session import checkpoint_dir, joins_in_place
from kerbside.sources import testbed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark) -> set:
    root = checkpoint_dir(spark).removeprefix("file:") + "/testbed"
    return {d for _, dirs, _ in os.walk(root) for d in dirs}


def test_samples_are_cleaned_without_a_shuffle(spark):
    assert "Exchange" not in _plan(L.clean_telemetry(testbed.stored_telemetry(spark, SMALL)))
    assert "Exchange" not in _plan(L.with_stints(testbed.stored_laps(spark, SMALL)))


def test_stored_and_read_samples_are_the_same(spark):
    stored, read = testbed.stored_telemetry(spark, SMALL), testbed.read_telemetry(spark, SMALL)
    assert stored.columns == read.columns
    assert stored.exceptAll(read).isEmpty() and read.exceptAll(stored).isEmpty()


@pytest.mark.parametrize("name", ["p1_raw_envelope", "p2_parsed_telemetry"])
def test_messages_are_rendered_as_they_are_read(spark, name):
    entry.queries()[name](spark, SMALL).count()
    assert "telemetry_log" not in _tables(spark)


def test_nodes_read_laps_only(spark):
    plan = _plan(entry.queries()["g5_nodes"](spark, SMALL))
    assert "gold_" not in plan and "Window" not in plan


def test_first_lap_takes_all_samples_before_its_end(spark):
    laps = spark.createDataFrame([("S", "D", 1, 100), ("S", "D", 2, 90_000), ("S", "E", 5, 70)],
                                 "session_id string, driver_id string, lap_number int, cum_ms long")
    rows = [("S", "D", t) for t in (-10 ** 9, 100, 101, 90_000, 90_001, None)] + [(None, "D", 5), ("S", "F", 5)]
    got = L.asof_forward_join(spark.createDataFrame(rows, "session_id string, driver_id string, t_ms long"), laps)
    assert sorted((str(r.session_id), r.driver_id, str(r.t_ms), r.asof_lap_number) for r in got.collect()) == sorted([
        ("S", "D", "-1000000000", 1), ("S", "D", "100", 1), ("S", "D", "101", 2), ("S", "D", "90000", 2), ("S", "D", "90001", 0),
        ("S", "D", "None", 0), ("None", "D", "5", 0), ("S", "F", "5", 0)])


def test_lap_events_are_parsed_before_they_travel(spark):
    rows = [("S", "D", 1, "e1", "LAP_COMPLETION", f'{{"lap_time_ms": {ms}, "compound": "SOFT"}}', 0, off) for ms, off in ((7, 2), (5, 1))]
    ev = spark.createDataFrame(rows, "session_id string, driver_id string, lap_number int, event_id string, event_type string, "
                                     "payload string, partition int, offset long")
    got = L.lap_events(ev)
    assert [(r.lap_time_ms, r.event_compound) for r in got.collect()] == [(5, "SOFT")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") > plan.index("RepartitionByExpression")


def test_samples_are_not_stored_and_lie_as_the_laps(spark):
    for name in ("f17_driving_metrics", "f17_acceleration", "f18_speed_in_metres", "f18_harmonised_units", "w8_zscore_anomalies"):
        assert "Exchange" not in _plan(entry.queries()[name](spark, SMALL))
    assert "telemetry" not in _tables(spark)


def test_buckets_go_by_rows_not_by_bytes(spark, tmp_path):
    rows = spark.range(100_000).select(*[F.lit(1).cast("bigint").alias(c) for c in ("l_orderkey", "l_linenumber")])
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")  # a few hundred bytes
    assert testbed.lap_buckets(spark, str(tmp_path)) == 8
    rows.unionByName(rows).unionByName(rows).unionByName(rows).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert testbed.lap_buckets(spark, str(tmp_path)) == 11


def test_race_order_travels_narrow(spark):
    laps = testbed.stored_laps(spark, SMALL)
    narrow, wide = L.race_positions(laps, 5), L.positions(laps)
    assert narrow.exceptAll(wide.select(*narrow.columns)).isEmpty() and narrow.count() == wide.count()
    assert _plan(narrow).count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in _plan(narrow)


def test_close_pairs_without_keys_or_times(spark):
    rows = [(s, n, d, ms, p) for s, n in (("S", 1), (None, 1), ("S", None)) for d, ms, p in (
        ("A", 0, 1), ("B", 0, 2), ("C", 999, 3), ("D", 1000, 4), ("E", None, 5), ("F", None, 6))]
    pos = spark.createDataFrame([(*r, None) for r in rows], "session_id string, lap_number int, driver_id string, race_ms long, "
                                                            "position int, next_position int")
    for parts in (None, 3):
        got = {(r.ahead_id, r.behind_id, r.gap_ms) for r in graph.close_pairs(pos, parts=parts).collect()}
        assert got == {("A", "B", 0), ("A", "C", 999), ("B", "C", 999), ("C", "D", 1)}


def test_ranks_and_communities_shuffle_once(spark):
    nodes = spark.createDataFrame([(s, x) for s in "ST" for x in "abc"], "session_id string, node string")
    edges = spark.createDataFrame([("S", "a", "b", 1.0), ("S", "b", "c", 2.0), ("T", "a", "c", 1.0)],
                                  "session_id string, src string, dst string, weight double")
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with joins_in_place(spark):
        trans, ranks = graph._transitions(nodes, edges, 3)
        assert "Exchange hash" not in _plan(graph._round(trans, ranks, 0.85))
    assert spark.conf.get(key) == before
    one, other = (graph.pagerank(nodes, edges, parts=n).orderBy("session_id", "node").collect() for n in (1, 7))
    assert [r.rank for r in one] == pytest.approx([r.rank for r in other])


def test_cap_by_group_first(spark):
    rows = [(s, d, t) for s in ("S", None) for d in ("A", "B", None) for t in range(9)]
    df = spark.createDataFrame(rows, "session_id string, driver_id string, t_ms long")
    whole = serve.cap_per_session(df, 5, ["t_ms", "driver_id"])
    got = serve.cap_per_session(df, 5, ["t_ms", "driver_id"], within=["driver_id"], parts=3)
    assert got.count() == 10 and got.exceptAll(whole).isEmpty()


def test_samples_without_a_key_have_no_lap_and_stay(spark):
    laps = spark.createDataFrame([(None, "D", 1, 100, "SOFT"), ("S", None, 1, 100, "SOFT"), ("S", "D", 1, 100, "SOFT")],
                                 "session_id string, driver_id string, lap_number int, cum_ms long, tyre_compound string")
    samples = spark.createDataFrame([(None, "D", 5), ("S", None, 5), ("S", "D", 5)], "session_id string, driver_id string, t_ms long")
    got = L.asof_forward_join(samples, laps, carry=["tyre_compound"]).collect()
    assert sorted((r.asof_lap_number, str(r.asof_tyre_compound)) for r in got) == [(0, "None"), (0, "None"), (1, "SOFT")]
