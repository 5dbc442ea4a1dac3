"""Lap facts are made where laps and samples lie, messages are parsed once, and losses are counted without a join."""

import pytest

import __spark_entry__ as entry
from paths import SMALL
from kerbside.operators import laps as L, quality
from kerbside.session import configured, shuffles_removed
from kerbside.sources import envelope, testbed
from kerbside.sources.schemas import RACE_EVENT_SCHEMA, TELEMETRY_SCHEMA

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _plan(df, stage: str = "executedPlan") -> str:
    return getattr(df._jdf.queryExecution(), stage)().toString()


@pytest.mark.parametrize("name", ["a12_fact_lap", "a13_fact_stint", "k10_lap_metrics", "w7_rolling_trends"])
def test_lap_facts_are_made_without_a_shuffle(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    assert "Exchange" not in plan and "gold_fact_lap" not in plan


def test_each_message_is_parsed_once_for_its_facts(spark):
    lp = testbed.stored_laps(spark, SMALL)
    tel = envelope.parsed_view(envelope.raw_view(testbed.telemetry_messages(spark, SMALL, lp)), TELEMETRY_SCHEMA, "telemetry.raw")
    ev = envelope.parsed_view(envelope.raw_view(testbed.event_messages(spark, SMALL, lp)), RACE_EVENT_SCHEMA, "race.events")
    plan = _plan(L.gold_fact_lap(tel, ev), "optimizedPlan")
    assert plan.count("StructField(fuel_mass_kg") == 1  # the schema of a sample
    physical = _plan(L.gold_fact_lap(tel, ev))
    assert "ENSURE_REQUIREMENTS" not in physical  # samples and events are dealt once, by (session, driver)


def test_samples_without_a_driver_stay_in_their_facts(spark):
    laps = spark.createDataFrame([("S", "D", 1, 100, "SOFT"), ("S", None, 1, 100, "HARD")],
                                 "session_id string, driver_id string, lap_number int, cum_ms long, tyre_compound string")
    samples = spark.createDataFrame([("S", "D", 5), ("S", "D", 101), ("S", None, 5)], "session_id string, driver_id string, t_ms long")
    got = {True: None, False: None}
    for laid_out in got:
        rows = L.asof_forward_join(samples, laps, carry=["tyre_compound"], laid_out=laid_out).collect()
        got[laid_out] = sorted((str(r.driver_id), r.t_ms, r.asof_lap_number, str(r.asof_tyre_compound)) for r in rows)
    assert got[True] == got[False] == [("D", 5, 1, "SOFT"), ("D", 101, 0, "None"), ("None", 5, 0, "None")]


def test_losses_are_counted_without_a_join(spark):
    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "10m"}):
        assert "Join" not in _plan(entry.queries()["q2_parse_loss"](spark, SMALL), "optimizedPlan")


def test_losses_with_copies_and_missing_coordinates(spark):
    key = "topic string, partition int, offset long"
    raw = spark.createDataFrame([("a", 0, 1), ("a", 0, 1), ("a", 0, 2), ("a", 0, 2), ("a", None, 3), (None, 0, 4)], key)
    parsed = spark.createDataFrame([("a", 0, 1, None), ("a", 0, 1, 5), ("a", None, 3, 5), ("b", 1, 1, 5)], key + ", x int")
    got = {r.topic: (r.raw, r.parsed, r.unparsed, r.lost) for r in quality.parse_loss(raw, parsed, ["x"]).collect()}
    assert got == {"a": (5, 3, 1, 3), "b": (0, 1, 0, 0), None: (1, 0, 0, 1)}


def test_shuffles_go_with_the_write_of_a_stored_table(spark, monkeypatch):
    before, seen = spark.conf.get(CLEANUP), []
    testbed.stored_table(spark, SMALL, "one_number", lambda: seen.append(spark.conf.get(CLEANUP)) or spark.range(1))
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before
    with pytest.raises(ValueError), shuffles_removed(spark):
        raise ValueError
    assert spark.conf.get(CLEANUP) == before


def test_log_streams_are_rendered_as_they_are_read(spark):
    from kerbside.plans import streams
    from kerbside.sources.schemas import ENVELOPE_SCHEMA
    fields = [f.name for f in ENVELOPE_SCHEMA.fields]
    for topic, log in (("telemetry.raw", testbed.telemetry_log(spark, SMALL)), ("race.events", testbed.event_messages(spark, SMALL))):
        got = []
        stream = envelope.read_envelope(spark, topic, {}, log=testbed.log_stream(spark, SMALL, topic, files=3))
        (stream.writeStream.trigger(availableNow=True).foreachBatch(lambda b, n: got.append([tuple(r) for r in b.collect()])).start()
         .awaitTermination())
        assert len(got) == 3  # eight files of laps
        assert sorted(sum(got, []), key=str) == sorted((tuple(r) for r in log.select(*fields).collect()), key=str)
    with pytest.raises(ValueError, match="latest"):
        envelope.read_envelope(spark, topic, {"startingOffsets": "latest"}, log=stream)
    assert not hasattr(streams, "_land")


@pytest.mark.parametrize("name", ["p2_parsed_telemetry", "a18_late_arrivals", "a18_null_rates", "q2_parse_loss"])
def test_messages_are_rendered_in_a_step_of_their_own(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL), "optimizedPlan")
    assert not [line for line in plan.splitlines() if "from_json(" in line and "to_json(" in line]


def test_stamps_need_no_rendered_message(spark):
    assert "to_json(" not in _plan(entry.queries()["p3_ingest_stamps"](spark, SMALL), "optimizedPlan")
