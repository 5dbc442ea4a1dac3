"""Streams joined, enriched and kept as state; merged nodes; what a checkpoint tells."""

import datetime as dt
import os

from pyspark.sql import functions as F

from kerbside.operators import laps as L
from kerbside.sources.schemas import ENVELOPE_SCHEMA, RACE_EVENT_SCHEMA
from kerbside.streaming import bronze, checkpoints, closed_laps, gold, lap_events, versions

NOON = dt.datetime(2024, 3, 1, 12)
EVENTS = "session_id string, driver_id string, lap_number int, event_id string, event_ts_utc string, event_type string, " \
         "pit_duration_ms long, penalty_seconds float, safety_car_state string, payload string"


def _at(seconds):
    return (NOON + dt.timedelta(seconds=seconds)).isoformat()


def _ms(seconds):
    return int((NOON - dt.datetime(1970, 1, 1)).total_seconds() * 1000) + int(seconds * 1000)


def _land(spark, rows, schema, path, n):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/f{n}")


def _event(driver, lap, seconds, kind="LAP_COMPLETION", lap_ms=90000, n=0):
    payload = f'{{"lap_time_ms":{lap_ms},"compound":"SOFT"}}' if kind == "LAP_COMPLETION" else None
    return ("S1", driver, lap, f"{kind}-{driver}-{lap}-{n}", _at(seconds), kind, 2000 if kind == "PIT_STOP" else None,
            5.0 if kind == "PENALTY" else None, None, payload)


def _run_to_end(df, base, mode="append"):
    def write(batch, n):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}")
    df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).foreachBatch(write).start() \
        .awaitTermination()


def _joined(spark, base):
    s = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1)
    laps = lap_events.laps_stream(s.parquet(f"{base}/laps/*"))
    events = lap_events.events_stream(s.parquet(f"{base}/events/*"))
    _run_to_end(lap_events.laps_with_events(laps, events), base)
    return spark.read.parquet(f"{base}/out")


def test_stream_join_of_laps_and_events(spark, tmp_path):
    """Matched at once, over batches and in either order; without an event only when the watermark has passed the bound;
    events outside the bound, of another lap, or late meet nothing; a second run goes on from the checkpoint."""
    base = str(tmp_path)
    _land(spark, [_event("A", 1, 90), _event("A", 2, 180), _event("B", 1, 95)], EVENTS, f"{base}/laps", 0)
    _land(spark, [_event("A", 2, 185, "PIT_STOP"), _event("A", 2, 190, "PENALTY"), _event("B", 1, 500, "PIT_STOP")], EVENTS, f"{base}/events", 0)
    first = _joined(spark, base)
    got = {(r.driver_id, r.lap_number, r.event_type) for r in first.collect()}
    assert got == {("A", 2, "PIT_STOP"), ("A", 2, "PENALTY")}  # laps without an event still wait
    # an hour later: both streams' watermarks pass the bounds of the first laps
    _land(spark, [_event("A", 40, 3700)], EVENTS, f"{base}/laps", 1)
    _land(spark, [_event("A", 40, 3700, "PIT_STOP")], EVENTS, f"{base}/events", 1)
    got = sorted((r.driver_id, r.lap_number, str(r.event_type)) for r in _joined(spark, base).collect())
    assert got == [("A", 1, "None"), ("A", 2, "PENALTY"), ("A", 2, "PIT_STOP"), ("A", 40, "PIT_STOP"), ("B", 1, "None")]
    # late: the lap of an hour ago has gone, its event meets nothing and changes nothing
    _land(spark, [_event("A", 41, 3800)], EVENTS, f"{base}/laps", 2)
    _land(spark, [_event("A", 1, 91, "PIT_STOP"), _event("A", 41, 3801, "PENALTY")], EVENTS, f"{base}/events", 2)
    out = _joined(spark, base)
    assert out.where("lap_number = 1 and driver_id = 'A'").select("event_id").collect()[0][0] is None
    per = {(r.driver_id, r.lap_number): r for r in lap_events.per_lap(out).collect()}
    assert per["A", 2].pit_stops == 1 and per["A", 2].events == 2 and per["A", 2].pit_time_ms == 2000 and per["A", 2].penalty_seconds == 5.0
    assert per["A", 1].events == 0 and per["A", 1].pit_time_ms is None and len(per) == 5


def test_stream_join_equals_tables(spark, tmp_path):
    rows = [_event(d, n, 90 * n) for d in "AB" for n in range(1, 8)] + [_event("A", n, 90 * n + 30 * n, "PIT_STOP") for n in (2, 5, 7)]
    table = spark.createDataFrame(rows, EVENTS)
    want = lap_events.laps_with_events(lap_events.laps_stream(table), lap_events.events_stream(table))
    got = {(r.driver_id, r.lap_number): r.event_id for r in want.collect()}
    assert got["A", 2] and got["A", 5] and got["A", 7] is None and got["B", 2] is None  # 7: 210 s after its end
    assert len(got) == 14


SAMPLES = closed_laps.ROWS


def _sample(driver, seconds, speed, place, fuel=None, battery=None):
    return ("S1", driver, NOON + dt.timedelta(seconds=seconds), _ms(seconds), place, float(speed), fuel, battery, None, None, None)


def _end(driver, lap, seconds, lap_ms=90000, compound="SOFT"):
    return ("S1", driver, NOON + dt.timedelta(seconds=seconds), _ms(seconds), None, None, None, None, lap, lap_ms, compound)


def _closed(spark, base):
    rows = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(f"{base}/rows/*").withWatermark("event_time", "2 minutes")
    with closed_laps.configured(spark):
        _run_to_end(closed_laps.closed_laps(rows), base)
    return sorted((r.driver_id, r.lap_number, r.samples, r.avg_speed_kph) for r in spark.read.schema(
        "driver_id string, lap_number int, samples long, avg_speed_kph double").parquet(f"{base}/out").collect())


def test_laps_close_from_state_and_survive_a_restart(spark, tmp_path):
    base = str(tmp_path)
    _land(spark, [_sample("A", 10, 100, 1), _sample("A", 10, 999, 2), _sample("A", 90, 200, 3), _sample("A", 91, 300, 4), _end("A", 1, 90),
                  _end("A", 1, 90), _sample("B", 20, 50, 5)], SAMPLES, f"{base}/rows", 0)
    assert _closed(spark, base) == []  # the watermark has not passed the lap's end
    _land(spark, [_sample("A", 150, 500, 6), _end("A", 2, 180), _sample("A", 300, 7, 7)], SAMPLES, f"{base}/rows", 1)
    # of two samples of one time the first in the log counts; the sample at the end belongs to the lap
    assert _closed(spark, base) == [("A", 1, 2, 150.0), ("A", 2, 2, 400.0)]
    # late rows of a closed lap change nothing; B's lap is told at last, and its sample was kept
    _land(spark, [_sample("A", 179, 1, 8), _end("B", 1, 305, lap_ms=None), _sample("C", 900, 1, 9)], SAMPLES, f"{base}/rows", 2)
    got = _closed(spark, base)
    assert got == [("A", 1, 2, 150.0), ("A", 2, 2, 400.0), ("B", 1, 1, 50.0)]


def test_dimension_version_between_batches_counts_for_the_next(spark, tmp_path):
    base, dim = str(tmp_path), str(tmp_path / "drivers")
    teams = lambda *rows: spark.createDataFrame(list(rows), "driver_id string, team_id string")
    defaults = {"team_id": "UNKNOWN"}

    def run():
        def write(batch, n):
            batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}")
        rows = spark.readStream.schema("id int, driver_id string").parquet(f"{base}/rows/*")
        (rows.writeStream.option("checkpointLocation", f"{base}/ck").trigger(availableNow=True)
         .foreachBatch(versions.enriching_writer(spark, dim, "driver_id", defaults, write)).start().awaitTermination())

    _land(spark, [(1, "A")], "id int, driver_id string", f"{base}/rows", 0)
    run()  # no version yet
    versions.publish(teams(("A", "T1"), ("B", None), (None, "T9")), dim, 1)
    _land(spark, [(2, "A"), (3, "B"), (4, "X"), (5, None)], "id int, driver_id string", f"{base}/rows", 1)
    run()
    versions.publish(teams(("A", "T2"), ("A", "T3")), dim, 2)
    os.makedirs(f"{dim}/version=3")  # a version in the making
    _land(spark, [(6, "A")], "id int, driver_id string", f"{base}/rows", 2)
    run()
    got = {r.id: r.team_id for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: "UNKNOWN", 2: "T1", 3: "UNKNOWN", 4: "UNKNOWN", 5: "UNKNOWN", 6: "T2"}


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_writes_the_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "nodes")
    frame = lambda rows: spark.createDataFrame(rows, "id string, label string, value long, seen long")
    versions.merge(spark, frame([(f"n{i}", "x", i, 0) for i in range(2000)]), path, ["id", "label"], "seen", 0, buckets=16)
    before = _files(path)
    size = lambda files: sum(os.path.getsize(f) for f in files)
    versions.merge(spark, frame([("n5", "x", 500, 1), ("new", "x", 1, 1)]), path, ["id", "label"], "seen", 1, buckets=16)
    written = {f for f in _files(path) - before if "/data/" in f}
    assert before <= _files(path) and 1 <= len(written) <= 2 and size(written) < size(before) / 4
    table = versions.read_merged(spark, path)
    assert table.count() == 2001 and table.columns == ["id", "label", "value", "seen"]
    assert {r.id: r.value for r in table.where("id in ('n5', 'n6', 'new')").collect()} == {"n5": 500, "n6": 6, "new": 1}
    # a repeated batch starts from the manifest before it
    versions.merge(spark, frame([("n5", "x", 501, 1)]), path, ["id", "label"], "seen", 1, buckets=16)
    table = versions.read_merged(spark, path)
    assert table.count() == 2000 and table.where("id = 'n5'").first().value == 501
    assert versions.merge(spark, frame([]), path, ["id", "label"], "seen", 2, buckets=16)
    assert versions.read_merged(spark, str(tmp_path / "none")) is None


def test_nodes_keep_their_properties_and_teams(spark):
    laps = spark.createDataFrame([("S1", d, n, 90000, "SOFT", False) for d in "AB" for n in (1, 2)],
                                 "session_id string, driver_id string, lap_number int, lap_time_ms long, tyre_compound string, pit boolean")
    drivers = spark.createDataFrame([("A", "T1"), ("B", "T1"), ("C", "T2")], "driver_id string, team_id string")
    pos = L.positions(laps)
    rows = {(r.label, r.id): r for r in gold.gold_nodes(pos, 3, drivers).collect()}
    assert rows["Driver", "A"].team_id == "T1" and rows["Team", "T1"].drivers == 2 and rows["Session", "S1"].drivers == 2
    assert rows["Lap", "S1/A/2"].lap_time_ms == 90000 and rows["Lap", "S1/A/2"].seen_batch == 3 and len(rows) == 9
    assert gold.gold_nodes(pos, 3).where("label = 'Team' or team_id is not null").count() == 0


def test_checkpoint_tells_commits_loss_and_lag(spark, tmp_path):
    base, topic = str(tmp_path), "race.events"
    row = lambda i: (f"k{i}", "{}", topic, i % 3, i, NOON)
    run = lambda: [q.awaitTermination() for q in bronze.start_bronze(
        spark, {topic: RACE_EVENT_SCHEMA}, {"maxFilesPerTrigger": "1"}, f"{base}/bronze", f"{base}/ck", path=f"{base}/in put/*", available_now=True)]
    for n in range(13):  # more batches than a source's log holds before it is compacted
        _land(spark, [row(i) for i in range(4 * n, 4 * n + 4)], ENVELOPE_SCHEMA, f"{base}/in put", n)
    run()
    _land(spark, [row(i) for i in range(100, 107)], ENVELOPE_SCHEMA, f"{base}/in put", 20)
    ck = f"{base}/ck/{bronze.table_name(topic, 'bronze')}"
    assert checkpoints.committed(spark, ck).count() == 13
    assert [(r.source, r.topic, r.end_offset, r.batches) for r in checkpoints.last_offsets(spark, ck).collect()] == [(0, None, 12, 13)]
    files = checkpoints.committed_files(spark, ck)
    assert files.count() == 13 and files.select("batch").distinct().count() == 13
    landed = spark.read.schema(ENVELOPE_SCHEMA).parquet(f"{base}/in put/*").select("topic", "partition", "offset",
                                                                                   F.col("_metadata.file_path").alias("file"))
    raw = gold.read_complete(spark, f"{base}/bronze/race_events-raw")
    assert tuple(checkpoints.reconcile(landed, raw, files).first()) == (topic, 59, 52, 0, 7)
    assert tuple(checkpoints.reconcile(landed, raw.where("offset <> 9"), files).first()) == (topic, 59, 52, 1, 7)


def test_offsets_of_a_log_source(spark, tmp_path):
    """Topics and partitions as a message log writes them; a batch that was planned but not committed does not count."""
    ck = tmp_path / "ck"
    (ck / "offsets").mkdir(parents=True)
    (ck / "commits").mkdir()
    for batch, end in ((0, 10), (1, 25), (2, 40)):
        (ck / "offsets" / str(batch)).write_text('v1\n{"batchWatermarkMs":0}\n{"t.raw":{"0":%d,"1":%d}}\n-' % (end, end + 1))
    for batch in (0, 1):
        (ck / "commits" / str(batch)).write_text('v1\n{"nextBatchWatermarkMs":0}')
    got = sorted(map(tuple, checkpoints.last_offsets(spark, str(ck)).collect()))
    assert got == [(0, "t.raw", 0, 25, 2), (0, "t.raw", 1, 26, 2)]


def test_a_key_reads_and_writes_its_state_once_a_call():
    import pandas as pd

    class Value:
        held, calls = None, 0

        def get(self):
            self.calls += 1
            return self.held

        def update(self, row):
            self.calls += 1
            self.held = row

    class Handle:
        timers: list = []

        def getValueState(self, name, schema):  # noqa: N802
            return Value()

        def registerTimer(self, at):  # noqa: N802
            self.timers.append(at)

        def deleteTimer(self, at):  # noqa: N802
            self.timers.remove(at)

    class Watermark:
        def getCurrentWatermarkInMs(self):  # noqa: N802
            return 1000

    closer = closed_laps.LapCloser()
    closer.init(Handle())
    names = [x.split()[0] for x in closed_laps.ROWS.split(",")]
    rows = [("S", "D", None, t, p, speed, 10.0 - t / 1000, None, None, None, None) for t, p, speed in (
        (100, 2, 9.0), (100, 1, 5.0), (900, 3, None), (1500, 4, 7.0))]
    rows += [("S", "D", None, end, None, None, None, None, n, None, "SOFT") for n, end in ((1, 500), (2, 1000), (3, 2000), (2, 1100))]
    list(closer.handleInputRows(("S", "D"), iter([pd.DataFrame(rows, columns=names)]), None))
    assert closer.handle.timers == [500] and closer.state.calls == 2
    (out,) = closer.handleExpiredTimer(("S", "D"), Watermark(), None)
    assert closer.state.calls == 4
    assert out[["lap_number", "lap_end_ms", "samples"]].to_numpy().tolist() == [[1, 500, 1], [2, 1000, 1]]
    assert out["avg_speed_kph"].tolist()[0] == 5.0 and pd.isna(out["avg_speed_kph"].tolist()[1])
    late = [("S", "D", None, 950, 9, 1.0, 1.0, None, None, None, None), ("S", "D", None, 990, None, None, None, None, 9, None, None)]
    list(closer.handleInputRows(("S", "D"), iter([pd.DataFrame(late, columns=names)]), None))
    held, laps, closed, timer = closer._open()
    assert held["t"].tolist() == [1500] and list(laps) == [3] and (closed, timer) == (1000, 2000)
