"""Column helpers and quality checks."""

import datetime as dt

from pyspark.sql import functions as F

from kerbside.functions import scalars as S
from kerbside.operators import quality
from kerbside.sources import envelope


def test_iso_helpers(spark):
    df = spark.createDataFrame([("2026-03-21T07:23:33.427679Z",), ("2026-03-21T07:23:33",), ("junk",)], "s string")
    got = [r.t for r in df.select(S.iso_to_ts("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2026, 3, 21, 7, 23, 33, 427000) and got[1] == dt.datetime(2026, 3, 21, 7, 23, 33)
    assert got[2] is None
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0),), (dt.datetime(2024, 1, 1, 0, 0, 0, 5000),)], "t timestamp")
    assert [r.s for r in ts.select(S.isoformat("t").alias("s")).collect()] == \
        ["2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.005000+00:00"]


def test_ids_masks_and_casts(spark):
    df = spark.createDataFrame([("2024", "Monaco Grand Prix", "Race", "4111222233334444", "NaN", "1.5")],
                               "y string, e string, s string, card string, bad string, ok string")
    r = df.select(S.session_key("y", "e", "s").alias("k"), S.mask_last4("card").alias("m"),
                  S.null_safe_double("bad").alias("b"), S.null_safe_double("ok").alias("o"),
                  S.event_matches(F.lit(6), "e", "monaco").alias("by_name"),
                  S.event_matches(F.lit(6), "e", "6").alias("by_round")).first()
    assert r.k == "2024_Monaco_Grand_Prix_Race" and r.m == "...4444"
    assert r.b is None and r.o == 1.5 and r.by_name and r.by_round
    assert S.lower_columns(df.select(F.col("y").alias("FRAUD_RULE"))).columns == ["fraud_rule"]


def test_reader_options():
    o = envelope.reader_options("b:9092", "earliest", overrides=["kafka.security.protocol=SSL"])
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "100000"
    assert o["failOnDataLoss"] == "false" and o["kafka.security.protocol"] == "SSL"


def test_progress_offsets_and_falling_behind(spark):
    p = ('{"id":"q1","name":"bronze","batchId":3,"timestamp":"2024-01-01T00:00:00.000Z",'
         '"sources":[{"description":"KafkaV2[Subscribe[t]]","endOffset":"{\\"t\\":{\\"0\\":10,\\"1\\":7}}",'
         '"numInputRows":17}]}')
    rows = quality.progress_offsets(spark.createDataFrame([(p,)], "json string")).collect()
    assert sorted((r.partition, r.end_offset) for r in rows) == [("0", 10), ("1", 7)]
    m = spark.createDataFrame([("bronze", dt.datetime(2024, 1, 1), 45000, dt.datetime(2024, 1, 1, 0, 10))],
                              "name string, batch_ts timestamp, duration_ms long, checked_at timestamp")
    r = quality.falling_behind(m, 30000).first()
    assert r.falling_behind and r.stalled


def test_iso_times_with_zones_and_fractions(spark):
    noon = dt.datetime(2024, 3, 1, 12)
    cases = {"2024-03-01T12:00:00+00:00": noon, "2024-03-01T12:00:00Z": noon, "2024-03-01 12:00:00": noon,
             "2024-03-01T14:00:00+02:00": noon, "2024-03-01T14:00:00+0200": noon, "2024-03-01T06:30:00.250000-05:30":
             noon + dt.timedelta(milliseconds=250), "junk": None, "T12:00": None, "2024-02-30T10:00:00": None, "": None}
    for digits in range(1, 10):
        text = "123456789"[:digits]
        ms = int((text + "00")[:3])
        for zone in ("", "Z", "+00:00"):
            cases[f"2024-03-01T12:00:00.{text}{zone}"] = noon + dt.timedelta(milliseconds=ms)
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    got = {r.s: r.t for r in df.select("s", S.iso_to_ts("s").alias("t")).collect()}
    assert got == {**cases, None: None}
