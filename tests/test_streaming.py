"""Structured Streaming forms: batch = stream equality, late rows, restart from the
checkpoint, bronze fan-out and the gold micro-batch job. Inputs are several parquet
files written in event-time order (a single file is a single micro-batch)."""

import os

from pyspark.sql import functions as F

from paths import SMALL
from kerbside.operators import alerts, laps as L, windows
from kerbside.sources import envelope, testbed
from kerbside.sources.schemas import ENVELOPE_SCHEMA, RACE_EVENT_SCHEMA, TELEMETRY_SCHEMA
from kerbside.streaming import alerts as salerts, analytics, bronze, gold, versions


def _write_chunks(df, path, order_col, chunks=4):
    """Split ``df`` into ``chunks`` files ordered by ``order_col``."""
    ranked = df.withColumn("__q", F.ntile(chunks).over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy(order_col)))
    for q in range(1, chunks + 1):
        ranked.where(F.col("__q") == q).drop("__q").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(path, f"part{q:03d}"))


def _stream_dir(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(path, "*"))


def _rows(df):
    return sorted(tuple(str(round(x, 6) if isinstance(x, float) else x) for x in r) for r in df.collect())


def test_window_stats_stream_equals_batch(spark, tmp_path):
    tx = testbed.transactions(spark, SMALL)
    src = str(tmp_path / "tx")
    _write_chunks(tx, src, "transaction_time")
    stream = _stream_dir(spark, src, tx.schema)
    q = analytics.start(analytics.windowed(stream, "window_stats"), "ws_stream", mode="append",
                        checkpoint=str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    got = spark.sql("SELECT * FROM ws_stream")
    max_t = tx.agg(F.max("transaction_time")).first()[0]
    expect = analytics.final_window_cut(windows.window_stats(tx), max_t)
    assert got.count() > 0
    assert _rows(got) == _rows(expect)


def test_alert_stream_equals_batch_and_restart(spark, tmp_path):
    tx = testbed.transactions(spark, SMALL)
    src = str(tmp_path / "tx")
    _write_chunks(tx.where(F.col("transaction_time") < "2024-01-01 06:00:00"), src + "/a", "transaction_time", 2)
    ck, out = str(tmp_path / "ck"), str(tmp_path / "alerts")

    def run():
        s = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*/*")
        q = salerts.start_alert_topic(salerts.alert_stream(s), ck, path=out, available_now=True)
        q.awaitTermination()

    run()
    first = spark.read.json(out).count()
    _write_chunks(tx.where(F.col("transaction_time") >= "2024-01-01 06:00:00"), src + "/b", "transaction_time", 2)
    run()  # restart from the checkpoint: only new files are processed
    recs = spark.read.json(out)
    assert recs.count() > first
    batch = alerts.all_alerts(tx)
    max_t = tx.agg(F.max("transaction_time")).first()[0]
    stateless = batch.where(F.col("fraud_rule") != "VELOCITY")
    vel = batch.where((F.col("fraud_rule") == "VELOCITY")
                      & (F.col("window_end") <= F.lit(max_t) - F.expr("INTERVAL 10 SECONDS")))
    got = recs.select(F.from_json("value", batch.schema).alias("a")).select("a.*")
    assert got.where(F.col("fraud_rule") != "VELOCITY").count() == stateless.count()
    assert got.where(F.col("fraud_rule") == "VELOCITY").count() == vel.count()


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "card_number string, amount decimal(10,2), transaction_time timestamp"
    src = str(tmp_path / "late")
    batches = [
        [("c1", 1, "2024-01-01 00:00:05"), ("c1", 1, "2024-01-01 00:00:06"), ("c1", 1, "2024-01-01 00:00:07")],
        [("c2", 1, "2024-01-01 00:05:00")],                       # moves the watermark to 00:04:50
        [("c3", 1, "2024-01-01 00:05:01")],
        # Spark filters late input with the previous batch's watermark, so this row
        # is late from the batch after next on
        [("c1", 1, "2024-01-01 00:00:08")],
        [("c9", 1, "2024-01-01 00:10:00")],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame([(c, a, t) for c, a, t in b], "card_number string, amount int, transaction_time string") \
            .select("card_number", F.col("amount").cast("decimal(10,2)").alias("amount"),
                    F.col("transaction_time").cast("timestamp").alias("transaction_time")) \
            .coalesce(1).write.parquet(os.path.join(src, f"part{i:03d}"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    q = analytics.start(analytics.windowed(s, "fast_cards"), "late_stream", mode="append",
                        checkpoint=str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    rows = spark.sql("SELECT card_number, txn_count FROM late_stream").collect()
    assert [(r.card_number, r.txn_count) for r in rows] == [("c1", 3)]   # the late 4th row was dropped


def test_bronze_fan_out_and_gold(spark, tmp_path):
    lp = testbed.laps(spark, SMALL).where(F.col("session_id").isin("S0", "S1"))
    msgs = testbed.telemetry_messages(spark, SMALL, lp).unionByName(testbed.event_messages(spark, SMALL, lp))
    land = str(tmp_path / "land")
    _write_chunks(msgs.select([f.name for f in ENVELOPE_SCHEMA.fields]), land, "offset", 3)
    base, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    qs = bronze.start_bronze(spark, {"telemetry.raw": TELEMETRY_SCHEMA, "race.events": RACE_EVENT_SCHEMA},
                             {"maxFilesPerTrigger": "1"}, base, ck, path=os.path.join(land, "*"), available_now=True,
                             partition_by={"telemetry.raw": ["session_id"], "race.events": ["session_id"]})
    for q in qs:
        q.awaitTermination()
    tel = spark.read.parquet(os.path.join(base, "telemetry_raw-parsed"))
    raw = spark.read.parquet(os.path.join(base, "telemetry_raw-raw"))
    n_tel = msgs.where(F.col("topic") == "telemetry.raw").count()
    assert tel.count() == n_tel and raw.count() == n_tel
    ev_path = os.path.join(base, "race_events-parsed")
    ev_stream = spark.readStream.schema(spark.read.parquet(ev_path).schema).parquet(ev_path)
    gq = gold.start_gold(spark, ev_stream, os.path.join(base, "telemetry_raw-parsed"), ev_path,
                         str(tmp_path / "gold"), str(tmp_path / "gck"), available_now=True)
    gq.awaitTermination()
    fl = spark.read.parquet(str(tmp_path / "gold" / "fact_lap"))
    expect = L.gold_fact_lap(tel, spark.read.parquet(ev_path))
    assert fl.count() == expect.count() > 0
    assert spark.read.parquet(str(tmp_path / "gold" / "fact_overtakes")).count() >= 0


def test_streaming_dedup_within_watermark(spark, tmp_path):
    lp = testbed.laps(spark, SMALL).where(F.col("session_id") == "S0")
    tp = envelope.parsed_view(envelope.raw_view(testbed.telemetry_messages(spark, SMALL, lp)), TELEMETRY_SCHEMA,
                              "telemetry.raw").where(F.col("session_id").isNotNull())
    src = str(tmp_path / "tel")
    cols = ["session_id", "driver_id", "timestamp_utc", "speed_kph", "offset"]
    _write_chunks(tp.select(*cols), src, "offset", 3)
    s = spark.readStream.schema(tp.select(*cols).schema).parquet(os.path.join(src, "*"))
    q = analytics.start(gold.dedup_stream(s), "dedup_stream", checkpoint=str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    got = spark.sql("SELECT * FROM dedup_stream").count()
    assert got == tp.select("session_id", "driver_id", "timestamp_utc").distinct().count()


def test_fraud_rings_stream_exact_distinct_and_update_mode(spark, tmp_path):
    tx = testbed.transactions(spark, SMALL)
    src = str(tmp_path / "tx")
    _write_chunks(tx, src, "transaction_time", 3)
    max_t = tx.agg(F.max("transaction_time")).first()[0]
    expect = analytics.final_window_cut(windows.fraud_rings(tx, min_cards=2), max_t)
    for mode in ("chained", "set"):
        q = analytics.start(analytics.windowed(_stream_dir(spark, src, tx.schema), "fraud_rings", min_cards=2,
                                               streaming_distinct=mode),
                            f"rings_{mode}", mode="append", checkpoint=str(tmp_path / f"ck_{mode}"), available_now=True)
        q.awaitTermination()
        assert _rows(spark.sql(f"SELECT * FROM rings_{mode}")) == _rows(expect), mode
    # update mode emits every changed running total; the last emission per key is final
    q2 = analytics.start(analytics.windowed(_stream_dir(spark, src, tx.schema), "category_breakdown", per_window=False),
                         "cat_update", mode="update", checkpoint=str(tmp_path / "ck2"), available_now=True)
    q2.awaitTermination()
    got = spark.sql("SELECT merchant_category, max(txn_count) AS n FROM cat_update GROUP BY 1")
    want = windows.category_breakdown(tx, per_window=False).select("merchant_category", F.col("txn_count").alias("n"))
    assert _rows(got) == _rows(want)


def test_table_stream_and_date_layout(spark, tmp_path):
    lp = testbed.laps(spark, SMALL).where(F.col("session_id") == "S0")
    msgs = testbed.telemetry_messages(spark, SMALL, lp)
    land = str(tmp_path / "land")
    _write_chunks(msgs.select([f.name for f in ENVELOPE_SCHEMA.fields]), land, "offset", 2)
    parsed, raw = envelope.read_topic(spark, "telemetry.raw", TELEMETRY_SCHEMA, {"maxFilesPerTrigger": "1"},
                                      path=os.path.join(land, "*"))
    out = str(tmp_path / "tbl")
    q = bronze.start_table_stream(parsed.withColumn("date", F.to_date(F.col("timestamp_utc").try_cast("timestamp"))),
                                  out, str(tmp_path / "ck"), available_now=True, partition_by=["date"])
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == msgs.count()
    assert "date" in got.columns and got.select("date").distinct().count() >= 1


def test_velocity_emit_changes_update_mode(spark, tmp_path):
    """Update mode re-emits a card-window whenever its count changes (EMIT CHANGES);
    the last emission per card-window equals the batch result."""
    tx = testbed.transactions(spark, SMALL)
    src = str(tmp_path / "tx")
    _write_chunks(tx, src, "transaction_time", 3)
    s = windows.with_event_time(_stream_dir(spark, src, tx.schema))
    q = analytics.start(alerts.card_velocity(s, min_txns=1), "vel_update", mode="update",
                        checkpoint=str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    got = spark.sql("SELECT card_number, window_start, max(txn_count) AS txn_count FROM vel_update GROUP BY 1, 2")
    want = alerts.card_velocity(tx, min_txns=1).select("card_number", "window_start", "txn_count")
    assert _rows(got) == _rows(want)


def test_alert_records_to_document_sink(spark, tmp_path):
    """S5 + K4: a second query consumes the alert records and writes lower-cased
    documents with ingest time, one folder per batch."""
    tx = testbed.transactions(spark, SMALL)
    src = str(tmp_path / "tx")
    _write_chunks(tx, src, "transaction_time", 2)
    out = str(tmp_path / "alerts")
    q = salerts.start_alert_topic(salerts.alert_stream(_stream_dir(spark, src, tx.schema)), str(tmp_path / "ck1"),
                                  path=out, available_now=True)
    q.awaitTermination()
    batch_schema = alerts.all_alerts(tx).schema
    recs = spark.readStream.schema("key string, value string").json(out)
    docs = str(tmp_path / "docs")
    q2 = salerts.start_document_sink(recs, batch_schema, docs, str(tmp_path / "ck2"), available_now=True)
    q2.awaitTermination()
    d = spark.read.json(docs)
    assert d.count() == spark.read.json(out).count() > 0
    assert {"card_number", "fraud_rule", "fraud_reason", "ingested_at"} <= set(d.columns)
    assert d.where(F.col("fraud_rule").isNull()).count() == 0


def test_batch_writers_are_idempotent_on_replay(spark, tmp_path):
    """A micro-batch replayed after a failure (same batch id) rewrites its own output
    instead of appending a second copy -- bronze fan-out and gold recomputation."""
    lp = testbed.laps(spark, SMALL).where(F.col("session_id").isin("S0"))
    raw = envelope.raw_view(testbed.telemetry_messages(spark, SMALL, lp))
    base = str(tmp_path / "bronze")
    w = bronze.fan_out_writer("telemetry.raw", TELEMETRY_SCHEMA, base, partition_cols=["session_id"])
    w(raw, 7)
    w(raw, 7)
    n = spark.read.parquet(os.path.join(base, "telemetry_raw-parsed")).count()
    assert n == raw.count()
    ev_raw = envelope.raw_view(testbed.event_messages(spark, SMALL, lp))
    bronze.fan_out_writer("race.events", RACE_EVENT_SCHEMA, base, partition_cols=["session_id"])(ev_raw, 7)
    ev_path = os.path.join(base, "race_events-parsed")
    g = gold.gold_writer(spark, os.path.join(base, "telemetry_raw-parsed"), ev_path, str(tmp_path / "gold"))
    batch = spark.read.parquet(ev_path)
    g(batch, 3)
    first = spark.read.parquet(str(tmp_path / "gold" / "fact_lap")).count()
    g(batch, 3)
    assert spark.read.parquet(str(tmp_path / "gold" / "fact_lap")).count() == first > 0
    nodes = versions.read_merged(spark, str(tmp_path / "gold" / "nodes"))
    assert nodes.where("label = 'Driver'").count() == batch.select("driver_id").distinct().count()
    assert nodes.where("label = 'Lap'").count() == lp.count()


def test_gold_equals_batch_under_replay_repeats_and_late_telemetry(spark, tmp_path):
    """Two batches touch one session, a bronze batch is landed twice, an event comes twice and some
    telemetry lands after its laps' events: the final tables equal those of a single pass."""
    lp = testbed.laps(spark, SMALL).where(F.col("session_id").isin("S0", "S1"))
    tel = envelope.raw_view(testbed.telemetry_messages(spark, SMALL, lp))
    ev = envelope.raw_view(testbed.event_messages(spark, SMALL, lp))
    base = str(tmp_path / "bronze")
    land_t = bronze.fan_out_writer("telemetry.raw", TELEMETRY_SCHEMA, base, partition_cols=["session_id"])
    land_e = bronze.fan_out_writer("race.events", RACE_EVENT_SCHEMA, base, partition_cols=["session_id"])
    tel_path, ev_path = (os.path.join(base, n) for n in ("telemetry_raw-parsed", "race_events-parsed"))
    g = gold.gold_writer(spark, tel_path, ev_path, str(tmp_path / "gold"))
    late = F.col("offset") % 10 == 3
    land_t(tel.where(~late), 0)
    land_e(ev.where("offset % 2 = 0"), 0)
    g(spark.read.parquet(ev_path), 0)
    land_e(ev.unionByName(ev.where("offset % 7 = 0")), 1)      # everything again, some of it twice
    g(spark.read.parquet(ev_path), 1)
    land_t(tel.where(late | (F.col("offset") % 10 == 4)), 1)   # late rows, and some that landed before
    os.makedirs(os.path.join(tel_path, "batch_id=9", "session_id=S0"))  # a batch in mid-commit
    g(spark.read.parquet(os.path.join(tel_path, "batch_id=1")), 2)
    parsed_t = envelope.parsed_view(tel, TELEMETRY_SCHEMA, "telemetry.raw").where("session_id is not null")
    parsed_e = envelope.parsed_view(ev, RACE_EVENT_SCHEMA, "race.events")
    want = gold.gold_tables(parsed_t, parsed_e)
    for name in ("fact_lap", "fact_stint", "fact_overtakes", "fact_battles", "lap_positions"):
        cols = [c for c in want[name].columns if c != "generated_at"]
        got = spark.read.parquet(str(tmp_path / "gold" / name)).select(*cols)
        assert _rows(got) == _rows(want[name].select(*cols)), name
    edges = spark.read.parquet(str(tmp_path / "gold" / "edges"))
    assert edges.count() == edges.distinct().count()
    assert edges.where("rel = 'OVERTOOK'").count() == want["fact_overtakes"].count() > 0
    assert edges.where("rel = 'COMPLETED_BY'").count() == lp.count()


def test_replayed_bronze_batch_is_read_once_as_a_stream(spark, tmp_path):
    lp = testbed.laps(spark, SMALL).where(F.col("session_id") == "S0")
    raw = envelope.raw_view(testbed.event_messages(spark, SMALL, lp))
    path = str(tmp_path / "events")
    raw.write.parquet(os.path.join(path, "batch_id=0"))
    raw.write.mode("append").parquet(os.path.join(path, "batch_id=0"))  # the same rows under new file names
    s = envelope.read_bronze_stream(spark, path, raw.schema, replay_delay="2 hours")
    q = analytics.start(s, "replayed", checkpoint=str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    assert spark.sql("SELECT * FROM replayed").count() == raw.count()


def test_bronze_and_gold_resume_from_their_checkpoints(spark, tmp_path):
    """Files landed between two runs are read once by the second run, and gold follows."""
    lp = testbed.laps(spark, SMALL).where(F.col("session_id").isin("S0", "S1"))
    base, land = str(tmp_path / "b"), str(tmp_path / "land")
    topics = {"telemetry.raw": TELEMETRY_SCHEMA, "race.events": RACE_EVENT_SCHEMA}
    msgs = testbed.telemetry_messages(spark, SMALL, lp).unionByName(testbed.event_messages(spark, SMALL, lp))
    msgs = msgs.select([f.name for f in ENVELOPE_SCHEMA.fields])
    tel_path, ev_path = (os.path.join(base, "bronze", bronze.table_name(t, "parsed")) for t in topics)

    def run():
        qs = bronze.start_bronze(spark, topics, {}, os.path.join(base, "bronze"), os.path.join(base, "ck"), path=land,
                                 available_now=True, partition_by={t: ["session_id"] for t in topics})
        for q in qs:
            q.awaitTermination()
        bronze.await_all(spark, qs)
        ids = [spark.readStream.schema("session_id string").parquet(p) for p in (tel_path, ev_path)]
        gold.start_gold(spark, gold.touched_sessions(*ids), tel_path, ev_path, os.path.join(base, "gold"),
                        os.path.join(base, "gold-ck"), available_now=True).awaitTermination()

    first = F.col("offset") % 3 > 0
    msgs.where(first).coalesce(1).write.parquet(land)
    run()
    msgs.where(~first).coalesce(1).write.mode("append").parquet(land)
    run()
    tel, ev = gold.read_complete(spark, tel_path), gold.read_complete(spark, ev_path)
    assert tel.count() == tel.select("offset").distinct().count() == msgs.where("topic = 'telemetry.raw'").count()
    want = gold.gold_tables(tel, ev)["fact_lap"]
    cols = [c for c in want.columns if c != "generated_at"]
    assert _rows(spark.read.parquet(os.path.join(base, "gold", "fact_lap")).select(*cols)) == _rows(want.select(*cols))


def test_progress_goes_to_a_table(spark, tmp_path):
    from kerbside.operators import quality
    from kerbside.streaming import monitor
    tx = testbed.transactions(spark, SMALL)
    src, path = str(tmp_path / "tx"), str(tmp_path / "progress")
    _write_chunks(tx, src, "transaction_time", 2)
    rec = monitor.attach(spark, path)
    try:
        q = analytics.start(analytics.windowed(_stream_dir(spark, src, tx.schema), "window_stats"), "watched",
                            checkpoint=str(tmp_path / "ck"), available_now=True)
        q.awaitTermination()
        for _ in range(100):  # listeners are told after the batch
            if os.path.isdir(path) and monitor.progress_frame(spark, path).count() >= 2:
                break
            __import__("time").sleep(0.2)
    finally:
        spark.streams.removeListener(rec)
    metrics = monitor.batch_metrics(monitor.progress_frame(spark, path))
    assert metrics.where("name = 'watched' AND duration_ms > 0 AND batch_ts is not null").count() >= 2
    row = quality.falling_behind(metrics, trigger_ms=10**9).where("name = 'watched'").first()
    assert not row.falling_behind and not row.stalled
