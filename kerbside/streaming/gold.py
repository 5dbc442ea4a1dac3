"""Gold micro-batch job.

Analytic windows (lag/lead/row_number) are refused on streams, and laps, stints and
overtakes span micro-batches. The job therefore uses ``foreachBatch``: every batch of
new bronze rows, telemetry as well as events, names the sessions it touched; those
sessions' rows are re-read from the bronze tables (a semi-join on the session_id
partition column: the sessions stay a DataFrame, and the scan is pruned to their
partitions at run time) and their gold rows are recomputed as batch DataFrames, then
written with dynamic partition overwrite by ``session_id``. A replayed batch, repeated
messages or late telemetry rewrite the same partitions, so the job is idempotent and
survives executor loss. Only bronze batches whose write is complete are read.

What several tables are derived from (laps, clean samples, race order, close pairs) is written once a batch to a work
folder, which the batch deletes at its end. Facts and edges of a session overwrite the session's partition. Nodes with
their properties are merged by bucket (K8, ``versions.merge``): a batch rewrites the buckets of its own nodes only.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators import graph, laps as L, quality
from kerbside.session import configured
from kerbside.streaming import versions

# Gold trigger interval (design doc).
GOLD_TRIGGER = "60 seconds"
# Shuffle partitions that are written as folders are put together up to this size only, as long as there are cores for them.
FOLDER_TASKS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}


def _write_sessions(df: DataFrame, path: str) -> None:
    # a session's rows meet in one task, so a session is one file, not one from each task; small tables are not brought
    # together in few tasks, as a task's time goes by its folders
    with configured(df.sparkSession, FOLDER_TASKS):
        (df.hint("rebalance", F.col("session_id")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("session_id").parquet(path))


Keep = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def gold_tables(telemetry: DataFrame, events: DataFrame, keep: Keep = _as_is) -> dict[str, DataFrame]:
    """Gold facts from parsed bronze rows of some sessions (batch DataFrames). ``keep(df, name)`` may store what several
    tables are derived from, and returns it. A message that was landed twice counts once: samples go by their time,
    events by their id."""
    lp = keep(L.laps_from_events(events), "laps")
    samples = keep(L.clean_telemetry(L.samples_from_bronze(telemetry)), "samples")
    laps_w = lp.select("session_id", "driver_id", "lap_number", "lap_time_ms", "tyre_compound", "pit")
    stints = L.with_stints(laps_w)
    pos = keep(L.positions(laps_w), "lap_positions")
    pairs = keep(graph.close_pairs(pos), "pairs")
    facts = L.facts_of(samples.select(*L.SAMPLE_COLUMNS).repartition(*L.KEYS), lp, events.select(*L.EVENT_COLUMNS).repartition(*L.KEYS))
    fact_lap = keep(facts, "fact_lap")
    fact_stint = L.fact_stint(stints, fact_lap.select("session_id", "driver_id", "lap_number", "fuel_used_kg"))
    fact_lap = fact_lap.join(stints.select("session_id", "driver_id", "lap_number", "stint_id"),
                             ["session_id", "driver_id", "lap_number"], "left").withColumn(
        "generated_at", F.current_timestamp())
    return {"fact_lap": fact_lap, "fact_stint": fact_stint, "fact_overtakes": graph.overtakes(pairs),
            "fact_battles": graph.battles(pairs), "lap_positions": pos,
            "speed_anomalies": quality.zscore_anomalies(samples),
            "fact_passes": graph.pattern_close_alongside_ahead(pairs)}


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """A bronze table without the batch folders that a writer has not finished (no ``_SUCCESS``);
    tables without batch folders are read as they are."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    batches = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("batch_id=")]
    if not batches:
        return spark.read.parquet(path)
    done = [b.toString() for b in batches if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(b, "_SUCCESS"))]
    return spark.read.option("basePath", path).parquet(*done)


def gold_edges(tables: dict[str, DataFrame], drivers: DataFrame | None = None) -> DataFrame:
    """Edges of the recomputed sessions: overtakes, battles, laps in order and their drivers; with the driver dimension
    (driver_id, team_id) also who races for which team, which belongs to no session."""
    lap = lambda no: F.concat_ws("/", "session_id", "driver_id", F.col(no).cast("string"))

    def rel(df, src, dst, name, lap_no, weight):
        return df.select(src.alias("src"), dst.alias("dst"), F.lit(name).alias("rel"), "session_id",
                         lap_no.cast("int").alias("lap_number"), weight.cast("double").alias("weight"))

    pos, c = tables["lap_positions"], F.col
    drove = pos.groupBy("session_id", "driver_id").agg(F.min("lap_number").alias("lap_number"))
    parts = [rel(tables["fact_overtakes"], c("passer_id"), c("passed_id"), "OVERTOOK", c("lap_number"), c("delta_time_ms")),
             rel(tables["fact_battles"], c("driver_a"), c("driver_b"), "BATTLED", c("start_lap"), c("lap_count")),
             rel(pos.where("next_lap_number is not null"), lap("lap_number"), lap("next_lap_number"), "NEXT",
                 c("lap_number"), F.lit(1.0)),
             rel(pos, lap("lap_number"), c("driver_id"), "COMPLETED_BY", c("lap_number"), F.lit(1.0)),
             rel(drove, c("driver_id"), c("session_id"), "DROVE_IN", F.lit(None), F.lit(1.0))]
    if drivers is not None:
        teams = drivers.where("team_id is not null").select("driver_id", "team_id", F.lit(None).cast("string").alias("session_id"))
        parts.append(rel(teams, c("driver_id"), c("team_id"), "RACES_FOR", F.lit(None), F.lit(1.0)))
    edges = parts[0]
    for p in parts[1:]:
        edges = edges.unionByName(p)
    return edges


NODES = ("id string, label string, team_id string, drivers bigint, lap_number int, lap_time_ms bigint, tyre_compound string, "
         "seen_batch bigint")


def gold_nodes(pos: DataFrame, batch_id: int, drivers: DataFrame | None = None) -> DataFrame:
    """Driver, Session and Lap nodes of the recomputed sessions with their properties (a driver's team, a session's number
    of drivers, a lap's number, time and compound), and the Team nodes of the driver dimension with their number of
    drivers, all stamped with the batch."""
    lap = F.concat_ws("/", "session_id", "driver_id", F.col("lap_number").cast("string"))
    cast = {f.strip().split(" ")[0]: f.strip().split(" ")[1] for f in NODES.split(",")}

    def node(df, label, **columns):
        given = {"label": F.lit(label), "seen_batch": F.lit(batch_id), **columns}
        return df.select(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in cast.items()])

    who = pos.select("driver_id").distinct()
    who = (who.withColumn("team_id", F.lit(None).cast("string")) if drivers is None
           else who.join(drivers.groupBy("driver_id").agg(F.min("team_id").alias("team_id")), "driver_id", "left"))
    sessions = pos.select("session_id", "driver_id").distinct().groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    out = (node(who, "Driver", id=F.col("driver_id"), team_id=F.col("team_id"))
           .unionByName(node(sessions, "Session", id=F.col("session_id"), drivers=F.col("n")))
           .unionByName(node(pos, "Lap", id=lap, lap_number=F.col("lap_number"), lap_time_ms=F.col("lap_time_ms"),
                             tyre_compound=F.col("tyre_compound"))))
    if drivers is not None:
        teams = drivers.where("team_id is not null").groupBy("team_id").agg(F.count_distinct("driver_id").alias("n"))
        out = out.unionByName(node(teams, "Team", id=F.col("team_id"), drivers=F.col("n")))
    return out


def gold_writer(spark: SparkSession, bronze_telemetry: str, bronze_events: str, gold_base: str, drivers_path: str | None = None):
    """The ``foreachBatch`` function: recompute the touched sessions from bronze. ``drivers_path``: a versioned dimension
    (driver_id, team_id), read anew by each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        work = os.path.join(gold_base, "_work", f"batch={batch_id}")

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(os.path.join(work, name))
            return spark.read.schema(df.schema).parquet(os.path.join(work, name))

        sessions = batch.select("session_id").where(F.col("session_id").isNotNull()).distinct().persist()
        try:
            if sessions.isEmpty():
                return
            drivers = versions.newest(spark, drivers_path) if drivers_path else None
            tel = read_complete(spark, bronze_telemetry).join(sessions, "session_id", "left_semi")
            ev = keep(read_complete(spark, bronze_events).join(sessions, "session_id", "left_semi"), "events")
            tables = gold_tables(tel, ev, keep)
            for name, df in tables.items():
                _write_sessions(df, os.path.join(gold_base, name))
            _write_sessions(gold_edges(tables, drivers), os.path.join(gold_base, "edges"))
            versions.merge(spark, gold_nodes(tables["lap_positions"], batch_id, drivers), os.path.join(gold_base, "nodes"),
                           ["id", "label"], "seen_batch", batch_id)
            rejected = L.split_valid(L.samples_from_bronze(tel))[1]
            _write_sessions(rejected.where("session_id is not null"), os.path.join(gold_base, "quarantine"))
        finally:
            sessions.unpersist()
            folder = spark._jvm.org.apache.hadoop.fs.Path(work)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return write


def touched_sessions(*streams: DataFrame) -> DataFrame:
    """Session ids of new rows in any of the bronze streams: telemetry that lands after its lap's
    event recomputes its session as well."""
    ids = [s.select("session_id") for s in streams]
    out = ids[0]
    for more in ids[1:]:
        out = out.unionByName(more)
    return out


def start_gold(spark: SparkSession, touched: DataFrame, bronze_telemetry: str, bronze_events: str,
               gold_base: str, checkpoint: str, trigger: str = GOLD_TRIGGER,
               available_now: bool = False, drivers_path: str | None = None) -> StreamingQuery:
    """S6 + R12: drive the gold recomputation from a stream whose rows name the sessions to
    recompute: a bronze stream, or ``touched_sessions`` of several."""
    w = touched.writeStream.foreachBatch(gold_writer(spark, bronze_telemetry, bronze_events, gold_base, drivers_path))
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def dedup_stream(telemetry: DataFrame, time_col: str = "event_time", delay: str = "30 seconds",
                 keys: tuple[str, ...] = ("session_id", "driver_id", "timestamp_utc")) -> DataFrame:
    """R9 / U3 streaming: drop duplicates of (session, driver, timestamp) that arrive
    within the watermark delay of each other; state is evicted by the watermark."""
    x = telemetry.withColumn(time_col, F.col("timestamp_utc").try_cast("timestamp"))
    return x.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def lap_metrics_records(fact_lap: DataFrame) -> DataFrame:
    """fact_lap rows as keyed JSON records for an optional lap-metrics topic."""
    key = F.concat_ws("_", "session_id", "driver_id", F.col("lap_number").cast("string"))
    return fact_lap.select(key.alias("key"), F.to_json(F.struct(*fact_lap.columns)).alias("value"))
