"""Compacted layout, figures observed in a stream's pass, communities by LSH, units, start position, slow batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from kerbside.functions import scalars as S
from kerbside.operators import graph, quality, windows
from kerbside.sources import envelope
from kerbside.sources.schemas import ENVELOPE_SCHEMA
from kerbside.streaming import compaction, monitor, observed

ROWS = "session_id string, n long, at string"


def _land(spark, path, number, rows):
    (spark.createDataFrame(rows, ROWS).write.partitionBy("session_id").mode("overwrite").parquet(f"{path}/batch_id={number}"))


def _folders(path, name):
    return sorted(x for x in os.listdir(path) if x.startswith(name)) if os.path.isdir(path) else []


def test_compaction_bounds_files_and_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda n, s: (s, n, f"2024-03-0{1 + n % 2}T10:00:00+00:00")
    for n in range(10):
        _land(spark, path, n, [row(n, "S0"), row(n, "S1"), row(n, None)])
        assert compaction.compact(spark, path, "at", fanout=2) <= 4
        table = compaction.read(spark, path, "at")
        assert table.count() == 3 * (n + 1) and sorted(table.columns) == ["at", "batch_id", "date", "n", "session_id"]
    assert len(_folders(path, "batch_id=")) <= 1 and len(_folders(f"{path}/_segments", "segment=")) <= 8
    # a folder in the making does not count, batches behind the manifest do
    os.makedirs(f"{path}/batch_id=11/session_id=S0")
    _land(spark, path, 10, [row(10, "S0")])
    table = compaction.read(spark, path, "at")
    assert table.count() == 31 and table.where("session_id = 'S0'").count() == 11
    assert table.where("session_id is null").count() == 10 and table.select("date").distinct().count() == 2
    number = compaction.compact(spark, path, "at", fanout=2)
    assert compaction.compact(spark, path, "at", fanout=2) == number  # nothing new: nothing written
    with pytest.raises(FileNotFoundError):
        compaction.read(spark, str(tmp_path / "none"), "at")


def test_segments_are_pruned_by_date_and_session(spark, tmp_path):
    path = str(tmp_path / "t")
    _land(spark, path, 0, [(f"S{k}", k, f"2024-03-{1 + k % 9:02d}T10:00:00Z") for k in range(40)])
    compaction.compact(spark, path, "at")
    table = compaction.read(spark, path, "at")
    plan = table.where("session_id = 'S3' and date = '2024-03-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "session_id" in plan.split("PartitionFilters")[1][:200]
    files = table.where("session_id = 'S3'").select("_metadata.file_path").distinct().count() if "_metadata" in table.columns else 1
    assert files == 1 and table.where("session_id = 'S3'").count() == 1
    # partitions that another table names are pruned while the query runs
    spark.createDataFrame([("S3", 1), ("S5", 2)], "session_id string, rank int").coalesce(1).write.parquet(f"{tmp_path}/some")
    some = spark.read.parquet(f"{tmp_path}/some").where("rank = 1")
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
    try:
        joined = table.join(some.select("session_id"), "session_id", "left_semi")
        assert "dynamicpruning" in joined._jdf.queryExecution().optimizedPlan().toString().lower()
        assert joined.count() == 1
    finally:
        spark.conf.unset("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly")


def test_observed_nulls_late_and_dropped_rows(spark, tmp_path):
    noon = dt.datetime(2024, 3, 1, 12)
    at = lambda s: noon + dt.timedelta(seconds=s)
    schema = "card_number string, amount int, transaction_time timestamp, record_time timestamp"
    data = [[("c1", 1, at(0), at(0)), (None, 2, at(1), at(9)), ("c1", None, at(2), at(2))], [("c2", 4, at(100), at(100))],
            [("c2", 5, at(101), at(101))], [("c3", 5, at(3), at(101)), (None, 6, at(102), at(102))]]
    for n, rows in enumerate(data):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/f{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    late = F.unix_seconds("record_time") - F.unix_seconds("transaction_time") > 5
    rows = windows.with_event_time(observed.observe(stream, ["card_number", "amount"], late))
    q = (rows.groupBy(F.window("transaction_time", "10 seconds")).count().writeStream.outputMode("append").format("memory").queryName("obs")
         .option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    progress = observed.progress_of(spark, q)
    rates = {r.column_name: r.null_rate for r in observed.null_rates(progress, ["card_number", "amount"]).collect()}
    table = spark.read.schema(schema).parquet(f"{tmp_path}/in/*")
    assert rates == {r.column_name: r.null_rate for r in quality.null_rates(table, ["card_number", "amount"]).collect()}
    got = observed.late_rows(progress).first()
    assert (got["rows"], got["late"], got["dropped"]) == (7, 2, 1)  # the last file's first row is behind the watermark
    monitor_rows = monitor.batch_metrics(progress)
    assert monitor_rows.count() >= 3


def test_lsh_links_equal_the_exact_ones(spark):
    import random
    rng = random.Random(4)
    rows = []
    for s in range(6):
        for a in range(18):
            rows += [(f"S{s}", f"D{a}", f"O{o}") for o in rng.sample(range(8 + a % 3), rng.randint(1, 5))]
    btl = spark.createDataFrame(rows, "session_id string, driver_a string, driver_b string")
    key = lambda df: sorted((r.session_id, r.src, r.dst, round(r.jaccard, 9)) for r in df.collect())
    exact = key(graph.rivalry_links(btl))
    assert exact and key(graph.lsh_links(btl)) == exact
    assert sorted(graph.lsh_communities(btl).collect()) == sorted(graph.rivalry_communities(btl).collect())
    assert graph.lsh_links(btl.where("false")).count() == 0


def test_a_long_chain_is_contracted_in_few_rounds(spark):
    names = [f"n{i:04d}" for i in range(1000)]
    links = spark.createDataFrame(list(zip(names, names[1:])) + [("x", "y"), ("z", "z")], "src string, dst string")
    nodes = spark.createDataFrame([(n,) for n in [*names, "x", "y", "z"]], "node string")
    found, rounds = graph.contracted_components(links, nodes)
    got = {r.node: r.component for r in found.collect()}
    assert rounds < 15 and got == {**dict.fromkeys(names, "n0000"), "x": "x", "y": "x", "z": "z"}


def test_units(spark):
    df = spark.createDataFrame([(100.0, 20.0, None), (None, float("nan"), 1.0)], "v double, t double, p double")
    got = S.harmonised(df, {"v": ("kph", "m/s"), "t": ("c", "f"), "p": ("bar", "kpa")}).collect()
    assert round(got[0].v, 6) == 27.777778 and got[0].t == 68.0 and got[0].p is None
    assert got[1].v is None and got[1].t != got[1].t and got[1].p == 100.0
    back = df.select(S.to_unit(S.to_unit("v", "kph", "mph"), "mph", "kph").alias("v")).first().v
    assert round(back, 9) == 100.0
    for bad in (lambda: S.to_unit("v", "kph", "kg"), lambda: S.harmonised(df, {"none": ("c", "f")})):
        with pytest.raises(ValueError):
            bad()


def test_latest_start_reads_later_files_and_goes_on_from_there(spark, tmp_path):
    import time
    row = lambda i: (f"k{i}", "{}", "t", 0, i, dt.datetime(2024, 3, 1))
    land = lambda n: spark.createDataFrame([row(n)], ENVELOPE_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/f{n}")

    def run(name):
        df = envelope.read_envelope(spark, "t", {"startingOffsets": "latest"}, f"{tmp_path}/in/*", start_path=f"{tmp_path}/start")
        q = (df.select("offset").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(r.offset for r in spark.read.schema("offset long").parquet(f"{tmp_path}/out").collect())

    land(0)
    time.sleep(1.1)  # file times may be whole seconds
    assert run("a") == []
    time.sleep(1.1)
    land(1)  # landed while the stream is down
    assert run("b") == [1]
    land(2)
    assert run("c") == [1, 2]


def test_one_slow_batch_is_not_hidden_by_the_average(spark):
    at = dt.datetime(2024, 3, 1, 12)
    rows = [("q", at + dt.timedelta(seconds=30 * i), 70000 if i == 3 else 1000, at + dt.timedelta(seconds=330)) for i in range(10)]
    metrics = spark.createDataFrame(rows, "name string, batch_ts timestamp, duration_ms long, checked_at timestamp")
    r = quality.falling_behind(metrics, 30000).first()
    assert r.falling_behind and r.slow_batches == 1 and r.worst_duration_ms == 70000 and r.avg_duration_ms < 30000 and not r.stalled


def test_ranks_until_they_rest(spark):
    """The fixed point is that of a plain iteration; former ranks save rounds; gone and new nodes are taken."""
    import random
    rng = random.Random(8)
    names = [f"D{i}" for i in range(12)]
    edges = [("S", rng.choice(names), rng.choice(names[:9]), float(rng.randint(1, 4))) for _ in range(40)]
    nodes = spark.createDataFrame([("S", n) for n in names] + [("E", "alone")], "session_id string, node string")
    frame = spark.createDataFrame(edges, "session_id string, src string, dst string, weight double")
    ranks = {n: 1 / 12 for n in names}
    out = {n: sum(w for _, s, _, w in edges if s == n) for n in names}
    for _ in range(300):
        spread = sum(ranks[n] for n in names if not out[n]) / 12
        ranks = {n: 0.15 / 12 + 0.85 * (spread + sum(ranks[s] * w / out[s] for _, s, d, w in edges if d == n)) for n in names}
    got, cold = graph.pagerank_until(nodes, frame, tolerance=1e-10)
    rows = {(r.session_id, r.node): r["rank"] for r in got.collect()}
    assert all(abs(rows["S", n] - ranks[n]) < 1e-8 for n in names) and abs(rows["E", "alone"] - 1) < 1e-9
    former = got.where("node <> 'D3'").unionByName(spark.createDataFrame([("S", "gone", 0.4)], "session_id string, node string, rank double"))
    near, _ = graph.pagerank_until(nodes, frame, former, tolerance=1e-10)
    assert all(abs(r["rank"] - rows[r.session_id, r.node]) < 1e-8 for r in near.collect()) and near.count() == 13
    _, warm = graph.pagerank_until(nodes, frame, got, tolerance=1e-10)
    assert warm < cold
    with pytest.raises(RuntimeError):
        graph.pagerank_until(nodes, frame, tolerance=0.0, most_rounds=5)


def test_a_tier_that_fills_is_written_once(spark, tmp_path, monkeypatch):
    path, written = str(tmp_path / "t"), []
    write = compaction._write
    monkeypatch.setattr(compaction, "_write", lambda rows, path, segment, *rest: (written.append(segment), write(rows, path, segment, *rest)))
    for n in range(4):
        _land(spark, path, n, [("S0", n, "2024-03-01T10:00:00+00:00")])
        compaction.compact(spark, path, "at", fanout=2)
        assert len(written) == n + 1 and compaction.read(spark, path, "at").count() == n + 1
    assert compaction._segments(spark, path)[1][0]["tier"] == 2
