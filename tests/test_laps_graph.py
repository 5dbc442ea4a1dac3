"""As-of join, stints and graph operators against brute force on small fixtures."""

import random

import numpy as np
from pyspark.sql import functions as F

from kerbside.operators import graph, laps as L

LAPS_SCHEMA = "session_id string, driver_id string, lap_number int, cum_ms bigint, tyre_compound string"


def _brute_asof(samples, laps):
    out = []
    for s, d, t in samples:
        cands = [lap for (ls, ld, lap, cum, _c) in laps if ls == s and ld == d and cum is not None and cum >= t]
        out.append((s, d, t, min(cands) if cands else 0))
    return sorted(out)


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    laps, samples = [], []
    for d in ("A", "B"):
        cum = 0
        for lap in range(1, 9):
            cum += rnd.randint(50000, 130000)
            laps.append(("S", d, lap, cum, "SOFT"))
        ends = [x[3] for x in laps if x[1] == d]
        samples += [("S", d, t) for t in ends]                   # ties on lap ends
        samples += [("S", d, rnd.randint(-5000, cum + 90000)) for _ in range(300)]
    samples.append(("S", "C", 10))                               # driver without laps
    sdf = spark.createDataFrame(samples, "session_id string, driver_id string, t_ms bigint")
    ldf = spark.createDataFrame(laps, LAPS_SCHEMA)
    got = sorted(tuple(r) for r in L.asof_forward_join(sdf, ldf).select(
        "session_id", "driver_id", "t_ms", "asof_lap_number").collect())
    assert got == _brute_asof(samples, laps)


def test_asof_bucket_size_does_not_change_result(spark):
    laps = [("S", "A", 1, 1000, "S"), ("S", "A", 2, 250000, "M"), ("S", "A", 3, 250500, "H")]
    samples = [("S", "A", t) for t in (-10, 0, 1000, 1001, 249999, 250000, 250001, 250500, 999999)]
    sdf = spark.createDataFrame(samples, "session_id string, driver_id string, t_ms bigint")
    ldf = spark.createDataFrame(laps, LAPS_SCHEMA)
    for b in (1000, 60000, 10 ** 9):
        got = sorted(tuple(r) for r in L.asof_forward_join(sdf, ldf, bucket_ms=b).select(
            "session_id", "driver_id", "t_ms", "asof_lap_number").collect())
        assert got == _brute_asof(samples, laps)


def test_stints_and_one_lap_stint(spark):
    rows = [("S", "A", 1, 90000, "SOFT", False), ("S", "A", 2, 91000, "SOFT", True),
            ("S", "A", 3, 95000, "SOFT", False), ("S", "A", 4, 94000, "HARD", False)]
    df = spark.createDataFrame(rows, "session_id string, driver_id string, lap_number int, lap_time_ms bigint, "
                                     "tyre_compound string, pit boolean")
    st = {r.lap_number: r.stint_no for r in L.with_stints(df).collect()}
    assert st == {1: 1, 2: 1, 3: 2, 4: 3}
    fs = {r.stint_no: r for r in L.fact_stint(L.with_stints(df)).collect()}
    assert fs[2].consistency_score is None and fs[2].lap_count == 1
    assert fs[1].degradation_rate_ms_per_lap == 1000.0


def test_battle_needs_three_laps_and_gap_is_strict(spark):
    # race_ms per lap: A leads; B 900 ms behind on laps 1-2 only; C exactly 1000 ms behind A
    rows = []
    for lap in (1, 2, 3):
        order = sorted([("A", lap * 100000), ("B", lap * 100000 + (900 if lap < 3 else 5000)),
                        ("C", lap * 100000 + 1000)], key=lambda x: (x[1], x[0]))
        rows += [("S", lap, d, ms, i + 1) for i, (d, ms) in enumerate(order)]
    df = spark.createDataFrame(rows, "session_id string, lap_number int, driver_id string, race_ms bigint, position int")
    nxt = {(r[1], r[2]): r[4] for r in rows}
    df = df.withColumn("next_position", F.lit(None).cast("int"))
    pos = spark.createDataFrame([(s_, lap, d, ms, p, nxt.get((lap + 1, d))) for s_, lap, d, ms, p in rows],
                                df.schema)
    pairs = graph.close_pairs(pos)
    got = {(r.ahead_id, r.behind_id, r.lap_number) for r in pairs.collect()}
    assert ("A", "B", 1) in got and ("A", "B", 2) in got and ("A", "B", 3) not in got
    assert not [g for g in got if g[:2] == ("A", "C")]      # a gap of exactly 1000 ms is not close
    assert ("B", "C", 1) in got                               # 100 ms apart
    assert graph.battles(pairs).count() == 0                  # A-B close on 2 laps only
    # C was 100 ms behind B on lap 2 and is ahead of B on lap 3
    assert [(r.passer_id, r.passed_id, r.lap_number, r.delta_time_ms) for r in graph.overtakes(pairs).collect()] == \
        [("C", "B", 3, 100)]


def test_pagerank_matches_power_iteration(spark):
    nodes = ["a", "b", "c", "d"]
    edges = [("a", "b", 1.0), ("a", "c", 2.0), ("b", "c", 1.0), ("c", "a", 1.0)]  # d is dangling
    ndf = spark.createDataFrame([("S", n) for n in nodes], "session_id string, node string")
    edf = spark.createDataFrame([("S", s, d, w) for s, d, w in edges],
                                "session_id string, src string, dst string, weight double")
    got = {r.node: r.rank for r in graph.pagerank(ndf, edf, iterations=10).collect()}
    n, damp = len(nodes), 0.85
    ix = {k: i for i, k in enumerate(nodes)}
    m = np.zeros((n, n))
    for s, d, w in edges:
        m[ix[d], ix[s]] += w
    out = m.sum(axis=0)
    r = np.full(n, 1 / n)
    for _ in range(10):
        dangling = r[out == 0].sum()
        r = (1 - damp) / n + damp * (m @ np.where(out > 0, r / np.where(out > 0, out, 1), 0) + dangling / n)
    for k in nodes:
        assert abs(got[k] - r[ix[k]]) < 1e-9
    assert abs(sum(got.values()) - 1.0) < 1e-9


def test_rivalry_communities_by_exact_jaccard(spark):
    fights = [("S", "a", "x"), ("S", "a", "y"), ("S", "b", "x"), ("S", "b", "y"), ("S", "c", "z"), ("T", "a", "q")]
    btl = spark.createDataFrame(fights, "session_id string, driver_a string, driver_b string")
    got = {(r.session_id, r.driver_id): r.community for r in graph.rivalry_communities(btl).collect()}
    # in S, a and b fought the same two cars, and x and y too; c and z fought only each other
    assert got == {("S", "a"): "a", ("S", "b"): "a", ("S", "x"): "x", ("S", "y"): "x", ("S", "c"): "c", ("S", "z"): "z",
                   ("T", "a"): "a", ("T", "q"): "q"}
    links = {(r.src, r.dst): r.jaccard for r in graph.rivalry_links(btl, 0.1).collect()}
    assert links == {("a", "b"): 1.0, ("x", "y"): 1.0}


def test_asof_with_a_sample_at_epoch_zero_is_not_replicated(spark):
    day = 1_700_000_000_000
    laps = [("S", "A", i, day + i * 90_000, "SOFT") for i in range(1, 6)]
    samples = [("S", "A", 0), ("S", "A", day), ("S", "A", day + 90_000), ("S", "A", day + 90_001), ("S", "A", day + 10**6)]
    sdf = spark.createDataFrame(samples, "session_id string, driver_id string, t_ms bigint")
    m = L.asof_forward_join(sdf, spark.createDataFrame(laps, LAPS_SCHEMA), carry=["tyre_compound"])
    assert sorted((r.t_ms, r.asof_lap_number) for r in m.collect()) == [
        (0, 1), (day, 1), (day + 90_000, 1), (day + 90_001, 2), (day + 10**6, 0)]


def test_last_laps_are_those_of_the_session(spark):
    ovt = spark.createDataFrame([("S", 3), ("S", 20)], "session_id string, lap_number int")
    laps = spark.createDataFrame([("S", i) for i in range(1, 41)], "session_id string, lap_number int")
    assert [r.lap_number for r in graph.last_n_laps(ovt, laps, 25).collect()] == [20]
    assert graph.last_n_laps(ovt, laps, 10).count() == 0


def test_degrees_count_passes_and_battles_both_ways(spark):
    ovt = spark.createDataFrame([("S", "a", "b"), ("S", "a", "b")], "session_id string, passer_id string, passed_id string")
    btl = spark.createDataFrame([("S", "b", "c", 2.5)],
                                "session_id string, driver_a string, driver_b string, interaction_strength double")
    got = {r.node: (r.out_degree, r.in_degree) for r in graph.weighted_degree(graph.interaction_edges(ovt, btl)).collect()}
    assert got == {"a": (2.0, 0.0), "b": (2.5, 4.5), "c": (2.5, 2.5)}


def test_repeated_event_changes_nothing(spark):
    from paths import SMALL
    from kerbside.sources import envelope, testbed
    from kerbside.sources.schemas import RACE_EVENT_SCHEMA, TELEMETRY_SCHEMA
    lp = testbed.laps(spark, SMALL).where(F.col("session_id") == "S0")
    ev = envelope.parsed_view(envelope.raw_view(testbed.event_messages(spark, SMALL, lp)), RACE_EVENT_SCHEMA, "race.events")
    tel = envelope.parsed_view(envelope.raw_view(testbed.telemetry_messages(spark, SMALL, lp)), TELEMETRY_SCHEMA, "telemetry.raw")
    twice = ev.unionByName(ev.where("lap_number = 5").withColumn("offset", F.col("offset") + 10**12))
    for f in (lambda e: L.gold_fact_lap(tel, e), lambda e: L.laps_with_events(lp, e)):
        assert sorted(map(str, f(twice).collect())) == sorted(map(str, f(ev).collect()))


def test_nan_channels_are_null(spark):
    rows = [("S", "A", 1, "2024-03-01T12:00:00+00:00", float("nan"), 1.0, 0.0, "0", 5.0, 50.0, "SOFT", 1)]
    t = spark.createDataFrame(rows, "session_id string, driver_id string, lap_number int, timestamp_utc string, speed_kph double, "
                              "throttle_pct double, brake_pressure_bar double, drs_state string, fuel_mass_kg double, "
                              "battery_pct double, tyre_compound string, offset bigint")
    assert L.samples_from_bronze(t).first().speed_kph is None
    bad = t.withColumn("t_ms", F.lit(1)).select("session_id", "speed_kph", "t_ms")
    assert L.split_valid(bad)[1].count() == 1


def test_interval_join_matches_brute_force(spark):
    rnd = random.Random(3)
    periods = [("S", s, s + rnd.randint(1, 50000), f"SC{i}") for i, s in
               enumerate(sorted(rnd.sample(range(0, 1000000), 12)))]
    points = [("S", rnd.randint(-1000, 1100000)) for _ in range(400)] + [("S", p[1]) for p in periods] + \
             [("S", p[2]) for p in periods]
    pdf = spark.createDataFrame(points, "session_id string, t_ms bigint")
    idf = spark.createDataFrame(periods, "session_id string, start_ms bigint, end_ms bigint, label string")
    got = sorted((r.t_ms, r.label) for r in L.interval_join(pdf, idf, ["session_id"], "t_ms", "start_ms", "end_ms",
                                                              ["label"], 7000, "inner").collect())
    want = sorted((t, lab) for _s, t in points for (_x, s, e, lab) in periods if s <= t < e)
    assert got == want


def test_select_laps(spark):
    laps = spark.createDataFrame([("S1", "A", 1), ("S1", "B", 1), ("S2", "A", 1)],
                                 "session_id string, driver_id string, lap_number int")
    dim = spark.createDataFrame([("S1", 2024, 6, "Monaco Grand Prix", "Race"), ("S2", 2024, 7, "Spanish Grand Prix", "Race")],
                                "session_id string, year int, round int, event_name string, session_name string")
    assert L.select_laps(laps, dim, year=2024, event="MONACO").count() == 2
    assert L.select_laps(laps, dim, event="7", driver="A").collect()[0].session_id == "S2"


def test_hot_copy_group_and_hot_driver(spark):
    """One sample copied 5000 times and one driver holding most samples: dedup keeps
    the first copy; the as-of match of the hot driver still equals brute force and is
    spread over many join buckets."""
    rows = [("S", "HOT", 500, c, 1.0 * c) for c in range(5000)]
    rows += [("S", "HOT", t, 0, 0.0) for t in range(0, 400000, 97)]
    rows += [("S", "B", t, 0, 0.0) for t in range(0, 20000, 1000)]
    df = spark.createDataFrame(rows, "session_id string, driver_id string, t_ms bigint, copy_no bigint, v double")
    d = L.deduplicate(df, ["session_id", "driver_id", "t_ms"], "copy_no")
    hot = d.where((F.col("driver_id") == "HOT") & (F.col("t_ms") == 500)).collect()
    assert len(hot) == 1 and hot[0].copy_no == 0 and hot[0].v == 0.0
    assert d.count() == df.select("session_id", "driver_id", "t_ms").distinct().count()
    laps = [("S", "HOT", i, i * 90000, "SOFT") for i in range(1, 5)] + [("S", "B", 1, 15000, "HARD")]
    ldf = spark.createDataFrame(laps, LAPS_SCHEMA)
    samples = [(r.session_id, r.driver_id, r.t_ms) for r in d.select("session_id", "driver_id", "t_ms").collect()]
    m = L.asof_forward_join(d.select("session_id", "driver_id", "t_ms"), ldf, bucket_ms=10000)
    got = sorted(tuple(r) for r in m.select("session_id", "driver_id", "t_ms", "asof_lap_number").collect())
    assert got == _brute_asof(samples, laps)
    buckets = d.where(F.col("driver_id") == "HOT").select(F.floor(F.col("t_ms") / 10000)).distinct().count()
    assert buckets >= 40
