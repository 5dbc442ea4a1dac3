"""Serving tables and session summaries (SURVEY §2.8 T3-T5/T7, §2.5 A11/A15-A17/A19-A20,
§2.14 X1-X4).

Top-k per group uses ``row_number() <= k``, which Catalyst plans as a window group
limit (partial top-k before the shuffle). Global top-k uses ``orderBy().limit()``,
planned as TakeOrderedAndProject (per-partition top-k, then a merge of k rows each).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.laps import dealt


def top_overtakers(ovt: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` drivers with most overtakes in each session (ties by driver id)."""
    made = ovt.groupBy("session_id", F.col("passer_id").alias("driver_id")).agg(F.count(F.lit(1)).alias("overtakes"))
    w = Window.partitionBy("session_id").orderBy(F.col("overtakes").desc(), "driver_id")
    return made.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def most_influential(summary: DataFrame, k: int = 10) -> DataFrame:
    """Drivers by summed PageRank over all sessions."""
    return (summary.groupBy("driver_id").agg(F.sum("pagerank").alias("total_pagerank"))
            .orderBy(F.col("total_pagerank").desc(), "driver_id").limit(k))


def rivalry_pairs(btl: DataFrame, k: int = 10) -> DataFrame:
    """T4: driver pairs by number of battles, then battle laps."""
    g = btl.groupBy("driver_a", "driver_b").agg(F.count(F.lit(1)).alias("battles"),
                                                F.sum("lap_count").alias("battle_laps"))
    return g.orderBy(F.col("battles").desc(), F.col("battle_laps").desc(), "driver_a", "driver_b").limit(k)


def final_order(pos: DataFrame) -> DataFrame:
    """Each driver's race order at their last completed lap."""
    last = pos.groupBy("session_id", "driver_id").agg(
        F.max_by(F.struct("lap_number", "race_ms"), "lap_number").alias("l"))
    return last.select("session_id", "driver_id", F.col("l.lap_number").alias("laps_completed"),
                       F.col("l.race_ms").alias("race_ms"))


def leaderboard(pos: DataFrame) -> DataFrame:
    """T5: session classification: more laps first, then less race time; ``rank`` per
    session. Groups are the drivers of one session."""
    f = final_order(pos)
    w = Window.partitionBy("session_id").orderBy(F.col("laps_completed").desc(), "race_ms", "driver_id")
    return f.withColumn("final_position", F.row_number().over(w).cast("int"))


#: [ours] session numbers of a range in the trend over sessions
SESSIONS_PER_RANGE = 1000

# Fixed values [ours]: points for classified positions 1-10.
POINTS = [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]


def team_standings(board: DataFrame, drivers: DataFrame) -> DataFrame:
    """T5: team points over all sessions (driver -> team via the driver dimension), ranked."""
    pts = F.when(F.col("final_position") <= len(POINTS),
                 F.element_at(F.array(*[F.lit(p) for p in POINTS]), F.col("final_position"))).otherwise(0)
    x = board.join(drivers, "driver_id", "left").groupBy("team_id").agg(F.sum(pts).alias("points"))
    # one row per team after the aggregate: a global ranking window over a table
    # bounded by the number of teams, not by the data
    return x.withColumn("standing", F.rank().over(Window.orderBy(F.col("points").desc())))


def driver_session_summary(fact_lap: DataFrame, board: DataFrame, inter: DataFrame, pr: DataFrame) -> DataFrame:
    """fact_driver_session -- laps, best/avg lap, final position, interactions, PageRank."""
    laps = fact_lap.groupBy("session_id", "driver_id").agg(
        F.count(F.lit(1)).alias("laps"), F.min("lap_time_ms").alias("best_lap_ms"),
        F.avg("lap_time_ms").alias("avg_lap_ms"), F.avg("avg_speed_kph").alias("avg_speed_kph"))
    return (laps.join(board.select("session_id", "driver_id", "final_position"), ["session_id", "driver_id"], "left")
                .join(inter, ["session_id", "driver_id"], "left")
                .join(pr, ["session_id", "driver_id"], "left"))


def team_battle_intensity(btl: DataFrame, drivers: DataFrame) -> DataFrame:
    """A16 + J7: summed interaction strength per unordered pair of different teams."""
    da = drivers.select(F.col("driver_id").alias("driver_a"), F.col("team_id").alias("team_a"))
    db = drivers.select(F.col("driver_id").alias("driver_b"), F.col("team_id").alias("team_b"))
    x = btl.join(da, "driver_a").join(db, "driver_b").where(F.col("team_a") != F.col("team_b"))
    return x.groupBy(F.least("team_a", "team_b").alias("team_1"), F.greatest("team_a", "team_b").alias("team_2")).agg(
        F.sum("interaction_strength").alias("intensity"), F.count(F.lit(1)).alias("battles"))


def team_heatmap(intensity: DataFrame, wide: bool = False) -> DataFrame:
    """Team x team intensity; long form (symmetric) or pivoted wide form."""
    long = intensity.select("team_1", "team_2", "intensity").unionByName(
        intensity.select(F.col("team_2").alias("team_1"), F.col("team_1").alias("team_2"), "intensity"))
    if not wide:
        return long
    return long.groupBy("team_1").pivot("team_2").agg(F.sum("intensity"))


def influence_vs_result(summary: DataFrame) -> DataFrame:
    """Correlation of PageRank and influence with the final position."""
    return summary.agg(F.corr("pagerank", "final_position").alias("corr_pagerank_position"),
                       F.corr("influence_score", "final_position").alias("corr_influence_position"),
                       F.count(F.lit(1)).alias("rows"))


def run_totals(telemetry: DataFrame, events: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per-session telemetry, event and error counts plus an overall row (rollup)."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = (telemetry.select("session_id", one.alias("telemetry"), zero.alias("events"), zero.alias("errors"))
            .unionByName(events.select("session_id", zero.alias("telemetry"), one.alias("events"), zero.alias("errors")))
            .unionByName(rejected.select("session_id", zero.alias("telemetry"), zero.alias("events"), one.alias("errors"))))
    # a union and one partial+final aggregate instead of full outer joins; a null
    # session stays one group
    x = rows.groupBy("session_id").agg(F.sum("telemetry").alias("telemetry"), F.sum("events").alias("events"),
                                       F.sum("errors").alias("errors"))
    return x.rollup("session_id").agg(F.sum("telemetry").alias("telemetry"), F.sum("events").alias("events"),
                                      F.sum("errors").alias("errors"), F.count(F.lit(1)).alias("sessions"))


def cap_per_session(df: DataFrame, n: int, order: list[str], within: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """At most ``n`` rows per session (the ``--max-events`` cap), first by ``order``. ``within``: columns that ``df`` is laid out
    by beside the session; no group of theirs gives more than ``n`` rows, so only its first ``n`` travel to their session, dealt to
    ``parts`` partitions."""

    def first(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")

    if within:
        df = first(df, ["session_id", *within])
    return first(dealt(df, parts, "session_id"), ["session_id"])


def pit_efficiency(pits: DataFrame) -> DataFrame:
    """A20 [ours]: each stop against the session's median stop time (exact median)."""
    med = pits.groupBy("session_id").agg(F.median("pit_duration_ms").alias("session_median_ms"))
    return pits.join(med, "session_id").withColumn(
        "pit_delta_ms", F.col("pit_duration_ms") - F.col("session_median_ms"))


def blue_flag_exposure(samples: DataFrame, flag_col: str = "flag_state") -> DataFrame:
    """A20 [ours]: time under blue flag per (session, driver, lap): sum of
    ``next sample time - sample time`` over BLUE samples (windows per lap)."""
    w = Window.partitionBy("session_id", "driver_id", "lap_number").orderBy("t_ms")
    dt = F.lead("t_ms").over(w) - F.col("t_ms")
    return (samples.withColumn("__dt", F.when(F.col(flag_col) == "BLUE", dt))
            .groupBy("session_id", "driver_id", "lap_number").agg(F.coalesce(F.sum("__dt"), F.lit(0)).alias("blue_flag_ms")))


def undercut_rate(pos: DataFrame) -> DataFrame:
    """X1 [ours]: per session, the share of stops after which the driver's position two
    laps later is better than on the lap before the stop. Both positions come from the
    driver's neighbouring rows (the window that orders laps), checked by their lap numbers."""
    w = Window.partitionBy("session_id", "driver_id").orderBy("lap_number")

    def at(shift):
        row = F.lag(F.struct("lap_number", "position"), 1).over(w) if shift < 0 else \
            F.lead(F.struct("lap_number", "position"), shift).over(w)
        return F.when(row["lap_number"] == F.col("lap_number") + shift, row["position"])

    x = (pos.select("session_id", "driver_id", "lap_number", "position", "pit")
         .withColumn("pos_before", at(-1)).withColumn("pos_after", at(2))
         .where(F.col("pit") & F.col("pos_before").isNotNull() & F.col("pos_after").isNotNull()))
    return x.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("stops"),
        F.avg((F.col("pos_after") < F.col("pos_before")).cast("double")).alias("undercut_rate"))


def team_gap_trend(pos: DataFrame, drivers: DataFrame) -> DataFrame:
    """X2 [ours]: per (session, team), slope and intercept of the gap to the leader over
    laps (best car of the team per lap), and the gap that the line predicts for the lap after
    the team's last."""
    x = pos.select("session_id", "driver_id", "lap_number", "delta_vs_leader_ms").join(drivers, "driver_id").groupBy("session_id", "team_id", "lap_number").agg(
        F.min("delta_vs_leader_ms").alias("gap_ms"))
    return x.groupBy("session_id", "team_id").agg(
        F.regr_slope("gap_ms", "lap_number").alias("gap_slope_ms_per_lap"),
        F.regr_intercept("gap_ms", "lap_number").alias("gap_intercept_ms"),
        F.max("lap_number").alias("last")).withColumn(
        "predicted_gap_ms", F.col("gap_intercept_ms") + F.col("gap_slope_ms_per_lap") * (F.col("last") + 1)).drop("last")


def multi_session_trend(fact_lap: DataFrame) -> DataFrame:
    """Per-driver average lap per session and the change from the previous session
    (sessions ordered by number). A driver's sessions are split into ranges of session
    numbers, so a few drivers with very many sessions spread over many tasks; the first
    row of a range takes the last row of the driver's range before it."""
    x = fact_lap.groupBy("driver_id", "session_id").agg(F.avg("lap_time_ms").alias("avg_lap_ms"))
    x = x.withColumn("__no", F.substring("session_id", 2, 20).try_cast("bigint"))
    x = x.withColumn("__range", F.expr(f"__no div {SESSIONS_PER_RANGE}"))
    last = x.groupBy("driver_id", "__range").agg(F.max_by("avg_lap_ms", "__no").alias("__last"))
    ranges = Window.partitionBy("driver_id").orderBy("__range")
    before = last.select("driver_id", "__range", F.lag("__last").over(ranges).alias("__before"))
    inside = Window.partitionBy("driver_id", "__range").orderBy("__no")
    previous = F.coalesce(F.lag("avg_lap_ms").over(inside), F.col("__before"))
    return (x.join(before, ["driver_id", "__range"])
            .withColumn("delta_vs_prev_session_ms", F.col("avg_lap_ms") - previous)
            .drop("__no", "__range", "__before"))


def plan_vs_actual(plan: DataFrame, pit_laps: DataFrame) -> DataFrame:
    """X4 [ours]: planned stop laps against actual pit laps, matched by stop order."""
    w = Window.partitionBy("session_id", "driver_id").orderBy("lap_number")
    actual = pit_laps.select("session_id", "driver_id", "lap_number").withColumn("stop_no", F.row_number().over(w))
    return plan.join(actual.withColumnRenamed("lap_number", "actual_lap"),
                     ["session_id", "driver_id", "stop_no"], "full").withColumn(
        "lap_diff", F.abs(F.col("actual_lap") - F.col("planned_lap")))
