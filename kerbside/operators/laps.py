"""Telemetry cleansing, as-of lap matching and the lap / stint layer
(SURVEY §2.4 J1-J5, §2.5 A12-A14/A21, §2.6 W1-W7/W9-W11, §2.9 U3, §2.3 P10-P13, F17).

Partitioning notes (checked with ``explain``):
* Windows are keyed by (session, driver) or (session, lap): groups are bounded by the
  laps of one driver or the cars of one lap, never by the size of a session.
* Session-wide running quantities (best lap so far) are computed on a per-(session, lap)
  pre-aggregate, so a session holding a third of all rows only adds rows to map-side
  partial aggregates.
* The as-of join is a bucketed band join: equi-join on (session, driver, time bucket)
  plus a range residual. A hot driver spreads over many buckets, so no single task
  receives all of its samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.scalars import made_once, null_safe_double
from kerbside.session import joined_as_laid_out

KEYS = ["session_id", "driver_id"]
ASOF_BUCKET_MS = 60000


# ------------------------------------------------------------------ cleansing
def deduplicate(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep, per key, the row with the smallest ``order_col`` (e.g. copy number or
    (partition, offset)). A ``min(struct(order, row))`` aggregate: copies are reduced map-side
    before the shuffle. Rows with strings make it a sort-based aggregate, which spills."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.min(F.struct(F.col(order_col).alias("__o"), *[F.col(c) for c in rest])).alias("__r")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col("__r." + c).alias(c) for c in rest]).select(*df.columns)


def reject_reason(df: DataFrame) -> Column:
    """First failing check, or null when the row is valid.

    Coordinates are track X/Y/Z in metres, not degrees, so only non-finite values are
    impossible here."""
    checks = [
        (F.col("session_id").isNull(), "NULL_SESSION"),
        (F.isnan("speed_kph") | (F.col("speed_kph") < 0), "NEGATIVE_SPEED"),
    ]
    if "t_ms" in df.columns:  # P12: a sample without a time cannot be placed on a lap
        checks.append((F.col("t_ms").isNull(), "NULL_TIME"))
    for c in ("gps_lat", "gps_lon", "gps_alt"):
        if c in df.columns:
            checks.append((F.isnan(c) | (F.abs(F.col(c)) == float("inf")), "BAD_COORDINATES"))
    expr = F.lit(None).cast("string")
    for cond, reason in reversed(checks):
        expr = F.when(cond, F.lit(reason)).otherwise(expr)
    return expr


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``reject_reason``)."""
    tagged = df.withColumn("reject_reason", reject_reason(df))
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def non_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null guard on required columns."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def split_required(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """P10: (rows with all of ``cols``, the others with the first missing one as ``reject_reason``)."""
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit("MISSING_" + c.upper())) for c in cols])
    tagged = df.withColumn("reject_reason", reason)
    return tagged.where("reject_reason is null").drop("reject_reason"), tagged.where("reject_reason is not null")


def clean_telemetry(telemetry: DataFrame) -> DataFrame:
    """Valid, deduplicated samples (one per session, driver and sample time)."""
    valid, _ = split_valid(telemetry)
    return deduplicate(valid, ["session_id", "driver_id", "t_ms"], "copy_no")


# ------------------------------------------------------------------ as-of join
def asof_forward_join(samples: DataFrame, laps: DataFrame, keys: list[str] = KEYS, t_col: str = "t_ms",
                      lap_t: str = "cum_ms", lap_no: str = "lap_number", carry: list[str] | None = None,
                      prefix: str = "asof_", bucket_ms: int = ASOF_BUCKET_MS, laid_out: bool = False) -> DataFrame:
    """Attach to each sample the first lap (in lap order) whose end time is >= the
    sample time; lap number 0 when there is none.

    A lap L matches time t iff ``max(end of laps before L) < t <= end of L``, so each lap
    owns a half-open interval and a sample falls in at most one. Laps but the first are
    replicated into every ``bucket_ms`` bucket their interval touches (a lap of ~90 s
    touches 2-3) and equi-joined with samples on (keys, bucket); the interval is the
    residual predicate. The first lap of a key takes every sample up to its end, however
    far back a bad clock has put it: one row per key, joined on the key and never
    replicated. That side has as many rows as there are keys; where it is large, adaptive
    execution splits a hot key's samples. ``laid_out``: samples and laps lie by ``keys`` alike and stay there
    (``session.joined_as_laid_out``), samples without a key too, so that all are read once.
    """
    carry = carry or []
    rk = {k: "__k_" + k for k in keys}
    lap_order = Window.partitionBy(*keys).orderBy("__lap").rowsBetween(Window.unboundedPreceding, -1)
    lp = laps.select(*keys, F.col(lap_no).alias("__lap"), F.col(lap_t).alias("__hi"),
                     *[F.col(c).alias(prefix + c) for c in carry]).where(F.col("__hi").isNotNull())
    lp = lp.withColumn("__lo", F.max("__hi").over(lap_order))
    first = (lp.where(F.col("__lo").isNull())
             .select(*[F.col(k).alias("__f_" + k) for k in keys], F.col("__hi").alias("__f_hi"),
                     F.struct("__lap", *[prefix + c for c in carry]).alias("__f")))
    later = (lp.where(F.col("__lo") < F.col("__hi"))
             .withColumn("__lb", F.explode(F.sequence(F.floor(F.col("__lo") / bucket_ms),
                                                      F.floor(F.col("__hi") / bucket_ms)))))
    later = later.select(*[F.col(k).alias(v) for k, v in rk.items()], "__lo", "__hi", "__lb",
                         F.struct("__lap", *[prefix + c for c in carry]).alias("__l"))
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    s = (samples if laid_out else samples.where(keyed)).withColumn("__sb", F.floor(F.col(t_col) / bucket_ms))
    # only a sample that lies in its key's first lap takes that lap along to the second join
    s = s.join(first, [F.col(k) == F.col("__f_" + k) for k in keys], "left").select(
        *samples.columns, "__sb", F.when(F.col(t_col) <= F.col("__f_hi"), F.col("__f")).alias("__f"))
    cond = [F.col(k) == F.col(v) for k, v in rk.items()]
    cond += [F.col("__sb") == F.col("__lb"), F.col(t_col) > F.col("__lo"), F.col(t_col) <= F.col("__hi")]
    joined = s.join(later, cond, "left")
    hit = F.coalesce("__f", "__l")
    out = [F.col(c) for c in samples.columns] + [F.coalesce(hit["__lap"], F.lit(0)).alias(prefix + lap_no)]
    out += [hit[prefix + c].alias(prefix + c) for c in carry]
    found = joined.select(*out)
    if laid_out:
        return found
    # a sample without a key has no lap, and need not travel to learn it
    return found.unionByName(samples.where(~keyed).select(
        *samples.columns, *[F.lit(0 if c == prefix + lap_no else None).cast(found.schema[c].dataType).alias(c)
                            for c in [prefix + lap_no, *[prefix + c for c in carry]]]))


# ------------------------------------------------------------------ reference lookups
def attach_last_reading(samples: DataFrame, readings: DataFrame, key: str, ts: str,
                        fields: list[str]) -> DataFrame:
    """J2 (literal): the key's LAST reading stamped on every row (look-ahead, as the
    reference does). One row per key survives the ``max_by`` aggregate, so the join side
    is as small as the key count; AQE broadcasts it when it is small."""
    last = readings.groupBy(key).agg(F.max_by(F.struct(*fields), F.col(ts)).alias("__w"))
    last = last.select(key, *[F.col("__w." + f).alias(f) for f in fields])
    return samples.join(last, key, "left")


def attach_asof_reading(samples: DataFrame, readings: DataFrame, key: str, t_col: str, ts: str,
                        fields: list[str], bucket: int) -> DataFrame:
    """J2 without look-ahead [ours]: each sample gets the key's latest reading taken at or
    before the sample time. Readings become intervals ``[ts, next ts)`` (``lead`` over one
    key's readings) and are matched with the bucketed ``interval_join``; samples before
    the first reading get nulls."""
    w = Window.partitionBy(key).orderBy("__from")
    # the last reading holds until the key's last sample (a per-key partial aggregate),
    # so every interval is finite and replicates into a bounded number of buckets
    last_t = samples.groupBy(key).agg((F.max(t_col) + 1).alias("__last"))
    iv = (readings.select(key, F.col(ts).alias("__from"), *fields)
          .withColumn("__next", F.lead("__from").over(w))
          .join(last_t, key, "left")
          .withColumn("__to", F.coalesce("__next", F.greatest(F.col("__last"), F.col("__from") + 1)))
          .drop("__next", "__last"))
    return interval_join(samples, iv, [key], t_col, "__from", "__to", fields, bucket)


def lookup(df: DataFrame, dim: DataFrame, keys: list[str] | str) -> DataFrame:
    """Dimension enrichment (left join). No hint: the static planner broadcasts
    when the dimension's size estimate is under the threshold, and AQE converts to a
    broadcast at run time when the materialised side proves small; otherwise it stays
    a shuffle join."""
    return df.join(dim, keys, "left")


# ------------------------------------------------------------------ lap facts
def distinct_events(race_events: DataFrame, laid_out: bool = False) -> DataFrame:
    """U3 on events: logs deliver at least once, so of the copies of an event (same event_id) the
    first in the log stays. Rows are dealt by lap, which the joins and counts of events need as
    well, so the copies meet without a shuffle of their own. ``laid_out``: rows lie by (session, driver), as what they meet
    does, and stay there."""
    order = [c for c in ("partition", "offset") if c in race_events.columns]
    keys = ["session_id", "driver_id", "lap_number", "event_id"]
    dealt = race_events if laid_out else race_events.repartition("session_id", "driver_id", "lap_number")
    if not order:
        return dealt.dropDuplicates(keys)
    rest = [c for c in race_events.columns if c not in keys and c not in order]
    one = dealt.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__r"))
    return one.select(*[F.col("__r." + c).alias(c) if c not in keys else F.col(c) for c in race_events.columns])


def lap_events(race_events: DataFrame, laid_out: bool = False) -> DataFrame:
    """LAP_COMPLETION payloads parsed into lap-time and sector columns, one row per lap."""
    schema = ("lap_time_ms BIGINT, sector1_ms BIGINT, sector2_ms BIGINT, sector3_ms BIGINT, "
              "compound STRING, tyre_life INT, stint INT, fresh_tyre BOOLEAN")
    # payloads are parsed where they are read: the figures travel to their lap, not the texts
    order = [c for c in ("partition", "offset") if c in race_events.columns]
    told = race_events.where(F.col("event_type") == "LAP_COMPLETION").select(
        "session_id", "driver_id", "lap_number", "event_id", *order, F.from_json("payload", schema).alias("p"))
    return (distinct_events(told, laid_out)
            .select("session_id", "driver_id", "lap_number", "p.lap_time_ms", "p.sector1_ms",
                    "p.sector2_ms", "p.sector3_ms", F.col("p.compound").alias("event_compound")))


def fact_lap(samples: DataFrame, race_events: DataFrame | None = None, lap_col: str = "lap_number",
             compound_per_lap: bool = False, laid_out: bool = False) -> DataFrame:
    """Per (session, driver, lap) speeds, fuel used (first - last by time), battery
    delta (last - first), compound; lap and sector times from the LAP_COMPLETION payload,
    else the span of the lap's sample times [ours].

    All aggregation buffers are fixed-width (doubles, longs), so Spark plans a hash
    aggregate with map-side partial aggregation. The compound is a string: by default it
    is the compound of the lap's last sample (``max_by``, a sort-based aggregate); with
    ``compound_per_lap=True`` -- the samples carry their as-of matched lap's compound,
    constant within the group -- it is a grouping key and the aggregate stays hashed.
    ``laid_out``: samples and events lie by (session, driver) alike, and stay there."""
    keys = ["session_id", "driver_id", F.col(lap_col).alias("lap_number")]
    if compound_per_lap:
        keys.append("tyre_compound")
        compound = []
    else:
        compound = [F.max_by("tyre_compound", "t_ms").alias("tyre_compound")]
    g = samples.groupBy(*keys).agg(
        F.min("speed_kph").alias("min_speed_kph"), F.avg("speed_kph").alias("avg_speed_kph"),
        F.max("speed_kph").alias("max_speed_kph"),
        (F.min_by("fuel_mass_kg", "t_ms") - F.max_by("fuel_mass_kg", "t_ms")).alias("fuel_used_kg"),
        (F.max_by("battery_pct", "t_ms") - F.min_by("battery_pct", "t_ms")).alias("battery_delta_pct"),
        *compound,
        (F.max("t_ms") - F.min("t_ms")).alias("sample_span_ms"),
        F.count(F.lit(1)).alias("samples"),
    )
    if race_events is None:
        return g.withColumn("lap_time_ms", F.col("sample_span_ms"))
    ev = lap_events(race_events, laid_out)
    j = g.join(ev, ["session_id", "driver_id", "lap_number"], "left")
    return j.select(
        "session_id", "driver_id", "lap_number",
        F.coalesce("lap_time_ms", "sample_span_ms").alias("lap_time_ms"),
        "sector1_ms", "sector2_ms", "sector3_ms", "avg_speed_kph", "max_speed_kph", "min_speed_kph",
        F.coalesce("tyre_compound", "event_compound").alias("tyre_compound"),
        "fuel_used_kg", "battery_delta_pct", "samples")


# ------------------------------------------------------------------ stints
def with_stints(laps: DataFrame, pit_col: str = "pit") -> DataFrame:
    """Gaps-and-islands stint numbering. A new stint starts on the first lap, on a
    compound change, or on the lap after a pit stop."""
    w = Window.partitionBy(*KEYS).orderBy("lap_number")
    prev_comp = F.lag("tyre_compound").over(w)
    prev_pit = F.lag(pit_col).over(w)
    start = (prev_comp.isNull() | (prev_comp != F.col("tyre_compound")) | F.coalesce(prev_pit, F.lit(False)))
    x = laps.withColumn("__new", start.cast("int"))
    x = x.withColumn("stint_no", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return x.drop("__new").withColumn(
        "stint_id", F.concat_ws("_", "session_id", "driver_id", F.col("stint_no").cast("string")))


def fact_stint(laps_with_stints: DataFrame, fuel: DataFrame | None = None) -> DataFrame:
    """A13 + A14 + A21 per stint: laps, pace, degradation slope (ms per lap),
    consistency ``1 - stddev/avg`` and the 95 % confidence interval of pace [ours]."""
    x = laps_with_stints
    if fuel is not None:
        x = x.join(fuel, ["session_id", "driver_id", "lap_number"], "left")
    fuel_agg = [F.sum("fuel_used_kg").alias("total_fuel_used_kg")] if "fuel_used_kg" in x.columns else []
    g = x.groupBy("stint_id", "session_id", "driver_id", "stint_no").agg(
        F.min_by("tyre_compound", "lap_number").alias("tyre_compound"),
        F.min("lap_number").alias("start_lap"), F.max("lap_number").alias("end_lap"),
        F.count(F.lit(1)).alias("lap_count"),
        F.avg("lap_time_ms").alias("avg_pace_ms"),
        F.regr_slope("lap_time_ms", "lap_number").alias("degradation_rate_ms_per_lap"),
        F.stddev_samp("lap_time_ms").alias("sd"),
        *fuel_agg)
    half = F.lit(1.96) * F.col("sd") / F.sqrt(F.col("lap_count"))
    return g.select(
        "stint_id", "session_id", "driver_id", "stint_no", "tyre_compound", "start_lap", "end_lap", "lap_count",
        "avg_pace_ms", "degradation_rate_ms_per_lap",
        *(["total_fuel_used_kg"] if fuel_agg else []),
        F.when(F.col("lap_count") > 1, F.lit(1) - F.col("sd") / F.col("avg_pace_ms")).alias("consistency_score"),
        F.when(F.col("lap_count") > 1, F.col("avg_pace_ms") - half).alias("pace_ci_low"),
        F.when(F.col("lap_count") > 1, F.col("avg_pace_ms") + half).alias("pace_ci_high"))


# ------------------------------------------------------------------ race order
def with_race_order(laps: DataFrame) -> DataFrame:
    """W2 cumulative time, W3 position, W4 gap to the car ahead, W5 delta to leader,
    W6 delta to the best lap so far in the session, W7 3-lap rolling pace, W11 next lap."""
    per_driver = Window.partitionBy(*KEYS).orderBy("lap_number")
    x = laps.withColumn("race_ms", F.sum("lap_time_ms").over(
        per_driver.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    x = x.withColumn("rolling3_pace_ms", F.avg("lap_time_ms").over(per_driver.rowsBetween(-2, 0)))
    x = x.withColumn("next_lap_number", F.lead("lap_number").over(per_driver))
    per_lap = Window.partitionBy("session_id", "lap_number").orderBy("race_ms", "driver_id")
    x = x.withColumn("position", F.row_number().over(per_lap).cast("int"))
    x = x.withColumn("gap_ahead_ms", F.col("race_ms") - F.lag("race_ms").over(per_lap))
    x = x.withColumn("delta_vs_leader_ms", F.col("race_ms") - F.min("race_ms").over(
        Window.partitionBy("session_id", "lap_number")))
    # best lap so far: per-(session, lap) minimum, then a running minimum over the laps of
    # the session on that small pre-aggregate, joined back on (session, lap)
    best = x.groupBy("session_id", "lap_number").agg(F.min("lap_time_ms").alias("__m"))
    best = best.withColumn("__best", F.min("__m").over(
        Window.partitionBy("session_id").orderBy("lap_number").rowsBetween(Window.unboundedPreceding, 0)))
    x = x.join(best.select("session_id", "lap_number", "__best"), ["session_id", "lap_number"], "left")
    return x.withColumn("delta_vs_best_ms", F.col("lap_time_ms") - F.col("__best")).drop("__best")


def positions(laps: DataFrame) -> DataFrame:
    """Per (session, lap) race order with the driver's position on the next lap."""
    x = with_race_order(laps)
    per_driver = Window.partitionBy(*KEYS).orderBy("lap_number")
    return x.withColumn("next_position", F.lead("position").over(per_driver))


def race_positions(laps: DataFrame, parts: int | None = None) -> DataFrame:
    """What pairs of cars and pit stops read of ``positions``: race time, position, and the driver's next lap and position. A lap
    travels twice, to its race order and back to its driver, with these columns alone, and ``pit`` where laps have it; ``parts``:
    to so many partitions."""
    per_driver = Window.partitionBy(*KEYS).orderBy("lap_number")
    x = laps.select(*KEYS, "lap_number", F.sum("lap_time_ms").over(
        per_driver.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint").alias("race_ms"),
        *(["pit"] if "pit" in laps.columns else []))
    x = dealt(x, parts, "session_id", "lap_number")
    x = x.withColumn("position", F.row_number().over(
        Window.partitionBy("session_id", "lap_number").orderBy("race_ms", "driver_id")).cast("int"))
    x = dealt(x, parts, *KEYS)
    return x.withColumn("next_lap_number", F.lead("lap_number").over(per_driver)).withColumn(
        "next_position", F.lead("position").over(per_driver))


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to ``parts`` partitions, a number that grows with the rows so that a task sorts its share in
    memory; without one the next operator deals them as the session says."""
    return df if parts is None else df.repartition(parts, *keys)


def rolling_trends(fact: DataFrame, laps: int = 3) -> DataFrame:
    """W7 [ours]: mean change of the lap time from lap to lap, and mean fuel used per lap, over the
    last ``laps`` laps of a driver."""
    order = Window.partitionBy(*KEYS).orderBy("lap_number")
    last = order.rowsBetween(1 - laps, 0)
    x = fact.withColumn("__step", F.col("lap_time_ms") - F.lag("lap_time_ms").over(order))
    return x.select(*KEYS, "lap_number", F.avg("__step").over(last).alias("degradation_ms_per_lap"),
                    F.avg("fuel_used_kg").over(last).alias("fuel_per_lap_kg"))


def lap_metrics(fact: DataFrame, stints: DataFrame, full_samples: int = 8) -> DataFrame:
    """Lap facts in the lap-metrics layout, with their stint, the time of making and a tag that tells
    whether the lap has all of its samples [ours]."""
    from kerbside.sources.schemas import LAP_METRICS_SCHEMA
    tag = F.when(F.col("samples") < full_samples, "PARTIAL").otherwise("COMPLETE")
    x = (fact.join(stints.select(*KEYS, "lap_number", "stint_id"), [*KEYS, "lap_number"], "left")
         .withColumn("generated_at", F.current_timestamp()).withColumn("metadata", F.array(tag)))
    return x.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LAP_METRICS_SCHEMA.fields])


# ------------------------------------------------------------------ events joined to laps
def laps_with_events(laps: DataFrame, race_events: DataFrame) -> DataFrame:
    """Per (session, driver, lap) event counts and pit time, left-joined to the laps.
    The events are pre-aggregated to the lap key so the join is one-to-one."""
    ev = distinct_events(race_events).groupBy("session_id", "driver_id", "lap_number").agg(
        F.count(F.when(F.col("event_type") == "PIT_STOP", 1)).alias("pit_stops"),
        F.sum("pit_duration_ms").alias("pit_time_ms"),
        F.sum("penalty_seconds").alias("penalty_seconds"),
        F.count(F.lit(1)).alias("events"))
    return laps.join(ev, ["session_id", "driver_id", "lap_number"], "left")


def corrected_pit_duration(laps: DataFrame, pit_in: str = "pit_in_ms", pit_out: str = "pit_out_ms") -> DataFrame:
    """The out time of a stop lies on the following (out-)lap; take it with ``lead``.
    The literal form uses the same row's out time or, missing that, the in time."""
    w = Window.partitionBy(*KEYS).orderBy("lap_number")
    literal = F.coalesce(F.col(pit_out), F.col(pit_in)) - F.col(pit_in)
    corrected = F.coalesce(F.lead(pit_out).over(w), F.col(pit_out), F.col(pit_in)) - F.col(pit_in)
    return (laps.withColumn("pit_duration_literal_ms", F.when(F.col(pit_in).isNotNull(), literal))
                .withColumn("pit_duration_ms", F.when(F.col(pit_in).isNotNull(), corrected)))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key (compacted-topic view) by (timestamp, partition, offset).
    A ``max(struct(order..., row))`` aggregate (sort-based where rows hold strings), so a hot
    key is pre-reduced map-side."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max(F.struct(*[F.col(c).alias("__o%d" % i) for i, c in enumerate(order)],
                            *[F.col(c) for c in rest])).alias("__r")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col("__r." + c).alias(c) for c in rest])


# ------------------------------------------------------------------ driving metrics
def driving_metrics(samples: DataFrame, lap_col: str = "lap_number") -> DataFrame:
    """F17 per (session, driver, lap) [ours]: mean deceleration (kph per second) over
    samples taken under braking; mean speed with throttle >= 90 % (straight) and with
    throttle < 90 % (corner exit). Windows are per lap, so groups stay small."""
    w = Window.partitionBy("session_id", "driver_id", lap_col).orderBy("t_ms")
    dv = F.col("speed_kph") - F.lag("speed_kph").over(w)
    dt = (F.col("t_ms") - F.lag("t_ms").over(w)) / 1000.0
    x = samples.withColumn("__decel", F.when((F.col("brake") > 0) & (dt > 0), -dv / dt))
    return x.groupBy("session_id", "driver_id", F.col(lap_col).alias("lap_number")).agg(
        F.avg("__decel").alias("braking_decel_kph_s"),
        F.avg(F.when(F.col("throttle_pct") >= 90, F.col("speed_kph"))).alias("straight_speed_kph"),
        F.avg(F.when(F.col("throttle_pct") < 90, F.col("speed_kph"))).alias("corner_speed_kph"))


def acceleration_times(samples: DataFrame, low_kph: float = 0, high_kph: float = 200) -> DataFrame:
    """F17 per (session, driver, lap) [ours]: shortest time from a sample at or below ``low_kph`` to
    the next one at or above ``high_kph``; laps without such a run have no row."""
    w = Window.partitionBy("session_id", "driver_id", "lap_number").orderBy("t_ms").rowsBetween(Window.unboundedPreceding, 0)
    slow = F.last(F.when(F.col("speed_kph") <= low_kph, F.col("t_ms")), ignorenulls=True).over(w)
    return (samples.withColumn("__slow", slow).where((F.col("speed_kph") >= high_kph) & F.col("__slow").isNotNull())
            .groupBy("session_id", "driver_id", "lap_number")
            .agg(F.min(F.col("t_ms") - F.col("__slow")).alias("acceleration_ms")))


# ------------------------------------------------------------------ from bronze tables
def laps_from_events(events: DataFrame, laid_out: bool = False) -> DataFrame:
    """Lap table from parsed race events: lap end time (epoch ms) from the
    LAP_COMPLETION record, lap time and compound from its payload, pit flag and stop
    time from PIT_STOP records of the same lap (pre-aggregated to the lap key)."""
    keys = ["session_id", "driver_id", "lap_number"]
    end_ms = F.unix_millis(F.col("event_ts_utc").try_cast("timestamp"))
    p = F.from_json("payload", "lap_time_ms BIGINT, compound STRING")
    events = distinct_events(events, laid_out)
    lap = (events.where(F.col("event_type") == "LAP_COMPLETION")
           .select(*keys, end_ms.alias("cum_ms"), p.alias("p"))
           .select(*keys, "cum_ms", F.col("p.lap_time_ms").alias("lap_time_ms"), F.col("p.compound").alias("tyre_compound")))
    pits = (events.where(F.col("event_type") == "PIT_STOP").groupBy(*keys)
            .agg(F.max("pit_duration_ms").alias("pit_duration_ms")))
    return (lap.join(pits, keys, "left")
               .withColumn("pit", F.col("pit_duration_ms").isNotNull()))


def samples_from_bronze(telemetry: DataFrame) -> DataFrame:
    """Sample rows from parsed bronze telemetry: epoch-ms sample time, channels as
    doubles with NaN turned to null (F7), the log offset as the duplicate order (first
    landed copy wins). A row is made once: conditions on it are not pushed down to the messages."""
    return made_once(telemetry.select(
        "session_id", "driver_id", "lap_number",
        F.unix_millis(F.col("timestamp_utc").try_cast("timestamp")).alias("t_ms"),
        null_safe_double("speed_kph").alias("speed_kph"), null_safe_double("throttle_pct").alias("throttle_pct"),
        null_safe_double("brake_pressure_bar").alias("brake"), "drs_state",
        null_safe_double("fuel_mass_kg").alias("fuel_mass_kg"), null_safe_double("battery_pct").alias("battery_pct"),
        "tyre_compound", F.col("offset").alias("copy_no")))


#: What laps and their facts read of a sample and of an event.
SAMPLE_COLUMNS = [*KEYS, "t_ms", "speed_kph", "fuel_mass_kg", "battery_pct", "copy_no"]
EVENT_COLUMNS = [*KEYS, "lap_number", "event_id", "event_type", "event_ts_utc", "pit_duration_ms", "payload", "partition", "offset"]


def valid_samples(telemetry: DataFrame) -> DataFrame:
    """The valid samples of parsed telemetry, with the columns that lap facts read."""
    return split_valid(samples_from_bronze(telemetry))[0].select(*SAMPLE_COLUMNS)


def facts_of(samples: DataFrame, laps: DataFrame, events: DataFrame) -> DataFrame:
    """A12 from clean samples, the lap table and parsed events, all of them lying by (session, driver) alike: as-of lap match
    on the event-time clock, lap facts with payload times."""
    joined_as_laid_out(samples.sparkSession)
    m = asof_forward_join(samples, laps, carry=["tyre_compound"], laid_out=True) \
        .drop("lap_number", "tyre_compound") \
        .withColumnRenamed("asof_lap_number", "lap_number").withColumnRenamed("asof_tyre_compound", "tyre_compound")
    return fact_lap(m, events, compound_per_lap=True, laid_out=True)


def gold_fact_lap(telemetry_parsed: DataFrame, events_parsed: DataFrame) -> DataFrame:
    """A12 end to end from bronze: cleaned, deduplicated samples matched with the laps of the events. Rows are dealt by
    (session, driver) once, with the columns that facts read."""
    samples, events = valid_samples(telemetry_parsed).repartition(*KEYS), made_once(events_parsed.select(*EVENT_COLUMNS)).repartition(*KEYS)
    return facts_of(deduplicate(samples, [*KEYS, "t_ms"], "copy_no"), laps_from_events(events, laid_out=True), events)


# ------------------------------------------------------------------ interval join (J5 periods)
def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], t_col: str, start: str, end: str,
                  carry: list[str], bucket: int, how: str = "left") -> DataFrame:
    """Attach to each point the intervals ``[start, end)`` containing it (e.g. safety
    car periods of the session). Intervals are replicated into the ``bucket``-wide
    slots they overlap and equi-joined with points on (keys, slot) plus the range
    residual, so no point is compared with intervals far from it. Each interval yields
    span / ``bucket`` rows: choose ``bucket`` near the typical interval length."""
    rk = {k: "__ik_" + k for k in keys}
    iv = (intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) < F.col(end)))
          .select(*[F.col(k).alias(v) for k, v in rk.items()], F.col(start).alias("__s"), F.col(end).alias("__e"),
                  *[F.col(c) for c in carry])
          .withColumn("__slot", F.explode(F.sequence(F.floor(F.col("__s") / bucket),
                                                     F.floor((F.col("__e") - 1) / bucket)))))
    p = points.withColumn("__pslot", F.floor(F.col(t_col) / bucket))
    cond = [F.col(k) == F.col(v) for k, v in rk.items()]
    cond += [F.col("__pslot") == F.col("__slot"), F.col(t_col) >= F.col("__s"), F.col(t_col) < F.col("__e")]
    return p.join(iv, cond, how).select(*[F.col(c) for c in points.columns], *[F.col(c) for c in carry])


def select_laps(df: DataFrame, sessions: DataFrame | None = None, year: int | None = None, event: str | None = None,
                session: str | None = None, driver: str | None = None) -> DataFrame:
    """S9 + P13 + F13: source selection on a laps/telemetry table joined to a session
    dimension (session_id, year, round, event_name, session_name): by year, by event
    (round number when numeric, else case-insensitive name substring), by session name
    and by driver. Filters on partition columns prune partitions at the scan."""
    from kerbside.functions.scalars import event_matches
    out = df
    if sessions is not None and (year is not None or event is not None or session is not None):
        s = sessions
        if year is not None:
            s = s.where(F.col("year") == year)
        if event is not None:
            s = s.where(event_matches("round", "event_name", event))
        if session is not None:
            s = s.where(F.lower("session_name") == session.lower())
        out = out.join(s.select("session_id"), "session_id", "left_semi")
    if driver is not None:
        out = out.where(F.col("driver_id") == driver)
    return out
