"""Driver interaction graph.

Close pairs are found in one pass over the cars of a lap in race order, as race order itself
is: a range window of ``gap_ms`` holds the cars close behind a car. Only pairs within the gap
are ever formed -- never all pairs of a lap -- and the key (session, lap) has high cardinality,
so no single task receives a whole session.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.laps import dealt
from kerbside.session import checkpoint_dir, joins_in_place, reliable_checkpoint

_LOG = logging.getLogger(__name__)

# Fixed values (design doc): proximity threshold and battle length.
GAP_MS = 1000
BATTLE_MIN_LAPS = 3
DRS_OPEN_STATES = ["10", "12", "14"]  # [ours] DRS channel values meaning "flap open"
UNDERCUT_LAPS = 2
DAMPING = 0.85
PAGERANK_ITERATIONS = 10


def close_pairs(pos: DataFrame, gap_ms: int = GAP_MS, parts: int | None = None) -> DataFrame:
    """J6 as a band join: (session, lap, car ahead, car behind) with
    ``0 <= race_ms(behind) - race_ms(ahead) < gap_ms``.

    ``pos`` needs session_id, lap_number, driver_id, race_ms, position, next_position; ``parts``: dealt to so many partitions.
    """
    cars = pos.where("session_id IS NOT NULL AND lap_number IS NOT NULL AND race_ms IS NOT NULL").select(
        "session_id", "lap_number", "driver_id", "race_ms", "position", "next_position")
    close = Window.partitionBy("session_id", "lap_number").orderBy("race_ms").rangeBetween(0, gap_ms)
    x = dealt(cars, parts, "session_id", "lap_number").withColumn("__behind", F.collect_list(F.struct(
        F.col("driver_id").alias("id"), F.col("race_ms").alias("ms"), F.col("position").alias("pos"),
        F.col("next_position").alias("next_pos"))).over(close))
    gap = F.col("b.ms") - F.col("race_ms")
    return (x.where(F.size("__behind") > 1).withColumn("b", F.explode("__behind"))
            .where((F.col("position") < F.col("b.pos")) & (gap < gap_ms)).select(
        "session_id", "lap_number", F.col("driver_id").alias("ahead_id"), F.col("b.id").alias("behind_id"),
        F.col("position").alias("ahead_pos"), F.col("b.pos").alias("behind_pos"), gap.alias("gap_ms"),
        F.col("next_position").alias("ahead_next_pos"), F.col("b.next_pos").alias("behind_next_pos")))


def overtakes(pairs: DataFrame) -> DataFrame:
    """G1: the car behind (within the gap on lap L-1) is ahead on lap L."""
    return pairs.where(F.col("behind_next_pos") < F.col("ahead_next_pos")).select(
        "session_id", (F.col("lap_number") + 1).alias("lap_number"),
        F.col("behind_id").alias("passer_id"), F.col("ahead_id").alias("passed_id"),
        F.col("gap_ms").alias("delta_time_ms"))


def battles(pairs: DataFrame, min_laps: int = BATTLE_MIN_LAPS, parts: int | None = None) -> DataFrame:
    """G2 + G3: runs of >= ``min_laps`` consecutive laps in which the same two cars are
    within the gap (gaps-and-islands per unordered pair), with interaction strength
    ``lap_count * (1 - avg_gap_ms / 1000)`` [ours]. ``parts``: pairs are dealt to so many partitions."""
    x = pairs.select("session_id", "lap_number", F.least("ahead_id", "behind_id").alias("driver_a"),
                     F.greatest("ahead_id", "behind_id").alias("driver_b"), "gap_ms")
    x = dealt(x, parts, "session_id", "driver_a", "driver_b")
    w = Window.partitionBy("session_id", "driver_a", "driver_b").orderBy("lap_number")
    x = x.withColumn("__grp", F.col("lap_number") - F.row_number().over(w))
    g = x.groupBy("session_id", "driver_a", "driver_b", "__grp").agg(
        F.min("lap_number").alias("start_lap"), F.max("lap_number").alias("end_lap"),
        F.count(F.lit(1)).alias("lap_count"), F.avg("gap_ms").alias("avg_gap_ms"))
    return g.where(F.col("lap_count") >= min_laps).select(
        "session_id", "driver_a", "driver_b", "start_lap", "end_lap", "lap_count", "avg_gap_ms",
        (F.col("lap_count") * (F.lit(1) - F.col("avg_gap_ms") / 1000.0)).alias("interaction_strength"))


def tag_overtakes(ovt: DataFrame, laps: DataFrame, samples: DataFrame) -> DataFrame:
    """G4 [ours]: UNDERCUT when either car pitted within the two laps before the pass
    (or on it); else DRS when the passer had the flap open in the lap; else BRAKING."""
    pit_window = (laps.where(F.col("pit"))
                  .select("session_id", "driver_id",
                          F.explode(F.sequence(F.col("lap_number"), F.col("lap_number") + UNDERCUT_LAPS))
                          .alias("lap_number"))
                  .distinct().withColumn("__pit", F.lit(True)))
    drs = (samples.where(F.col("drs_state").isin(DRS_OPEN_STATES))
           .select("session_id", "driver_id", "lap_number").distinct().withColumn("__drs", F.lit(True)))
    x = (ovt.join(pit_window.withColumnRenamed("driver_id", "passer_id").withColumnRenamed("__pit", "__p1"),
                  ["session_id", "passer_id", "lap_number"], "left")
            .join(pit_window.withColumnRenamed("driver_id", "passed_id").withColumnRenamed("__pit", "__p2"),
                  ["session_id", "passed_id", "lap_number"], "left")
            .join(drs.withColumnRenamed("driver_id", "passer_id"), ["session_id", "passer_id", "lap_number"], "left"))
    tag = (F.when(F.coalesce("__p1", "__p2", F.lit(False)), "UNDERCUT")
           .when(F.coalesce("__drs", F.lit(False)), "DRS").otherwise("BRAKING"))
    return x.select(*ovt.columns, tag.alias("overtake_type"))


def pattern_close_alongside_ahead(pairs: DataFrame, alongside_ms: int = 200) -> DataFrame:
    """G13 [ours]: for a pair, lap L close (< 1 s), lap L+1 alongside (< ``alongside_ms``
    with the same car still ahead), lap L+2 the former car behind is ahead. Matched
    with ``lead`` over the pair's laps; groups are one pair's laps."""
    x = pairs.select("session_id", "lap_number", "ahead_id", "behind_id", "gap_ms", "behind_next_pos",
                     "ahead_next_pos")
    w = Window.partitionBy("session_id", "ahead_id", "behind_id").orderBy("lap_number")
    x = (x.withColumn("__next_lap", F.lead("lap_number").over(w))
          .withColumn("__next_gap", F.lead("gap_ms").over(w))
          .withColumn("__next_pass", F.lead(F.col("behind_next_pos") < F.col("ahead_next_pos")).over(w)))
    return x.where((F.col("__next_lap") == F.col("lap_number") + 1) & (F.col("__next_gap") < alongside_ms)
                   & F.col("__next_pass")).select(
        "session_id", F.col("lap_number").alias("close_lap"), F.col("behind_id").alias("passer_id"),
        F.col("ahead_id").alias("passed_id"), F.col("gap_ms").alias("close_gap_ms"),
        F.col("__next_gap").alias("alongside_gap_ms"))


# ------------------------------------------------------------------ node / edge tables
def nodes_and_edges(laps: DataFrame, pos: DataFrame, ovt: DataFrame, btl: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node table (id, label and properties: a driver's team, a session's and a team's number
    of drivers, a lap's number, time and compound) and edge table (src, dst, rel, session_id,
    lap_number, weight, and a battle's mean gap). ``laps`` needs team_id; ``pos`` the race order."""
    drivers = laps.groupBy("driver_id").agg(F.min("team_id").alias("team_id"))
    sessions = laps.select("session_id", "driver_id").distinct().groupBy(F.col("session_id").alias("id")).agg(
        F.count(F.lit(1)).alias("drivers"))
    teams = drivers.groupBy(F.col("team_id").alias("id")).agg(F.count(F.lit(1)).alias("drivers"))
    nodes = (drivers.select(F.col("driver_id").alias("id"), F.lit("Driver").alias("label"), "team_id")
             .unionByName(sessions.withColumn("label", F.lit("Session")), allowMissingColumns=True)
             .unionByName(teams.withColumn("label", F.lit("Team")), allowMissingColumns=True)
             .unionByName(laps.select(F.concat_ws("/", "session_id", "driver_id", F.col("lap_number").cast("string"))
                                      .alias("id"), F.lit("Lap").alias("label"), F.col("lap_number").cast("int"),
                                      "lap_time_ms", "tyre_compound"), allowMissingColumns=True))
    lap_id = lambda lap: F.concat_ws("/", "session_id", "driver_id", lap.cast("string"))
    e_drove = laps.select("driver_id", "session_id").distinct().select(
        F.col("driver_id").alias("src"), F.col("session_id").alias("dst"), F.lit("DROVE_IN").alias("rel"),
        "session_id", F.lit(None).cast("int").alias("lap_number"), F.lit(1.0).alias("weight"))
    e_races = drivers.select(F.col("driver_id").alias("src"), F.col("team_id").alias("dst"),
                             F.lit("RACES_FOR").alias("rel"), F.lit(None).cast("string").alias("session_id"),
                             F.lit(None).cast("int").alias("lap_number"), F.lit(1.0).alias("weight"))
    e_ovt = ovt.select(F.col("passer_id").alias("src"), F.col("passed_id").alias("dst"), F.lit("OVERTOOK").alias("rel"),
                       "session_id", F.col("lap_number").cast("int"), F.col("delta_time_ms").cast("double").alias("weight"))
    e_btl = btl.select(F.col("driver_a").alias("src"), F.col("driver_b").alias("dst"), F.lit("BATTLED").alias("rel"),
                       "session_id", F.col("start_lap").cast("int").alias("lap_number"),
                       F.col("lap_count").cast("double").alias("weight"), "avg_gap_ms")
    e_next = pos.where(F.col("next_lap_number").isNotNull()).select(
        lap_id(F.col("lap_number")).alias("src"), lap_id(F.col("next_lap_number")).alias("dst"),
        F.lit("NEXT").alias("rel"), "session_id", F.col("lap_number").cast("int"), F.lit(1.0).alias("weight"))
    e_done = laps.select(lap_id(F.col("lap_number")).alias("src"), F.col("driver_id").alias("dst"),
                         F.lit("COMPLETED_BY").alias("rel"), "session_id", F.col("lap_number").cast("int"),
                         F.lit(1.0).alias("weight"))
    edges = e_drove.withColumn("avg_gap_ms", F.lit(None).cast("double"))
    for more in (e_races, e_ovt, e_btl, e_next, e_done):
        edges = edges.unionByName(more, allowMissingColumns=True)
    return nodes, edges


def last_n_laps(df: DataFrame, laps: DataFrame, n: int = 50) -> DataFrame:
    """Rows from the last ``n`` laps of each session. The session's last lap comes from
    its laps (not from ``df``, which may end earlier), as an aggregate joined back."""
    last = laps.groupBy("session_id").agg(F.max("lap_number").alias("__last"))
    return df.join(last, "session_id").where(F.col("lap_number") > F.col("__last") - n).drop("__last")


# ------------------------------------------------------------------ metrics
def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int = PAGERANK_ITERATIONS,
             damping: float = DAMPING, checkpoint_every: int = 5, parts: int | None = None) -> DataFrame:
    """Weighted PageRank per session with a fixed iteration count.

    ``nodes``: (session_id, node); ``edges``: (session_id, src, dst, weight). Dangling
    mass is spread evenly over the session's nodes.

    The transition table is built once and checkpointed: every node gets a zero-weight
    self edge (so it appears in every iteration's output) and every dangling node one
    edge to a per-session sink row. An iteration is then ONE join of the ranks with that
    table keyed by (session, src), ONE aggregate keyed by (session, dst), and a window
    sum over the session's rows (bounded by the drivers of a session) that spreads the
    sink's mass -- the ranks are referenced once, so the plan grows linearly. Nodes and
    edges are dealt by session once, to ``parts`` partitions, and no iteration shuffles:
    rank moves inside a session only. Lineage is cut with a reliable ``checkpoint()`` into
    ``spark.checkpoint.dir``.
    """
    with joins_in_place(nodes.sparkSession):
        trans, ranks = _transitions(nodes, edges, parts)
        for it in range(iterations):
            ranks = _round(trans, ranks, damping)
            if it + 1 == iterations or checkpoint_every and (it + 1) % checkpoint_every == 0:
                ranks = reliable_checkpoint(ranks)
    return ranks.select("session_id", "node", "rank")


_SINK = "\u0000sink"


def _by_session(df: DataFrame, parts: int | None) -> DataFrame:
    return df.repartition(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "session_id")


def _transitions(nodes: DataFrame, edges: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The checkpointed transition table of ``pagerank`` and the even ranks (session_id, node, rank), both dealt by session."""
    checkpoint_dir(nodes.sparkSession)
    nodes = reliable_checkpoint(_by_session(nodes.select("session_id", "node").distinct(), parts))
    n = nodes.groupBy("session_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    e = _by_session(edges, parts).groupBy("session_id", "src", "dst").agg(F.sum("weight").alias("w"))
    out_w = e.groupBy("session_id", "src").agg(F.sum("w").alias("out_w"))
    moves = e.join(out_w, ["session_id", "src"]).select(
        "session_id", "src", "dst", (F.col("w") / F.col("out_w")).alias("p"))
    selfs = nodes.select("session_id", F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("p"))
    dangling = (nodes.join(out_w.select("session_id", F.col("src").alias("node")), ["session_id", "node"], "left_anti")
                .select("session_id", F.col("node").alias("src"), F.lit(_SINK).alias("dst"), F.lit(1.0).alias("p")))
    # sorted as the rounds' joins need it
    trans = _by_session(moves.unionByName(selfs).unionByName(dangling), parts).join(n, "session_id")
    trans = reliable_checkpoint(trans.sortWithinPartitions("session_id", "src"))
    return trans, nodes.join(n, "session_id").select("session_id", "node", (F.lit(1.0) / F.col("n")).alias("rank"))


def _round(trans: DataFrame, ranks: DataFrame, damping: float) -> DataFrame:
    """The ranks (session_id, node, rank) after one more round, and each node's rank before it (``was``)."""
    per_session = Window.partitionBy("session_id")
    contrib = (trans.join(ranks.select("session_id", F.col("node").alias("src"), "rank"), ["session_id", "src"])
               .groupBy("session_id", "dst").agg(F.sum(F.col("rank") * F.col("p")).alias("c"), F.first("n").alias("n"),
                                                 F.max(F.when(F.col("src") == F.col("dst"), F.col("rank"))).alias("was")))
    mass = F.sum(F.when(F.col("dst") == _SINK, F.col("c")).otherwise(0.0)).over(per_session)
    return (contrib.withColumn("__d", mass).where(F.col("dst") != _SINK)
            .select("session_id", F.col("dst").alias("node"),
                    ((F.lit(1 - damping) / F.col("n"))
                     + F.lit(damping) * (F.col("c") + F.col("__d") / F.col("n"))).alias("rank"), "was"))


def pagerank_until(nodes: DataFrame, edges: DataFrame, former: DataFrame | None = None, tolerance: float = 1e-6,
                   most_rounds: int = 200, damping: float = DAMPING, every: int = 5,
                   parts: int | None = None) -> tuple[DataFrame, int]:
    """G6 + G7: PageRank from ``former`` ranks (session_id, node, rank; those of an earlier graph of the sessions, say the one
    before the latest laps) until no rank moves by more than ``tolerance`` in a round; the ranks and the rounds taken.

    Nodes that ``former`` lacks begin with the even share, nodes that are gone are left out, and a session's ranks are
    scaled to one. Rows are dealt by session once, as in ``pagerank``. Ranks are cut with a reliable checkpoint every ``every``
    rounds, and only there the largest move, one number, is asked for. The fixed point does not depend on the start; a start
    near it saves rounds."""
    with joins_in_place(nodes.sparkSession):
        trans, ranks = _transitions(nodes, edges, parts)
        if former is not None:
            had = _by_session(former, parts).groupBy("session_id", "node").agg(F.max("rank").alias("had"))
            both = ranks.join(had, ["session_id", "node"], "left").withColumn("start", F.coalesce("had", "rank"))
            total = F.sum("start").over(Window.partitionBy("session_id"))
            ranks = reliable_checkpoint(both.select("session_id", "node", (F.col("start") / total).alias("rank")))
        for done in range(every, most_rounds + every, every):
            for _ in range(every):
                ranks = _round(trans, ranks, damping)
            ranks = reliable_checkpoint(ranks)
            moved = ranks.agg(F.max(F.abs(F.col("rank") - F.col("was")))).first()[0]
            if moved is None or moved <= tolerance:
                _LOG.info("ranks moved by %s after %d rounds", moved, done)
                return ranks.select("session_id", "node", "rank"), done
    raise RuntimeError(f"ranks still move by {moved} after {most_rounds} rounds")


def interaction_edges(ovt: DataFrame, btl: DataFrame) -> DataFrame:
    """Directed interactions of a session with comparable weights: an overtake counts 1, from the
    passer to the car passed; a battle has no direction, so it counts its interaction strength
    both ways."""
    passes = ovt.select("session_id", F.col("passer_id").alias("src"), F.col("passed_id").alias("dst"),
                        F.lit(1.0).alias("weight"))
    ends = F.explode(F.array(F.struct(F.col("driver_a").alias("src"), F.col("driver_b").alias("dst")),
                             F.struct(F.col("driver_b").alias("src"), F.col("driver_a").alias("dst"))))
    fights = btl.select("session_id", "interaction_strength", ends.alias("e")).select(
        "session_id", "e.src", "e.dst", F.col("interaction_strength").cast("double").alias("weight"))
    return passes.unionByName(fights)


def weighted_degree(edges: DataFrame) -> DataFrame:
    """in/out weighted degree per (session, node): each edge gives a row to either end, and
    one aggregate sums them."""
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.col("weight").alias("o"), F.lit(0.0).alias("i")),
        F.struct(F.col("dst").alias("node"), F.lit(0.0).alias("o"), F.col("weight").alias("i"))))
    return edges.select("session_id", ends.alias("e")).groupBy("session_id", F.col("e.node").alias("node")).agg(
        F.sum("e.o").alias("out_degree"), F.sum("e.i").alias("in_degree"))


def driver_interactions(ovt: DataFrame, btl: DataFrame, pairs: DataFrame) -> DataFrame:
    """G9-G11 per (session, driver): overtakes made/received, influence
    ``(made - received) / (made + received)``, success rate = passes / laps spent within
    the gap behind another car, and average battle duration [ours]. One union of narrow
    counter rows and one aggregate, without joins."""
    none = F.lit(0).cast("bigint")

    def rows(df, driver, **counts):
        return df.select("session_id", F.col(driver).alias("driver_id"),
                         *[counts.get(c, none).cast("bigint").alias(c) for c in "mrabd"])

    one = F.lit(1)
    x = (rows(ovt, "passer_id", m=one).unionByName(rows(ovt, "passed_id", r=one))
         .unionByName(rows(pairs, "behind_id", a=one))
         .unionByName(rows(btl, "driver_a", b=one, d=F.col("lap_count")))
         .unionByName(rows(btl, "driver_b", b=one, d=F.col("lap_count")))
         .groupBy("session_id", "driver_id").agg(*[F.sum(c).alias(c) for c in "mrabd"]))
    m, r, a, b = F.col("m"), F.col("r"), F.col("a"), F.col("b")
    return x.select(
        "session_id", "driver_id", m.alias("overtakes_made"), r.alias("overtakes_received"), a.alias("attempts"),
        F.when(m + r > 0, (m - r) / (m + r)).alias("influence_score"),
        F.when(a > 0, m / a).alias("overtake_success_rate"),
        b.alias("battles"), F.when(b > 0, F.col("d") / b).alias("avg_battle_duration"))


# ------------------------------------------------------------------ rivalry communities
def rivalry_links(btl: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Drivers of a session whose sets of battle opponents have Jaccard similarity of at least
    ``threshold``, exactly: drivers meet over an opponent they share (an inverted index keyed by
    session and opponent), the meetings count the intersection, set sizes give the union."""
    sides = F.explode(F.array(F.struct(F.col("driver_a").alias("driver_id"), F.col("driver_b").alias("opponent")),
                              F.struct(F.col("driver_b").alias("driver_id"), F.col("driver_a").alias("opponent"))))
    both = btl.select("session_id", sides.alias("s")).select("session_id", "s.driver_id", "s.opponent").distinct()
    size = both.groupBy("session_id", "driver_id").agg(F.count(F.lit(1)).alias("n"))
    left = both.select("session_id", "opponent", F.col("driver_id").alias("src"))
    right = both.select("session_id", "opponent", F.col("driver_id").alias("dst"))
    common = (left.join(right, ["session_id", "opponent"]).where(F.col("src") < F.col("dst"))
              .groupBy("session_id", "src", "dst").agg(F.count(F.lit(1)).alias("c")))
    x = (common.join(size.withColumnRenamed("driver_id", "src").withColumnRenamed("n", "n1"), ["session_id", "src"])
         .join(size.withColumnRenamed("driver_id", "dst").withColumnRenamed("n", "n2"), ["session_id", "dst"]))
    jaccard = F.col("c") / (F.col("n1") + F.col("n2") - F.col("c"))
    return x.withColumn("jaccard", jaccard).where(F.col("jaccard") >= threshold).select(
        "session_id", "src", "dst", "jaccard")


def rivalry_communities(btl: DataFrame, threshold: float = 0.5, parts: int | None = None) -> DataFrame:
    """G12 [ours]: communities of rivals per session: connected components of ``rivalry_links``,
    named by their smallest driver; drivers without a battle are in none. Smallest labels travel
    along links until none changes, which takes as many rounds as the longest chain of a
    session's drivers; lineage is cut with ``checkpoint()`` every round. Battles are dealt by session
    once, to ``parts`` partitions; links and rounds, which stay in a session, shuffle nothing."""
    checkpoint_dir(btl.sparkSession)
    with joins_in_place(btl.sparkSession):
        btl = reliable_checkpoint(_by_session(btl.select("session_id", "driver_a", "driver_b").distinct(), parts))
        links = rivalry_links(btl, threshold)
        links = reliable_checkpoint(_by_session(links.select("session_id", "src", "dst").unionByName(
            links.select("session_id", F.col("dst").alias("src"), F.col("src").alias("dst"))), parts))
        ends = btl.select("session_id", F.explode(F.array("driver_a", "driver_b")).alias("driver_id")).distinct()
        labels = reliable_checkpoint(ends.withColumn("community", F.col("driver_id")))
        while True:
            proposals = (links.join(labels.withColumnRenamed("driver_id", "src"), ["session_id", "src"])
                         .groupBy("session_id", F.col("dst").alias("driver_id")).agg(F.min("community").alias("cand")))
            moved = reliable_checkpoint(labels.join(proposals, ["session_id", "driver_id"], "left").select(
                "session_id", "driver_id", F.least("community", F.coalesce("cand", "community")).alias("community"),
                (F.col("cand") < F.col("community")).alias("changed")))
            labels = moved.drop("changed")
            if moved.where("changed").isEmpty():
                return labels


def lsh_links(btl: DataFrame, threshold: float = 0.5, tables: int = 24, features: int = 1 << 18) -> DataFrame:
    """``rivalry_links`` by min-hash LSH: a driver's opponents become a binary vector, two drivers are candidates when one of
    ``tables`` min-hash values agrees (a pair at the threshold is missed with a chance of (1 - threshold)^tables, 6e-8),
    and candidates are verified on their whole sets. Drivers of different sessions have no element in common, as the
    session is part of it."""
    from pyspark.ml.feature import HashingTF, MinHashLSH
    from pyspark.ml.functions import vector_to_array

    both = (btl.select("session_id", F.col("driver_a").alias("driver_id"), F.col("driver_b").alias("opponent"))
            .unionByName(btl.select("session_id", F.col("driver_b").alias("driver_id"), F.col("driver_a").alias("opponent"))))
    sets = both.groupBy("session_id", "driver_id").agg(F.collect_set("opponent").alias("opponents"))
    sets = sets.withColumn("items", F.transform("opponents", lambda o: F.concat_ws("\u0001", "session_id", o)))
    vectors = reliable_checkpoint(HashingTF(inputCol="items", outputCol="vector", binary=True, numFeatures=features).transform(sets).drop("items"))
    if vectors.isEmpty():
        return vectors.select("session_id", F.col("driver_id").alias("src"), F.col("driver_id").alias("dst"), F.lit(1.0).alias("jaccard"))
    model = MinHashLSH(inputCol="vector", outputCol="hashes", numHashTables=tables, seed=7).fit(vectors)
    hashed = model.transform(vectors).select("session_id", "driver_id", "opponents", F.posexplode("hashes").alias("table", "h"))
    hashed = hashed.withColumn("value", vector_to_array("h")[0])
    left = hashed.select("session_id", "table", "value", F.col("driver_id").alias("src"), F.col("opponents").alias("__a"))
    right = hashed.select("session_id", "table", "value", F.col("driver_id").alias("dst"), F.col("opponents").alias("__b"))
    pairs = left.join(right, ["session_id", "table", "value"]).where(F.col("src") < F.col("dst"))
    one = pairs.groupBy("session_id", "src", "dst").agg(F.first("__a").alias("__a"), F.first("__b").alias("__b"))
    jaccard = F.size(F.array_intersect("__a", "__b")) / F.size(F.array_union("__a", "__b"))
    return one.withColumn("jaccard", jaccard).where(F.col("jaccard") >= threshold).select("session_id", "src", "dst", "jaccard")


def contracted_components(links: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """Connected components in a number of rounds that grows with the logarithm of the nodes, and that number.

    ``links`` (src, dst) without direction, ``nodes`` (node). In a round every node chooses, among itself and its neighbours,
    the one whose hash of that round is smallest, and then that one's choice; the chosen nodes and the links between
    them are the next round's graph. A chain shrinks to about a third, whatever the order of its names. When no link is
    left, the choices are put together backwards and every component takes the name of its smallest node."""
    checkpoint_dir(links.sparkSession)
    both = links.select("src", "dst").unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    edges = reliable_checkpoint(both.where("src <> dst").distinct())
    choices: list[DataFrame] = []
    while not edges.isEmpty():
        rank = lambda c: F.xxhash64(F.lit(len(choices)), c)  # noqa: B023, E731
        own = edges.select("src").distinct().select(F.col("src").alias("node"), F.col("src").alias("seen"))
        near = own.unionByName(edges.select(F.col("src").alias("node"), F.col("dst").alias("seen")))
        first = near.groupBy("node").agg(F.min_by("seen", F.struct(rank(F.col("seen")), F.col("seen"))).alias("choice"))
        first = reliable_checkpoint(first)
        then = first.select(F.col("node").alias("choice"), F.col("choice").alias("rep"))
        choice = reliable_checkpoint(first.join(then, "choice").select("node", "rep"))
        a, b = (choice.select(F.col("node").alias(end), F.col("rep").alias("to_" + end)) for end in ("src", "dst"))
        edges = reliable_checkpoint(edges.join(a, "src").join(b, "dst").select(F.col("to_src").alias("src"), F.col("to_dst").alias("dst"))
                                    .where("src <> dst").distinct())
        choices.append(choice)
    root = nodes.select("node", F.col("node").alias("rep"))
    for choice in choices:
        onward = choice.select(F.col("node").alias("rep"), F.col("rep").alias("__next"))
        root = root.join(onward, "rep", "left").select("node", F.coalesce("__next", "rep").alias("rep"))
    name = root.groupBy("rep").agg(F.min("node").alias("component"))
    return root.join(name, "rep").select("node", "component"), len(choices)


def lsh_communities(btl: DataFrame, threshold: float = 0.5) -> DataFrame:
    """G12 by min-hash LSH and contraction: the communities of ``rivalry_communities``."""
    node = lambda d: F.struct("session_id", F.col(d).alias("driver_id"))
    links = lsh_links(btl, threshold).select(node("src").alias("src"), node("dst").alias("dst"))
    ends = btl.select("session_id", F.explode(F.array("driver_a", "driver_b")).alias("driver_id")).distinct()
    found, _ = contracted_components(links, ends.select(node("driver_id").alias("node")))
    return found.select("node.session_id", "node.driver_id", F.col("component.driver_id").alias("community"))
