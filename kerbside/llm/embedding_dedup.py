"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors of one direction (equal when scaled to length 1) are one class. Centroids are fitted on a bounded sample; every class goes to its nearest
clusters, so that clusters overlap. In each shard a flat graph is built: of a vector's nearest candidates
robust pruning keeps those that no kept one is much closer to. The adjacency lists of all shards are united.
On the united graph every vector is searched in each of its shards, from the shard's medoid: a greedy beam
search finds the way to it, then the search expands through every vector within the range. What is found is
verified by cosine in double precision. Recall is audited on a sample of vectors against all others, as a mean
over vectors, apart for those with few links and with many; below the target, the join is repeated with wider
beams, degrees and overlap, and if the widest one misses it too, all vectors are compared in blocks.

Shards beyond a bounded size are dealt into pairs of blocks. A link is counted in the first shard that its
two ends share, and a shard gives out only counts and a spanning forest, so no pairs are written.

Definitions: see ``vectors.usable`` for rows that link with nothing; they are their own component with no
links. Vectors are scaled by their largest component before anything is squared, so very large and very small
ones compare like others. Similarity equal to the threshold links. Every input row gives one row; rows that share an id get the
same result. A null id is its own component. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import by_group, stored
from kerbside.llm.components import connected
from kerbside.llm.jaccard_join import Forest, in_blocks
from kerbside.llm.vectors import bounded_sample, matrix, usable

THRESHOLD = 0.9
#: Vectors that the centroids are fitted on, vectors per shard aimed at, and the most shards.
SAMPLE, SHARD_ROWS, MOST_SHARDS = 8192, 1000, 512
#: Vectors of a block; two blocks meet in a task.
BLOCK = 1500
#: Clusters that a vector goes to, candidates and degree of its list, and width of the beam.
OVERLAP, CANDIDATES, DEGREE, BEAM = 3, 48, 24, 16
ALPHA = 1.2
#: Audited vectors, and the recall below which the join is repeated wider.
AUDIT, TARGET_RECALL = 256, 0.995
#: Of so many times AUDIT vectors all with at most FEW links are audited, so that large groups do not hide them.
AUDIT_FEW, FEW = 4, 16


def centroids(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def build(x: np.ndarray, candidates: int, degree: int) -> list[np.ndarray]:
    """Robust-pruned neighbours of each row of unit vectors, with the reverse links."""
    n = len(x)
    k = min(candidates, n - 1)
    lists: list[set[int]] = [set() for _ in range(n)]
    if k <= 0:
        return [np.zeros(0, np.int64)] * n
    small = x.astype(np.float32)
    for at in range(0, n, 512):
        s = small[at:at + 512] @ small.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable"), 1)
        for r, row in enumerate(near):
            far = np.maximum(1.0 - s[r, row], 0.0)
            between = 1.0 - small[row] @ small[row].T
            alive = np.ones(k, bool)
            kept = 0
            for j in range(k):
                if alive[j]:
                    lists[at + r].add(int(row[j]))
                    kept += 1
                    if kept == degree:
                        break
                    alive &= ALPHA * between[j] > far  # out: closer to the kept one than to the row
    back: list[set[int]] = [set(v) for v in lists]
    for i, v in enumerate(lists):
        for j in v:
            back[j].add(i)
    return [np.fromiter(sorted(v), np.int64, len(v)) for v in back]


def range_search(x: np.ndarray, adjacency: list[np.ndarray], threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of unit vectors with product >= threshold that searches from the medoid reach."""
    n = len(x)
    degree = np.array([len(a) for a in adjacency])
    begin = np.concatenate([[0], np.cumsum(degree)])
    flat = np.concatenate(adjacency) if n else np.zeros(0, np.int64)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    visited = np.zeros((n, n), bool)
    hits_q, hits_v = [], []

    def expand(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unvisited neighbours of v for query q, with their products."""
        d = degree[v]
        total = int(d.sum())
        qs = np.repeat(q, d)
        at = np.arange(total) - np.repeat(np.cumsum(d) - d, d) + np.repeat(begin[v], d)
        vs = flat[at]
        new = ~visited[qs, vs]
        codes = np.unique(qs[new] * n + vs[new])
        qs, vs = codes // n, codes % n
        visited[qs, vs] = True
        dots = np.empty(len(qs))
        for lo in range(0, len(qs), 100_000):
            dots[lo:lo + 100_000] = np.einsum("ij,ij->i", x[qs[lo:lo + 100_000]], x[vs[lo:lo + 100_000]])
        inside = dots >= threshold
        hits_q.append(qs[inside])
        hits_v.append(vs[inside])
        return qs, vs, dots

    everyone = np.arange(n)
    visited[:, medoid] = True
    ids = np.full((n, beam), -1)
    dots = np.full((n, beam), -np.inf)
    open_ = np.zeros((n, beam), bool)
    ids[:, 0], dots[:, 0], open_[:, 0] = medoid, x @ x[medoid], True
    inside = dots[:, 0] >= threshold
    hits_q.append(everyone[inside])
    hits_v.append(np.full(int(inside.sum()), medoid))
    done_q, done_v = [], []
    while True:
        best = np.where(open_, dots, -np.inf)
        at = best.argmax(axis=1)
        q = everyone[best[everyone, at] > -np.inf]
        if not len(q):
            break
        v = ids[q, at[q]]
        open_[q, at[q]] = False
        done_q.append(q)
        done_v.append(v)
        qs, vs, ps = expand(q, v)
        if not len(qs):
            continue
        # the best `beam` of old and new, by query
        rank = np.lexsort((-ps, qs))
        qs, vs, ps = qs[rank], vs[rank], ps[rank]
        first = np.searchsorted(qs, qs)
        nth = np.arange(len(qs)) - first
        keep = nth < beam
        qs, vs, ps, nth = qs[keep], vs[keep], ps[keep], nth[keep]
        rows = np.unique(qs)
        to = np.searchsorted(rows, qs)
        new_ids, new_dots = np.full((len(rows), beam), -1), np.full((len(rows), beam), -np.inf)
        new_ids[to, nth], new_dots[to, nth] = vs, ps
        all_ids = np.concatenate([ids[rows], new_ids], axis=1)
        all_dots = np.concatenate([dots[rows], new_dots], axis=1)
        all_open = np.concatenate([open_[rows], new_ids >= 0], axis=1)
        top = np.argsort(-all_dots, axis=1, kind="stable")[:, :beam]
        ids[rows], dots[rows] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_dots, top, 1)
        open_[rows] = np.take_along_axis(all_open, top, 1)
    # the range expands: every hit that has not been expanded yet
    expanded = set() if not done_q else np.unique(np.concatenate(done_q) * n + np.concatenate(done_v))
    spread = 0
    while spread < len(hits_q):
        codes = np.unique(np.concatenate(hits_q[spread:]) * n + np.concatenate(hits_v[spread:]))
        spread = len(hits_q)
        codes = codes[~np.isin(codes, expanded)]
        if not len(codes):
            break
        expanded = np.union1d(expanded, codes)
        for lo in range(0, len(codes), 50_000):
            part = codes[lo:lo + 50_000]
            expand(part // n, part % n)
    q, v = np.concatenate(hits_q), np.concatenate(hits_v)
    pairs = q != v
    low, high = np.minimum(q[pairs], v[pairs]), np.maximum(q[pairs], v[pairs])
    codes = np.unique(low * n + high)
    return codes // n, codes % n


def shard_build(cols: dict, candidates: int, degree: int) -> tuple:
    order = np.argsort(cols["id"])
    ids, x = cols["id"][order], matrix(cols["vec"][order])
    return [int(i) for i in ids], [[int(ids[j]) for j in v] for v in build(x, candidates, degree)]


def shard_search(cols: dict, threshold: float, beam: int) -> tuple | None:
    """Counts of links, and a spanning forest, that searches of a block pair find."""
    order = np.argsort(cols["id"])
    ids, x = cols["id"][order], matrix(cols["vec"][order])
    if len(ids) < 2:
        return None
    place = {int(i): k for k, i in enumerate(ids)}
    adjacency = [np.array([place[int(j)] for j in cols["near"][k] if int(j) in place], np.int64) for k in order]
    a, b = range_search(x, adjacency, threshold, beam)
    if not len(a):
        return None
    shard, own = int(cols["shard"][0]), cols["own"][order]
    homes = np.stack([np.asarray(s) for s in cols["shards"][order]])
    # the first shard that both ends share counts the link, in the one block pair that is theirs
    same = homes[a][:, :, None] == homes[b][:, None, :]
    common = np.where(same.any(axis=2), homes[a], np.iinfo(np.int32).max).min(axis=1)
    mine = (common == shard) & ((own[a] != own[b]) | (cols["first"][0] == cols["second"][0]))
    copies = cols["copies"][order]
    linked = np.zeros(len(ids), np.int64)
    np.add.at(linked, a[mine], copies[b[mine]])
    np.add.at(linked, b[mine], copies[a[mine]])
    forest = Forest(len(ids))
    start = np.searchsorted(b, np.arange(len(ids) + 1)) if (np.diff(b) >= 0).all() else None
    if start is None:
        rank = np.argsort(b, kind="stable")
        a, b = a[rank], b[rank]
        start = np.searchsorted(b, np.arange(len(ids) + 1))
    for i in range(len(ids)):
        if start[i] < start[i + 1]:
            forest.add(i, a[start[i]:start[i + 1]])
    to: list[list[int]] = [[] for _ in ids]
    for p, q in forest.links:
        to[q].append(int(ids[p]))
    return [int(i) for i in ids], [int(v) for v in linked], to


def attempt(classes: DataFrame, centres: np.ndarray, threshold: float, widen: int) -> tuple[DataFrame, DataFrame]:
    """Links' counts (id, linked) and forest (a, b) of one pass over all classes (id, copies, vec)."""
    overlap = min(OVERLAP * widen, len(centres))
    shared = classes.sparkSession.sparkContext.broadcast(centres)  # at most MOST_SHARDS rows

    def assign(frames):
        for frame in frames:
            if len(frame):
                near = np.argsort(-(matrix(frame["vec"]) @ shared.value.T), axis=1, kind="stable")[:, :overlap]
                yield frame.assign(shards=[np.sort(r).astype(np.int32) for r in near])

    homes = stored(classes.mapInPandas(assign, "id long, copies long, vec array<double>, shards array<int>"), "graph-homes")
    placed = homes.withColumn("shard", F.explode("shards"))
    sizes = stored(placed.groupBy("shard").count(), "graph-sizes")  # at most MOST_SHARDS rows
    dealt = in_blocks(placed.join(F.broadcast(sizes), "shard"), "count", "id", BLOCK)
    keys = ["shard", "first", "second"]
    lists = stored(by_group(dealt.select(*keys, "id", "vec"), keys,
                            lambda cols: shard_build(cols, CANDIDATES * widen, DEGREE * widen),
                            "id long, near array<long>"), "graph-lists")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    found = stored(by_group(dealt.join(united, "id").select(*keys, "own", "id", "copies", "vec", "shards", "near"), keys,
                            lambda cols: shard_search(cols, threshold, BEAM * widen),
                            "id long, linked long, to array<long>"), "graph-links")
    return (found.groupBy("id").agg(F.sum("linked").alias("linked")),
            found.select(F.explode("to").alias("a"), F.col("id").alias("b")))


def block_links(cols: dict, threshold: float) -> tuple | None:
    """Counts of links, and a spanning forest, of a block pair by comparing all."""
    order = np.argsort(cols["id"])
    ids, x, own, copies = cols["id"][order], matrix(cols["vec"][order]), cols["own"][order], cols["copies"][order]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    near |= near.T
    every = near
    if cols["first"][0] != cols["second"][0]:
        near = near & (own[:, None] != own[None, :])
    if not near.any():
        return None
    forest = Forest(len(ids))
    for i in range(1, len(ids)):
        before = np.flatnonzero(every[i, :i])
        if len(before):
            forest.add(i, before)
    to: list[list[int]] = [[] for _ in ids]
    for p, q in forest.links:
        to[q].append(int(ids[p]))
    return [int(i) for i in ids], [int(v) for v in near @ copies], to


def compare_all(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links' counts (id, linked) and forest (a, b) of all classes by comparing every block with every other."""
    dealt = in_blocks(classes.withColumn("count", F.lit(classes.count())), "count", "id", BLOCK)
    found = stored(by_group(dealt.select("first", "second", "own", "id", "copies", "vec"), ["first", "second"],
                            lambda cols: block_links(cols, threshold), "id long, linked long, to array<long>"), "graph-exact")
    return (found.groupBy("id").agg(F.sum("linked").alias("linked")),
            found.select(F.explode("to").alias("a"), F.col("id").alias("b")))


def audit(classes: DataFrame, counts: DataFrame, threshold: float, most: int = AUDIT) -> float:
    """Mean share of a class's links, by brute force against all, that were found: of a bounded sample of classes,
    the smaller mean of those with few links and those with many."""
    ids, x = bounded_sample(classes, AUDIT_FEW * most)
    if not len(ids):
        return 1.0
    shared = classes.sparkSession.sparkContext.broadcast((ids, x))

    def count(frames):
        import pandas as pd
        asked, q = shared.value
        total = np.zeros(len(asked), np.int64)
        for frame in frames:
            if len(frame):
                near = q @ matrix(frame["vec"]).T >= threshold
                near &= asked[:, None] != frame["id"].to_numpy()[None, :]
                total += near @ frame["copies"].to_numpy()
        yield pd.DataFrame({"id": asked, "true": total})

    true = classes.mapInPandas(count, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    means = (true.join(counts, "id", "left").where(F.col("true") > 0).groupBy(F.col("true") <= FEW)
             .agg(F.avg(F.least("true", F.coalesce("linked", F.lit(0))) / F.col("true")).alias("recall")).collect())
    return min((r["recall"] for r in means), default=1.0)


def dedup(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept, and the class (smallest id of its direction) of every row."""
    vecs = usable(rows, id_column, vector)
    # classes are of vectors that are equal when scaled to length 1; the largest component is scaled to 1 first, so
    # that no square leaves the range of doubles
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))
    whole = stored(vecs.withColumn("_peak", F.array_max(F.transform("vec", lambda v: F.abs(v))))
                   .withColumn("vec", F.transform("vec", lambda v: v / F.col("_peak")))
                   .withColumn("_norm", norm).withColumn("unit", F.transform("vec", lambda v: v / F.col("_norm")))
                   .select("id", "unit"), "graph-vectors")
    classes = stored(whole.groupBy("unit").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                     .select("id", "copies", F.col("unit").alias("vec")), "graph-classes")
    total = classes.count()
    _, x = bounded_sample(classes, SAMPLE)
    k = max(1, min(MOST_SHARDS, round(total / SHARD_ROWS), len(x) // 8))
    centres = centroids(x, k) if len(x) else np.zeros((0, 0))
    component = counts = None
    if total:
        for widen in (1, 2, 4):
            counts, forest = attempt(classes, centres, threshold, widen)
            if audit(classes, counts, threshold) >= TARGET_RECALL:
                break
        else:
            counts, forest = compare_all(classes, threshold)
        component = connected(forest)
    own = whole.join(classes.select(F.col("id").alias("class_id"), "copies", F.col("vec").alias("unit")), "unit").select(
        "id", "class_id", "copies")
    if component is not None:
        own = (own.join(component.withColumnRenamed("id", "class_id"), "class_id", "left")
               .join(counts.withColumnRenamed("id", "class_id"), "class_id", "left"))
    else:
        own = own.withColumn("component", F.lit(None).cast("long")).withColumn("linked", F.lit(None).cast("long"))
    all_rows = rows.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"))
    return (all_rows.join(own.withColumnRenamed("id", "vec_id"), "vec_id", "left")
            .select("vec_id", (F.coalesce("linked", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
                    F.coalesce("component", "class_id", "vec_id").alias("component_id"),
                    F.coalesce("class_id", "vec_id").alias("class_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
