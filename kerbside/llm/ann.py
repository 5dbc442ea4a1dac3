"""Approximate nearest neighbours by learned partitions.

On a bounded sample the exact neighbour graph is built, cut into balanced partitions with few edges between
them (regions grown along the graph, then moves that gain edges while sizes allow), and a small neural
network learns to which partitions a vector's neighbours belong. The network then files every vector under
its most probable partition and routes each query to its several most probable ones, where all vectors are
compared exactly. How many partitions a query visits is fitted on sample vectors that the network has not
seen, to a recall well above the target.

A partition is split into blocks of candidates and blocks of queries by a hash of the id, so that a task
holds bounded numbers of both, however uneven the partitions or common a vector is.

A query whose partitions hold fewer vectors than it asks for is searched again in all partitions.

Definitions: see ``vectors.usable`` for rows that take no part. Distances are Euclidean, in double precision
by differences of the original vectors; equal distances rank the smaller id first. Very large and very small
components are scaled before they are squared, so only a distance that no double holds is infinite. A query
gets fewer rows when there are fewer candidates; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import by_group, stored
from kerbside.llm.vectors import bounded_sample, matrix, usable

#: The index is fitted on so many vectors at most.
SAMPLE = 8192
NEIGHBOURS = 10
#: Vectors per partition aimed at, and the most partitions that the sample supports.
PARTITION_ROWS, MOST_PARTITIONS = 1000, 64
#: Recall that the fitted number of visited partitions reaches on unseen sample vectors.
TARGET_RECALL = 0.98
HIDDEN, EPOCHS = 128, 30
#: Candidates and queries of a block.
BLOCK, QUERY_BLOCK = 8192, 1024


def neighbour_graph(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest rows of ``x`` to x[queries], without themselves."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(queries), max(k, 0)), np.int64)
    if k <= 0:
        return out
    norms = (x * x).sum(axis=1)
    for at in range(0, len(queries), 512):
        q = queries[at:at + 512]
        d = norms[None, :] - 2.0 * (x[q] @ x.T)
        d[np.arange(len(q)), q] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        out[at:at + 512] = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1), 1)
    return out


def balanced_partition(graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 20) -> np.ndarray:
    """A part for each node of a neighbour graph, sizes within ``slack`` of equal, few edges cut."""
    n = len(graph)
    most = math.ceil(n / parts * slack)
    rows = np.repeat(np.arange(n), graph.shape[1])
    src, dst = np.concatenate([rows, graph.ravel()]), np.concatenate([graph.ravel(), rows])
    order = np.argsort(src, kind="stable")
    dst, begin = dst[order], np.searchsorted(src[order], np.arange(n + 1))
    part = np.full(n, -1)
    goal = math.ceil(n / parts)
    links = np.zeros(n)
    for p in range(parts):  # grow a region of the nodes most linked to it
        links[:] = 0
        links[part >= 0] = -np.inf
        free = int((part < 0).sum())
        if not free:
            break
        node = int(np.flatnonzero(part < 0)[0])
        for _ in range(min(goal, free)):
            part[node] = p
            links[node] = -np.inf
            np.add.at(links, dst[begin[node]:begin[node + 1]], 1.0)
            node = int(np.argmax(links))
    size = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        ties = np.zeros((n, parts))
        np.add.at(ties, (rows, part[graph.ravel()]), 1.0)
        np.add.at(ties, (graph.ravel(), part[rows]), 1.0)
        best = ties.argmax(axis=1)
        gain = ties[np.arange(n), best] - ties[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < most:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network with one hidden layer from vectors to partition scores; ``visits``: partitions to search,
    ``peak``: the usual largest component."""

    centre: np.ndarray
    scale: float
    layers: list[np.ndarray]
    visits: int
    peak: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((tamed(x, self.peak) - self.centre) / self.scale @ w1 + b1, 0.0) @ w2 + b2


def tamed(x: np.ndarray, peak: float) -> np.ndarray:
    """Vectors in units of ``peak``; components beyond 1000 of them count as 1000."""
    with np.errstate(over="ignore"):
        return np.clip(x / peak, -1000.0, 1000.0)


def train_router(x: np.ndarray, wanted: np.ndarray, seed: int = 5) -> Router:
    """Fits ``wanted`` (rows: shares of a vector's neighbours by partition) by cross entropy and Adam."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    parts = wanted.shape[1]
    router = Router(x.mean(axis=0), float(x.std()) or 1.0, [
        rng.normal(0, math.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, math.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)], parts)
    z = (x - router.centre) / router.scale
    first, second, step = [0.0 * w for w in router.layers], [0.0 * w for w in router.layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at:at + 256]
            w1, b1, w2, b2 = router.layers
            pre = z[rows] @ w1 + b1
            h = np.maximum(pre, 0.0)
            s = h @ w2 + b2
            s = np.exp(s - s.max(axis=1, keepdims=True))
            g = (s / s.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            back = (g @ w2.T) * (pre > 0)
            step += 1
            for k, grad in enumerate((z[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                router.layers[k] = router.layers[k] - 0.003 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return router


def fit(x: np.ndarray, total: int, target_recall: float = TARGET_RECALL) -> Router:
    """A router for ``total`` vectors of which ``x`` is a sample."""
    parts = max(1, min(MOST_PARTITIONS, round(total / PARTITION_ROWS), len(x) // (4 * NEIGHBOURS)))
    if parts == 1:
        d = x.shape[1]
        return Router(np.zeros(d), 1.0, [np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    peak = float(np.median(np.abs(x).max(axis=1)))
    x = tamed(x, peak)
    seen = np.arange(len(x)) % 8 != 0
    known = x[seen]
    graph = neighbour_graph(known, np.arange(len(known)), NEIGHBOURS)
    part = balanced_partition(graph, parts)
    wanted = np.zeros((len(known), parts))
    np.add.at(wanted, (np.arange(len(known)), part), 1.0)
    np.add.at(wanted, (np.repeat(np.arange(len(known)), graph.shape[1]), part[graph.ravel()]), 1.0)
    router = train_router(known, wanted / wanted.sum(axis=1, keepdims=True))
    # recall of unseen vectors' neighbours by partitions visited; ``x`` is in units of the peak already
    held = np.flatnonzero(~seen)
    near = neighbour_graph(x, held, NEIGHBOURS)
    filed = router.scores(x).argmax(axis=1)
    ranks = np.argsort(np.argsort(-router.scores(x[held]), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(ranks, filed[near], axis=1).ravel()
    reached = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    router.visits = int(np.searchsorted(reached, target_recall) + 1)
    router.visits = min(router.visits, parts)
    router.peak = peak
    return router


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` from ``q``; squares that leave the range of doubles are avoided."""
    with np.errstate(over="ignore", under="ignore"):
        d = x - q
        far = np.sqrt((d * d).sum(axis=1))
        most = np.abs(d).max(axis=1, initial=0.0)
        odd = ((far > 1e150) | (far < 1e-150)) & (most > 0) & np.isfinite(most)
        if odd.any():
            part = d[odd] / most[odd, None]
            far[odd] = np.sqrt((part * part).sum(axis=1)) * most[odd]
    return far


def nearest(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query row, id, distance) of the k nearest rows of a block, exact; ties go to smaller ids. Rows are
    chosen by a fast estimate with a margin far above its rounding, and measured by differences."""
    out = []
    peak = max(np.abs(x).max(initial=0.0), np.abs(q).max(initial=0.0))
    unit = 1.0 if 1e-100 < peak < 1e100 else peak  # the estimate's squares stay in range
    small = x / unit
    norms = (small * small).sum(axis=1)
    for at in range(0, len(q), 256):
        part = q[at:at + 256] / unit
        lengths = (part * part).sum(axis=1)
        rough = norms[None, :] + lengths[:, None] - 2.0 * (part @ small.T)
        other = ids[None, :] != own[at:at + 256, None]
        rough[~other] = np.inf
        for r in range(len(part)):
            row = rough[r]
            rows = np.flatnonzero(other[r])
            if len(rows) > k:
                margin = 1e-9 * (norms + lengths[r]) + 1e-300
                limit = np.partition(row + margin, k - 1)[k - 1]
                rows = np.flatnonzero((row - margin <= limit) & other[r])
            far = distances(x[rows], q[at + r])
            first = np.lexsort((ids[rows], far))[:k]
            out += [(at + r, int(ids[rows[j]]), float(far[j])) for j in first]
    return out


def search(rows: DataFrame, is_query: Column, k: int = NEIGHBOURS, sample: int = SAMPLE,
           target_recall: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``is_query`` (over column ``id``)
    names, among all other rows."""
    spark = rows.sparkSession
    vecs = stored(usable(rows), "ann-vectors")
    total = vecs.count()
    _, x = bounded_sample(vecs, sample)
    router = fit(x, total, target_recall)
    shared = spark.sparkContext.broadcast(router)  # bounded by HIDDEN and MOST_PARTITIONS

    def route(frames):
        for frame in frames:
            if len(frame):
                s = shared.value.scores(matrix(frame["vec"]))
                order = np.argsort(-s, axis=1, kind="stable")[:, :shared.value.visits]
                yield frame.assign(parts=[r.astype(np.int32) for r in order])

    routed = stored(vecs.withColumn("query", F.coalesce(is_query, F.lit(False)))
                    .mapInPandas(route, "id long, vec array<double>, query boolean, parts array<int>"), "ann-routed")
    own = routed.select("id", "vec", F.element_at("parts", 1).alias("part"))
    sizes = stored(own.groupBy("part").agg(F.count("*").alias("rows")), "ann-sizes")  # at most MOST_PARTITIONS rows

    def compared(asked: DataFrame) -> DataFrame:
        """The k nearest of each block pair for ``asked`` (id, vec, part)."""
        blocks = F.broadcast(sizes.select("part", F.ceil(F.col("rows") / BLOCK).cast("int").alias("cs"))
                             .join(asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("qs")), "part"))

        def dealt(side: DataFrame, mine: str, other: str, flag: bool) -> DataFrame:
            return (side.join(blocks, "part")
                    .withColumn("mine", F.pmod(F.xxhash64("id"), F.col(mine)).cast("int"))
                    .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                    .select("part", F.col("other" if flag else "mine").alias("c"), F.col("mine" if flag else "other").alias("q"),
                            F.lit(flag).alias("query"), "id", "vec"))

        def work(cols: dict) -> tuple | None:
            ask = cols["query"].astype(bool)
            if not ask.any() or ask.all():
                return None
            own_ids = cols["id"][ask]
            got = nearest(matrix(cols["vec"][~ask]), cols["id"][~ask], matrix(cols["vec"][ask]), own_ids, k)
            return [int(own_ids[r]) for r, _, _ in got], [i for _, i, _ in got], [d for _, _, d in got]

        return by_group(dealt(own, "cs", "qs", False).unionByName(dealt(asked, "qs", "cs", True)), ["part", "c", "q"], work,
                        "query_id long, vec_id long, score double")

    asked = routed.where("query")
    found = compared(asked.select("id", "vec", F.explode("parts").alias("part")))
    if router.visits < len(router.layers[3]):  # some partitions were not visited
        found = stored(found, "ann-found")
        full = found.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)).select(F.col("query_id").alias("id"))
        short = stored(asked.select("id", "vec").join(full, "id", "left_anti"), "ann-short")
        if not short.isEmpty():
            unseen = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(len(router.layers[3]) - 1))))
            again = compared(unseen)
            found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def brute_force(rows: pd.DataFrame, queries: list[int], k: int = NEIGHBOURS) -> dict[int, list[int]]:
    """Exact neighbours on the driver, for small tables and recall checks."""
    ids, x = rows["id"].to_numpy(), matrix(rows["vec"])
    at = {int(i): n for n, i in enumerate(ids)}
    out = {}
    for q in queries:
        got = nearest(x, ids, x[at[q]][None, :], np.array([q]), k)
        out[q] = [i for _, i, _ in got]
    return out
