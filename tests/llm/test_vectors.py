"""Both embedding operators against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from kerbside.llm import ann, embedding_dedup
from llm_tables import CLASH

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def rows_of(n=900, d=16, seed=2, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 30, d))
    x = (centres[rng.integers(0, len(centres), n)] + 0.35 * rng.normal(size=(n, d))).astype(np.float32)
    rows = [(i, x[i].tolist(), 1) for i in range(n)]
    rows += [(n + i, x[5].tolist(), 2) for i in range(copies)]
    m = n + copies
    rows += [(m, None, 0), (m + 1, [], 0), (m + 2, [0.0] * d, 0), (m + 3, [NAN] * d, 0), (m + 4, [INF] * d, 0),
             (m + 5, [None] + [1.0] * (d - 1), 0), (m + 6, [1.0] * (d + 1), 0), (None, x[1].tolist(), 0)]
    return rows, {i: v for i, v, _ in rows[:m]}


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASH + ["vec", "part", "query", "shard", "copies"] if clash else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def exact(vecs, q, k):
    far = sorted((math.sqrt(float(((np.asarray(v, float) - np.asarray(vecs[q], float)) ** 2).sum())), i)
                 for i, v in vecs.items() if i != q)
    return far[:k]


def test_neighbours(spark):
    rows, vecs = rows_of(4000, copies=60)
    got = {}
    for r in ann.search(frame(spark, rows, clash=True), F.col("id") % 100 == 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    asked = [i for i in vecs if i % 100 == 5]
    assert sorted(got) == asked
    hit = 0
    for q in asked:
        want = exact(vecs, q, 10)
        own = [got[q][k] for k in sorted(got[q])]
        assert sorted(got[q]) == list(range(1, 11))
        assert own == sorted(own)
        for far, i in own:
            assert abs(far - dict((b, a) for a, b in exact(vecs, q, len(vecs)))[i]) < 1e-12
        hit += len({i for _, i in own} & {i for _, i in want})
    assert hit >= 0.9 * 10 * len(asked)
    # ties between copies go to the smaller ids: 5 is a query with 60 copies
    assert [i for _, i in [got[5][k] for k in range(1, 11)]] == list(range(4000, 4010))


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [3.0, 2.0], 0), (2, [3.0, 2.0], 0)]
    got = ann.search(frame(spark, rows), F.col("id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.0), (2, 2, 2.0)]
    assert ann.search(frame(spark, []), F.col("id") == 0).collect() == []


def test_partition_is_balanced():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 8))
    graph = ann.neighbour_graph(x, np.arange(800), 10)
    part = ann.balanced_partition(graph, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.min() > 0 and sizes.max() <= math.ceil(100 * 1.1)
    cut = (part[graph] != part[:, None]).mean()
    assert cut < 0.8 * (1 - 1 / 8)  # far fewer edges cut than by chance


def test_near_duplicates(spark):
    rows, vecs = rows_of(1500, copies=40)
    ids = sorted(vecs)
    x = np.array([vecs[i] for i in ids], float)
    cos = (x @ x.T) / np.sqrt(np.outer((x * x).sum(1), (x * x).sum(1)))
    linked = cos >= 0.9
    np.fill_diagonal(linked, False)
    up = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(linked[i]):
            a, b = sorted((up[i], up[j]))
            if a != b:
                up = [a if u == b else u for u in up]
    got = {r["vec_id"]: r for r in embedding_dedup.dedup(frame(spark, rows, clash=True)).collect()}
    assert len(got) == len(rows)
    right = sum(got[i]["n_links"] == linked[k].sum() and got[i]["component_id"] == ids[up[k]] for k, i in enumerate(ids))
    assert linked.sum() > 2000 and right >= 0.995 * len(ids)
    assert all(got[i]["n_links"] <= linked[k].sum() for k, i in enumerate(ids))
    for i in set(got) - set(ids):
        assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_of_blocks_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 120)
    rng = random.Random(4)
    base = [rng.gauss(0, 1) for _ in range(12)]
    rows = [(i, [v + rng.gauss(0, 0.02) for v in base], 0) for i in range(400)]  # one group of near copies
    got = embedding_dedup.dedup(frame(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0}
    assert {r["n_links"] for r in got} == {399}
    assert embedding_dedup.dedup(frame(spark, [])).collect() == []
    only = embedding_dedup.dedup(frame(spark, [(3, [0.0, 0.0], 1), (3, [0.0, 0.0], 1)])).collect()
    assert [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in only] == [(3, 0, 3, True)] * 2


def test_scaled_copies_give_one_row_each(spark):
    rng = random.Random(6)
    base = [rng.gauss(0, 1) for _ in range(12)]
    rows = [(i, [v * 2.0 ** i for v in base], 0) for i in range(3)]  # v, 2v and 4v
    rows += [(10 + i, [rng.gauss(0, 1) for _ in range(12)], 0) for i in range(5)]
    got = embedding_dedup.dedup(frame(spark, rows)).collect()
    assert sorted(r["vec_id"] for r in got) == sorted(i for i, _, _ in rows)
    assert {(r["n_links"], r["component_id"], r["class_id"]) for r in got if r["vec_id"] < 3} == {(2, 0, 0)}


def test_audit_sees_lost_pairs_beside_a_dense_group(spark):
    rng = np.random.default_rng(8)
    dense = rng.normal(size=24) + 0.01 * rng.normal(size=(300, 24))
    pairs = np.repeat(rng.normal(size=(40, 24)), 2, axis=0) + 0.01 * rng.normal(size=(80, 24))
    x = np.concatenate([dense, pairs])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    classes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id long, copies long, vec array<double>")
    full = [(i, 299 if i < 300 else 1) for i in range(380)]
    frame_of = lambda rows: spark.createDataFrame(rows, "id long, linked long")
    assert embedding_dedup.audit(classes, frame_of(full), 0.9) == 1.0
    assert embedding_dedup.audit(classes, frame_of(full[:300]), 0.9) < embedding_dedup.TARGET_RECALL
    assert embedding_dedup.audit(classes, frame_of(full[300:]), 0.9) < embedding_dedup.TARGET_RECALL


def test_all_are_compared_when_no_search_reaches_the_target(spark, monkeypatch):
    rows, vecs = rows_of(150, copies=4)
    x = np.array([vecs[i] for i in sorted(vecs)], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.9).sum(axis=1) - 1
    none = (spark.createDataFrame([], "id long, linked long"), spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(embedding_dedup, "attempt", lambda *_: none)  # a search that finds nothing
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.dedup(frame(spark, rows)).collect()}
    assert linked.sum() > 100 and [got[i] for i in sorted(vecs)] == linked.tolist()


WIDE = "vec_id long, embedding array<double>, label int"


def test_neighbours_of_very_large_and_very_small_vectors(spark):
    huge = spark.createDataFrame([(0, [1e160, 0.0], 0), (1, [1e160, 3e160], 0), (2, [-1e160, 0.0], 0)], WIDE)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(huge, F.lit(True)).collect()}
    assert [got[0, k][0] for k in (1, 2)] == [2, 1] and got[0, 1][1] == 2e160 and got[0, 2][1] == 3e160
    assert len(got) == 6
    tiny = spark.createDataFrame([(0, [1e-200, 0.0], 0), (1, [1e-200, 3e-200], 0), (2, [-1e-200, 0.0], 0)], WIDE)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(tiny, F.lit(True)).collect()}
    assert got[0, 1] == (2, 2e-200) and got[0, 2] == (1, 3e-200) and len(got) == 6


def test_one_huge_vector_among_many(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(3000)] + [(3000, [1e200] * 8, 0)]
    vecs = {i: v for i, v, _ in rows}
    got = {}
    for r in ann.search(spark.createDataFrame(rows, WIDE), F.col("id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sorted(got) == list(range(0, 3001, 100)) and {len(v) for v in got.values()} == {10}
    hit = sum(len(set(got[q]) & {i for _, i in exact(vecs, q, 10)}) for q in got if q < 3000)
    assert hit >= 0.9 * 10 * 30


def test_queries_of_small_partitions_get_all_their_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    x[:3, 0] += 100.0  # three vectors that the router files apart; it visits one partition only
    layers = [np.eye(4, 1), np.array([-50.0]), np.array([[1.0, 0.0]]), np.array([0.0, 1.0])]
    monkeypatch.setattr(ann, "fit", lambda *_: ann.Router(np.zeros(4), 1.0, layers, 1))
    vecs = {i: v.tolist() for i, v in enumerate(x)}
    got = {}
    for r in ann.search(spark.createDataFrame([(i, v, 0) for i, v in vecs.items()], WIDE), F.col("id").isin(0, 7)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    for q in (0, 7):
        near = [i for _, i in exact(vecs, q, 11) if q == 0 or i > 2][:10]
        assert [got[q][k] for k in range(1, 11)] == near


def test_links_of_very_large_and_very_small_vectors(spark):
    rows = [(0, [1e-200, 1e-200], 0), (1, [1.0, 1.0], 0), (2, [1e200, 1e200], 0), (3, [1e200, -1e200], 0),
            (4, [5e-324, -5e-324], 0), (5, [1.7e308, 1.6e308], 0), (6, [-1.0, 1e-5], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           embedding_dedup.dedup(spark.createDataFrame(rows, WIDE)).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 5: (3, 0), 3: (1, 3), 4: (1, 3), 6: (0, 6)}
