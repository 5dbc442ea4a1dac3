"""Toxicity: held-out calls and ordered severities."""

import math
import random
import re
from collections import Counter

import numpy as np
from llm_tables import DOCS, documents, frame, prose

from kerbside.llm import toxicity

BAD = ["vilefool", "rotbrain", "scumlord", "trashmouth"]


def rows_of(n=400, seed=9):
    rng = random.Random(seed)
    rows, labels, dose = [], [], {}
    for i in range(n):
        words = prose(rng, ("en", "de", "fr")[i % 3], 80).split()
        dose[i] = rng.choice([2, 5, 12]) if i % 4 == 0 else 0
        for _ in range(dose[i]):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "en", "src0", 1))
        if i % 3:
            labels.append((i, int(dose[i] > 0)))
    return rows, labels, dose


def test_held_out_and_order(spark):
    rows, labels, dose = rows_of()
    extra = documents(6)[6:]
    labels += [(0, None), (None, 1), (1, 0), (1, None)]
    docs = frame(spark, rows + [(d + 9000 if d is not None else None, *r) for d, *r in extra], clash=True)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == toxicity.GRADES - 1
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r["doc_id"]: r for r in got}
    held = [i for i in dose if not i % 3]
    assert all(by[i]["is_toxic"] == (dose[i] > 0) for i in held)
    mean = {d: np.mean([by[i]["severity"] for i in held if dose[i] == d]) for d in (0, 2, 5, 12)}
    assert mean[0] < 0.6 < mean[2] < mean[5] < mean[12] <= 3
    assert all(0 <= r["severity"] <= 3 and 0 <= r["p_toxic"] <= 1 for r in got)
    empty = [r for r in got if r["doc_id"] is not None and r["doc_id"] >= 9000 and r["severity"] == 0]
    assert len(empty) >= 3  # null, empty and blank texts


def test_one_class_or_nothing(spark):
    docs = frame(spark, documents(6))
    model = toxicity.train(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert {r["severity"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(frame(spark, [], DOCS), model).count() == 0


def test_gradient_reaches_the_thresholds():
    rng = np.random.default_rng(0)
    n = 600
    x = rng.normal(size=n)
    grades = np.digitize(3 * x + rng.logistic(size=n), [0.0, 2.0, 4.0])
    w, t = toxicity.fit_ordinal(np.arange(n), np.zeros(n, np.int64), x, grades, 1)
    assert w[0] > 1.5 and (np.diff(t) > 0.5).all()


def brute_force(rows, labels):
    """Severity of every text: terms counted one by one, and the likelihood climbed by differences of the loss."""
    toxic = {}
    for i, label in labels:
        toxic[i] = max(toxic.get(i, 0), label)
    bags = {i: Counter(re.findall(r"[^\W\d_]+", text.lower())) for i, text, *_ in rows}
    known = {text: toxic[i] for i, text, *_ in rows if i in toxic}
    train = [(Counter(re.findall(r"[^\W\d_]+", text.lower())), label) for text, label in known.items()]
    bad, good = sum(label for _, label in train), sum(1 - label for _, label in train)
    terms, strong = [], set()
    for term in sorted({t for bag, _ in train for t in bag}):
        a = sum(label for bag, label in train if term in bag)
        b = sum(1 - label for bag, label in train if term in bag)
        odds = math.log((a + 0.5) / (bad + 1)) - math.log((b + 0.5) / (good + 1))
        if a + b >= 6 and abs(odds) >= 1.0 and abs(odds) / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= 3.0:
            terms.append(term)
            if odds >= 2.0:
                strong.add(term)
    x = np.array([[math.log1p(bag[t]) for t in terms] for bag, _ in train])
    dose = np.array([sum(math.log1p(n) for t, n in bag.items() if t in strong) for bag, _ in train])
    label = np.array([label for _, label in train])
    cuts = np.quantile(dose[label > 0], [1 / 3, 2 / 3])
    grade = np.array([0 if not y else 1 + sum(d > c for c in cuts) for y, d in zip(label, dose)])
    weight = np.where(grade > 0, 0.5 / (grade > 0).sum(), 0.5 / (grade == 0).sum())

    def thresholds(p):
        return np.array([p[-3], p[-3] + math.exp(p[-2]), p[-3] + math.exp(p[-2]) + math.exp(p[-1])])

    def loss(p):
        above = 1 / (1 + np.exp(-(x @ p[:-3])[:, None] + thresholds(p)[None, :]))
        edges = np.hstack([np.ones((len(x), 1)), above, np.zeros((len(x), 1))])
        chance = edges[np.arange(len(x)), grade] - edges[np.arange(len(x)), grade + 1]
        return -(weight * np.log(np.maximum(chance, 1e-9))).sum() + toxicity.PENALTY / 2 * (p[:-3] ** 2).sum()

    p = np.zeros(len(terms) + 3)
    first, second = np.zeros_like(p), np.zeros_like(p)
    for turn in range(1, toxicity.ROUNDS + 1):
        slope = np.array([(loss(p + e) - loss(p - e)) / 2e-6 for e in 1e-6 * np.eye(len(p))])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        p = p - toxicity.RATE * (first / (1 - 0.9 ** turn)) / (np.sqrt(second / (1 - 0.999 ** turn)) + 1e-9)
    return {i: sum(1 / (1 + math.exp(t - sum(p[k] * math.log1p(bag[w]) for k, w in enumerate(terms))))
                   for t in thresholds(p)) if bag else 0.0 for i, bag in bags.items()}


def test_severities_equal_brute_force(spark):
    rows, labels, _ = rows_of(150, seed=4)
    rows += [(500, "", "en", "src0", 0), (501, rows[4][1], "en", "src0", 1)]  # an empty text and a copy
    labels += [(501, 1), (4, 0)]  # of several labels and of equal texts, the higher one counts
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["severity"] for r in toxicity.score(frame(spark, rows), model).collect()}
    want = brute_force(rows, labels)
    assert set(got) == set(want) and max(want.values()) > 2 and min(want.values()) < 0.3
    assert max(abs(got[i] - want[i]) for i in got) < 0.01
