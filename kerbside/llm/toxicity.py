"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades are ordered: 0 not toxic, 1 to 3 toxic. The labels say only toxic or not; a toxic training
text is graded by how much it holds of toxic terms (words whose document frequency is much higher among toxic
texts): the sum of the logarithms of their counts, at its two terciles over the toxic training texts. The model
has one weight per feature, shared by all thresholds, and ordered thresholds: P(grade > k) = sigmoid(w.x - t[k]).
Features are words that tell the classes apart clearly, as logarithms of their counts. The result is the
expected severity, the sum of P(grade > k).

The fit uses at most SAMPLE labelled documents of each class (by hash of doc_id); identical texts count once.
Document frequencies are counted by Spark; only the chosen terms and the sample's sparse rows reach the
driver. Every document is scored, on its whole text.

Definitions: null or wordless text has severity 0, probability 0 and grade 0. A document with several labels
is toxic if any says so; null labels are ignored. Without labels of both classes every severity is 0.
Repeated rows are scored each. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored, text_batches

#: Labelled documents of each class that the fit reads, and terms that it keeps.
SAMPLE, MAX_TERMS = 8000, 4000
#: Documents that a term must occur in, the log odds (either way) that make it a feature, those from which it
#: counts as a toxic term, and how many standard errors they must be from zero.
MIN_DOCUMENTS, CLEAR_ODDS, TOXIC_ODDS, CLEAR_ERRORS = 6, 1.0, 2.0, 3.0
GRADES = 4
PENALTY, ROUNDS, RATE = 1e-4, 400, 0.05
#: A document is called toxic from this probability of a grade above 0.
CALL = 0.5

WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


@dataclass
class Model:
    """Weights by term, and the thresholds in ascending order."""

    terms: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str | None) -> tuple[float, float, int]:
        """Expected severity, probability of any toxicity, most probable grade."""
        counts = terms_of(text)
        if not counts or not len(self.thresholds):
            return 0.0, 0.0, 0
        x = sum(self.weights[self.terms[t]] * math.log1p(n) for t, n in counts.items() if t in self.terms)
        above = 1.0 / (1.0 + np.exp(-np.clip(x - self.thresholds, -500, 500)))
        chance = -np.diff(np.concatenate([[1.0], above, [0.0]]))
        return float(above.sum()), float(above[0]), int(chance.argmax())


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood of the grades; the classes weigh alike."""
    n = len(grades)
    counts = np.bincount(np.minimum(grades, 1), minlength=2)
    weight = np.where(grades > 0, 0.5 / max(counts[1], 1), 0.5 / max(counts[0], 1))
    w = np.zeros(features)
    # thresholds are the first one and positive steps
    start, steps = 0.0, np.zeros(GRADES - 2)
    state = [np.zeros(features + 1 + len(steps)) for _ in range(2)]
    for turn in range(1, ROUNDS + 1):
        gaps = np.exp(steps)
        t = start + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(rows, values * w[columns], minlength=n)
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        low, high = edges[grades] - x, edges[grades + 1] - x
        with np.errstate(over="ignore"):
            pl, ph = 1.0 / (1.0 + np.exp(-low)), 1.0 / (1.0 + np.exp(-high))
        chance = np.maximum(ph - pl, 1e-9)
        dl, dh = pl * (1 - pl) / chance, ph * (1 - ph) / chance
        by_x = weight * (dh - dl)  # derivative of the loss by x
        grad_t = np.zeros(GRADES + 1)
        np.add.at(grad_t, grades, weight * dl)
        np.add.at(grad_t, grades + 1, -weight * dh)
        grad_t = grad_t[1:GRADES]
        grad = np.concatenate([np.bincount(columns, values * by_x[rows], minlength=features) + PENALTY * w,
                               [grad_t.sum()], [grad_t[k + 1:].sum() * gaps[k] for k in range(len(steps))]])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad * grad
        move = RATE * (state[0] / (1 - 0.9 ** turn)) / (np.sqrt(state[1] / (1 - 0.999 ** turn)) + 1e-9)
        w -= move[:features]
        start -= move[features]
        steps -= move[features + 1:]
    return w, start + np.concatenate([[0.0], np.cumsum(np.exp(steps))])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_terms: int = MAX_TERMS) -> Model:
    """Fits documents (doc_id, text) with labels (doc_id, toxic)."""
    text_batches(docs.sparkSession)
    nothing = Model({}, np.zeros(0), np.zeros(0))
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return nothing
    share = F.when(F.col("toxic") > 0, int(1e6 * min(1.0, sample / sizes[1]))).otherwise(
        int(1e6 * min(1.0, sample / sizes[0])))
    picked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    # about 2 * sample rows at most
    texts = (docs.where("text is not null").join(F.broadcast(picked), "doc_id")
             .groupBy(F.xxhash64("text").alias("key")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")))

    def rows_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [terms_of(t) for t in frame["text"]]
            yield pd.DataFrame({"key": frame["key"], "toxic": frame["toxic"], "terms": [list(c) for c in found], "counts": [list(c.values()) for c in found]})

    rows = stored(texts.mapInPandas(rows_of, "key long, toxic int, terms array<string>, counts array<int>"), "toxicity-sample")
    classes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not classes.get(0) or not classes.get(1):
        return nothing
    seen = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("docs"), F.sum("toxic").alias("toxic")).where(F.col("docs") >= MIN_DOCUMENTS)
    odds = F.log((F.col("toxic") + 0.5) / (classes[1] + 1)) - F.log((F.col("docs") - F.col("toxic") + 0.5) / (classes[0] + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("docs") - F.col("toxic") + 0.5))
    chosen = (seen.withColumn("odds", odds).withColumn("z", F.abs(F.col("odds")) / error)
              .where((F.abs("odds") >= CLEAR_ODDS) & (F.col("z") >= CLEAR_ERRORS))
              .orderBy(F.desc("z"), "term").limit(max_terms).collect())
    terms = {r["term"]: k for k, r in enumerate(chosen)}
    strong = {r["term"] for r in chosen if r["odds"] >= TOXIC_ODDS}
    shared = docs.sparkSession.sparkContext.broadcast((terms, strong))

    def sparse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, marks = shared.value
        for frame in frames:
            out = []
            for toxic, own, counts in zip(frame["toxic"], frame["terms"], frame["counts"]):
                kept = [(places[t], int(n)) for t, n in zip(own, counts) if t in places]
                hits = sum(math.log1p(int(n)) for t, n in zip(own, counts) if t in marks)
                out.append((int(toxic), hits, [k for k, _ in kept], [n for _, n in kept]))
            yield pd.DataFrame(out, columns=["toxic", "hits", "at", "n"])

    data = rows.orderBy("key").mapInPandas(sparse, "toxic int, hits double, at array<int>, n array<int>").toPandas()
    toxic, hits = data["toxic"].to_numpy(), data["hits"].to_numpy()
    cuts = np.quantile(hits[toxic > 0], [1 / 3, 2 / 3])
    grades = np.where(toxic > 0, 1 + (hits[:, None] > cuts[None, :]).sum(axis=1), 0)
    sizes_ = np.array([len(a) for a in data["at"]])
    r = np.repeat(np.arange(len(data)), sizes_)
    c = np.concatenate([np.asarray(a, np.int64) for a in data["at"]]) if len(r) else np.zeros(0, np.int64)
    v = np.log1p(np.concatenate([np.asarray(a, float) for a in data["n"]])) if len(r) else np.zeros(0)
    weights, thresholds = fit_ordinal(r, c, v, grades.astype(np.int64), len(terms))
    return Model(terms, weights, thresholds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity, p_toxic, grade, is_toxic of every row."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_TERMS terms

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [shared.value.score(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "severity": [g[0] for g in got],
                                "p_toxic": [g[1] for g in got], "grade": [g[2] for g in got],
                                "is_toxic": [g[1] >= CALL for g in got]})

    return (docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
            .mapInPandas(run, "doc_id string, severity double, p_toxic double, grade int, is_toxic boolean")
            .withColumn("doc_id", F.col("doc_id").cast("long")))
