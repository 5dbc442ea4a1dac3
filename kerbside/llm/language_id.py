"""Language identification by word-first backoff.

A word that training has seen is scored by its log frequency in each language. An unseen word falls
back to its character n-grams, from the longest order down: the first order of which the model knows
any n-gram decides. A document's score adds up its words; all of its text is read.

Definitions: null text, or text without a letter, is ``und`` with score 0. Repeated rows are each
predicted. An empty training set makes every prediction ``und``. Equal scores go to the language that
sorts first. Other columns of the input are ignored, whatever they are called.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import fresh, give_back, stored, text_batches

#: Bounds of the fit: labelled documents read for each language, and entries kept in the model.
SAMPLE_PER_LANGUAGE = 3000
MAX_WORDS = 80_000
MAX_GRAMS = 60_000
LONGEST_GRAM = 4
UNDETERMINED = "und"

WORD = re.compile(r"[^\W\d_]+")
#: Smoothing of frequencies, and rows of the word cache of a Python worker.
ALPHA, CACHE_ROWS = 0.5, 100_000


def words_of(text: str | None) -> list[str]:
    """Lower-case words; none when the text has no letter."""
    found = WORD.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word; orders above 1 see its ends."""
    w = f" {word} " if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


@dataclass
class Model:
    """Rows of ``scores`` hold log posteriors by language (uniform prior) of words and n-grams."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray


def count_tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(frame["lang"], frame["text"]):
            counts[lang].update(words_of(text))
        rows = []
        for lang, seen in counts.items():
            rows += [(lang, 0, w, n) for w, n in seen.items()]
            grams: Counter = Counter()
            for w, n in seen.items():
                for k in range(1, LONGEST_GRAM + 1):
                    for g in grams_of(w, k):
                        grams[k, g] += n
            rows += [(lang, k, g, n) for (k, g), n in grams.items()]
        yield pd.DataFrame(rows, columns=["lang", "kind", "token", "n"])


def train(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, max_words: int = MAX_WORDS,
          max_grams: int = MAX_GRAMS) -> Model:
    """Fit on (key, text, lang): a sample by hash of ``key``, about ``sample_per_language`` documents
    of each language; the model keeps the most frequent words and n-grams."""
    labelled = labelled.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], {}, {}, np.zeros((0, 0)))
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items()
                           for x in (k, int(1e6 * min(1.0, sample_per_language / n)))])
    sample = labelled.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < share[F.col("lang")])
    counted = sample.select("lang", "text").mapInPandas(count_tokens, "lang string, kind int, token string, n long")
    summed = stored(counted.groupBy("kind", "token", "lang").agg(F.sum("n").alias("n")), "language-counts")
    totals = {(r["kind"], r["lang"]): r["n"] for r in
              summed.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    # one count column for each language
    tokens = (summed.groupBy("kind", "token").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}")
                                     for i, lang in enumerate(languages)]).where("total > 1"))
    size = np.array([[totals.get((k, lang), 0) for lang in languages] for k in range(LONGEST_GRAM + 1)], float)
    index: list[dict[str, int]] = []
    scores = []
    row = 0
    for which, most in (("kind = 0", max_words), ("kind > 0", max_grams)):
        top = tokens.where(which).orderBy(F.desc("total"), "kind", "token").limit(most).toPandas()
        kind = top["kind"].to_numpy()
        n = top[[f"n{i}" for i in range(len(languages))]].to_numpy(float) + ALPHA
        kept = np.bincount(kind, minlength=LONGEST_GRAM + 1)[kind]
        s = np.log(n) - np.log(size[kind] + ALPHA * kept[:, None])
        scores.append(s - np.logaddexp.reduce(s, axis=1, keepdims=True))
        index.append(dict(zip(top["token"], range(row, row + len(top)))))
        row += len(top)
    return Model(languages, index[0], index[1], np.concatenate(scores))


class WordRows(dict):
    """Row of a word in ``scores``; computes and keeps the backoff row of an unseen word."""

    def __init__(self, model: Model):
        super().__init__(model.words)
        self.model, self.known = model, len(model.scores)
        self.scores = np.zeros((self.known + CACHE_ROWS, len(model.languages)))
        self.scores[:self.known] = model.scores
        self.used = self.known

    def trim(self) -> None:
        """Between documents: start the cache anew when it is nearly full."""
        if self.used > self.known + CACHE_ROWS * 3 // 4:
            self.clear()
            self.update(self.model.words)
            self.used = self.known

    def backoff(self, word: str) -> np.ndarray:
        grams = self.model.grams
        for n in range(LONGEST_GRAM, 0, -1):
            rows = [grams[g] for g in grams_of(word, n) if g in grams]
            if rows:
                return self.model.scores[rows].mean(axis=0)
        return np.zeros(len(self.model.languages))

    def __missing__(self, word: str) -> int:
        if self.used == len(self.scores):  # one text with very many unseen words
            self.scores = np.vstack([self.scores, np.zeros((CACHE_ROWS, self.scores.shape[1]))])
        row = self.used
        self.scores[row] = self.backoff(word)
        self[word] = row
        self.used += 1
        return row


def predict_text(text: str | None, rows: WordRows) -> tuple[str, float]:
    words = words_of(text) if isinstance(text, str) else []
    if not words or not rows.model.languages:
        return UNDETERMINED, 0.0
    rows.trim()
    total = rows.scores[np.fromiter(map(rows.__getitem__, words), np.int64, len(words))].sum(axis=0)
    best = int(np.argmax(total))
    return rows.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def predictor(spark: SparkSession, model: Model):
    """A function of a text column that gives (lang_pred, score)."""
    shared = spark.sparkContext.broadcast(model)  # bounded by MAX_WORDS and MAX_GRAMS

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows = WordRows(shared.value)
        for texts in batches:
            yield pd.DataFrame([predict_text(t, rows) for t in texts], columns=["lang_pred", "score"])
        del rows
        give_back()

    # else a filter on the result is pushed below it and the texts are read twice, by twice as many workers
    return run.asNondeterministic()


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``language`` (by another name if that is taken, then the last
    column) of lang_pred and score."""
    spark = docs.sparkSession
    text_batches(spark)
    return docs.withColumn(fresh(docs, "language"), predictor(spark, model)(F.col(f"`{text}`")))


def keep_identified(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told, with all their columns; a missing language is filled in."""
    found = predict(docs, model, text)
    pred = F.col(f"{found.columns[-1]}.lang_pred")
    kept = found.where(pred != UNDETERMINED)
    return kept.select(*[F.coalesce(F.col(f"`{c}`"), pred).alias(c) if c == lang else F.col(f"`{c}`")
                         for c in docs.columns])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(True))


def fit_documents(docs: DataFrame, **bounds: int) -> Model:
    """Model of the labelled documents that are not held out."""
    text_batches(docs.sparkSession)
    return train(docs.where(~held_out()).select(F.col("doc_id").alias("key"), "text", "lang"), **bounds)
