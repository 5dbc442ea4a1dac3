"""Substring deduplication by sliding sentence spans.

A text is cut into units: sentences, which end at ``.``, ``!``, ``?`` or a line break; a sentence also
ends before a capitalised word that follows an uncapitalised one (a sentence start whose stop is
missing), and before words chosen by their own hash, about one in 16, so that a passage glued into a
longer sentence is cut alike everywhere. A span is a run of consecutive units with at least three units
and 30 words, or at least 45 words; from each unit starts, and at each unit ends, the shortest such run.
Each run is hashed (lower-case words, white space ignored). All runs of all documents are grouped by
hash; the first occurrence (smallest doc_id, then position) stays, and every unit that is covered by any
later occurrence is removed. Repeats inside one document count like those between documents.

Units that touch a passage's ends also hold the text around it. With ``passage_words`` (the queries ask for
PASSAGE_WORDS), every stretch of so many words that occurs before is cut too, by its exact words, wherever it
begins and ends. For that, runs of SHINGLE words are hashed; the smallest hash of a stretch, its anchor, is the same
in every copy. Neighbouring stretches with one anchor are a block. A block that occurs before goes whole; where an
anchor has several different blocks, the first of each is opened and its stretches are compared one by one. Of a
stretch that overlaps its own first occurrence only the words behind that go.

Texts are read once for runs and blocks. What is found in a few megabytes of text travels as packed columns, one row
for each bucket of hashes, and a bucket's occurrences meet sorted in one task; buckets are as many as the texts need.
Of the occurrences inside one such part of the table all but the first are known to be later at once, so a passage
that a third of all documents share comes to its bucket once a part.

Definitions: null text stays null, empty text stays empty; a text shorter than a span is never touched;
a text that loses every unit becomes ''. Rows with the same doc_id and text are one occurrence (none of
them is a repeat of the others) and are treated alike. A null doc_id sorts before all others. Text that
loses nothing is returned as it is, byte for byte. ``drop_repeats`` carries other columns along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import give_back, shield, stored, text_batches

MIN_UNITS = 3
MIN_WORDS = 30
LONG_WORDS = 45
#: Words of a stretch that is cut exactly, and of the runs that candidates are found by.
PASSAGE_WORDS, SHINGLE = 50, 20
#: One word in so many ends a sentence by its own hash.
CUT_ONE_IN = 16

#: Characters of texts whose occurrences are packed together, and of the texts whose hashes share a bucket, about.
PART_CHARS, BUCKET_CHARS = 3_000_000, 16_000_000

WORD = re.compile(r"\S+")
STOP = re.compile(r"[.!?…。！？][\"'»”’)\]]*$")
_BASE = np.uint64(0x9E3779B97F4A7C15)


#: What a word's low bits tell in a parse: whether it begins in upper or lower case, ends a sentence, or is a cut by its hash.
UPPER, LOWER, STOPS, CUTS = (np.uint64(1 << k) for k in range(4))
_HASH = ~np.uint64(15)


class Words(dict):
    """Hash (of the lower-case word) and marks of a word; begins anew when it has grown large."""

    MOST = 150_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word.lower())
        first = word[0]
        marks = (first.isupper() | first.islower() << 1 | (not word[-1].isalnum() and STOP.search(word) is not None) << 2
                 | (h % CUT_ONE_IN == 0) << 3)
        found = self[word] = h & ~15 | marks
        return found


def parse(texts: list[str], known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, the first word of each unit, and the first word of each text (and their number)."""
    words: list[str] = []
    lines, texts_at = [], []
    for text in texts:
        texts_at.append(len(words))
        for line in text.split("\n"):
            here = line.split()
            if here:
                lines.append(len(words))
                words += here
    found = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    texts_at = np.array([*texts_at, len(words)])
    new = np.zeros(len(words), bool)
    new[lines] = True
    new[1:] |= (found[:-1] & STOPS > 0) | (found[:-1] & LOWER > 0) & (found[1:] & UPPER > 0)
    # a cut needs four words before it since the unit's start, which an earlier cut may be
    at = np.flatnonzero(~new & (found & CUTS > 0))
    starts = np.flatnonzero(new)
    last = -1
    for word, start in zip(at.tolist(), starts[np.searchsorted(starts, at) - 1].tolist() if len(at) else []):
        if word - max(start, last) >= 4:
            new[word] = True
            last = word
    return found & _HASH, np.flatnonzero(new), texts_at


def units(text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Offsets where units start (a unit reaches to the next one's start), words and hash of each."""
    hashes, starts, _ = parse([text], Words())
    at = [m.start() for m in WORD.finditer(text)]
    ends = np.append(starts[1:], len(hashes)) if len(starts) else starts
    return [at[k] for k in starts], ends - starts, run_hashes(hashes, starts, ends)


def run_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the items from each ``begin`` to each ``end``."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE, np.uint64))])
        prefix = np.zeros(n + 1, np.uint64)
        # prefix[k+1] = prefix[k] * B + h[k]; as a sum of h[k] * B^-(k+1), scaled: B is odd, so it has an inverse
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        inverses = np.cumprod(np.full(n, inverse, np.uint64))
        prefix[1:] = np.cumsum(hashes * inverses)
        value = (prefix[end] - prefix[begin]) * power[end]
        value ^= value >> np.uint64(31)
        value = value * np.uint64(0xBF58476D1CE4E5B9) + (end - begin).astype(np.uint64)
        value ^= value >> np.uint64(29)
    return value


def spans(words: np.ndarray, hashes: np.ndarray, firsts: np.ndarray | None = None, min_units: int = MIN_UNITS,
          min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First unit, end unit and hash of each distinct shortest run that starts or ends at a unit. ``firsts``: the first
    units of several texts, and the number of units; a run lies in one text."""
    n = len(words)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    firsts = np.array([0, n]) if firsts is None else firsts
    low, high = (np.repeat(x, np.diff(firsts)) for x in (firsts[:-1], firsts[1:]))
    total = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(n)
    # shortest run from i: enough units and words, or many words
    end = np.minimum(np.maximum(np.searchsorted(total, total[:-1] + min_words), at + min_units),
                     np.searchsorted(total, total[:-1] + long_words))
    forward = np.stack([at, end])[:, end <= high]
    # shortest run that ends before unit j (exclusive end j = 1..n)
    stop = at + 1
    begin = np.maximum(np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, stop - min_units),
                       np.searchsorted(total, total[1:] - long_words, side="right") - 1)
    backward = np.stack([begin, stop])[:, begin >= low]
    codes = np.unique(np.concatenate([forward[0] * (n + 1) + forward[1], backward[0] * (n + 1) + backward[1]]))
    runs = np.stack(np.divmod(codes, n + 1))
    return runs[0], runs[1], run_hashes(hashes, runs[0], runs[1])


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of each ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[:len(x) - (width - done)], x[width - done:]) if width > done else x


def blocks_of(hashes: np.ndarray, texts_at: np.ndarray, passage_words: int) -> tuple[np.ndarray, ...]:
    """Anchor, hash, first stretch (its first word) and number of stretches of each block of the texts' words."""
    n = len(hashes) - passage_words + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    at = np.arange(len(hashes) - SHINGLE + 1)
    shingles = run_hashes(hashes, at, at + SHINGLE)
    order = np.argsort(shingles, kind="stable")  # of equal hashes the leftmost
    rank = np.empty_like(order)
    rank[order] = at
    where = order[sliding(rank, passage_words - SHINGLE + 1, np.minimum)]
    # stretches that lie in one text; the anchor's place tells texts apart
    whole = np.repeat(texts_at[1:], np.diff(texts_at))[:n] >= at[:n] + passage_words
    start = np.flatnonzero(whole)
    if not len(start):
        return shingles[:0], shingles[:0], start, start
    where = where[start]
    first = np.concatenate([[0], np.flatnonzero(where[1:] != where[:-1]) + 1])
    begin, length = start[first], np.diff(np.append(first, len(start)))
    return shingles[where[first]], run_hashes(hashes, begin, begin + length - 1 + passage_words), begin, length


#: Kinds of packed rows: runs, blocks and stretches to be compared; runs and words that are cut; stretches to be opened.
RUN, BLOCK, STRETCH, CUT_RUN, CUT_WORDS, OPEN = range(6)
PACKED = "bucket int, kind int, n int, data binary"
FOUND = "d long, k int, kind int, data binary"
_COLUMNS = {"key": "<u8", "block": "<u8", "d": "<i8", "k": "<i4", "a": "<i4", "b": "<i4"}


def pack(columns: dict[str, np.ndarray]) -> bytes:
    return b"".join(columns[c].astype(kind).tobytes() for c, kind in _COLUMNS.items())


def unpack(n: list[int], data: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of several packed rows, one after the other."""
    out, parts = {}, {c: [] for c in _COLUMNS}
    for rows, raw in zip(n, data):
        at = 0
        for c, kind in _COLUMNS.items():
            parts[c].append(np.frombuffer(raw, kind, rows, at))
            at += rows * int(kind[-1])
    for c, kind in _COLUMNS.items():
        out[c] = np.concatenate(parts[c]) if parts[c] else np.zeros(0, kind)
    return out


def first_of(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows by key, block and place, and for each row in that order the place of its group's first."""
    order = np.lexsort((rows["a"], rows["k"], rows["d"], rows["block"], rows["key"]))
    new = np.ones(len(order), bool)
    key, block = rows["key"][order], rows["block"][order]
    new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
    return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def later(rows: dict[str, np.ndarray], kind: int, passage_words: int) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(Cuts, the rest): the rows that come after the first with their key and block, as what they cut; and the others.
    ``rest`` also has ``group``, the number of its key and block."""
    order, first = first_of(rows)
    rows = {c: v[order] for c, v in rows.items()}
    same_text = (rows["d"] == rows["d"][first]) & (rows["k"] == rows["k"][first])
    after = ~(same_text & (rows["a"] == rows["a"][first]))
    cuts = {c: v[after] for c, v in rows.items()}
    if kind != RUN:  # a and b are the first word and the number of stretches; the first occurrence's words stay
        kept = np.where(same_text, rows["a"][first] + passage_words, 0)[after]
        cuts["b"] = cuts["a"] + cuts["b"] - 1 + passage_words
        cuts["a"] = np.maximum(cuts["a"], kept)
        some = cuts["a"] < cuts["b"]
        cuts = {c: v[some] for c, v in cuts.items()}
    return cuts, {c: v[~after] for c, v in rows.items()}


def dealt(rows: dict[str, np.ndarray], kind: int, buckets: int, passage_words: int) -> Iterator[tuple]:
    """Packed rows of one part. What is surely later, whatever comes from other parts, is cut already: all runs after the
    part's first, and the blocks and stretches after one in another text."""
    order, first = first_of(rows)
    rows = {c: v[order] for c, v in rows.items()}
    other = (rows["d"] != rows["d"][first]) | (rows["k"] != rows["k"][first])
    gone = other | (rows["a"] != rows["a"][first]) if kind == RUN else other
    done = {c: v[gone] for c, v in rows.items()}
    if kind != RUN:
        done["b"] = done["a"] + done["b"] - 1 + passage_words
    bucket = (rows["key"] % np.uint64(buckets)).astype(np.int64)
    for what, which, these in ((CUT_RUN if kind == RUN else CUT_WORDS, bucket[gone], done),
                               (kind, bucket[~gone], {c: v[~gone] for c, v in rows.items()})):
        order = np.lexsort((these["d"], which))
        cut = np.flatnonzero(np.diff(which[order], prepend=-1))
        for x, y in zip(cut, [*cut[1:], len(order)]):
            part = {c: v[order[x:y]] for c, v in these.items()}
            yield int(which[order[x]]), what, int(y - x), pack(part)


def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows anew, as frames of about PART_CHARS characters of ``t``, one row at least."""
    held, chars = [], 0
    for frame in frames:
        lengths = frame["t"].str.len().to_numpy()
        start = 0
        for k, n in enumerate(lengths):
            chars += n
            if chars >= PART_CHARS:
                yield pd.concat([*held, frame.iloc[start:k + 1]])
                held, start, chars = [], k + 1, 0
        held.append(frame.iloc[start:])
    if sum(map(len, held)):
        yield pd.concat(held)


def packed(work):
    """A function for ``mapInPandas``: ``work`` on each part, which gives packed rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words()
        for part in parts(frames):
            rows = list(work(part, known))
            if rows:
                yield pd.DataFrame(rows, columns=["bucket", "kind", "n", "data"])
        del known
        give_back()

    return run


def find_runs(docs: DataFrame, buckets: int, passage_words: int | None) -> DataFrame:
    """Packed runs, and blocks of stretches of ``passage_words``, of all documents (d, k, t)."""

    def work(part: pd.DataFrame, known: Words) -> Iterator[tuple]:
        hashes, starts, texts_at = parse(part["t"].tolist(), known)
        d, k = part["d"].to_numpy(), part["k"].to_numpy()
        firsts = np.searchsorted(starts, texts_at)
        ends = np.append(starts[1:], len(hashes))[:len(starts)]
        a, b, key = spans(ends - starts, run_hashes(hashes, starts, ends), firsts)
        of = np.searchsorted(firsts, a, side="right") - 1
        yield from dealt({"key": key, "block": np.zeros(len(a), np.uint64), "d": d[of], "k": k[of], "a": a - firsts[of],
                          "b": b - firsts[of]}, RUN, buckets, 0)
        if passage_words is not None:
            anchor, block, begin, n = blocks_of(hashes, texts_at, passage_words)
            of = np.searchsorted(texts_at, begin, side="right") - 1
            yield from dealt({"key": anchor, "block": block, "d": d[of], "k": k[of], "a": begin - texts_at[of], "b": n},
                             BLOCK, buckets, passage_words)

    return docs.mapInPandas(packed(work), PACKED)


def find_stretches(opened: DataFrame, buckets: int, passage_words: int) -> DataFrame:
    """Packed single stretches of the opened blocks (d, k, t, data)."""

    def work(part: pd.DataFrame, known: Words) -> Iterator[tuple]:
        hashes, _, texts_at = parse(part["t"].tolist(), known)
        rows = {c: [] for c in ("d", "k", "a")}
        for d, k, data, first in zip(part["d"], part["k"], part["data"], texts_at):
            a, n = np.frombuffer(b"".join(data), "<i4").reshape(-1, 2).T
            at = np.unique(np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            for c, v in zip(rows, (np.full(len(at), d), np.full(len(at), k), at + first)):
                rows[c].append(v)
        rows = {c: np.concatenate(v) for c, v in rows.items()}
        key = run_hashes(hashes, rows["a"], rows["a"] + passage_words)
        rows["a"] = rows["a"] - texts_at[np.searchsorted(texts_at, rows["a"], side="right") - 1]
        yield from dealt({**rows, "key": key, "block": np.zeros(len(key), np.uint64), "b": np.ones(len(key), np.int64)},
                         STRETCH, buckets, passage_words)

    return opened.mapInPandas(packed(work), PACKED)


def resolve(rows: DataFrame, buckets: int, passage_words: int) -> DataFrame:
    """Of packed rows what is cut from each text, and which of its blocks must be opened: rows (d, k, kind, data), one for a
    text, kind and bucket."""

    def by_text(kind: int, rows: dict[str, np.ndarray]) -> pd.DataFrame:
        order = np.lexsort((rows["k"], rows["d"]))
        d, k = rows["d"][order], rows["k"][order]
        pairs = np.stack([rows["a"][order], rows["b"][order]], axis=1).astype("<i4")
        cut = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))) if len(d) else []
        raw = pairs.tobytes()
        return pd.DataFrame({"d": d[cut], "k": k[cut], "kind": np.int32(kind),
                             "data": [raw[x * 8:y * 8] for x, y in zip(cut, [*cut[1:], len(d)])]})

    def work(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, part in frame.groupby("kind"):
            rows = unpack(part["n"].tolist(), part["data"].tolist())
            if kind in (CUT_RUN, CUT_WORDS):
                out.append(by_text(kind, rows))
                continue
            cuts, rest = later(rows, kind, passage_words)
            out.append(by_text(CUT_RUN if kind == RUN else CUT_WORDS, cuts))
            if kind == BLOCK:  # blocks of anchors that have several: rows are in the order of anchors
                anchor, block = rest["key"], rest["block"]
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])) if len(anchor) else np.zeros(0, bool)
                rest = {c: v[new] for c, v in rest.items()}
                _, back, n = np.unique(rest["key"], return_inverse=True, return_counts=True)
                out.append(by_text(OPEN, {c: v[n[back] > 1] for c, v in rest.items()}))
        return pd.concat(out)

    return rows.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(work, FOUND)


def find_cuts(docs: DataFrame, passage_words: int | None) -> DataFrame:
    """What is cut from the documents (_span_d, _span_k, text): rows (d, k, kind, data)."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col("_span_d").alias("d"), F.col("_span_k").alias("k"), F.col("text").alias("t")).where("t <> ''")
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    # as many as a shuffle has partitions at least, so that small tables use all machines, too
    buckets = max(1 + chars // BUCKET_CHARS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = stored(resolve(find_runs(rows, buckets, passage_words), buckets, passage_words or 0), "substring-found")
    cuts = found.where(F.col("kind") != OPEN)
    if passage_words is None:
        return cuts
    opened = found.where(F.col("kind") == OPEN).groupBy("d", "k").agg(F.collect_list("data").alias("data"))
    stretches = find_stretches(rows.join(opened, ["d", "k"]), buckets, passage_words)
    return cuts.unionByName(stored(resolve(stretches, buckets, passage_words), "substring-stretches"))


def inside(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` items the runs (first, end) cover."""
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, runs[:, 0], 1)
    np.add.at(gone, runs[:, 1], -1)
    return np.cumsum(gone)[:-1] > 0


def remove(text: str, covered: np.ndarray, passages: np.ndarray, known: Words) -> tuple[str, int]:
    """The text without the units in the covered runs and the words of the passages, and how many units lost words."""
    _, starts, (_, n) = parse([text], known)
    unit = np.zeros(n, np.int64)
    unit[starts[1:]] = 1
    unit = np.cumsum(unit)
    gone = inside(covered, len(starts))[unit] | inside(passages, n)
    at = [m.start() for m in WORD.finditer(text)]
    at.append(len(text))
    # stretches of words that stay
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]])))
    kept = [text[at[x]:at[y]] for x, y in edge.reshape(-1, 2).tolist()]
    return "".join(kept).rstrip(), len(np.unique(unit[gone]))


def dedup(docs: DataFrame, passage_words: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text and any others without names in ``_span_*``) with repeated spans cut out of
    ``text``, and ``_span_removed``, the number of units that lost words."""
    least = F.lit(-(1 << 63)).cast("long")
    # the text's hash tells rows with one id apart; rows that agree in id and text are one occurrence
    keyed = docs.withColumn("_span_d", F.coalesce(F.col("doc_id").cast("long"), least)).withColumn("_span_k", F.hash("text"))
    data = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("data")))
    covered = (find_cuts(keyed, passage_words).groupBy(F.col("d").alias("_span_d"), F.col("k").alias("_span_k"))
               .agg(data(CUT_RUN).alias("_span_cut"), data(CUT_WORDS).alias("_span_words")))
    pairs = lambda x: np.frombuffer(b"".join(x), "<i4").reshape(-1, 2)

    @F.pandas_udf("text string, gone int")
    def cleaned(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = Words()
        for texts, runs, passages in batches:
            rows = [(t, 0) if r is None else remove(t, pairs(r), pairs(p), known) for t, r, p in zip(texts, runs, passages)]
            yield pd.DataFrame(rows, columns=["text", "gone"])
        del known
        give_back()

    cleaned = cleaned.asNondeterministic()  # else a filter on the result makes Spark cut every text twice
    joined = keyed.join(covered, ["_span_d", "_span_k"], "left").withColumn("_span_done", cleaned("text", "_span_cut", "_span_words"))
    return joined.select(*[F.col("_span_done.text").alias("text") if c == "text" else F.col(c) for c in docs.columns],
                         F.col("_span_done.gone").alias("_span_removed"))


def cut_repeats(docs: DataFrame, passage_words: int | None = None) -> DataFrame:
    """doc_id, text without repeated spans (and repeated passages), removed_units of every row."""
    return dedup(docs.select("doc_id", "text"), passage_words).withColumnRenamed("_span_removed", "removed_units")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, with all its columns, with repeated spans and passages cut out, ``n_chars`` set anew where text was cut, and
    without the rows that lost all of their text."""
    plain, back = shield(docs, "doc_id", "text", "n_chars")
    out = dedup(plain, PASSAGE_WORDS).where("_span_removed = 0 or text <> ''")
    length = F.length("text").cast(plain.schema["n_chars"].dataType)
    return back(out.withColumn("n_chars", F.when(F.col("_span_removed") > 0, length).otherwise(F.col("n_chars"))))
