"""Set-similarity self-join on word shingles by chosen paths.

Texts become sets of hashed shingles (five lower-case words). Texts with equal sets are one class, held by
its smallest doc_id, so copies never meet each other. Each set is embedded as min-hash values. A run of the
join splits all sets recursively: a bucket, named by the path that led to it, chooses some of the embedding's
coordinates by its own hash, and its sets that share a value there go on together. Small buckets, and those
that splitting no longer divides, are compared by brute force on their embeddings. Runs are repeated until
the chance that a pair at the threshold meets in none of them is below 1 - recall.

Similar sets of a bucket become links of a spanning forest (never all pairs). The connected groups of these
candidates are then compared exactly on their whole shingle sets, in blocks of bounded size, so that large
groups are dealt over many tasks and every pair in a group is verified. The result has one row per document
with its group and its number of links, never a row per pair.

Definitions: words are runs of letters and digits, lower-case. A text of fewer words than a shingle but at
least one has one shingle, all of its words; a text without words (null, empty) has no links and is its own
group. Similarity equal to the threshold links. Rows with equal doc_id are one document; of different texts
the one whose set's name sorts first counts. A document's group is named by the smallest doc_id that links
reach. Rows with a null doc_id take no part. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import by_group, give_back, shield, stored, text_batches
from kerbside.llm.components import connected

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
COORDINATES = 64
#: Coordinates that a bucket chooses, and depth after which its sets are compared anyway.
CHOSEN = 2
DEPTH = 3
#: Sets of a bucket that are compared without splitting, embeddings of a block of a larger one, and whole sets of
#: a block of a candidate group.
SMALL, BLOCK, EXACT_BLOCK = 256, 512, 128
#: Average similarity of a bucket's sets from which they are compared rather than split.
TIGHT = 0.3
#: Estimated similarity (share of equal min-hash values) from which sets become candidates: more than three
#: standard errors below the threshold at 64 coordinates.
CANDIDATE = 0.62

WORD = re.compile(r"[^\W_]+")
_RNG = np.random.default_rng(20240807)
_MULTIPLY = _RNG.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 62, COORDINATES, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hash of a word; starts anew when it has grown large."""

    MOST = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, words: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    found = WORD.findall(text.lower()) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = min(size, len(h))
    with np.errstate(over="ignore"):
        total = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(total)]
    return np.unique(mix(total))


def key_of(hashes: np.ndarray) -> bytes:
    """Names a set of shingles."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def embed(hashes: np.ndarray) -> np.ndarray:
    """Min-hash values, 16 bits each."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):
            part = hashes[at:at + 4096, None] * _MULTIPLY + _ADD
            low = np.minimum(low, part.min(axis=0))
    return (mix(low) & np.uint64(0xFFFF)).astype(np.uint16)


def embedded(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), set_key (hash of the set) and sketch of every document."""
    text_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for frame in frames:
            sets = [shingles(t, words) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "n": [len(s) for s in sets],
                "set_key": [key_of(s) for s in sets],
                "sketch": [embed(s).tobytes() if len(s) else b"" for s in sets]})
        del words
        give_back()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
            .mapInPandas(run, "doc_id long, n int, set_key binary, sketch binary"))


class Forest:
    """Links that join groups of numbered items as they come."""

    def __init__(self, n: int):
        self.group, self.links = np.arange(n), []

    def add(self, i: int, near: np.ndarray) -> None:
        """``i`` is similar to each of ``near``: one link to each of their groups."""
        groups, at = np.unique(self.group[near], return_index=True)
        other = groups != self.group[i]
        if other.any():
            self.links += [(int(near[k]), i) for k in at[other]]
            self.group[np.isin(self.group, np.append(groups, self.group[i]))] = groups.min()


def similar_forest(sketches: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that connect the sets whose embeddings agree in at least ``least`` of the coordinates."""
    forest = Forest(len(sketches))
    need = math.ceil(least * sketches.shape[1])
    for i in range(1, len(sketches)):
        near = np.flatnonzero((sketches[:i] == sketches[i]).sum(axis=1) >= need)
        if len(near):
            forest.add(i, near)
    return forest.links


def runs_needed(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has been missed with a chance below 1 - recall, if its buckets
    are split to the full depth."""
    meets = (1 - (1 - threshold) ** CHOSEN) ** DEPTH
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def split(rows: DataFrame) -> DataFrame:
    """(path, id, sketch) to (path, id) of the buckets below: each bucket's own hash chooses CHOSEN of the
    coordinates, and a coordinate's value names the bucket below."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = (np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D))[None, :]
        for frame in frames:
            if not len(frame):
                continue
            path = frame["path"].to_numpy().astype(np.int64).view(np.uint64)
            sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint16).reshape(len(frame), COORDINATES)
            paths, which = np.unique(path, return_inverse=True)
            chosen = np.argsort(mix(paths[:, None] + steps), axis=1, kind="stable")[:, :CHOSEN][which]
            values = np.take_along_axis(sketches, chosen, axis=1).astype(np.uint64)
            below = mix(mix(path[:, None] + chosen.astype(np.uint64)) ^ (values + np.uint64(1)) * np.uint64(0x2545F4914F6CDD1D))
            yield pd.DataFrame({"path": below.ravel().view(np.int64), "id": np.repeat(frame["id"].to_numpy(), CHOSEN)})

    return rows.select("path", "id", "sketch").mapInPandas(run, "path long, id long")


def in_blocks(rows: DataFrame, count: str, key: str, block: int = BLOCK) -> DataFrame:
    """Deals groups of more than ``block`` rows into pairs of blocks (``first``, ``second``), so that every two
    rows of a group meet in one task of about two blocks, whatever the group's size; ``own`` is a row's block."""
    n = F.ceil(F.col(count) / F.lit(block)).cast("int")
    return (rows.withColumn("_n", n)
            .withColumn("own", F.when(F.col("_n") > 1, F.pmod(F.xxhash64(F.col(key)), F.col("_n")).cast("int")).otherwise(0))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
            .withColumn("first", F.least("own", "_other")).withColumn("second", F.greatest("own", "_other"))
            .drop("_n", "_other"))


def compare(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between similar embeddings of each bucket: rows are (path, id, count)."""
    dealt = in_blocks(rows, "count", "id").drop("own").join(sets, "id")

    def work(cols: dict) -> tuple | None:
        ids = cols["id"]
        if len(ids) < 2:
            return None
        links = similar_forest(np.frombuffer(b"".join(cols["sketch"]), np.uint16).reshape(len(ids), -1), CANDIDATE)
        return [int(ids[a]) for a, _ in links], [int(ids[b]) for _, b in links]

    return by_group(dealt.select("path", "first", "second", "id", "sketch"), ["path", "first", "second"], work,
                    "a long, b long")


def tight(big: DataFrame) -> DataFrame:
    """Paths whose sets are alike already, so that splitting would not divide them: the average share of equal
    values, over pairs of the bucket, at a few coordinates."""
    probes = range(0, COORDINATES, COORDINATES // 4)
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.substring("sketch", 2 * c + 1, 2).alias("v"))
                                 for c in probes]))
    return (big.select("path", "count", values.alias("x")).groupBy("path", "count", "x").agg(F.count("*").alias("m"))
            .groupBy("path").agg((F.sum(F.col("m") * F.col("m")) / (len(probes) * F.first("count") * F.first("count")))
                                 .alias("alike")).where(F.col("alike") >= TIGHT).select("path"))


def candidate_links(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Links (a, b) that connect similar sets: chosen-path runs over (id, sketch)."""
    roots = mix(np.arange(1, runs_needed(threshold, recall) + 1, dtype=np.uint64)).view(np.int64)
    rows = sets.select(F.explode(F.array(*[F.lit(int(v)) for v in roots])).alias("path"), "id", "sketch")
    links = None
    for depth in range(1, DEPTH + 1):
        below = stored(split(rows), "join-paths")
        sizes = stored(below.groupBy("path").count().where("count > 1"), "join-sizes")
        shared = stored(below.join(sizes, "path"), "join-buckets")
        big = shared.where(F.col("count") > SMALL)
        last = depth == DEPTH or big.isEmpty()
        if last:
            ready = shared
        else:
            alike = stored(tight(big.join(sets, "id")), "join-tight")
            ready = (shared.where(F.col("count") <= SMALL)
                     .unionByName(big.join(alike, "path").select(*big.columns)))
            rows = big.join(alike, "path", "left_anti").join(sets, "id").select("path", "id", "sketch")
        found = stored(compare(ready, sets).distinct(), "join-links")
        links = found if links is None else links.unionByName(found)
        if last:
            break
    return links


def exact_block(cols: dict, threshold: float) -> tuple | None:
    """Exact links between the rows of a block, or across two: for each row the documents linked to it (copies
    counted) and its links in a spanning forest."""
    ids, first = np.unique(cols["id"], return_index=True)  # rows that share a doc_id and a text are one
    n = len(ids)
    if n < 2:
        return None
    sets = [np.frombuffer(cols["hashes"][k], np.uint64) for k in first]
    size, copies, own = np.array([len(s) for s in sets]), cols["copies"][first], cols["own"][first]
    values, rows = np.concatenate(sets), np.repeat(np.arange(n), size)
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    several = times > 1  # a shingle of one set adds to no intersection
    use = several[place]
    columns, rows = (np.cumsum(several) - 1)[place[use]], rows[use]
    order = np.argsort(columns, kind="stable")
    columns, rows = columns[order], rows[order]
    common = np.zeros((n, n), np.float32)
    total = int(several.sum())
    width = max(1, min(total, 4_000_000 // n))
    for at in range(0, total, width):
        lo, hi = np.searchsorted(columns, [at, at + width])
        dense = np.zeros((n, width), np.float32)
        dense[rows[lo:hi], columns[lo:hi] - at] = 1
        common += dense @ dense.T
    both = common.astype(np.int64)  # counts below 2**24 are exact in float32
    union = size[:, None] + size[None, :] - both
    linked = both >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    if cols["first"][0] != cols["second"][0]:
        linked &= own[:, None] != own[None, :]
    forest = Forest(n)
    for i in range(1, n):
        near = np.flatnonzero(linked[i, :i])
        if len(near):
            forest.add(i, near)
    to: list[list[int]] = [[] for _ in range(n)]
    for a, b in forest.links:
        to[b].append(int(ids[a]))
    return [int(i) for i in ids], [int(v) for v in (linked * copies[None, :]).sum(axis=1)], to


def verify(docs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Exact links inside candidate groups. ``members``: id, copies, set_key, candidate. A row per set and block:
    id, linked (documents, copies counted), to (its links in the block's forest)."""
    sizes = stored(members.groupBy("candidate").count(), "join-groups")
    wanted = members.join(sizes, "candidate")
    rows = docs.join(wanted, docs["doc_id"] == wanted["id"]).select("candidate", "id", "copies", "count", "text", "set_key")

    def sets_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for frame in frames:
            sets = [shingles(t, words) for t in frame.pop("text")]
            own = [key_of(s) == bytes(k) for s, k in zip(sets, frame.pop("set_key"))]
            frame["hashes"] = [s.tobytes() for s in sets]
            yield frame[own]
        del words
        give_back()

    sets = rows.mapInPandas(sets_of, "candidate long, id long, copies long, count long, hashes binary")
    keys = ["candidate", "first", "second"]
    return by_group(in_blocks(sets, "count", "id", EXACT_BLOCK).select(*keys, "own", "id", "copies", "hashes"), keys,
                    lambda cols: exact_block(cols, threshold), "id long, linked long, to array<long>")


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its group), n_links (other documents with
    similarity at least ``threshold``) and set_id (smallest doc_id with an equal set)."""
    one = embedded(docs).groupBy("doc_id").agg(F.min(F.struct("set_key", "n", "sketch")).alias("s"))
    sketched = stored(one.select("doc_id", "s.*"), "jaccard-sketches")
    some = sketched.where("n > 0")
    classes = stored(some.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"),
                                                 F.min("sketch").alias("sketch")), "jaccard-classes")
    candidates = candidate_links(classes.select("id", "sketch"), threshold, recall)
    groups = connected(candidates)  # id, component
    members = (classes.join(groups, "id").select("id", "copies", "set_key", F.col("component").alias("candidate")))
    members = stored(members, "jaccard-members")
    found = stored(verify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), members, threshold),
                   "jaccard-links")
    final = connected(found.select(F.explode("to").alias("a"), F.col("id").alias("b")))
    counts = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    by_set = (classes.join(final, "id", "left").join(counts, "id", "left")
              .select("set_key", "id", F.coalesce("component", "id").alias("class_id"),
                      (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")))
    return (sketched.join(by_set, "set_key", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("id", "doc_id").alias("set_id")))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which no similar document has a smaller doc_id. Rows
    without doc_id stay; of rows that share one, the one with the smallest text stays (null first)."""
    kept = join(docs, threshold).where("doc_id = class_id").select(F.col("doc_id").alias("kept_id"))
    plain, back = shield(docs, "doc_id", "text")
    own = plain.join(kept, plain["doc_id"].cast("long") == kept["kept_id"]).groupBy("kept_id").agg(
        F.min_by(F.struct(*plain.columns), F.struct("text")).alias("row"))
    return back(own.select("row.*").unionByName(plain.where("doc_id is null")))
