"""Exact deduplication over a cuckoo-filter index of live digests.

A text's key is the SHA-256 of its normalised form (every character of ``[\\x20\\x09-\\x0D]`` deleted). Keys are
dealt to shards by their first bits. A shard holds a cuckoo filter (buckets of four 16-bit fingerprints, a
key's second bucket is its first XOR a hash of the fingerprint) and its content, the whole keys with what is
known of their texts, in buckets of the keys' leading bits. A key that the filter does not hold is new and
goes into both; a hit is verified against the whole keys of its content bucket, since fingerprints of
different keys may agree. When an insertion finds no free slot after many moves, the filter is built anew,
twice as large, from the stored keys. Deletion takes a key out of the content and one fingerprint out of
the filter, so the text counts as unseen again.

``DigestIndex`` keeps both in the shared folder as versions: a batch writes a new one, and a pointer to it
when it is whole, so a batch that fails or is repeated leaves the index as it was. A
version whose shards have grown past their size is dealt to twice as many, from the stored keys.

Rows are folded before they are shuffled: the equal texts of one input partition become one entry (key,
partition, rows, best row), so a text that makes up a third of a table reaches its shard once a partition.
The index answers every entry, and the answers go back to the rows by (key, partition), which no text can
make hot. Shards are as many as entries need; a task holds one shard's batch at a time.

Definitions: null text counts as empty, and all texts of white space alone are equal to it. Of equal texts the
row with the most code points in the original text stays, then the one with the smallest doc_id (a null
doc_id after all others), then the first in the table's order; of repeated rows one stays. An empty table
has no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import scratch, stored

#: The characters that do not tell texts apart: fixed values.
WHITE = " \t\n\x0b\f\r"
SLOTS = 4
MAX_MOVES = 200
#: Entries of a batch and live keys that a shard holds about.
SHARD_KEYS = 50_000
FIRST_BUCKETS = 256

#: Entries that go into a shard at a time.
CHUNK = 8192
#: A missing doc_id, and the place of a row of a former batch.
NO_ID, FORMER = np.iinfo(np.int64).max, -1

COLUMNS = ("rows", "n_chars", "rid", "doc_id")
#: Kinds of the rows of a shard: saved keys, the saved filter (its slots as ``key``), answers, entries, deletions, questions.
CONTENT, FILTER, ANSWER, ENTRY, GONE, ASK = range(6)
_STATE = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("key", pa.binary()), ("part", pa.int64()), ("rows", pa.int64()),
                    ("n_chars", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("known", pa.bool_())])
STATE = "shard int, kind int, key binary, part long, rows long, n_chars long, rid long, doc_id long, known boolean"


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Overflow(Exception):
    """No free slot after ``MAX_MOVES`` rounds of moves."""


class CuckooFilter:
    """Fingerprints of distinct 64-bit hashes in ``buckets`` (a power of two) of four slots; 0 is a free slot."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        if buckets & (buckets - 1) or buckets < 1:
            raise ValueError("the number of buckets must be a power of two")
        self.mask = np.uint64(buckets - 1)
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots.reshape(buckets, SLOTS)

    @property
    def buckets(self) -> int:
        return len(self.slots)

    def placed(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each hash."""
        mark = (hashes >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = hashes & self.mask
        return mark, first, self.other(first, mark)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return (bucket ^ _mixed(mark.astype(np.uint64))) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        mark, first, second = self.placed(hashes)
        return ((self.slots[first] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)

    def _settle(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts marks into free slots of their buckets; which of them found none."""
        order = np.argsort(bucket, kind="stable")
        mine = bucket[order]
        new = np.concatenate([[True], mine[1:] != mine[:-1]])
        place = np.arange(len(mine)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        free = self.slots[mine] == 0
        fits = place < free.sum(axis=1)
        # the slot of the place-th free one in a bucket
        slot = np.argmax(np.cumsum(free, axis=1) == (place + 1)[:, None], axis=1)
        self.slots[mine[fits], slot[fits]] = mark[order][fits]
        left = np.zeros(len(mark), bool)
        left[order[~fits]] = True
        return left

    def insert(self, hashes: np.ndarray) -> None:
        """All of the hashes, none of which is held; raises Overflow, and the filter must then be built anew."""
        mark, first, second = self.placed(hashes)
        if not len(mark):
            return
        left = self._settle(mark, first)
        mark, bucket = mark[left], second[left]
        for move in range(MAX_MOVES):
            if not len(mark):
                return
            left = self._settle(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return
            # one mark a bucket takes the place of one that lies there, which moves to its other bucket
            _, one = np.unique(bucket, return_index=True)
            slot = (move + np.arange(len(one))) % SLOTS
            moved = self.slots[bucket[one], slot].copy()
            self.slots[bucket[one], slot] = mark[one]
            mark[one] = moved
            bucket[one] = self.other(bucket[one], moved)
        raise Overflow

    def delete(self, hashes: np.ndarray) -> None:
        """One fingerprint of each of the hashes, all of which must be held."""
        for mark, *two in zip(*self.placed(hashes)):
            for b in two:
                at = np.flatnonzero(self.slots[b] == mark)
                if len(at):
                    self.slots[b, at[0]] = 0
                    break


def words_of(column: pa.ChunkedArray) -> np.ndarray:
    """Keys of 32 bytes as rows of four 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(-1, 4).astype(np.uint64)


def bytes_of(keys: np.ndarray) -> pa.Array:
    flat = pa.py_buffer(keys.astype(">u8").tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(keys), [None, flat]).cast(pa.binary())


@dataclass
class Shard:
    """A filter, which goes by the last word of a key, and the content: whole keys in the order of their second word,
    with columns beside them."""

    filter: CuckooFilter = field(default_factory=lambda: CuckooFilter(FIRST_BUCKETS))
    keys: np.ndarray = field(default_factory=lambda: np.zeros((0, 4), np.uint64))
    columns: dict[str, np.ndarray] = field(default_factory=lambda: {c: np.zeros(0, np.int64) for c in COLUMNS})
    resized: int = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the content, -1 for none: the filter first, then the whole keys of a hit's content
        bucket, those with the same second word."""
        at = np.full(len(keys), -1)
        hit = np.flatnonzero(self.filter.contains(keys[:, 3]))
        low = np.searchsorted(self.keys[:, 1], keys[hit, 1], "left")
        high = np.searchsorted(self.keys[:, 1], keys[hit, 1], "right")
        while len(hit):
            there = low < high
            hit, low, high = hit[there], low[there], high[there]
            same = (self.keys[low] == keys[hit]).all(axis=1)
            at[hit[same]] = low[same]
            hit, low, high = hit[~same], low[~same] + 1, high[~same]
        return at

    def add(self, keys: np.ndarray, columns: dict[str, np.ndarray]) -> None:
        """Distinct keys that the content does not hold."""
        both = np.concatenate([self.keys, keys])
        where = np.argsort(both[:, 1], kind="stable")
        self.keys = both[where]
        self.columns = {c: np.concatenate([self.columns[c], columns[c]])[where] for c in COLUMNS}
        try:
            self.filter.insert(keys[:, 3])
        except Overflow:
            self.rebuild(2 * self.filter.buckets)

    def rebuild(self, buckets: int) -> None:
        """The filter anew from the stored keys, with as many buckets as they need at least, and more until all fit."""
        while buckets * SLOTS < len(self.keys):
            buckets *= 2
        while True:
            self.resized += 1
            self.filter = CuckooFilter(buckets)
            try:
                return self.filter.insert(self.keys[:, 3])
            except Overflow:
                buckets *= 2

    def remove(self, keys: np.ndarray) -> None:
        """Keys that are held go out of both; others are passed over."""
        at = self.find(keys)
        at = np.unique(at[at >= 0])
        self.filter.delete(self.keys[at, 3])
        self.keys = np.delete(self.keys, at, axis=0)
        self.columns = {c: np.delete(v, at) for c, v in self.columns.items()}

    def merge(self, keys: np.ndarray, columns: dict[str, np.ndarray]) -> None:
        """Entries, several of a key perhaps: their rows are added up, and of all rows the best stays."""
        if not len(keys):
            return
        order = np.lexsort((columns["rid"], columns["doc_id"], -columns["n_chars"], *keys.T[::-1]))
        mine = keys[order]
        first = np.flatnonzero(np.concatenate([[True], (mine[1:] != mine[:-1]).any(axis=1)]))
        one = {c: v[order][first] for c, v in columns.items()}
        one["rows"] = np.add.reduceat(columns["rows"][order], first)
        at = self.find(mine[first])
        held = at >= 0
        coming, place = {c: v[held] for c, v in one.items()}, at[held]
        self.columns["rows"][place] += coming["rows"]
        wins = better(coming, {c: v[place] for c, v in self.columns.items()})
        for c in ("n_chars", "doc_id", "rid"):
            self.columns[c][place[wins]] = coming[c][wins]
        if not held.all():
            self.add(mine[first][~held], {c: v[~held] for c, v in one.items()})


def better(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> np.ndarray:
    """Where the row of ``a`` stays before that of ``b``: more code points, smaller doc_id, earlier."""
    return ((a["n_chars"] > b["n_chars"]) | (a["n_chars"] == b["n_chars"])
            & ((a["doc_id"] < b["doc_id"]) | (a["doc_id"] == b["doc_id"]) & (a["rid"] < b["rid"])))


def numbers(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table.column(c).to_numpy().astype(np.int64) for c in ("rows", "n_chars", "rid")}
    out["doc_id"] = table.column("doc_id").fill_null(NO_ID).to_numpy().astype(np.int64)
    return out


def load(content: pa.Table, filters: pa.Table) -> Shard:
    """A shard as it was saved; without a saved filter (its keys were dealt anew) one is built from the keys. Rows of
    former batches come before those of this one."""
    shard = Shard()
    if content.num_rows:
        keys = words_of(content.column("key"))
        where = np.argsort(keys[:, 1], kind="stable")
        shard.keys = keys[where]
        shard.columns = {c: v[where] for c, v in numbers(content).items()}
        shard.columns["rid"][:] = FORMER
    if filters.num_rows:
        slots = np.frombuffer(filters.column("key")[0].as_py(), np.uint16).copy()
        shard.filter = CuckooFilter(len(slots) // SLOTS, slots)
    elif len(shard.keys):
        shard.rebuild(FIRST_BUCKETS)
    return shard


def worked(table: pa.Table) -> pa.Table:
    """One shard's saved rows and its batch (deletions, then questions, then entries) -> its new state and the
    answers, as rows of ``STATE``."""
    kind = table.column("kind").to_numpy()
    part = {k: table.filter(pa.array(kind == k)) for k in range(6)}
    number = table.column("shard")[0].as_py()
    shard = load(part[CONTENT], part[FILTER])
    if part[GONE].num_rows:
        shard.remove(words_of(part[GONE].column("key")))

    def rows(k: int, n: int, **given) -> pa.Table:
        given |= {"shard": pa.array(np.full(n, number, np.int32)), "kind": pa.array(np.full(n, k, np.int32))}
        return pa.table({f.name: given.get(f.name, pa.nulls(n, f.type)) for f in _STATE}, schema=_STATE)

    def texts(k: int, keys: np.ndarray, at: np.ndarray, **more) -> pa.Table:
        """What is known of the keys that lie ``at`` places of the content; nothing where that is -1."""
        none = at < 0
        if len(shard.keys):
            of = {c: pa.array(v[at], mask=none | (v[at] == NO_ID) if c == "doc_id" else none) for c, v in shard.columns.items()}
        else:
            of = {}
        return rows(k, len(keys), key=bytes_of(keys), **of, **more)

    def answers(batch: pa.Table, keys: np.ndarray, before: np.ndarray) -> pa.Table:
        return texts(ANSWER, keys, shard.find(keys), part=batch.column("part").combine_chunks(), known=pa.array(before >= 0))

    asked = words_of(part[ASK].column("key"))
    out = [answers(part[ASK], asked, shard.find(asked))]
    keys, columns = words_of(part[ENTRY].column("key")), numbers(part[ENTRY])
    before = shard.find(keys)
    for a in range(0, len(keys), CHUNK):
        shard.merge(keys[a:a + CHUNK], {c: v[a:a + CHUNK] for c, v in columns.items()})
    out += [answers(part[ENTRY], keys, before), texts(CONTENT, shard.keys, np.arange(len(shard.keys))),
            rows(FILTER, 1, key=pa.array([shard.filter.slots.tobytes()], pa.binary()))]
    return pa.concat_tables(out)


class DigestIndex:
    """The index in ``path`` of the shared folder. ``insert`` and ``delete`` write a new version."""

    def __init__(self, spark: SparkSession, path: str, shard_keys: int = SHARD_KEYS):
        self.spark, self.path, self.shard_keys = spark, path.rstrip("/"), shard_keys

    def pointer(self) -> tuple[int, int, int, str | None]:
        """Number, shards, live keys and folder of the version that holds: the last one whose pointer is whole."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(f"{self.path}/versions")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        there = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
        whole = [p.getName() for p in there if fs.exists(path(p, "_SUCCESS"))]
        if not whole:
            return 0, 1, 0, None
        row = self.spark.read.schema(POINTER).json(f"{self.path}/versions/{max(whole)}").first()
        return int(max(whole)), row["shards"], row["live"], row["version"]

    def state(self) -> DataFrame:
        """Content and filters of the version that holds."""
        version = self.pointer()[3]
        if version is None:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(version).where(F.col("kind").isin(CONTENT, FILTER))

    def live(self) -> DataFrame:
        """The live keys: key, rows, n_chars, doc_id (of the row that stays)."""
        return self.state().where(F.col("kind") == CONTENT).select("key", "rows", "n_chars", "doc_id")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Per row of ``keys`` (key) keep_id, group_size and ``known``, whether its text is live. The index stays as it is."""
        rows = keys.select("key", F.lit(None).cast("long").alias("part"), F.lit(ASK).alias("kind"))
        return _answers(self._run(rows, self.pointer()[1])).select("key", "keep_id", "group_size", "known")

    def insert(self, entries: DataFrame) -> DataFrame:
        """Entries (key, part, rows, n_chars, rid, doc_id) go in; the answers (key, part, keep_rid, keep_id, group_size,
        known) say for each which row of its text stays (a null or other keep_rid: one of a former batch), how many
        rows it has, and whether its text was live before this batch."""
        return _answers(self._write(entries.withColumn("kind", F.lit(ENTRY)), entries.count()))

    def delete(self, keys: DataFrame) -> None:
        """The texts with these keys (key) are no longer live."""
        self._write(keys.select("key").distinct().withColumn("kind", F.lit(GONE)), 0)

    def _run(self, batch: DataFrame, shards: int) -> DataFrame:
        state = self.state()
        if shards != self.pointer()[1]:  # dealt anew from the stored keys; their filters are of no use then
            state = state.where(F.col("kind") == CONTENT).withColumn("shard", shard_of("key", shards))
        batch = batch.withColumn("shard", shard_of("key", shards))
        both = state.unionByName(batch, allowMissingColumns=True).select(*_STATE.names)
        return both.repartition(shards, "shard").groupBy("shard").applyInArrow(worked, STATE)

    def _write(self, batch: DataFrame, coming: int) -> DataFrame:
        number, shards, live, _ = self.pointer()
        needed = 1 << max(0, math.ceil(math.log2(max(1, (live + coming) / self.shard_keys))))
        shards = max(shards, needed)
        version = scratch(self.spark, "digest-index")
        self._run(batch, shards).write.option("compression", "zstd").parquet(version)
        out = self.spark.read.schema(STATE).parquet(version)
        live = out.where(F.col("kind") == CONTENT).count()
        self.spark.createDataFrame([(shards, live, version)], POINTER).coalesce(1).write.json(f"{self.path}/versions/{number + 1:09d}")
        return out


POINTER = "shards int, live long, version string"


def _answers(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") == ANSWER).select("key", "part", F.col("rid").alias("keep_rid"), F.col("doc_id").alias("keep_id"),
                                                      F.col("rows").alias("group_size"), "known")


def shard_of(key: str, shards: int) -> Column:
    """A shard by the first word of the key, which neither the filter nor the content's buckets use."""
    return F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long").bitwiseAND(shards - 1).cast("int")


def normalised(text: Column) -> Column:
    """The text without white space; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_chars, rid (unique), part of every row; stored, so that numbers of rows stay."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("key"),
                       F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
                       F.monotonically_increasing_id().alias("rid"))
    return stored(rows.withColumn("part", F.shiftright("rid", 33)), "digests")


def entries(rows: DataFrame) -> DataFrame:
    """The equal texts of a partition as one entry, the row that stays among them first."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.coalesce("doc_id", F.lit(NO_ID).cast("long")).alias("d"), "rid", "doc_id"))
    return (rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("rows"), best.alias("b"))
            .select("key", "part", "rows", (-F.col("b.n")).alias("n_chars"), "b.rid", "b.doc_id"))


def dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Inserts ``docs`` (doc_id, text) into the index (a new one by default) and returns per row doc_id, keep_id,
    group_size, kept, text_sha256, and whether the index held the text before. With rows of former batches in
    the index, a row of theirs may be the one that stays."""
    spark = docs.sparkSession
    index = index or DigestIndex(spark, scratch(spark, "digests-live"))
    rows = keyed(docs)
    answers = index.insert(stored(entries(rows), "digest-entries"))
    return (rows.join(answers, ["key", "part"])
            .select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    F.lower(F.hex("key")).alias("text_sha256"), "known"))
