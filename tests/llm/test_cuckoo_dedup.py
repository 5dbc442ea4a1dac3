"""Exact dedup over the digest index against a dictionary, and the filter alone."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_tables import documents, frame
from pyspark.sql import functions as F

from kerbside.llm import cuckoo_dedup as C
from kerbside.llm.common import scratch

WHITE = re.compile(r"[\x20\x09-\x0D]")


def digest(text):
    return hashlib.sha256(WHITE.sub("", text or "").encode()).hexdigest()


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(digest(r[1]), []).append(r)
    out = []
    for sha, members in groups.items():
        members.sort(key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], members[0][0], len(members), k == 0, sha) for k, r in enumerate(members)]
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


CASES = [(500, "a b", None, None, None), (501, "ab", None, None, None), (502, "a\tb\n", None, None, None), (503, "a b", None, None, None),
         (504, "a b", None, None, None), (505, "\x0b\x0c", None, None, None), (506, "A b", None, None, None),
         (507, "é", None, None, None), (508, "é", None, None, None), (None, "a b ", None, None, None), (509, "a b ", None, None, None)]


def test_equals_dictionary(spark):
    rows = documents(60) + CASES
    got = C.dedup(frame(spark, rows, clash=True).repartition(5)).drop("known")
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)


def test_hot_text_and_many_shards(spark):
    rng = random.Random(3)
    rows = [(i, "the same text" if i % 3 == 0 else f"text {rng.randint(0, 400)}" + " " * rng.randint(0, 3), None, None, None)
            for i in range(1500)]
    index = C.DigestIndex(spark, scratch(spark, "test-index"), shard_keys=50)
    got = C.dedup(frame(spark, rows).repartition(6), index).drop("known").collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows), key=key)
    assert index.pointer()[1] > 4


def test_empty_table(spark):
    assert C.dedup(frame(spark, [])).count() == 0


def test_batches_deletion_and_lookup(spark):
    index = C.DigestIndex(spark, scratch(spark, "test-index"), shard_keys=40)
    first = [(i, f"one {i}", None, None, None) for i in range(100)]
    second = [(i, f"one  {i}" if i < 150 else f"two {i}", None, None, None) for i in range(50, 250)]
    C.dedup(frame(spark, first), index)
    assert index.pointer()[2] == 100
    got = {r.doc_id: r for r in C.dedup(frame(spark, second), index).collect()}
    assert all(got[i].known == (i < 100) for i in got)
    assert all(got[i].kept and got[i].keep_id == i for i in got)  # the second's texts are longer by one space
    assert all(got[i].group_size == (2 if i < 100 else 1) for i in got)
    assert index.live().count() == 250
    keys = C.keyed(frame(spark, second)).select("key")
    index.delete(keys)
    assert index.live().count() == 50
    asked = index.lookup(C.keyed(frame(spark, first)).select("key"))
    assert asked.where("known").count() == 50 and asked.where("not known and keep_id is null").count() == 50
    again = C.dedup(frame(spark, second[:30]), index).collect()
    assert all(r.group_size == 1 and r.kept and not r.known for r in again)


def test_row_of_a_former_batch_stays(spark):
    index = C.DigestIndex(spark, scratch(spark, "test-index"))
    C.dedup(frame(spark, [(7, "a  b", None, None, None)]), index)
    got = C.dedup(frame(spark, [(3, "ab", None, None, None), (7, "a  b", None, None, None)]), index).collect()
    assert [(r.keep_id, r.kept, r.group_size) for r in got] == [(7, False, 3)] * 2


def random_hashes(n, seed):
    return np.random.default_rng(seed).integers(0, (1 << 64) - 1, n, dtype=np.uint64)


def test_filter_holds_what_is_inserted_and_forgets_what_is_deleted():
    f, hashes = C.CuckooFilter(1024), random_hashes(3600, 1)
    for a in range(0, 3600, 300):
        f.insert(hashes[a:a + 300])
    assert f.contains(hashes).all() and (f.slots > 0).sum() == 3600
    assert f.contains(random_hashes(20000, 2)).mean() < 0.002
    f.delete(hashes[:1800])
    assert f.contains(hashes[1800:]).all() and (f.slots > 0).sum() == 1800
    assert f.contains(hashes[:1800]).mean() < 0.01
    with pytest.raises(C.Overflow):
        C.CuckooFilter(64).insert(random_hashes(300, 3))
    with pytest.raises(ValueError):
        C.CuckooFilter(100)


def test_shard_resizes_from_stored_keys_and_verifies_hits():
    rng = np.random.default_rng(5)
    shard = C.Shard()
    keys = rng.integers(0, 1 << 63, (9000, 4), dtype=np.uint64)
    columns = lambda n: {"rows": np.ones(n, np.int64), "n_chars": np.arange(n), "rid": np.arange(n), "doc_id": np.arange(n)}
    for a in range(0, 9000, 1000):
        shard.merge(keys[a:a + 1000], columns(1000))
    assert shard.resized >= 3 and len(shard.keys) == 9000
    assert (shard.keys[shard.find(keys)] == keys).all()
    false = keys[:500].copy()
    false[:, 0] += np.uint64(1)  # same fingerprint, bucket and second word, another key
    assert shard.filter.contains(false[:, 3]).all() and (shard.find(false) == -1).all()
    shard.remove(np.concatenate([keys[:4000], false]))
    assert (shard.find(keys[:4000]) == -1).all() and (shard.find(keys[4000:]) >= 0).all()


def test_every_text_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = C.dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows), key=key)
    assert docs.join(C.dedup(docs).where("kept").select(F.col("doc_id").alias("d")), F.col("doc_id") == F.col("d")).count() == len({digest(r[1]) for r in rows})
