"""Merkle manifest against a plain reading of its definition."""

import hashlib
import zlib

import pytest
from llm_tables import DOCS, documents, frame
from pyspark.sql import functions as F

from kerbside.llm import merkle
from kerbside.llm.common import cut_key


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, arity):
    """Root of a list of digests, and per leaf its proof as (left, right) by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            first = k - k % arity
            run = nodes[first:first + arity]
            proofs[i].append(("".join(run[:k - first]), "".join(run[k - first + 1:])))
        nodes = [H(*nodes[k:k + arity]) for k in range(0, len(nodes), arity)]
        at = [k // arity for k in at]
    return nodes[0], proofs


def expected(rows, arity):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r, leaf(r, r[1])))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    done = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        done[name] = climb([x[1] for x in trees[name]], arity)
    root, tops = climb([done[n][0] for n in names], arity) if names else (None, [])
    out = []
    for name, top in zip(names, tops):
        for (r, h), path in zip(trees[name], done[name][1]):
            text, path = r[1], path + top
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf(r, text)
            for a, b in path:
                now = H(a, now, b)
            out.append((r[0], h, done[name][0], root, H(*[a + b for a, b in path]), now, now == root))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_equals_definition(spark, arity):
    rows = documents(70)
    got = merkle.verify(frame(spark, rows, clash=True), cut_key() % 5 == 0, arity)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows, arity), key=key)


def test_many_levels_null_source_lone_leaf_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 7)
    rows = [(i, f"Text {i}", "en", None if i % 3 else "é" if i % 2 else "Z", i) for i in range(300)]
    rows += [(9, "Same", "en", "z", 4)] * 40 + [(None, None, None, "alone", None)]
    got = merkle.verify(frame(spark, rows), cut_key() % 5 == 0, 4)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows, 4), key=key)


def test_one_row_and_none(spark):
    row = (15, "ABC", "en", "s", 3)
    one = merkle.verify(frame(spark, [row]), F.lit(True)).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == leaf(row, "ABC")
    assert one[0].proof_sha256 == H() and one[0].folded_root == leaf(row, "abc") and not one[0].verified
    assert merkle.verify(frame(spark, []), F.lit(True)).count() == 0


def test_every_change_is_found(spark):
    rows = documents(40)
    docs = frame(spark, rows)
    got = merkle.verify(docs, F.lit(True)).collect()
    changed = {leaf(r, r[1]) for r in rows if r[1] and r[1] != merkle_lower(r[1])}
    assert changed and all(r.verified == (r.leaf not in changed) for r in got)


def merkle_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_manifest_lists_every_node(spark):
    docs = frame(spark, [(i, "x", "en", f"s{i % 2}", 1) for i in range(10)])
    rows = docs.withColumn("leaf", merkle.leaf_digest()).select("doc_id", "source", "leaf")
    nodes = merkle.build(rows, F.col("source"), ["doc_id"], "leaf", 2).nodes()
    by = {(r["tree"], r["level"]): r["count"] for r in nodes.groupBy("tree", "level").count().collect()}
    assert by == {("+s0", 0): 5, ("+s0", 1): 3, ("+s0", 2): 2, ("+s0", 3): 1, ("+s1", 0): 5, ("+s1", 1): 3, ("+s1", 2): 2,
                  ("+s1", 3): 1, (None, 0): 2, (None, 1): 1}
    with pytest.raises(ValueError):
        merkle.build(rows, F.col("source"), ["doc_id"], "leaf", 1)


def test_no_group_is_ordered_in_one_task(spark):
    """The windows of the plan go over partitions' counts, never over a tree's leaves."""
    docs = frame(spark, [(i, "x", "en", "s", 1) for i in range(50)])
    rows = docs.withColumn("leaf", merkle.leaf_digest()).select("doc_id", "source", "leaf")
    leaves = merkle.numbered(rows.withColumn("tree", merkle.tree_key(F.col("source"))), ["doc_id"], "test")
    assert [r.idx for r in leaves.orderBy("doc_id").collect()] == list(range(50))
