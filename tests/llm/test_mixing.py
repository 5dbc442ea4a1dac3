"""Mixing against a brute-force version."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from llm_tables import DOCS, documents, frame
from pyspark.sql import functions as F

from kerbside.llm import mixing
from kerbside.llm.catalog import domain_of

WEIGHTS = {"web": 5, "other": 2, "web/en": 6, "web/de": 1, "web/en/src0": 3, "web/fr": 0}


def fill(budget, children, weights):
    """Exact shares by water filling: {name: capacity}; whole numbers by cumulative rounding."""
    if not any(weights[c] for c in children):
        weights = dict.fromkeys(children, 1)
    caps = {c: (children[c] if weights[c] else 0) for c in children}
    order = sorted(caps, key=lambda c: (Fraction(caps[c], max(weights[c], 1)), c))
    got, left, rest = {}, budget, sum(weights[c] for c in order)
    open_ = []
    for c in order:
        if not open_ and caps[c] * rest <= weights[c] * max(left, 0):
            got[c] = caps[c]
            left -= caps[c]
        else:
            open_.append(c)
        rest -= weights[c]
    whole, before = sum(weights[c] for c in open_), 0
    for c in open_:
        w = weights[c]
        got[c] = left * (before + w) // whole - left * before // whole
        before += w
    return got


def brute(rows, budget, weights, max_epochs, seed):
    leaves = defaultdict(list)
    for doc_id, text, lang, source, _ in rows:
        n = len(re.findall(r"[^ \t\n\r\f]+", text or ""))
        m = re.match(r"^src([0-9]{1,6})$", source or "")
        domain = next((d for d, k in (("web", 8), ("books", 14), ("code", 20)) if m and int(m[1]) < k), "other")
        if n:
            leaves[domain, lang or "", source or ""].append((doc_id, n))
    caps = {k: max_epochs * sum(n for _, n in v) for k, v in leaves.items()}
    targets = {(): min(budget, sum(caps.values()))}
    for level in range(3):
        new = {}
        for node, given in targets.items():
            kids = defaultdict(int)
            for k, c in caps.items():
                if k[:level] == node:
                    kids[k[level]] += c
            w = {c: weights.get("/".join([*node, c]), 10) for c in kids}
            for c, share in fill(given, kids, w).items():
                new[(*node, c)] = share
        targets = new
    out = []
    for leaf, docs in leaves.items():
        total = sum(n for _, n in docs)
        epochs, rest = divmod(targets[leaf], total)
        out += [(d, *leaf, n, e, n) for e in range(epochs) for d, n in docs]
        order = sorted(docs, key=lambda x: (hashlib.md5(f"{seed}:{epochs}:{'' if x[0] is None else x[0]}".encode()).hexdigest(),
                                            -1 if x[0] is None else x[0], x[1]))
        for d, n in order:
            if rest <= 0:
                break
            out.append((d, *leaf, n, epochs, min(n, rest)))
            rest -= n
    return out


@pytest.mark.parametrize("budget", [0, 1, 777, 20_000, 10**9])
def test_matches_brute_force(spark, budget):
    rows = documents()
    got = mixing.select_tokens(frame(spark, rows, clash=True), domain_of(), budget, WEIGHTS, 3, 11).collect()
    want = brute(rows, budget, WEIGHTS, 3, 11)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    possible = sum(3 * n for *_, n, e, t in brute(rows, 10**9, {}, 1, 11))
    if not WEIGHTS.get("web/fr"):
        assert sum(r["take_tokens"] for r in got) <= min(budget, possible)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(1, "a b", "en", "src1", 0), (2, "c " * 100, "de", "src1", 0), (3, "d " * 100, "en", "src9", 0)]
    got = mixing.select_tokens(frame(spark, rows), domain_of(), 100, {"web": 1, "books": 1}, 1).collect()
    by = {r["doc_id"]: r["take_tokens"] for r in got}
    assert by == {1: 2, 2: 48, 3: 50}  # web keeps its half: what src1/en lacks goes to src1/de


def test_documents_keep_columns_and_are_cut(spark):
    rows = documents()
    docs = frame(spark, rows, clash=True)
    out = mixing.mix_documents(docs, domain_of(), F.col("total"), WEIGHTS, 2)
    assert out.columns == docs.columns
    picks = brute(rows, sum(len((t or "").split()) for _, t, *_ in rows), WEIGHTS, 2, mixing.SEED)
    texts = sorted(r["text"] for r in out.collect())
    source = defaultdict(list)
    for d, t, lang, s, _ in rows:
        source[d, lang or "", s or "", len((t or "").split())].append(t)
    want = sorted(source[d, lang, s, n][0] if take == n else " ".join(source[d, lang, s, n][0].split()[:take])
                  for d, _, lang, s, n, _, take in picks)
    assert texts == want


def test_empty_table(spark):
    assert mixing.select_tokens(frame(spark, []), domain_of(), 10, {}).count() == 0
    assert mixing.mix_documents(frame(spark, [], DOCS), domain_of(), F.col("total"), {}).count() == 0


def test_plan_is_native(spark):
    docs = frame(spark, documents())
    plan = mixing.mix_documents(docs, domain_of(), 500, WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
