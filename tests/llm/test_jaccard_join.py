"""Jaccard join against all pairs."""

import random

import numpy as np
from llm_tables import DOCS, documents, frame, prose

from kerbside.llm import jaccard_join as J


def near_copy(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def brute(rows, threshold=0.8):
    words = J.WordHashes()
    sets = {}
    for d, t, *_ in rows:
        if d is not None:
            s = J.shingles(t, words)
            if d not in sets or J.key_of(s) < J.key_of(np.array(sorted(sets[d]), np.uint64)):
                sets[d] = set(s.tolist())
    ids = sorted(sets)
    links = {d: 0 for d in ids}
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                ra, rb = sorted((root(a), root(b)))
                up[rb] = ra
    return {d: (root(d), links[d]) for d in ids}


def group_rows():
    """Chains and groups at all similarities round the threshold, and a group larger than a block."""
    rng = random.Random(3)
    rows = documents(40)
    at = 1000
    for _ in range(25):
        text = prose(rng, rng.choice(["en", "de", "fr"]), rng.randint(60, 200))
        for _ in range(rng.randint(2, 5)):
            rows.append((at, text, "en", "src0", 1))
            at += 1
            text = near_copy(text, rng, rng.randint(1, max(1, len(text.split()) // 30)))
    base = prose(rng, "en", 400)
    for _ in range(700):
        rows.append((at, near_copy(base, rng, rng.randint(0, 3)), "en", "src0", 1))
        at += 1
    line = prose(rng, "en", 40)
    for _ in range(300):  # a shared passage that is no near copy
        rows.append((at, line + " " + prose(rng, "en", 60), "en", "src0", 1))
        at += 1
    rng.shuffle(rows)
    return rows


def test_matches_all_pairs(spark):
    rows = group_rows()
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in J.join(frame(spark, rows, clash=True)).collect()}
    want = brute(rows)
    assert max(n for _, n in want.values()) > 500
    assert got == want


def test_short_texts_and_one_per_group(spark):
    rows = [(1, "a b c", "", "", 1), (2, "A, b c!", "", "", 1), (3, "a b", "", "", 1), (4, None, "", "", 1),
            (5, "", "", "", 1), (5, "", "", "", 1), (None, "a b c", "", "", 1), (6, "?!", "", "", 1)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["set_id"]) for r in J.join(frame(spark, rows)).collect()}
    assert got == {1: (1, 1, 1), 2: (1, 1, 1), 3: (3, 0, 3), 4: (4, 0, 4), 5: (5, 0, 5), 6: (6, 0, 6)}
    docs = frame(spark, rows, clash=True)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "5", "6", "None"]


def test_empty(spark):
    assert J.join(frame(spark, [], DOCS)).count() == 0
    assert J.keep_one(frame(spark, [], DOCS)).count() == 0


def test_components_of_long_chains(spark):
    from kerbside.llm.components import connected
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(1000 + i, 1000) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(50)}}
