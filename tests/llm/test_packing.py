"""Packing: exact round trip of ids, gapless sequences, little padding."""

import zlib

import numpy as np
from llm_tables import DOCS, documents, frame

from kerbside.llm import packing


def round_trip(rows, pieces, window=1024):
    from collections import Counter, defaultdict

    encoder = packing.Encoder()
    docs = Counter()
    ids = {}
    for doc_id, text, *_ in rows:
        v = np.array([*encoder.slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        docs[doc_id, v.tobytes()] += 1
        ids.setdefault(doc_id, []).append(v)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    assert sum(p["length"] for p in pieces) == sum(len(k[1]) // 4 * n for k, n in docs.items())
    for p in pieces:
        assert any(len(v) == p["doc_tokens"]
                   and zlib.crc32(v[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
                   for v in ids[p["doc_id"]])
    # every id of every row exactly once
    for (doc_id, tokens), own in by_doc.items():
        copies = sum(n for (d, v), n in docs.items() if d == doc_id and len(v) // 4 == tokens)
        cover = np.zeros(tokens, int)
        for p in own:
            cover[p["start"]:p["start"] + p["length"]] += 1
        assert (cover == copies).all()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at
    return padding


def test_round_trip(spark):
    rows = documents(150) + [(7000 + i, "same text of a copy " * 40, "en", "src1", 1) for i in range(70)]
    pieces = packing.pack(frame(spark, rows, clash=True)).collect()
    assert round_trip(rows, pieces) < 1024  # only the last sequence is padded
    assert {p["part"] for p in pieces} == {"window", "combination", "greedy"}


def test_empty_and_single(spark):
    assert packing.pack(frame(spark, [], DOCS)).collect() == []
    only = packing.pack(frame(spark, [(1, None, None, None, None)])).collect()
    assert [(p["start"], p["length"], p["doc_tokens"], p["offset"]) for p in only] == [(0, 1, 1, 0)]


def test_fast_encoder_equals_tokenizers():
    encoder = packing.Encoder()
    odd = ["", " ", "\n\n \t x", "naïve café — 漢字 👩‍👧  ​ end", "a" * 3000, "it's we'll 1234567 !!!...",
           "x <|endoftext|> y", "́̀ Ünïcödé ÀÉ", "tab\tnew\r\nline   many   spaces  "]
    odd += [t for _, t, *_ in documents(30) if t]
    for text in odd:
        assert encoder.encode(text) == encoder.slow.encode(text, add_special_tokens=False).ids


def test_least_squares_uses_the_histogram():
    rng = np.random.default_rng(1)
    tails = {c: int(n) for c, n in enumerate(np.bincount(rng.integers(1, 1024, 60_000), minlength=1024)) if n}
    plan = packing.make_plan(tails, 0)
    assert sum(plan.used.values()) > 0.9 * sum(tails.values())
    assert all(plan.used[c] <= n for c, n in tails.items())


def test_combinations_fill_the_window():
    combos = packing.combinations(np.arange(1, 64), 64)
    assert (combos.sum(axis=1) == 64).all()
    want = {tuple(sorted((a, b, 64 - a - b), reverse=True)) for a in range(1, 63) for b in range(0, 64 - a) if 0 < 64 - a - b < 64 and a < 64 and (b > 0 or True)}
    want = {w for w in want if max(w) < 64}
    assert {tuple(c) for c in combos.tolist()} == want


def test_rows_without_ids_or_with_one_id_spread(spark, monkeypatch):
    """A third of the rows share an id, a third have none: the round trip holds, and no window partition gathers them."""
    import random
    rng = random.Random(6)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else 1000 + i, " ".join(f"w{rng.randint(0, 99)}" for _ in range(20)), None, None, None)
            for i in range(600)]
    docs = frame(spark, rows, DOCS)
    assert round_trip(rows, packing.pack(docs).collect()) < 1024
    from pyspark.sql import functions as F
    tokens = packing.tokenise(docs)
    sizes = tokens.groupBy("tail_length", F.pmod(F.xxhash64("doc_id", "doc_tokens", "tail"), F.lit(16))).count()
    by_id = tokens.groupBy("tail_length", F.pmod(F.xxhash64("doc_id"), F.lit(16))).count()
    most = lambda df: df.agg(F.max("count")).first()[0]
    assert most(sizes) * 2 < most(by_id)
