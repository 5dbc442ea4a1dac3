"""Substring dedup against a brute-force version, and on planted passages."""

import random
from collections import defaultdict

from llm_tables import DOCS, documents, frame, prose

from kerbside.llm import substring_dedup as S


def runs_by_definition(words, hashes):
    """All shortest runs that start or end at a unit, by trying every length."""
    n = len(words)
    enough = lambda a, b: sum(words[a:b]) >= S.LONG_WORDS or b - a >= S.MIN_UNITS and sum(words[a:b]) >= S.MIN_WORDS
    out = set()
    for i in range(n):
        out |= set([(i, j) for j in range(i + 1, n + 1) if enough(i, j)][:1])
        out |= set([(a, i + 1) for a in range(i, -1, -1) if enough(a, i + 1)][:1])
    return {(a, b): tuple(hashes[a:b].tolist()) for a, b in out}


def brute(rows):
    occurrences = defaultdict(set)
    for d, t, *_ in rows:
        if t:
            _, words, hashes = S.units(t)
            for (a, b), h in runs_by_definition(words, hashes).items():
                occurrences[h].add((float("-inf") if d is None else d, t, a, b))
    cut = defaultdict(set)
    for found in occurrences.values():
        first = min(found, key=lambda x: (x[0], x[2]))
        for d, t, a, b in found:
            if (d, a) != (first[0], first[2]):
                cut[d, t] |= set(range(a, b))
    out = []
    for d, t, *_ in rows:
        gone = cut.get((float("-inf") if d is None else d, t), set())
        if gone:
            starts, _, _ = S.units(t)
            ends = [*starts[1:], len(t)]
            t = "".join(t[s:e] for k, (s, e) in enumerate(zip(starts, ends)) if k not in gone).rstrip()
        out.append((d, t, len(gone)))
    return out


def planted():
    rng = random.Random(5)
    rows = documents(50)
    passage = prose(rng, "de", 70)
    long_one = " ".join(f"p{i}" for i in range(60)) + "."
    for k in range(12):
        head, tail = prose(rng, "en", 50), prose(rng, "en", 40)
        rows.append((500 + k, head.rstrip(".") + ", " + passage + " " + tail, "en", "src0", 1))
        rows.append((600 + k, head[:-1] + " glued " + long_one + " " + prose(rng, "fr", 30), "en", "src0", 1))
    return rows, passage, long_one


def test_matches_brute_force(spark):
    rows, _, _ = planted()
    got = sorted(map(tuple, S.cut_repeats(frame(spark, rows, clash=True)).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_planted_passages_go_and_clean_texts_stay(spark):
    rows, passage, long_one = planted()
    got = {r["doc_id"]: r for r in S.cut_repeats(frame(spark, rows)).collect()}
    for k in range(12):
        assert (passage in got[500 + k]["text"]) == (k == 0)
        # a passage glued to both sides keeps at most the words before its first own cut
        if k:
            assert sum(f"p{i}" in got[600 + k]["text"].split() for i in range(60)) < 30
    rng = random.Random(99)
    clean = [(k, prose(rng, "en", 90), "en", "s", 1) for k in range(40)]
    assert all(r["removed_units"] == 0 and r["text"] == clean[r["doc_id"]][1]
               for r in S.cut_repeats(frame(spark, clean)).collect())


def test_repeats_inside_a_text_and_same_rows(spark):
    rng = random.Random(1)
    p = prose(rng, "en", 60)
    rows = [(1, p + "\n" + p, "", "", 1), (2, "own words here. " + p, "", "", 1), (2, "own words here. " + p, "", "", 1)]
    got = sorted((r["doc_id"], r["text"]) for r in S.cut_repeats(frame(spark, rows)).collect())
    assert got == [(1, p), (2, "own words here."), (2, "own words here.")]


def test_rows_and_columns(spark):
    docs = frame(spark, documents(), clash=True)
    out = S.drop_repeats(docs)
    assert out.columns == docs.columns
    got = out.collect()
    texts = [r["text"] for r in got]
    assert texts.count(None) == 2 and "" in texts and "  \n " in texts
    before = {r["doc_id"]: r["n_chars"] for r in docs.collect()}
    assert all(r["n_chars"] in (before[r["doc_id"]], len(r["text"])) for r in got if r["text"] is not None)
    assert S.cut_repeats(frame(spark, [], DOCS)).count() == 0
    assert S.drop_repeats(frame(spark, [], DOCS)).count() == 0


def test_units_cut_glued_sentences():
    starts, words, _ = S.units("one two three, Passage begins here. then goes on! \n\nNext line")
    text = "one two three, Passage begins here. then goes on! \n\nNext line"
    assert [text[s:e].strip() for s, e in zip(starts, [*starts[1:], len(text)])] == [
        "one two three,", "Passage begins here.", "then goes on!", "Next line"]
    assert words.tolist() == [3, 3, 3, 2]


def first_stays(rows, width):
    """Texts without the words of every later occurrence of a stretch of words, by trying every stretch."""
    first = {}
    for d, t in sorted(rows):
        words = t.lower().split()
        for i in range(len(words) - width + 1):
            first.setdefault(tuple(words[i:i + width]), (d, i))
    out = {}
    for d, t in rows:
        words, gone = t.lower().split(), set()
        for i in range(len(words) - width + 1):
            doc, at = first[tuple(words[i:i + width])]
            if (doc, at) != (d, i):
                gone |= set(range(max(i, at + width) if doc == d else i, i + width))
        out[d] = " ".join(w for k, w in enumerate(t.split()) if k not in gone)
    return out


def test_glued_passages_go_by_their_exact_words(spark):
    rng = random.Random(11)
    rows = []
    for k in range(120):
        n = 50 + k % 12
        passage = [f"q{k}x{i}" for i in range(n)]  # no sentence ends inside
        for copy in range(2):
            own = [f"o{k}y{copy}z{i}" for i in range(40)]
            at = rng.randint(1, 39)
            rows.append((2 * k + copy, " ".join(own[:at] + passage + own[at:])))
    periodic = " ".join(f"t{i % 7}" for i in range(200))
    rows.append((1000, periodic))
    want = first_stays(rows, S.PASSAGE_WORDS)
    assert len(want[1000].split()) == 50 and all(len(want[2 * k + 1].split()) == 40 for k in range(120))
    docs = frame(spark, [(d, t, "", "", 1) for d, t in rows])
    got = {r["doc_id"]: r for r in S.cut_repeats(docs, S.PASSAGE_WORDS).collect()}
    for d, _ in rows[:-1]:
        assert got[d]["text"] == want[d] and (got[d]["removed_units"] > 0) == (d % 2 == 1)
    assert got[1000]["text"] and set(got[1000]["text"].split()) <= set(periodic.split())
    kept = {r["doc_id"]: r["text"] for r in S.drop_repeats(docs).collect()}
    assert all(kept[d] == want[d] for d, _ in rows[:-1])


def test_stretches_below_the_length_stay(spark):
    rng = random.Random(12)
    passage = [f"q{i}" for i in range(49)]
    rows = [(k, " ".join([f"a{k}"] * 3 + passage[rng.randint(0, 9):30] + [f"b{k}"] * 3), "", "", 1) for k in range(20)]
    got = S.cut_repeats(frame(spark, rows), S.PASSAGE_WORDS).collect()
    assert all(r["text"] == rows[r["doc_id"]][1] and r["removed_units"] == 0 for r in got)
