"""Language ID: held-out accuracy, backoff, and defined results for odd texts."""

import math
import re
import zlib
from collections import defaultdict

from llm_tables import DOCS, documents, frame

from kerbside.llm import language_id
from kerbside.llm.catalog import QUERIES


def test_held_out_accuracy(spark):
    rows = documents(240)
    docs = frame(spark, rows, clash=True)
    out = language_id.predict(docs.withColumn("h", language_id.held_out()), language_id.fit_documents(docs))
    name = out.columns[-1]
    assert name != "language" and out.columns[:-2] == docs.columns
    got = out.collect()
    good = [r for r in got if r["h"] and r["text"] and any(c.isalpha() for c in r["text"]) and r["lang"]]
    assert len(good) > 50 and sum(r[name]["lang_pred"] == r["lang"] for r in good) >= 0.98 * len(good)
    for r in got:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r[name]["lang_pred"], r[name]["score"]) == ("und", 0.0)
        assert 0 <= r[name]["score"] <= 1
        if r["doc_id"] is not None:
            assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert len(got) == len(rows)


def test_word_first_then_longest_grams():
    import numpy as np
    model = language_id.Model(["de", "en"], {"haus": 0}, {" ha": 1, "hau": 2, "a": 3},
                              np.log(np.array([[.9, .1], [.2, .8], [.4, .6], [.5, .5]])))
    rows = language_id.WordRows(model)
    lang, score = language_id.predict_text("Haus", rows)
    assert lang == "de" and abs(score - 0.9) < 1e-12
    lang, score = language_id.predict_text("haut", rows)  # unseen: both known 3-grams, not the shorter one
    s = np.exp(np.log([[.2, .8], [.4, .6]]).mean(axis=0))
    assert lang == "en" and abs(score - s[1] / s.sum()) < 1e-12
    assert language_id.predict_text("xyz", rows)[0] == "de"  # nothing known: a tie, the first language


def test_empty_training_and_tables(spark):
    docs = frame(spark, [(1, "some words", None, None, 1), (2, None, "en", None, 0)])
    out = language_id.predict(docs, language_id.fit_documents(docs)).collect()
    assert {r["language"]["lang_pred"] for r in out} == {"und"}
    assert language_id.predict(frame(spark, [], DOCS), language_id.fit_documents(frame(spark, [], DOCS))).count() == 0


def test_stage_keeps_clean_rows(spark):
    docs = frame(spark, documents(), clash=True)
    out = language_id.keep_identified(docs, language_id.fit_documents(docs))
    assert out.columns == docs.columns
    kept = out.collect()
    assert len(kept) == sum(1 for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"]))
    assert [r["lang"] for r in kept if r["text"] == "Haus"] == ["de"]


def test_query(spark):
    out = QUERIES["op3_language"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == 200


def plain_words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def plain_grams(word, n):
    padded = word if n == 1 else f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def brute_force(rows, max_words=language_id.MAX_WORDS, max_grams=language_id.MAX_GRAMS):
    """Language and score of every (doc_id, text, lang), one text and one token after the other."""
    counts = defaultdict(lambda: defaultdict(int))  # (order, token) -> language -> occurrences; order 0: words
    for doc_id, text, lang in rows:
        if text is not None and lang is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1:
            for word in plain_words(text):
                counts[0, word][lang] += 1
                for n in range(1, 5):
                    for gram in plain_grams(word, n):
                        counts[n, gram][lang] += 1
    languages = sorted({lang for seen in counts.values() for lang in seen})
    size = {(n, lang): sum(seen[lang] for (k, _), seen in counts.items() if k == n and lang in seen)
            for n in range(5) for lang in languages}
    often = sorted((-sum(seen.values()), n, token) for (n, token), seen in counts.items() if sum(seen.values()) > 1)
    kept = [x for x in often if x[1] == 0][:max_words] + [x for x in often if x[1] > 0][:max_grams]
    number = defaultdict(int)
    for _, n, _ in kept:
        number[n] += 1
    table = {}
    for _, n, token in kept:
        logs = [math.log(counts[n, token].get(lang, 0) + 0.5) - math.log(size[n, lang] + 0.5 * number[n]) for lang in languages]
        whole = math.log(sum(math.exp(x) for x in logs))
        table[n, token] = [x - whole for x in logs]

    def of_word(word):
        if (0, word) in table:
            return table[0, word]
        for n in range(4, 0, -1):
            known = [table[n, g] for g in plain_grams(word, n) if (n, g) in table]
            if known:
                return [sum(x) / len(known) for x in zip(*known)]
        return [0.0] * len(languages)

    out = {}
    for doc_id, text, _ in rows:
        words = plain_words(text)
        total = [sum(x) for x in zip(*map(of_word, words))]
        if not words or not total:
            out[doc_id] = ("und", 0.0)
        else:
            best = max(range(len(total)), key=lambda k: (total[k], -k))
            out[doc_id] = (languages[best], 1 / sum(math.exp(x - total[best]) for x in total))
    return out


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = brute_force(rows)
    got = QUERIES["op3_language"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9


def test_unseen_words_and_small_models_equal_brute_force(spark):
    rows = [(i, t, lang) for i, t, lang, *_ in documents(40) if i is not None]
    rows = list({r[0]: r for r in rows}.values())
    docs = frame(spark, [(i, t, lang, "src0", 1) for i, t, lang in rows])
    got = language_id.predict(docs, language_id.fit_documents(docs, max_words=30, max_grams=200)).collect()
    want = brute_force(rows, 30, 200)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["language"]["lang_pred"] == lang and abs(r["language"]["score"] - score) < 1e-9
