"""Alignment of two tokenizers against brute force over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_tables import documents, frame

from kerbside.llm import token_alignment as T


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    return a, b


def byte_decoder():
    """Characters of the byte-level alphabet: printable ones stand for themselves, the rest from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{chr(b): b for b in keep}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def spans(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(texts, tokenizers):
    a_coder, b_coder = tokenizers
    decoder = byte_decoder()
    docs = []
    for text in texts:
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        a_bytes = [bytes(decoder[c] for c in a_coder.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_coder.id_to_piece(i)[3:5], 16)]) if b_coder.is_byte(i) else b_coder.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append(None)
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        links = [(x, y) for x, (p, q) in zip(a, sa) for y, (r, s) in zip(b, sb) if p < s and r < q]
        shared = sorted({q for _, q in sa} & {s for _, s in sb})
        groups, low = [], 0
        for high in shared:
            groups.append(",".join(str(x) for x, (p, q) in zip(a, sa) if low < q <= high) + "|"
                          + ",".join(str(y) for y, (r, s) in zip(b, sb) if low < s <= high))
            low = high
        docs.append((len(a), len(b), links, groups))
    counts = Counter(link for d in docs if d for link in d[2])
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[3]), len(d[2]), sum(counts[x] == most[x[1]] for x in d[2]), sum(counts[x] for x in d[2]),
             hashlib.sha256(";".join(d[3]).encode()).hexdigest()) for d in docs]


HARD = [None, "", " ", "  \n ", "a  b", "\ta\n\nb ", "x▁y", "<|endoftext|> and <s> </s> <unk> <0x41>", " z", "日本語のテキスト です", "éﬁ \U0001f600 ok",
        "don't we'll  I'M", "1234567890 3.14", "\u0000\u0007 bell", "naïve—coöperate", "a" * 300, "ab " * 200, "ЖЗИ кириллица", "\r\nx\r\n"]


def check(spark, tokenizers, rows):
    got = T.align(frame(spark, rows, clash=True).repartition(3)).collect()
    want = brute([r[1] for r in rows], tokenizers)
    assert got[0].__fields__ == [x.split(" ")[0] for x in T.RESULT.split(", ")] if got else True
    mine = sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got)
    assert mine == sorted((str(r[0]), *w) for r, w in zip(rows, want))


def test_equals_brute_force(spark, tokenizers):
    rows = [r for r in documents(40) if r[1] is None or len(r[1]) < 3000]
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate(HARD)]
    check(spark, tokenizers, rows)


def test_small_blocks_give_the_same(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_DOCS", 3)
    monkeypatch.setattr(T, "MEMO_WINDOWS", 10)
    monkeypatch.setattr(T, "MEMO_TOKENS", 3)
    monkeypatch.setattr(T, "PART_CHARS", 700)
    check(spark, tokenizers, [r for r in documents(30) if r[1] is None or len(r[1]) < 3000])


def test_random_unicode(spark, tokenizers):
    rng = random.Random(11)
    ranges = [(32, 126), (32, 126), (9, 13), (0xa0, 0x24f), (0x370, 0x52f), (0x2000, 0x206f), (0x2580, 0x2585), (0x4e00, 0x4eff), (0x1f600, 0x1f64f)]
    rows = []
    for i in range(150):
        chars = [chr(rng.randint(*rng.choice(ranges))) if rng.random() < 0.8 else " " for _ in range(rng.randint(1, 60))]
        rows.append((i, "".join(chars), None, None, None))
    check(spark, tokenizers, rows)


def test_empty_table(spark):
    assert T.align(frame(spark, [])).count() == 0


def test_equals_tokenizers_on_every_text_of_the_table(spark, tokenizers):
    """The ranks give the ids that ``tokenizers`` gives for the vocabulary of the contract."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    a = T.BytePairs()
    assert [e.ids for e in tokenizers[0].encode_batch([" " + t for t in texts], add_special_tokens=False)] == [a.encode(t) for t in texts]


def test_windows_are_anchored_and_remembered():
    aligner = T.Aligner()
    text = "the river runs under the river runs"
    a, b = aligner.a.encode(text), aligner.b.encode(text)
    at_a, at_b = aligner.windows(np.array(a), np.array(b))
    assert len(at_a) == len(at_b) == 8
    for i, j in zip(at_a[:-1], at_b[:-1]):
        assert aligner.a.spaced[a[i]] and aligner.b.spaced[b[j]]
        assert aligner.a.lengths[a[:i]].sum() == aligner.b.lengths[b[:j]].sum()
    list(aligner.align([text, None, text]))
    assert len(aligner.memo) == 4  # the, river, runs, under


def test_packed_numbers():
    for x in ([], [0], [5, 6, 300, 70000], [0, 1 << 20]):
        x = np.array(x, np.int64)
        assert (T.summed(T.deltas(x)) == x).all() and (T.large(T.small(x)) == x).all()


def test_one_long_text(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeé ") for _ in range(8)) for _ in range(30000)) + "z" * 100000
    got = T.align(frame(spark, [(1, text, None, None, None)])).first()
    assert got.n_links == got.n_a + got.n_b - got.n_groups and got.n_a > 30000
