"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentence-piece BPE (B), by white-space anchors.

Every text is tokenised whole by both. Where a token of A and a token of B that begin with a space start at the
same byte, all tokens before end together: an anchor, verified by the byte offsets, never assumed. Anchors
split a document into windows, pairs of id tuples, and equal windows are aligned alike wherever they occur,
so a window's alignment is remembered by its ids. Inside a window an end that both share closes a group, and
every stretch between two neighbouring ends is one link, the pair of tokens that lie over it.

How often an id pair is linked in all texts needs a count over the table, and the counts must come back to
the documents. Documents are handled in blocks of bounded text. A block emits its documents (figures, and the
block's numbers of their id pairs with how often each occurs) and its id pairs with their counts. Counts are
summed by pair, the highest of each B id is found, and both go back to the pairs of the blocks; one block's
documents and pairs then meet in one task. Neither a document's links nor a table of all pairs is ever
gathered, sent to the driver or broadcast; a pair that is everywhere has one row a block.

Definitions: A encodes a space and the text, B the text (it adds the space itself); strings of special tokens
are ordinary text. A text that is null or empty, or whose tokens' bytes are not exactly a space and the
text in either vocabulary, has no tokens: all figures are 0 and ``groups_sha256`` is ''. Repeated rows count
each. An empty table gives no rows; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import give_back, stored, text_batches

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Characters and documents of a block, about: it is closed when it reaches either.
BLOCK_CHARS, BLOCK_DOCS = 8_000_000, 4096
#: Characters of documents that are aligned together, about.
PART_CHARS = 500_000
#: Windows of more tokens are aligned but not remembered; beyond so many, a worker forgets them all and begins anew.
MEMO_TOKENS, MEMO_WINDOWS = 24, 300_000

_ROWS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
                   ("pair", pa.int64()), ("number", pa.int32()), ("count", pa.int64())])
ROWS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, "
        "times binary, pair long, number int, count long")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


class Vocabulary:
    """The bytes of every id, as lengths and as whether they begin with a space."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.spaced = np.array([t[:1] == b" " for t in tokens], bool)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class BytePairs(Vocabulary):
    def __init__(self, name: str = VOCABULARY_A):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        by_id = dict(zip(ranks.values(), ranks))
        super().__init__([by_id.get(i, b"") for i in range(max(by_id) + 1)])

    def encode(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(" " + text)

    def joined(self, ids: list[int]) -> bytes:
        return self.coder.decode_bytes(ids)


class Pieces(Vocabulary):
    def __init__(self, name: str = VOCABULARY_B):
        import public_tokenizers
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))

        def in_bytes(i: int) -> bytes:
            piece = self.coder.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if self.coder.is_byte(i) else piece.replace("▁", " ").encode()

        super().__init__([in_bytes(i) for i in range(self.coder.get_piece_size())])

    def encode(self, text: str) -> list[int]:
        return self.coder.encode(text)


#: Ids of B in a window's ids begin here.
B_FROM = 1 << 20


class Aligner:
    def __init__(self, a: Vocabulary | None = None, b: Vocabulary | None = None):
        self.a, self.b = a or BytePairs(), b or Pieces()
        size = len(self.a.tokens)
        self.names = np.array([str(i) for i in (*range(size), *range(len(self.b.tokens)))], object)
        #: alignments by the bytes of a window's ids, A's and then B's from B_FROM on: groups, links, text
        self.memo: dict[bytes, tuple[int, bytes, str]] = {}

    def aligned(self, windows: list[bytes]) -> Iterator[tuple[int, bytes, str]]:
        """Each window's groups: how many, the id pair (a << 32 | b) of each link in order as 64-bit numbers, and
        ``a1,a2|b1;...``. The windows are laid end to end, so that one pass over the token ends does for all."""
        ids = np.frombuffer(b"".join(windows), np.uint32)
        window = np.repeat(np.arange(len(windows)), [len(w) // 4 for w in windows])
        of_b = ids >= B_FROM
        a, b = ids[~of_b].astype(np.int64), ids[of_b].astype(np.int64) - B_FROM
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        ends = np.zeros((2, ends_a[-1] + 1), bool)
        ends[0, ends_a] = True
        ends[1, ends_b] = True
        # links: every stretch up to an end lies in the token of A and the token of B that end there or next
        stretch = np.flatnonzero(ends[0] | ends[1])
        in_a, in_b = np.searchsorted(ends_a, stretch), np.searchsorted(ends_b, stretch)
        links = (a[in_a] << 32 | b[in_b]).tobytes()
        cuts = np.concatenate([[0], np.cumsum(np.bincount(window[~of_b][in_a], minlength=len(windows)))]) * 8
        # groups: a token's is the number of shared ends before its own end
        shared = ends[0] & ends[1]
        before = np.cumsum(shared)
        group = np.concatenate([before[ends_a - 1] * 2, before[ends_b - 1] * 2 + 1])
        groups = np.bincount(window[~of_b][shared[ends_a]], minlength=len(windows))
        order = np.argsort(group, kind="stable")
        group, place = group[order], np.concatenate([window[~of_b], window[of_b]])[order]
        after = np.full(len(order), ",", object)
        last = np.append(group[1:] != group[:-1], True)
        after[last] = "|"
        after[last & (group % 2 == 1)] = ";"
        after[np.append(place[1:] != place[:-1], True)] = "\n"
        text = np.empty(2 * len(order), object)
        text[::2] = self.names[np.concatenate([a, b + len(self.a.tokens)])[order]]
        text[1::2] = after
        cuts = cuts.tolist()
        return zip(groups.tolist(), [links[x:y] for x, y in zip(cuts, cuts[1:])], "".join(text.tolist()).split("\n"))

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin among the tokens of A and of B, and the two lengths at the end."""
        starts_a, starts_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])  # of the next tokens
        marked_a, marked_b = self.a.spaced[a[1:]], self.b.spaced[b[1:]]
        there = np.zeros((2, starts_a[-1] + 1), bool)
        there[0, starts_a[:-1][marked_a]] = True
        there[1, starts_b[:-1][marked_b]] = True
        both = there[0] & there[1]  # a token of either that begins with a space starts here
        return (np.concatenate([[0], np.flatnonzero(marked_a & both[starts_a[:-1]]) + 1, [len(a)]]),
                np.concatenate([[0], np.flatnonzero(marked_b & both[starts_b[:-1]]) + 1, [len(b)]]))

    def tokens(self, text: str | None) -> tuple[int, int, list[bytes]] | None:
        """n_a, n_b and the windows of a text; None for a text without tokens."""
        if not text:
            return None
        a, b = self.a.encode(text), self.b.encode(text)
        whole = b" " + text.encode()
        if self.a.joined(a) != whole or self.b.joined(b) != whole:
            return None
        a, b = (np.frombuffer(array("I", x), np.uint32) for x in (a, b))
        at_a, at_b = self.windows(a, b)
        # the ids of each window side by side
        ids = np.empty(len(a) + len(b), np.uint32)
        ids[np.arange(len(a)) + np.repeat(at_b[:-1], np.diff(at_a))] = a
        ids[np.arange(len(b)) + np.repeat(at_a[1:], np.diff(at_b))] = b + np.uint32(B_FROM)
        raw, cuts = ids.tobytes(), ((at_a + at_b) * 4).tolist()
        return len(a), len(b), [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray] | None]:
        """Per text n_a, n_b, n_groups, the groups' text and the id pairs of all links; None for a text without tokens."""
        memo = self.memo
        if len(memo) >= MEMO_WINDOWS:
            memo.clear()
        tokens = [self.tokens(t) for t in texts]
        new = list({w for t in tokens if t for w in t[2] if w not in memo})
        if new:
            memo.update(zip(new, self.aligned(new)))
        for t in tokens:
            if t is None:
                yield None
            else:
                found = list(map(memo.__getitem__, t[2]))
                links = np.frombuffer(b"".join([f[1] for f in found]), np.int64)
                yield t[0], t[1], sum([f[0] for f in found]), ";".join([f[2] for f in found]), links
        for w in new:
            if len(w) > 4 * MEMO_TOKENS:
                del memo[w]


class Block:
    """Documents whose id pairs are numbered together."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str | None, done: tuple | None) -> None:
        self.chars += len(text or "")
        if done is None:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            pairs = times = np.zeros(0, np.int64)
        else:
            n_a, n_b, n_groups, groups, links = done
            self.rows.append((doc_id, n_a, n_b, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest()))
            pairs, times = np.unique(links, return_counts=True)
        self.pairs.append(pairs)
        self.times.append(times)

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.rows) >= BLOCK_DOCS

    def rows_of(self, block: int) -> Iterator[pa.RecordBatch]:
        """The documents, then the pairs."""
        pairs, number = np.unique(np.concatenate(self.pairs), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, number, np.concatenate(self.times))
        n, docs = len(self.rows), list(zip(*self.rows))
        cuts = np.cumsum([len(p) for p in self.pairs])[:-1]
        packed = {"pairs": [deltas(x) for x in np.split(number, cuts)], "times": [small(x) for x in self.times]}
        names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        yield batch(n, block=np.full(n, block), **dict(zip(names, docs)), **packed)
        yield batch(len(pairs), block=np.full(len(pairs), block), pair=pairs, number=np.arange(len(pairs), dtype=np.int32), count=counts)


def small(x: np.ndarray) -> bytes:
    """Numbers as bytes where all fit, else as four bytes each; the first byte tells which."""
    return b"\1" + x.astype(np.uint8).tobytes() if not len(x) or x.max() < 256 else b"\4" + x.astype("<u4").tobytes()


def large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[0] == 1 else "<u4", offset=1).astype(np.int64)


def deltas(x: np.ndarray) -> bytes:
    """Ascending numbers as steps of two bytes, or four where one is longer; the first byte tells which."""
    step = np.diff(x, prepend=0)
    wide = len(step) and step.max() >= 1 << 16
    return (b"\4" + step.astype("<u4").tobytes()) if wide else (b"\2" + step.astype("<u2").tobytes())


def summed(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1), dtype=np.int64)


def batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ROWS],
                                      schema=_ROWS)


def parts(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Documents that are aligned together: as many as bring about PART_CHARS characters, one at least."""
    start = chars = 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars >= PART_CHARS or k == len(texts) - 1:
            yield ids[start:k + 1], texts[start:k + 1]
            start, chars = k + 1, 0


def blocks(docs: DataFrame) -> DataFrame:
    """The documents and id pairs of all blocks, as rows of ``ROWS``."""
    text_batches(docs.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, block = Aligner(), Block()
        number = TaskContext.get().partitionId() << 32
        for frame in frames:
            for ids, texts in parts(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
                for doc_id, text, done in zip(ids, texts, aligner.align(texts)):
                    block.add(doc_id, text, done)
                if block.full():
                    yield from block.rows_of(number)
                    block, number = Block(), number + 1
        if block.rows:
            yield from block.rows_of(number)
        del aligner, block
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """One block: its documents with the sums over their links."""
    size = (max(pairs.column("number").to_pylist()) + 1) if pairs.num_rows else 0
    total, best = np.zeros(size, np.int64), np.zeros(size, bool)
    number = pairs.column("number").to_numpy()
    total[number] = pairs.column("total").to_numpy()
    best[number] = pairs.column("best").to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for at, times in zip(docs.column("pairs").to_pylist(), docs.column("times").to_pylist()):
        at, times = summed(at), large(times)
        sums.append(int((total[at] * times).sum()))
        bests.append(int(times[best[at]].sum()))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return (out.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
            .append_column("groups_sha256", docs.column("groups_sha256")))


def pair_counts(rows: DataFrame) -> DataFrame:
    """Id pairs of the whole table: pair, total, and whether no pair of the same B id has more."""
    totals = rows.where("pair is not null").groupBy("pair").agg(F.sum("count").alias("total"))
    totals = totals.withColumn("_b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = totals.groupBy("_b").agg(F.max("total").alias("_most"))
    return totals.join(most, "_b").select("pair", "total", (F.col("total") == F.col("_most")).alias("best"))


def align(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = stored(blocks(docs), "token-blocks")
    counts = stored(pair_counts(rows), "token-pairs")
    pairs = (rows.where("pair is not null").select(F.col("block").alias("of"), "pair", "number").join(counts, "pair")
             .select("of", "number", "total", "best"))
    texts = rows.where("pair is null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")
    return texts.groupBy("block").cogroup(pairs.groupBy("of")).applyInArrow(scored, RESULT)
