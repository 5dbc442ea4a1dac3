"""Sequence packing by non-negative least squares.

Every document is tokenised and gets an end id. Windows that it fills alone become sequences; what is
left (its tail, shorter than a window) is packed with other tails. Combinations of two or three tail
lengths that fill a window exactly are enumerated, non-negative least squares finds how often to
repeat each so that the histogram of tail lengths is used up, the repeats are rounded, and tails that
remain are packed greedily: laid end to end, longest first, and cut at the window's end. Only the
last sequence of these can hold padding.

Ranks of the tails of one length come from counts by (length, bucket) and a window inside each bucket (a hash of
the id and the tail, so that rows without ids or with one id spread), with about the square root of the number of tails in a bucket, so no length is gathered in one task
however many documents share it. The driver sees one histogram row for each length: at most a window's
number of rows.

Definitions: null text is empty, so its document is the end id alone. Repeated rows are packed each.
An empty table gives no rows. Null ids of documents are kept. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import give_back, stored, text_batches

WINDOW = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"

TOKENISED = ("doc_id long, doc_tokens long, full_crcs array<long>, tail_length int, tail binary")
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, part string")


class Encoder:
    """Ids of a public byte-level BPE vocabulary. Texts are encoded by ``tiktoken`` over the ranks of
    that vocabulary, four times as fast and equal id for id (tested); a text that holds the string of
    a special token goes to ``tokenizers`` itself, and so does everything if there is no ranks file."""

    def __init__(self, vocabulary: str = TOKENIZER):
        import base64
        import json
        import os

        import public_tokenizers

        self.file = public_tokenizers.path(vocabulary)
        with open(self.file, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.fast = None
        ranks_file = public_tokenizers.path(vocabulary.replace(".json", ".tiktoken"))
        if os.path.exists(ranks_file):
            import tiktoken
            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def encode(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def tokenise(docs: DataFrame, window: int = WINDOW, vocabulary: str = TOKENIZER) -> DataFrame:
    """Per document: its tokens, the checksum of each full window, and the ids of its tail."""
    text_batches(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                ids = np.array([*encoder.encode(text or ""), END_ID], "<u4")
                full = len(ids) // window
                crcs = [zlib.crc32(ids[k * window:(k + 1) * window].tobytes()) for k in range(full)]
                tail = ids[full * window:]
                rows.append((len(ids), crcs, len(tail), tail.tobytes()))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "doc_tokens": [r[0] for r in rows],
                                "full_crcs": [r[1] for r in rows], "tail_length": [r[2] for r in rows],
                                "tail": [r[3] for r in rows]})
        del encoder
        give_back()

    # the id travels as text so that null ids survive pandas
    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (narrow.mapInPandas(run, TOKENISED.replace("doc_id long", "doc_id string"))
            .withColumn("doc_id", F.col("doc_id").cast("long")))


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of the given lengths that fill the window, as rows of three lengths in
    descending order; 0 stands for none."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    found = [(a, window - a, 0) for a in range((window + 1) // 2, window) if have[a] and have[window - a]]
    for a in (int(x) for x in lengths):
        b = np.arange(max(1, (window - a + 1) // 2), min(a, window - a - 1) + 1)
        c = window - a - b
        fit = have[b] & (c > 0) & have[c] & (c <= b)
        found += [(a, int(x), int(y)) for x, y in zip(b[fit], c[fit])]
    return np.array(found, np.int64).reshape(-1, 3)


def nnls(combos: np.ndarray, histogram: np.ndarray, rounds: int = 30, batch: int = 96,
         tolerance: float = 0.015) -> dict[int, float]:
    """Repeats x >= 0 of the combinations that minimise |uses(x) - histogram|: an active-set method that
    lets in the steepest combinations with no length in common. Returns the positive entries."""
    uses = lambda j: np.bincount(combos[j][combos[j] > 0], minlength=len(histogram))
    active: list[int] = []
    x = np.zeros(0)
    columns = np.zeros((len(histogram), 0))
    target = histogram.astype(float)
    gram, toward = np.zeros((0, 0)), np.zeros(0)
    floor = tolerance * max(1.0, float(target.sum()))
    for _ in range(rounds):
        residual = target - columns @ x
        if np.abs(residual).sum() < floor or len(active) >= len(target):
            break
        padded = residual.copy()
        padded[0] = 0.0
        slope = padded[combos].sum(axis=1)
        slope[active] = -np.inf
        chosen, taken = [], set()
        for j in np.argsort(-slope, kind="stable")[:batch * 16]:
            parts = {int(v) for v in combos[j] if v}
            if slope[j] <= 0.5 or len(chosen) >= batch:
                break
            if not parts & taken:
                chosen.append(int(j))
                taken |= parts
        if not chosen:
            break
        active += chosen
        new = np.column_stack([uses(j).astype(float) for j in chosen])
        cross = columns.T @ new
        gram = np.block([[gram, cross], [cross.T, new.T @ new + 1e-9 * np.eye(len(chosen))]])
        columns, toward = np.hstack([columns, new]), np.concatenate([toward, new.T @ target])
        x = np.concatenate([x, np.zeros(len(chosen))])
        while True:
            best = np.linalg.solve(gram, toward)
            if (best > 1e-9).all():
                x = best
                break
            low = best <= 1e-9
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.where(low, x / (x - best), np.inf)
            x = x + min(1.0, float(np.nanmin(step))) * (best - x)
            keep = ~(low & (x <= 1e-9))
            if keep.all():
                keep[np.argmin(np.where(low, x, np.inf))] = False
            active = [j for j, k in zip(active, keep) if k]
            x, columns = np.maximum(x[keep], 0.0), columns[:, keep]
            gram, toward = gram[np.ix_(keep, keep)], toward[keep]
            if not active:
                break
    return {j: float(v) for j, v in zip(active, x) if v > 0}


@dataclass
class Plan:
    """Where the tails go. ``slots[c]`` lists, for tails of length c in the order of their ranks, (first
    rank, tails a sequence, first sequence, offset of the first); ranks from ``used[c]`` on lie end to
    end from token ``rest_start[c]`` of the remaining sequences, which begin at ``rest_first``."""

    window: int
    slots: dict[int, list[tuple[int, int, int, int]]]
    used: dict[int, int]
    rest_start: dict[int, int]
    rest_first: int
    packs: int


def make_plan(tails: dict[int, int], full: int, window: int = WINDOW) -> Plan:
    """``tails``: documents by tail length; ``full``: sequences already taken by full windows."""
    tails = {c: n for c, n in tails.items() if c > 0}
    left = np.zeros(window + 1, np.int64)
    for c, n in tails.items():
        left[c] = n
    combos = combinations(np.array(sorted(tails), np.int64), window)
    repeats: dict[int, int] = {}

    def take(j: int, most: int) -> None:
        parts, times = np.unique(combos[j][combos[j] > 0], return_counts=True)
        n = int(min(most, (left[parts] // times).min()))
        if n > 0:
            left[parts] -= n * times
            repeats[j] = repeats.get(j, 0) + n

    if len(combos):
        solved = nnls(combos, left)
        order = sorted(solved, key=lambda j: (-solved[j], j))
        for j in order:
            take(j, round(solved[j]))
        for j in order:  # what rounding down has left, while whole combinations still fit
            take(j, int(left.sum()))
        for j in np.flatnonzero(combos[:, 2] == 0):
            take(int(j), int(left.sum()))
    slots: dict[int, list[tuple[int, int, int, int]]] = {c: [] for c in tails}
    used = dict.fromkeys(tails, 0)
    sequence = full
    for j, n in sorted(repeats.items()):
        parts, times = np.unique(combos[j][combos[j] > 0], return_counts=True)
        offset = 0
        for c, m in sorted(zip(parts.tolist(), times.tolist()), reverse=True):
            slots[c].append((used[c], m, sequence, offset))
            used[c] += n * m
            offset += c * m
        sequence += n
    rest_start, at = {}, 0
    for c in sorted(tails, reverse=True):
        rest_start[c] = at
        at += int(left[c]) * c
    return Plan(window, slots, used, rest_start, sequence, sum(repeats.values()))


def place(frame: pd.DataFrame, plan: Plan) -> pd.DataFrame:
    """Pieces of ranked documents; ``rank`` counts tails of a length, ``windows_before`` full windows."""
    out = []
    firsts = {c: [s[0] for s in slots] for c, slots in plan.slots.items()}
    w = plan.window
    for doc_id, tokens, crcs, length, tail, rank, before in zip(
            frame["doc_id"], frame["doc_tokens"], frame["full_crcs"], frame["tail_length"], frame["tail"],
            frame["rank"], frame["windows_before"]):
        for k, crc in enumerate(crcs):
            out.append((doc_id, k * w, w, int(crc), tokens, before + k, 0, "window"))
        if not length:
            continue
        start = len(crcs) * w
        if rank < plan.used[length]:
            slot = plan.slots[length][int(np.searchsorted(firsts[length], rank, side="right")) - 1]
            pack, nth = divmod(rank - slot[0], slot[1])
            out.append((doc_id, start, length, zlib.crc32(tail), tokens, slot[2] + pack, slot[3] + nth * length,
                        "combination"))
            continue
        at, end = plan.rest_start[length] + (rank - plan.used[length]) * length, 0
        while end < length:
            n = min(length - end, w - at % w)
            out.append((doc_id, start + end, n, zlib.crc32(tail[4 * end:4 * (end + n)]), tokens,
                        plan.rest_first + at // w, at % w, "greedy"))
            at, end = at + n, end + n
    return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                      "offset", "part"])


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = TOKENIZER) -> DataFrame:
    """Pieces of all documents: which ids of which document lie where in which sequence."""
    tokens = stored(tokenise(docs, window, vocabulary), "packing-tokens")
    histogram = tokens.groupBy("tail_length").agg(
        F.count("*").alias("docs"), F.sum(F.size("full_crcs")).cast("long").alias("windows")).collect()
    by_length = {r["tail_length"]: r for r in histogram}
    plan = make_plan({c: r["docs"] for c, r in by_length.items()}, sum(r["windows"] for r in histogram), window)
    # one entry for each length, at most `window`: sizes of buckets, and full windows of shorter tails
    buckets, first_window, windows = {}, {}, 0
    for c in sorted(by_length):
        buckets[c] = max(1, int(np.ceil(np.sqrt(by_length[c]["docs"]))))
        first_window[c] = windows
        windows += by_length[c]["windows"]

    def lookup(values: dict[int, int]):
        dense = [values.get(c, 0) for c in range(window)]
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in dense]), F.col("tail_length") + 1)

    if not by_length:
        return docs.sparkSession.createDataFrame([], PIECES)
    keyed = tokens.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "doc_tokens", "tail"), lookup(buckets)))
    in_length = Window.partitionBy("tail_length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (keyed.groupBy("tail_length", "bucket")
             .agg(F.count("*").alias("docs"), F.sum(F.size("full_crcs")).alias("windows"))
             .select("tail_length", "bucket", F.coalesce(F.sum("docs").over(in_length), F.lit(0)).alias("rank_base"),
                     F.coalesce(F.sum("windows").over(in_length), F.lit(0)).alias("windows_base")))
    order = Window.partitionBy("tail_length", "bucket").orderBy("doc_id", "doc_tokens", "tail")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (keyed
              .withColumn("rank", F.row_number().over(order) - 1)
              .withColumn("windows_before", F.coalesce(F.sum(F.size("full_crcs")).over(before), F.lit(0)))
              .join(bases, ["tail_length", "bucket"])
              .select(F.col("doc_id").cast("string").alias("doc_id"), "doc_tokens", "full_crcs", "tail_length", "tail",
                      (F.col("rank") + F.col("rank_base")).cast("long").alias("rank"),
                      (F.col("windows_before") + F.col("windows_base") + lookup(first_window)).cast("long")
                      .alias("windows_before")))
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # bounded by the number of lengths

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield place(frame, shared.value)

    return (ranked.mapInPandas(run, PIECES.replace("doc_id long", "doc_id string"))
            .withColumn("doc_id", F.col("doc_id").cast("long")))
