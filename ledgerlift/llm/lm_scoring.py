"""Language-model scoring by online logistic context mixing.

A text is coded as its lower-cased (A-Z) words, each ended by a space, and an end.
Every byte takes the path to its leaf in a Huffman tree of the training bytes. For
each bit three predictors look up what the training texts did at that node after
the last two, three or five bytes (hashed contexts). Their log-odds are combined
by weights that a gate selects (start of a word or not); the weights and a bias
follow the coding error bit by bit. The bits of a word multiply to its probability
by spelling, which is refined adaptively: it is averaged with the word's share of
the training tokens, and the weight of that share follows how well it did earlier
in the text. Bits per byte are -score / log10(2) / bytes.

Texts are coded in segments of 512 bytes, side by side in numpy. Mixing starts
anew in each segment; contexts reach back over its start.

Word counts travel packed per (shard of words, block of documents): each block
asks once per distinct word.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlift.llm.common import (
    LOWER, SPACE, U64, block_of, bytes_of, documents, member, pack, slices, strings, word_hashes, word_spans,
)

END = 255
ORDERS = (2, 3, 5)
CONTEXT_BITS = 15
CONTEXTS = 1 << CONTEXT_BITS
SEGMENT = 512
STEPS = 64  # bits of each segment that are mixed before the next are fetched
SIDE_BY_SIDE = 2 << 20  # bytes of text mixed at a time
TRUST, RECORD = 0.9, 10  # first weight of a word's share, and the tokens it stands for
BLOCK_DOCS = 1024
BLOCK_BYTES = 8 << 20
TOKENS_PER_SHARD = 4 << 20
RATE, BIAS_RATE = np.float32(0.012 / 256), np.float32(0.01)  # per step of log-odds squared
FIRST_WEIGHTS = np.array([0.1, 0.3, 0.6], np.float32)
STRETCH_STEP = 1 / 16  # log-odds are kept in signed bytes: -8 to 8


# ---- contexts and counts -------------------------------------------------------


def lower_spans(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts and ends of the words, words per text)."""
    buf, offsets = bytes_of(texts)
    return LOWER[buf], *word_spans(buf, offsets)


def coded_bytes(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, text edges, token edges, word hashes, words per text).

    A text becomes its lower-cased words, each ended by one space, and an end. Its
    tokens are the words with their space, then the end.
    """
    buf, starts, ends, counts = lower_spans(texts)
    sizes = np.insert(ends - starts + 1, np.cumsum(counts), 1)  # an end after the words of each text
    tokens = np.r_[0, np.cumsum(sizes)]
    edges = tokens[np.r_[0, np.cumsum(counts + 1)]]
    inside = np.ones(edges[-1], bool)
    inside[tokens[1:] - 1] = False
    out = np.full(edges[-1], 32, np.uint8)
    out[edges[1:] - 1] = END
    out[inside] = buf[~SPACE[buf]]
    return out, edges, tokens, word_hashes(buf, starts, ends), counts


def contexts(data: np.ndarray, edges: np.ndarray):
    """Per order, the hashed context of each byte; texts begin after an end."""
    last = np.full((max(ORDERS), len(data)), END, np.uint32)
    starts = edges[:-1]
    for k in range(1, max(ORDERS) + 1):
        last[k - 1, k:] = data[:-k] if k < len(data) else data[:0]
        for j in range(k):
            last[k - 1, (starts + j)[starts + j < edges[1:]]] = END
    mixed = np.zeros(len(data), np.uint32)
    for k in range(max(ORDERS)):
        mixed = (mixed + last[k] + np.uint32(1)) * np.uint32(0x9E3779B1)
        if k + 1 in ORDERS:
            yield ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - CONTEXT_BITS)


COUNT_DDL = "ord int, part int, cells binary, counts binary"
COUNT = pa.schema([("ord", pa.int32()), ("part", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])
PARTS = 16
COUNT_BYTES = 8 << 20  # bytes counted at a time


def _count_bytes(batches):
    """Per task: how often each byte follows each context; one row per order and part of the contexts."""
    totals = np.zeros((len(ORDERS), CONTEXTS * 256), np.int32)
    waiting: list[list[np.ndarray]] = [[] for _ in ORDERS]

    def add() -> None:
        for total, cells in zip(totals, waiting):
            total += np.bincount(np.concatenate(cells), minlength=len(total)).astype(np.int32)
            cells.clear()

    for batch in batches:
        texts = strings(batch.column("text"))
        for low, high in slices(texts):
            data, edges, *_ = coded_bytes(texts.slice(low, high - low))
            for cells, slot in zip(waiting, contexts(data, edges)):
                cells.append((slot << np.uint32(8)) | data)
            if sum(map(len, waiting[0])) >= COUNT_BYTES:
                add()
    if waiting[0]:
        add()
    size = CONTEXTS * 256 // PARTS
    for o in range(len(ORDERS)):
        for p in range(PARTS):
            cells = np.flatnonzero(totals[o, p * size : (p + 1) * size])
            if len(cells):
                counts = totals[o, p * size : (p + 1) * size][cells].astype(np.int64)
                yield pa.RecordBatch.from_pylist(
                    [{"ord": o, "part": p, "cells": pack(cells.astype(np.int32)), "counts": pack(counts)}], schema=COUNT
                )


def _add_counts(table: pa.Table) -> pa.Table:
    total = np.zeros(CONTEXTS * 256 // PARTS, np.int64)
    for cells, counts in zip(table.column("cells").to_pylist(), table.column("counts").to_pylist()):
        total[np.frombuffer(cells, np.int32)] += np.frombuffer(counts, np.int64)
    cells = np.flatnonzero(total)
    row = {"ord": table.column("ord")[0].as_py(), "part": table.column("part")[0].as_py()}
    return pa.Table.from_pylist([row | {"cells": pack(cells.astype(np.int32)), "counts": pack(total[cells])}], schema=COUNT)


# ---- the model -----------------------------------------------------------------


def code_tree(frequency: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Huffman tree over 256 bytes: (leaf order, inner nodes as (low, middle, high) ranges of it, paths)."""
    heap = [(int(f) + 1, b, b) for b, f in enumerate(frequency)]
    heapq.heapify(heap)
    tie = 256
    while len(heap) > 1:
        (f, _, x), (g, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (f + g, tie, (x, y)))
        tie += 1
    order, nodes, paths = [], [], [[] for _ in range(256)]

    def walk(tree, path):
        if isinstance(tree, int):
            paths[tree] = path
            order.append(tree)
            return
        me, low = len(nodes), len(order)
        nodes.append(None)
        walk(tree[0], [*path, (me, 0)])
        middle = len(order)
        walk(tree[1], [*path, (me, 1)])
        nodes[me] = (low, middle, len(order))

    walk(heap[0][2], [])
    sizes = np.array([len(p) for p in paths])
    steps = [s for p in paths for s in p]
    return np.array(order), nodes, sizes, np.array([n for n, _ in steps], np.uint8), np.array([b for _, b in steps], np.uint8)


class Model:
    """Node log-odds per order and context, in signed bytes; its size does not depend on the input."""

    def __init__(self, rows: list):
        """``rows``: (ord, part, cells, counts) over all training bytes."""
        frequency = np.zeros(256, np.int64)
        for r in rows:
            if r["ord"] == 0:
                np.add.at(frequency, np.frombuffer(r["cells"], np.int32) & 255, np.frombuffer(r["counts"], np.int64))
        self.tokens = int(frequency[32] + frequency[END])  # a space or an end closes each
        order, nodes, self.sizes, path_nodes, path_bits = code_tree(frequency)
        self.starts = np.cumsum(self.sizes) - self.sizes
        paths = np.r_[path_nodes + 256 * path_bits.astype(np.uint16), np.zeros(STEPS, np.uint16)]  # zeros for what fills a run
        self.paths, self.gated = np.r_[paths, paths + np.uint16(512)], len(paths)  # node, and above it bit and gate
        low, middle, high = (np.array(x) for x in zip(*nodes))
        size = CONTEXTS // PARTS
        self.tables = np.zeros((len(ORDERS), CONTEXTS, 256), np.int8)
        for r in rows:
            counts = np.zeros(size * 256)
            counts[np.frombuffer(r["cells"], np.int32)] = np.frombuffer(r["counts"], np.int64)
            sums = np.zeros((size, 257))
            np.cumsum(counts.reshape(size, 256)[:, order], axis=1, out=sums[:, 1:])
            zero, one = sums[:, middle] - sums[:, low], sums[:, high] - sums[:, middle]
            odds = np.log((one + 0.05) / (zero + 0.05)) / STRETCH_STEP
            at = r["part"] * size
            self.tables[r["ord"], at : at + size, : len(nodes)] = np.clip(np.rint(odds), -127, 127)

    def token_logs(self, data: np.ndarray, edges: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural log-probability of each token by its spelling."""
        start, stop, bits, sizes = self._cut(data, edges)
        loss = self._mix(bits, np.concatenate(list(self._needs(data, edges, start, stop, sizes))))
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(loss, starts[tokens[:-1]], dtype=np.float64)

    def _cut(self, data: np.ndarray, edges: np.ndarray):
        """(starts, stops, bits) of the segments, and the places of each byte; a segment's last fills its last run of STEPS."""
        lengths = np.diff(edges)
        pieces = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(lengths)), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = edges[:-1][owner] + within * SEGMENT
        stop = np.minimum(start + SEGMENT, edges[1:][owner])
        sizes = self.sizes[data]
        bits = np.add.reduceat(sizes, start)
        sizes[stop - 1] += -bits % STEPS
        return start, stop, bits, sizes

    def _needs(self, data: np.ndarray, edges: np.ndarray, start: np.ndarray, stop: np.ndarray, sizes: np.ndarray):
        """What each bit needs, some segments at a time."""
        gate = np.zeros(len(data), bool)  # after white space, and at the start
        gate[1:] = data[:-1] <= 32
        gate[edges[:-1]] = True
        begin = self.starts[data] + gate * self.gated
        slots = [slot.astype(np.intp) << 8 for slot in contexts(data, edges)]
        for a in range(0, len(start), 32):
            lo, hi = start[a], stop[min(a + 32, len(start)) - 1]
            size = sizes[lo:hi]
            of = np.repeat(np.arange(hi - lo), size)
            step = (begin[lo:hi] - (np.cumsum(size) - size)).take(of, mode="clip")
            step += np.arange(len(of))
            path = self.paths.take(step, mode="clip")
            node = (path & np.uint16(255)).astype(np.intp)
            needs = np.empty((len(of), 4), np.int8)  # three log-odds and two flags, gathered as one number later
            for k, (t, slot) in enumerate(zip(self.tables, slots)):
                cell = slot[lo:hi].take(of, mode="clip")
                cell |= node
                needs[:, k] = t.reshape(-1).take(cell, mode="clip")
            needs[:, 3] = path >> np.uint16(8)
            yield needs

    @staticmethod
    def _mix(length: np.ndarray, needs: np.ndarray) -> np.ndarray:
        """Natural log-probability of every bit, 0 for what fills the last run of a segment.

        Segments advance bit by bit, side by side. Their bits are turned from segment
        order to step order and back in runs of STEPS, as a step alone would touch one
        page of memory per segment.
        """
        needs = needs.view(np.uint32).reshape(-1, STEPS)
        runs = -(-length // STEPS)
        first = np.cumsum(runs) - runs
        by_length = np.argsort(-length, kind="stable")
        first, length = first[by_length], length[by_length]
        n, one = len(first), np.float32(1)
        weight = np.repeat(FIRST_WEIGHTS[:, None] * np.float32(STRETCH_STEP), n, axis=1)
        extra, bias = np.zeros_like(weight), np.zeros(n, np.float32)
        loss = np.empty(needs.shape, np.float32)
        active = np.searchsorted(-length, -np.arange(length[0]), "left").tolist()  # segments longer than t
        for low in range(0, len(active), STEPS):
            run = active[low : low + STEPS]
            most = run[0]
            rows = first[:most] + low // STEPS
            fetched = np.ascontiguousarray(needs[rows].T).view(np.int8).reshape(STEPS, most, 4)
            stretched = fetched[:, :, :3].transpose(0, 2, 1).astype(np.float32, order="C")
            flags = np.ascontiguousarray(fetched[:, :, 3])
            gates = (flags >= 2).astype(np.float32)
            signs = ((flags & 1) * 2 - 1).astype(np.float32)
            odds = np.ones((STEPS, most), np.float32)  # one over the probability of the bit
            for t, m in enumerate(run):
                x, g, sign = stretched[t, :, :m], gates[t, :m], signs[t, :m]
                w = extra[:, :m] * g
                w += weight[:, :m]
                w *= x
                dot = bias[:m] + w[0]
                dot += w[1]
                dot += w[2]
                np.minimum(np.maximum(dot, -12, out=dot), 12, out=dot)
                dot *= sign
                against = np.exp(np.negative(dot, out=dot), out=dot)
                whole = np.add(against, one, out=odds[t, :m])
                against /= whole
                against *= sign
                bias[:m] += against * BIAS_RATE
                against *= RATE
                x *= against
                weight[:, :m] += x
                x *= g
                extra[:, :m] += x
            loss[rows] = np.ascontiguousarray(-np.log(odds).T)
        return loss.reshape(-1)


def refined(spelled: np.ndarray, share: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Log probability of each token: spelling and share of training tokens, weighed by their record in the text."""
    by_spelling = np.exp(np.maximum(spelled, -600))
    credit = TRUST * share / (TRUST * share + (1 - TRUST) * by_spelling)
    total = np.cumsum(credit) - credit
    start = np.repeat(np.cumsum(tokens) - tokens, tokens)
    seen = np.arange(len(share)) - start
    trust = (TRUST * RECORD + total - total[start]) / (RECORD + seen)
    return np.log(trust * share + (1 - trust) * by_spelling)


# ---- word counts and scores ----------------------------------------------------

ASK_DDL = "shard int, block int, keys binary, counts binary"
ASK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWER_DDL = "block int, keys binary, counts binary"
ANSWER = pa.schema([("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _word_asks(shards: int):
    def run(docs: pa.Table) -> pa.Table:
        learn = docs.column("learn").to_numpy()
        keys, weights = [], []
        texts = strings(docs.column("text"))
        for low, high in slices(texts):
            buf, starts, ends, counts = lower_spans(texts.slice(low, high - low))
            part, place = np.unique(word_hashes(buf, starts, ends), return_inverse=True)
            keys.append(part)
            weights.append(np.bincount(place, np.repeat(learn[low:high], counts), len(part)))
        if not keys:
            return ASK.empty_table()
        keys, place = np.unique(np.concatenate(keys), return_inverse=True)
        weights = np.bincount(place, np.concatenate(weights), len(keys)).astype(np.int64)
        shard = (keys >> U64(32)) % U64(shards)
        block = docs.column("block")[0].as_py()
        rows = []
        for s in range(shards):
            mine = shard == U64(s)
            if mine.any():
                rows.append({"shard": s, "block": block, "keys": pack(keys[mine]), "counts": pack(weights[mine])})
        return pa.Table.from_pylist(rows, schema=ASK)

    return run


def _shard_counts(table: pa.Table):
    packed = table.column("keys").to_pylist()
    keys = np.frombuffer(b"".join(packed), U64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int64)
    distinct, place = np.unique(keys, return_inverse=True)
    return packed, place, np.bincount(place, counts, len(distinct)).astype(np.int64)


def _word_answers(table: pa.Table) -> pa.Table:
    packed, place, counts = _shard_counts(table)
    cuts = np.cumsum([0] + [len(p) // 8 for p in packed])
    return pa.Table.from_arrays(
        [
            table.column("block").combine_chunks(),
            pa.array(packed, pa.binary()),
            pa.array([pack(counts[place[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ],
        schema=ANSWER,
    )


def _vocabulary(table: pa.Table) -> pa.Table:
    _, _, counts = _shard_counts(table)
    return pa.table({"words": [int((counts > 0).sum())]})


SCORE_DDL = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, score double"
SCORE = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("logs", pa.float64()), ("score", pa.float64()),
])


def _scores(model: Model, taught: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return SCORE.empty_table()
        keys = np.frombuffer(b"".join(answers.column("keys").to_pylist()), U64)
        counts = np.frombuffer(b"".join(answers.column("counts").to_pylist()), np.int64)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        texts = strings(docs.column("text"))
        n, known, logs, score = (np.zeros(docs.num_rows, k) for k in (np.int64, np.int64, float, float))
        for low, high in slices(texts, SIDE_BY_SIDE):
            data, edges, tokens, words, per_doc = coded_bytes(texts.slice(low, high - low))
            n[low:high] = per_doc + 1
            c = np.full(len(tokens) - 1, taught, np.int64)  # the ends; then the words
            is_word = np.ones(len(c), bool)
            is_word[np.cumsum(per_doc + 1) - 1] = False
            c[is_word] = counts[member(words, keys)[1]]
            owner = np.repeat(np.arange(high - low), per_doc + 1)
            both = refined(model.token_logs(data, edges, tokens), c / max(1, model.tokens), per_doc + 1)
            known[low:high] = np.bincount(owner, c > 0, high - low)
            logs[low:high] = np.bincount(owner, np.log10(c + 1.0), high - low)
            score[low:high] = np.bincount(owner, both, high - low) / np.log(10)
        held = pa.array(~docs.column("learn").to_numpy())
        columns = [docs.column("doc_id").combine_chunks(), held, *(pa.array(x) for x in (n, known, logs, score))]
        return pa.Table.from_arrays(columns, schema=SCORE)

    return run


def lm_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """Score every text, learning from the rows where ``learn`` holds (null: it does not).

    Returns per row of ``docs``: doc_id, held_out, n_tokens (words and one end),
    n_known (tokens seen in training), train_tokens, base_score (log10 under
    add-one token frequencies) and score (log10 probability under the mixed model).

    A null text is empty: one token, the end. Rows count one by one, also where
    they repeat or share a doc_id. If nothing is learned, every count is 0 and the
    model predicts even odds. An empty table gives no rows. Words are told apart by
    64-bit hashes.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    counted = docs.filter("learn").select("text").mapInArrow(_count_bytes, COUNT_DDL)
    model = Model(counted.groupBy("ord", "part").applyInArrow(_add_counts, COUNT_DDL).collect())

    rows, size, taught = docs.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if("learn")
    ).first()
    blocks = max(1, -(-rows // BLOCK_DOCS), -(-size // BLOCK_BYTES))
    shards = max(1, -(-size // 6 // TOKENS_PER_SHARD))
    blocked = docs.select(block_of(blocks), "doc_id", "text", "learn")
    by_shard = blocked.groupBy("block").applyInArrow(_word_asks(shards), ASK_DDL).groupBy("shard")
    answers = by_shard.applyInArrow(_word_answers, ANSWER_DDL)
    seen = by_shard.applyInArrow(_vocabulary, "words bigint").agg(F.coalesce(F.sum("words"), F.lit(0)))
    scored = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores(model, taught), SCORE_DDL)
    room = F.lit(model.tokens + int(taught > 0) + 1) + F.col("seen")
    return scored.withColumn("seen", seen.scalar()).select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(room)).alias("base_score"),
        "score",
    )
