"""Substring dedup by level-wise doubling.

Level 1 looks at windows of half the length, ceil(window / 2) words. Of these,
each full window only names the one with the least hash (all copies of a window
name the same), so about a quarter of the short windows travel. Short windows
that occur in one document alone are dropped with everything that named them.
Those that repeat are extended to twice their length, cut at ``window``, and
judged exactly by (64-bit hash, least doc_id). If no candidate survives a level,
nothing is sent for the next.

Traffic is packed per (shard of hashes, block of documents): each block asks for
a hash once, so a passage that sits in a third of all documents costs one entry
per block, and shards stay even.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlift.llm.common import (
    U64, block_count, block_of, bytes_of, documents, member, pack, sliding_min, slices, strings, window_hashes,
    word_hashes, word_spans,
)

ASKS_PER_SHARD = 1 << 20
NO_ID = np.iinfo(np.int64).max


class Windows:
    """The windows of a run of documents: per window its document, short-window name and, on demand, full hash."""

    def __init__(self, texts: pa.LargeBinaryArray, window: int):
        self.buf, offsets = bytes_of(texts)
        self.starts, self.ends, self.counts = word_spans(self.buf, offsets)
        self.words = word_hashes(self.buf, self.starts, self.ends)
        self.window, self.short = window, -(-window // 2)
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        whole = owner[: max(0, len(owner) - window + 1)] == owner[window - 1 :]
        self.at = np.flatnonzero(whole)
        self.doc = owner[self.at]
        names = sliding_min(window_hashes(self.words, self.short), window - self.short + 1)
        self.names = names[self.at]

    def full(self) -> np.ndarray:
        return window_hashes(self.words, self.window)[self.at]


def _runs(ids, texts, window):
    for low, high in slices(texts):
        yield ids[low:high], Windows(texts.slice(low, high - low), window), low


def _ids(column) -> np.ndarray:
    """doc_ids; a null id sorts last, so it never lets another document lose words."""
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy()


def _by_shard(keys: np.ndarray, shards: int):
    """Sorted keys, cut at the shards of their high bits."""
    shard = (keys >> U64(32)) % U64(shards)
    order = np.lexsort((keys, shard))
    bounds = np.searchsorted(shard[order], np.arange(shards + 1, dtype=U64))
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), order[bounds[s] : bounds[s + 1]]


ASK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
ASK_DDL = "shard int, block int, keys binary, low binary, high binary"


def _asks(block: int, keys: np.ndarray, ids: np.ndarray, shards: int):
    """One row per shard: each key once, with the least and greatest doc_id that holds it in this block."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    last = np.r_[first[1:] - 1, len(keys) - 1] if len(first) else first
    keys, low, high = keys[first], ids[first], ids[last]
    for s, pick in _by_shard(keys, shards):
        yield {"shard": s, "block": block, "keys": pack(keys[pick]), "low": pack(low[pick]), "high": pack(high[pick])}


SHORT_ASK_DDL = "shard int, keys binary, blocks binary, twice binary"
SHORT_ASK = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("blocks", pa.binary()), ("twice", pa.binary())])


def _short_asks(window: int, shards: int):
    """One row per batch and shard: each name once per block, by its low 32 bits."""

    def run(batches):
        for batch in batches:
            ids, texts, blocks = _ids(batch.column("doc_id")), strings(batch.column("text")), batch.column("block").to_numpy()
            key, doc, block = [], [], []
            for own, w, low in _runs(ids, texts, window):
                # neighbouring windows mostly share their name
                keep = np.r_[True, (w.names[1:] != w.names[:-1]) | (w.doc[1:] != w.doc[:-1])] if len(w.names) else np.zeros(0, bool)
                key.append(w.names[keep])
                doc.append(own[w.doc[keep]])
                block.append(blocks[low + w.doc[keep]])
            if not key:
                continue
            key, doc, block = np.concatenate(key), np.concatenate(doc), np.concatenate(block)
            order = np.lexsort((doc, key, block))
            key, doc, block = key[order], doc[order], block[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]) if len(key) else np.zeros(0, int)
            last = np.r_[first[1:], len(key)] - 1 if len(first) else first
            twice, key, block = doc[first] != doc[last], key[first], block[first]
            shard = ((key >> U64(32)) % U64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            bounds = np.searchsorted(shard[order], np.arange(shards + 1))
            picks = [(s, order[bounds[s] : bounds[s + 1]]) for s in np.flatnonzero(np.diff(bounds))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in picks], pa.int32()),
                    pa.array([pack(key[p].astype(np.uint32)) for _, p in picks], pa.binary()),
                    pa.array([pack(block[p].astype(np.int32)) for _, p in picks], pa.binary()),
                    pa.array([pack(twice[p]) for _, p in picks], pa.binary()),
                ],
                schema=SHORT_ASK,
            )

    return run


def _joined(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values, row of each) of a column of packed arrays."""
    parts = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    sizes = [len(p) for p in parts]
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), np.repeat(np.arange(len(parts)), sizes)


ANSWER_DDL = "block int, shard int, keys binary, low binary"
ANSWER = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("low", pa.binary())])


def _answers(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=ANSWER)


def _short_repeats(table: pa.Table) -> pa.Table:
    """Of one shard: short windows held by two documents or more, per block that asked."""
    keys, _ = _joined(table, "keys", np.uint32)
    block, _ = _joined(table, "blocks", np.int32)
    twice, _ = _joined(table, "twice", np.bool_)
    order = np.lexsort((block, keys))
    keys, block, twice = keys[order], block[order], twice[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    group = np.cumsum(np.r_[False, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    # map tasks that share a block send apart; counting them as two only adds candidates, never loses one
    often = (np.diff(np.r_[first, len(keys)]) > 1) | (np.bincount(group, weights=twice, minlength=len(first)) > 0)
    keep = often[group]
    order = np.lexsort((keys[keep], block[keep]))
    keys, block = keys[keep][order], block[keep][order]
    s, cuts = int(table.column("shard")[0].as_py()), np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
    return _answers([
        {"block": int(block[a]), "shard": s, "keys": pack(np.unique(keys[a:b])), "low": b""}
        for a, b in zip(cuts, [*cuts[1:], len(block)])
    ])


def _full_repeats(table: pa.Table) -> pa.Table:
    """Of one shard: full windows that start in an earlier document too, with its id, per block that asked."""
    keys, row = _joined(table, "keys", U64)
    low, _ = _joined(table, "low", np.int64)
    high, _ = _joined(table, "high", np.int64)
    order = np.argsort(keys, kind="stable")
    keys, low, high, row = keys[order], low[order], high[order], row[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    group = np.cumsum(np.r_[False, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    least = np.minimum.reduceat(low, first)[group] if len(keys) else low
    keep = high > least
    keys, least, row = keys[keep], least[keep], row[keep]
    order = np.argsort(row, kind="stable")
    keys, least, row = keys[order], least[order], row[order]
    s, cuts = int(table.column("shard")[0].as_py()), np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else []
    blocks = table.column("block").to_pylist()
    return _answers([
        {"block": blocks[row[a]], "shard": s, "keys": pack(keys[a:b]), "low": pack(least[a:b])}
        for a, b in zip(cuts, [*cuts[1:], len(row)])
    ])


def _known_names(answers: pa.Table) -> np.ndarray:
    """Repeated short windows of a block as sorted (shard, low 32 bits)."""
    keys, row = _joined(answers, "keys", np.uint32)
    shard = answers.column("shard").to_numpy()[row].astype(U64)
    return np.sort((shard << U64(32)) | keys.astype(U64))


def _full_asks(window: int, shards: int, full_shards: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known, keys, owners = _known_names(answers), [], []
        if docs.num_rows and len(known):
            for own, w, _ in _runs(_ids(docs.column("doc_id").combine_chunks()), strings(docs.column("text")), window):
                name = (((w.names >> U64(32)) % U64(shards)) << U64(32)) | (w.names & U64(0xFFFFFFFF))
                hit = member(name, known)[0]
                if hit.any():
                    keys.append(w.full()[hit])
                    owners.append(own[w.doc[hit]])
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        rows = list(_asks(block, np.concatenate(keys), np.concatenate(owners), full_shards)) if keys else []
        return pa.Table.from_pylist(rows, schema=ASK)

    return run


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed", pa.list_(pa.list_(pa.int64()))),
])
RESULT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, removed array<array<bigint>>"


def _remove(window: int, digest: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, _ = _joined(answers, "keys", U64)
        low, _ = _joined(answers, "low", np.int64)
        order = np.argsort(keys)
        keys, low = keys[order], low[order]
        if not docs.num_rows:
            return (DIGEST if digest else RESULT).empty_table()
        doc_ids, texts = docs.column("doc_id").combine_chunks(), strings(docs.column("text"))
        out = []
        for own, w, at in _runs(_ids(doc_ids), texts, window):
            gone = np.zeros(len(w.words) + 1, np.int64)
            if len(keys) and len(w.at):
                hit, place = member(w.full(), keys)
                hit &= low[place] < own[w.doc]
                np.add.at(gone, w.at[hit], 1)
                np.subtract.at(gone, np.minimum(w.at[hit] + window, len(w.words)), 1)
            gone = np.cumsum(gone)[:-1] > 0
            data, ends = w.buf.tobytes(), np.cumsum(w.counts)
            for i, (b, n) in enumerate(zip(ends, w.counts)):
                a = b - n
                kept = np.flatnonzero(~gone[a:b]) + a
                text = b" ".join([data[s:e] for s, e in zip(w.starts[kept].tolist(), w.ends[kept].tolist())])
                row = {"doc_id": doc_ids[at + i].as_py(), "n_words": int(n), "n_removed": int(n) - len(kept)}
                if digest:
                    row["kept_sha256"] = hashlib.sha256(text).hexdigest()
                else:
                    turns = np.flatnonzero(np.diff(np.r_[False, gone[a:b], False]))
                    row |= {"kept_text": text.decode("utf-8", "replace"), "removed": turns.reshape(-1, 2).tolist()}
                out.append(row)
        return pa.Table.from_pylist(out, schema=DIGEST if digest else RESULT)

    return run


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
DIGEST_DDL = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def substring_dedup(docs: DataFrame, window: int = 13, digest: bool = False) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller doc_id.

    Words are runs of bytes other than ASCII white space; windows are judged on
    the input. Returns per row of ``docs``: doc_id, n_words, n_removed, kept_text
    (kept words joined by one space) and the removed [from, to) word spans; with
    ``digest`` the SHA-256 of kept_text in place of the last two.

    Null texts have no words. Rows that share a doc_id are one document for the
    comparison and never remove each other's words; a null doc_id counts as
    larger than any other. Texts shorter than the window are kept whole. Equal
    windows are told by 64-bit hashes.
    """
    docs = documents(docs)
    blocks = block_count(docs)
    blocked = docs.select(block_of(blocks), "doc_id", "text")
    words = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 5
    shards = max(1, -(-words // 4 // ASKS_PER_SHARD * 4))
    asks = blocked.mapInArrow(_short_asks(window, shards), SHORT_ASK_DDL)
    short = asks.groupBy("shard").applyInArrow(_short_repeats, ANSWER_DDL)
    full_asks = blocked.groupBy("block").cogroup(short.groupBy("block")).applyInArrow(
        _full_asks(window, shards, shards), ASK_DDL
    )
    full = full_asks.groupBy("shard").applyInArrow(_full_repeats, ANSWER_DDL)
    return blocked.groupBy("block").cogroup(full.groupBy("block")).applyInArrow(
        _remove(window, digest), DIGEST_DDL if digest else RESULT_DDL
    )
