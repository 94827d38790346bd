"""Line dedup over a sharded minimal perfect hash.

1. Each task hashes its lines (128 bits) and asks, per (shard of hashes, block of
   documents), for each distinct line once, with the number of documents there.
2. Each shard sums its counts and becomes one index row: a minimal perfect hash
   (levels of bit arrays) with a 32-bit fingerprint and a document count per slot.
3. The blocks' asks probe those arrays; lines over the limit go back to the blocks,
   where the documents drop them.

Documents and lines never meet in a join: a line in a third of all documents is
one entry per block, and a shard holds about 2^15 lines at every input size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerlift.llm.common import U64, block_count, block_of, cut, give_back, mix, pack, strings, tidy

LINES_PER_SHARD = 1 << 15
BLANK = b" \t\n\x0b\x0c\r"
SPARE = 2  # bits per key and level
PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # on bytes, lower() changes A-Z only


def _digests(text: bytes, min_chars: int) -> list[bytes | None]:
    keys = [line_key(x) for x in text.split(b"\n")]
    long = [len(k) >= min_chars and (min_chars < 2 or len(k.decode("utf-8", "replace")) >= min_chars) for k in keys]
    return [xxhash.xxh3_128_digest(k) if ok else None for k, ok in zip(keys, long)]


# ---- minimal perfect hash ------------------------------------------------------


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys["a"] ^ mix(keys["b"] + U64(level))) % U64(size)).astype(np.int64)


def build_index(keys: np.ndarray, counts: np.ndarray) -> dict:
    """Minimal perfect hash of distinct keys: at each level a key alone in its slot gets the bit, the others go on."""
    sizes, bits, rank_of = [], [], np.empty(len(keys), np.int64)
    left, seen = np.arange(len(keys)), 0
    while len(left):
        size = -(-SPARE * len(left) // 8) * 8
        slot = _slots(keys[left], len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        bits.append(np.packbits(alone).tobytes())
        placed = alone[slot]
        rank_of[left[placed]] = seen + (np.cumsum(alone) - 1)[slot[placed]]
        seen += int(alone.sum())
        sizes.append(size)
        left = left[~placed]
    prints, held = np.empty(len(keys), np.uint32), np.empty(len(keys), np.int64)
    prints[rank_of] = (keys["b"] >> U64(32)).astype(np.uint32)
    held[rank_of] = counts
    return {"sizes": sizes, "bits": b"".join(bits), "prints": pack(prints), "counts": pack(held)}


def probe_index(index: dict, keys: np.ndarray) -> np.ndarray:
    """Count of each key; 0 where the slot is empty or holds another fingerprint."""
    prints, counts = np.frombuffer(index["prints"], np.uint32), np.frombuffer(index["counts"], np.int64)
    out, left, seen, at = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0, 0
    for level, size in enumerate(index["sizes"]):
        bits = np.unpackbits(np.frombuffer(index["bits"], np.uint8, size // 8, at)).astype(bool)
        slot = _slots(keys[left], level, size)
        hit = bits[slot]
        rank = seen + (np.cumsum(bits) - 1)[slot[hit]]
        found = left[hit]
        same = prints[rank] == (keys["b"][found] >> U64(32)).astype(np.uint32)
        out[found[same]] = counts[rank[same]]
        seen, at, left = seen + int(bits.sum()), at + size // 8, left[~hit]
    return out


# ---- Spark steps ---------------------------------------------------------------

ASK_DDL = "shard int, keys binary, blocks binary, docs binary"
ASK = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("blocks", pa.binary()), ("docs", pa.binary())])
INDEX_DDL = "shard int, sizes array<bigint>, bits binary, prints binary, counts binary"
INDEX = pa.schema([
    ("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary()),
])
DROP_DDL = "block int, keys binary"
DROP = pa.schema([("block", pa.int32()), ("keys", pa.binary())])


def _line_asks(shards: int, min_chars: int):
    """One row per batch and shard: each line once per block, with the number of documents there."""

    def run(batches):
        for batch in batches:
            digests, block = [], []
            for b, text in zip(batch.column("block").to_pylist(), strings(batch.column("text")).to_pylist()):
                own = {d for d in _digests(text, min_chars) if d is not None}
                digests.extend(own)
                block.extend([b] * len(own))
            if not digests:
                continue
            keys, block = np.frombuffer(b"".join(digests), PAIR), np.array(block)
            shard = (keys["a"] % U64(shards)).astype(np.int64)
            order = np.lexsort((keys["b"], keys["a"], block, shard))
            keys, block, shard = keys[order], block[order], shard[order]
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (block[1:] != block[:-1])])
            docs = np.diff(np.r_[first, len(keys)])
            keys, block, shard = keys[first], block[first], shard[first]
            cell = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            spans = list(zip(cell, [*cell[1:], len(keys)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[cell], pa.int32()),
                    pa.array([pack(keys[a:b]) for a, b in spans], pa.binary()),
                    pa.array([pack(block[a:b].astype(np.int32)) for a, b in spans], pa.binary()),
                    pa.array([pack(docs[a:b]) for a, b in spans], pa.binary()),
                ],
                schema=ASK,
            )

    return run


def _index(asks: pa.Table) -> pa.Table:
    keys = np.frombuffer(b"".join(asks.column("keys").to_pylist()), PAIR)
    docs = np.frombuffer(b"".join(asks.column("docs").to_pylist()), np.int64)
    order = np.argsort(keys, order=("a", "b"))
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    row = {"shard": asks.column("shard")[0].as_py()} | build_index(keys[first], np.add.reduceat(docs, first))
    return pa.Table.from_pylist([row], schema=INDEX)


def _probe(min_docs: int):
    def run(asks: pa.Table, index: pa.Table) -> pa.Table:
        if not asks.num_rows or not index.num_rows:
            return DROP.empty_table()
        arrays = index.to_pylist()[0]
        keys = np.frombuffer(b"".join(asks.column("keys").to_pylist()), PAIR)
        block = np.frombuffer(b"".join(asks.column("blocks").to_pylist()), np.int32)
        often = probe_index(arrays, keys) >= min_docs
        keys, block = keys[often], block[often]
        order = np.argsort(block, kind="stable")
        keys, block = keys[order], block[order]
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
        return pa.Table.from_pylist(
            [{"block": int(block[a]), "keys": pack(keys[a:b])} for a, b in zip(cuts, [*cuts[1:], len(block)])], schema=DROP
        )

    return run


COUNTS = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())]
COUNTS_DDL = "doc_id bigint, n_lines bigint, n_dropped bigint"


def _drop(min_chars: int, digest: bool, carry: list[str]):
    def run(docs: pa.Table, drops: pa.Table) -> pa.Table:
        packed = b"".join(drops.column("keys").to_pylist())
        often = {packed[i : i + 16] for i in range(0, len(packed), 16)}
        sizes, dropped, texts = [], [], []
        for text in strings(docs.column("text")).to_pylist():
            lines = text.split(b"\n")
            kept = [x for x, d in zip(lines, _digests(text, min_chars)) if d is None or d not in often] if often else lines
            joined = b"\n".join(kept)
            sizes.append(len(lines))
            dropped.append(len(lines) - len(kept))
            texts.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace"))
        columns = [docs.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())]
        names = [n for n, _ in COUNTS] + ["kept_sha256" if digest else "kept_text"]
        give_back()
        return pa.Table.from_arrays(columns + [docs.column(f"carry_{i}") for i in range(len(carry))], names=names + carry)

    return run


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, digest: bool = False, carry: list[str] | None = None) -> DataFrame:
    r"""Drop every line whose key is found in at least ``min_docs`` documents, in all of them.

    Texts are split at \n; a key is the line without ASCII white space at both
    ends and with A-Z lowered; keys under ``min_chars`` code points never count.
    Returns per row of ``docs``: doc_id, n_lines, n_dropped and kept_text (the
    other lines, unchanged, joined by \n) or, with ``digest``, its SHA-256, then the
    columns of ``docs`` named in ``carry``.

    A null or empty text is one empty line. Each row is a document of its own,
    also where rows share a doc_id or have none; a line repeated within one
    document counts once. An empty table gives an empty result. Lines are told
    apart by 128-bit hashes.
    """
    carry = carry or []
    carried = [F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)]
    types = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    blocks = block_count(docs)
    blocked = docs.withColumn("block", block_of(blocks))
    lines = docs.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit("\n")) + 1), F.lit(1))).first()[0]
    shards = max(1, -(-lines // LINES_PER_SHARD))
    asks = cut(blocked.select("block", "text").mapInArrow(tidy(_line_asks(shards, min_chars)), ASK_DDL))
    index = asks.groupBy("shard").applyInArrow(_index, INDEX_DDL)
    drops = asks.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe(min_docs), DROP_DDL)
    return blocked.groupBy("block").cogroup(drops.groupBy("block")).applyInArrow(
        _drop(min_chars, digest, carry), f"{COUNTS_DDL}, {'kept_sha256' if digest else 'kept_text'} string{types}"
    )
