"""Document frequencies of hashed words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlift.llm.common import LOWER, SPACE, U64, bytes_of, pack, slices, strings, word_hashes, word_spans

PARTS = 64
BIN_DDL = "part int, bins binary, docs binary"
BIN = pa.schema([("part", pa.int32()), ("bins", pa.binary()), ("docs", pa.binary())])


def word_bins(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> U64(64 - bits)).astype(np.int64)


def lower_words(array: pa.LargeBinaryArray, between: np.ndarray = SPACE, size: int = 1 << 20):
    """(first document, word hashes, words per document) of runs of texts, lower-cased."""
    for low, high in slices(array, size):
        buf, offsets = bytes_of(array.slice(low, high - low))
        starts, ends, counts = word_spans(buf, offsets, between)
        yield low, word_hashes(LOWER[buf], starts, ends), counts


def _count(bits: int, between: np.ndarray):
    """Per task: documents per bin, one row per part of the bins, and the number of documents in part -1."""

    def run(batches):
        total, docs = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            docs += batch.num_rows
            for _, words, counts in lower_words(strings(batch.column("text")), between):
                owner = np.repeat(np.arange(len(counts)), counts)
                pairs = np.sort((owner << bits) | word_bins(words, bits))
                once = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
                total += np.bincount(once & ((1 << bits) - 1), minlength=1 << bits)
        rows = [{"part": -1, "bins": b"", "docs": pack(np.array([docs]))}]
        for p, held in enumerate(total.reshape(PARTS, -1)):
            bins = np.flatnonzero(held)
            if len(bins):
                rows.append({"part": p, "bins": pack(bins.astype(np.int32)), "docs": pack(held[bins])})
        yield pa.RecordBatch.from_pylist(rows, schema=BIN)

    return run


def _add(bits: int):
    def run(table: pa.Table) -> pa.Table:
        part, total = table.column("part")[0].as_py(), np.zeros((1 << bits) // PARTS, np.int64)
        for bins, docs in zip(table.column("bins").to_pylist(), table.column("docs").to_pylist()):
            total[np.frombuffer(bins, np.int32) if part >= 0 else 0] += np.frombuffer(docs, np.int64) if part >= 0 else np.frombuffer(docs, np.int64)[0]
        bins = np.flatnonzero(total)
        return pa.Table.from_pylist([{"part": part, "bins": pack(bins.astype(np.int32)), "docs": pack(total[bins])}], schema=BIN)

    return run


def bin_counts(docs: DataFrame, bits: int, between: np.ndarray = SPACE) -> tuple[np.ndarray, int]:
    """(documents per bin of words, documents) over all rows of ``docs`` (text); 2^bits counts reach the driver."""
    counted = docs.select("text").mapInArrow(_count(bits, between), BIN_DDL).groupBy("part").applyInArrow(_add(bits), BIN_DDL)
    held, n = np.zeros((PARTS, (1 << bits) // PARTS), np.int64), 0
    for r in counted.collect():
        bins, docs_ = np.frombuffer(r["bins"], np.int32), np.frombuffer(r["docs"], np.int64)
        if r["part"] < 0:
            n = int(docs_.sum())
        else:
            held[r["part"], bins] = docs_
    return held.reshape(-1), n


def smooth_idf(held: np.ndarray, n: int) -> np.ndarray:
    """1 + ln(1 + documents / documents with the bin) / ln(1 + documents): from 1 to about 2."""
    return (1 + np.log1p(n / np.maximum(held, 1)) / np.log1p(max(n, 1))).astype(np.float32)


def plain_idf(held: np.ndarray, n: int) -> np.ndarray:
    """ln(1 + documents / documents with the bin)."""
    return np.log1p(n / np.maximum(held, 1)).astype(np.float32)
