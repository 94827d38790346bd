"""Vector codes: product quantisation in whole numbers, searched in the Walsh-Hadamard domain.

Components become integers floor(scale * x). A vector is cut into equal parts, and
each part position has its own codebook. For the search both parts and entries are
zero-padded to a power of two and go through the integer Walsh-Hadamard transform,
its rows in sequency order (by number of sign changes). The transform keeps
distances up to the factor ``size``, so the squared differences of the coefficients,
added up from the slowest to the fastest, are a growing lower bound of the scaled
distance: an entry whose sum exceeds the scaled distance of a likely entry is out
before its remaining coefficients are looked at. Nothing is rounded anywhere.

The codebooks (parts x entries x width) are the only thing that passes through the
driver; their size does not depend on the number of vectors.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlift.llm.common import stored

ROWS_AT_ONCE = 2048
SALTS = 64
LARGEST = 1 << 24


# ---- transform and search ------------------------------------------------------


@lru_cache(maxsize=16)
def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``size`` (a power of two), by their number of sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Integer transform of each row, zero-padded to a power of two, in sequency order."""
    size = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), size), np.int64)
    out[:, : x.shape[1]] = x
    half = 1
    while half < size:
        pairs = out.reshape(len(x), size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
        half *= 2
    return out[:, sequency_order(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance, entries left after each coefficient) per row; ties to the lower index."""
    size = 1 << max(0, x.shape[1] - 1).bit_length()
    xs, es = walsh_hadamard(x), walsh_hadamard(entries)
    first = (xs[:, :1] - es[None, :, 0]) ** 2
    likely = first.argmin(axis=1)
    limit = ((xs - es[likely]) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= limit[:, None])
    total, left = first[row, entry], [len(row)]
    for c in range(1, size):
        total = total + (xs[row, c] - es[entry, c]) ** 2
        keep = total <= limit[row]
        row, entry, total = row[keep], entry[keep], total[keep]
        left.append(len(row))
    start = np.searchsorted(row, np.arange(len(x)))
    best = np.minimum.reduceat(total, start) if len(x) else np.zeros(0, np.int64)
    at = np.flatnonzero(total == best[row])  # in order of row and entry: the first of a row is its lowest index
    _, low = np.unique(row[at], return_index=True)
    return entry[at[low]], best // size, np.array(left)


def _assigned(batch: pa.RecordBatch, codebooks: np.ndarray):
    """Per run of rows: (first row, parts as [row, part, component], entries, squared distances)."""
    parts, _, width = codebooks.shape
    column = batch.column("v")
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    for low in range(0, batch.num_rows, ROWS_AT_ONCE):
        high = min(low + ROWS_AT_ONCE, batch.num_rows)
        lengths = np.diff(offsets[low : high + 1])
        x = np.zeros((high - low, parts * width), np.int64)
        x[np.arange(parts * width)[None, :] < lengths[:, None]] = flat[offsets[low] : offsets[high]]
        x = x.reshape(high - low, parts, width)
        found = [nearest(x[:, p], codebooks[p])[:2] for p in range(parts)]
        yield low, x, np.stack([e for e, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


# ---- Spark steps ---------------------------------------------------------------

KEPT = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int32()))])
TOTALS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])
CODED = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("codes", pa.list_(pa.int32())), ("error", pa.int64())])


def _whole_numbers(scale: float):
    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("v").is_valid())
            column = batch.column("v")
            offsets = column.offsets.to_numpy()
            x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            out_of_range = np.r_[0, np.cumsum(~(np.abs(x) <= LARGEST))][offsets - offsets[0]]
            values = np.where(np.abs(x) <= LARGEST, x, 0).astype(np.int32)
            whole = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(values))
            kept = pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), whole], schema=KEPT)
            yield kept.filter(pa.array(np.diff(out_of_range) == 0))

    return run


def digitised(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, label, v array<int>) of the vectors that take part, written once."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    return stored(rows.mapInArrow(_whole_numbers(scale), "vec_id bigint, label bigint, v array<int>"))


def _totals(codebooks: np.ndarray):
    def run(batches):
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            for _, x, entry, _ in _assigned(batch, codebooks):
                for p in range(x.shape[1]):
                    np.add.at(sums[p], entry[:, p], x[:, p])
                    counts[p] += np.bincount(entry[:, p], minlength=counts.shape[1])
        part, used = np.nonzero(counts)
        width = codebooks.shape[2]
        columns = [np.repeat(part, width), np.repeat(used, width), np.tile(np.arange(width), len(part))]
        arrays = [pa.array(c.astype(np.int32)) for c in columns]
        arrays += [pa.array(sums[part, used].ravel()), pa.array(np.repeat(counts[part, used], width))]
        yield pa.RecordBatch.from_arrays(arrays, schema=TOTALS)

    return run


def _codes(codebooks: np.ndarray):
    def run(batches):
        for batch in batches:
            found = [(entry, distance.sum(axis=1)) for _, _, entry, distance in _assigned(batch, codebooks)]
            entries = np.concatenate([e for e, _ in found] or [np.zeros((0, len(codebooks)), np.int64)])
            errors = np.concatenate([d for _, d in found] or [np.zeros(0, np.int64)])
            offsets = pa.array(np.arange(len(entries) + 1) * len(codebooks), pa.int32())
            codes = pa.ListArray.from_arrays(offsets, pa.array(entries.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), codes, pa.array(errors)], schema=CODED)

    return run


def train_codebooks(kept: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks [part, entry, component] after ``rounds`` of integer k-means over all rows of ``kept``.

    They start as the parts of the ``entries`` rows of least vec_id (ties: by vector; no id: last).
    """
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    seeds = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    codebooks = np.zeros((parts, len(seeds), width), np.int64)
    for e, seed in enumerate(seeds):
        codebooks[:, e] = np.pad(np.array(seed.v, np.int64), (0, parts * width - len(seed.v))).reshape(parts, width)
    for _ in range(rounds if seeds else 0):
        totals = kept.select("v").mapInArrow(_totals(codebooks), "part int, entry int, place int, total bigint, n bigint")
        means = totals.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        moved = codebooks.copy()
        for r in means.collect():  # at most parts x entries x width rows
            moved[r.part, r.entry, r.place] = r.total // r.n
        codebooks = moved
    return codebooks


def encode(kept: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, codes array<int>, error): nearest entry per part and the summed squared distances."""
    return kept.mapInArrow(_codes(codebooks), "vec_id bigint, label bigint, codes array<int>, error bigint")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per vector of ``vectors`` (vec_id, embedding, label).

    ``code`` holds the entries as two hex digits each, in part order, so ``entries`` is at most 256;
    ``label_error`` adds up the errors of equal labels, null labels together.

    A null vector and one with a null or non-finite component take no part, nor does one with a
    component beyond 2^24 in steps of 1/scale, whose squares would not fit 64 bits. Parts are as
    wide as the longest vector asks for; shorter vectors are filled up with zeros, an empty one is
    all zero. Repeated rows count and return each; a null vec_id stays null and comes last among
    the starting rows. Fewer rows than ``entries`` give a smaller codebook, no rows an empty result.
    """
    kept = digitised(vectors, scale)
    codebooks = train_codebooks(kept, parts, entries, rounds)
    coded = stored(encode(kept, codebooks))
    # a label may hold a third of the rows: its sum is found map-side and met under spread keys
    salt = F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    spread = sums.select(
        F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    met = coded.withColumn("salt", salt).join(spread, (F.col("salt") == F.col("_salt")) & F.col("label").eqNullSafe(F.col("_label")))
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    return met.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
