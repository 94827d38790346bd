"""What the operators share: tables, checkpoints, blocks of documents and word hashes in numpy.

Operators take a frame with ``doc_id`` and ``text`` and look at nothing else, so
extra columns never clash. Null texts count as empty texts unless a docstring
says otherwise.
"""

from __future__ import annotations

import ctypes
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLOCK_ROWS = 256
BLOCK_BYTES = 4 << 20
HASH_STEP = 1 << 20
U64 = np.uint64


def give_back() -> None:
    """Hand freed memory back to the system; Python workers live on idle between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run):
    """A function of batches that leaves its worker small: once its locals are gone, memory goes back."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """Just (doc_id long, text string)."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of spark.checkpoint.dir.

    Only where that setting is absent (tests, notebooks) a folder in the warehouse is used.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like cut, as a Parquet table in the same folder; smaller than a checkpoint where rows hold texts."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def block_count(docs: DataFrame) -> int:
    """Blocks of about 256 documents and 4 MB of text, whatever the input size."""
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return max(1, -(-n // BLOCK_ROWS), -(-size // BLOCK_BYTES))


def block_of(blocks: int) -> Column:
    """Block of a document. The text takes part, so rows that share an id spread too."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")


def crc_mod(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def strings(column) -> pa.LargeBinaryArray:
    """One contiguous array of bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks] or [pa.array([], pa.large_binary())])
    return column.cast(pa.large_binary()).fill_null(b"")


def bytes_of(array: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the values, without copying them."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(array: pa.LargeBinaryArray, size: int = HASH_STEP):
    """(start, stop) of runs of values of about ``size`` bytes; a larger value stands alone."""
    _, offsets = bytes_of(array)
    start = 0
    while start < len(array):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield start, min(stop, len(array))
        start = stop


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
    """(starts, ends, words per document): runs of bytes other than ``between``, by default ASCII white space."""
    word = ~between[buf]
    n = len(buf)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE, STEP = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
INVERSE = {b: pow(b, -1, 1 << 64) for b in (BASE, STEP)}


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, room: int) -> np.ndarray:
    """Polynomial hash of each values[start:end], from one running sum."""
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _powers(base, room)[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(INVERSE[base], room)[starts]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, in steps of about a megabyte whatever the length of the text."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + HASH_STEP, "right")))
        high = ends[to - 1]
        room = HASH_STEP if high - low <= HASH_STEP else int(high - low)
        values = _byte_values()[buf[low:high]]
        out[at:to] = _ranges(values, starts[at:to] - low, ends[at:to] - low, BASE, room)
        at = to
    return mix(out ^ (ends - starts).astype(U64))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` words; runs across documents are the caller's to mask."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.empty(n, U64)
    for low in range(0, n, HASH_STEP // 2):
        high = min(n, low + HASH_STEP // 2)
        part = words[low : high + length - 1]
        at = np.arange(high - low)
        out[low:high] = _ranges(part, at, at + length, STEP, HASH_STEP // 2 + 4096 if length <= 4096 else len(part))
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def member(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is in, place) of ``values`` in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    place = np.searchsorted(ordered, values)
    place[place == len(ordered)] = 0
    return ordered[place] == values, place
