"""Spelling variants: Bloom-guided neighbourhoods of a vocabulary.

1. Words are counted in Spark. Letters are a-z and the Latin-1 letters, so a word of
   n letters is n bytes, and there are at most 90 letters to replace one with.
2. The vocabulary goes into blocked Bloom filters, one set of blocks per word length,
   built in Spark segment by segment and broadcast. ``FILTER_BYTES`` bounds what is
   broadcast at a time; a larger vocabulary is probed in several passes, each over
   the words whose hash falls into its share, so no pass has more false positives.
3. Every word generates its deletions (which belong to the filter one letter shorter)
   and its replacements by a later letter (same length). Each pair of near words
   arises exactly once: an insertion is a deletion seen from the longer word. Hashes
   of edits come from the hash of the word, without building the edited word.
4. Only edits that pass the filter are written out and meet the vocabulary in an exact
   join, which drops the false positives. A word has at most 91 * (2 * length + 1)
   near words, so no join key is hot.
5. Forms are followed step by step; n grows by the factor at each step, so the number of
   steps follows from the largest n.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlift.llm.common import U64, documents, mix, stored

# The letters of a word.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = np.array(sorted([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]), np.int64)

BITS_A_WORD = 16
PROBES = 6
BLOCK_WORDS = 8  # 64-bit words of a block
SEGMENT_BLOCKS = 1 << 14
FILTER_BYTES = 64 << 20
PROBE_STEP = 1 << 20


# ---- counting ------------------------------------------------------------------


def slipped_words(docs: DataFrame, every: int | None) -> DataFrame:
    """One row (word) per run of letters, A-Z lowered; with ``every``, planted slips.

    A run whose crc32 of ``<doc_id>:<run>`` is divisible by ``every`` loses the
    letter at crc32 % length. A null doc_id counts as an empty one.
    """
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.split(lowered, f"[^{LETTERS}]+")).alias("run")).filter("run <> ''")
    if every is None:
        return runs.select(F.col("run").alias("word"))
    tagged = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs.withColumn("h", F.crc32(tagged.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, slip).otherwise(F.col("run")).alias("word"))


def word_counts(docs: DataFrame, every: int | None, min_letters: int, min_count: int) -> DataFrame:
    words = slipped_words(docs, every).filter(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# ---- hashes of words and of their edits ------------------------------------------

BASE = U64(0x9E3779B97F4A7C15)
VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def raw_hashes(codes: np.ndarray) -> np.ndarray:
    """Sum of value * BASE^place per row of letters; ``finish`` spreads it."""
    return (VALUES[codes] * _powers(codes.shape[1])[: codes.shape[1]]).sum(axis=1, dtype=U64)


def finish(raw: np.ndarray, length: int) -> np.ndarray:
    return mix(raw ^ U64(length * 0xA24BAED4963EE407 % (1 << 64)))


def deletions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(raw hashes, is to be probed) per row and place; of equal neighbours only the last is deleted."""
    n, length = codes.shape
    terms = VALUES[codes] * _powers(length)[:length]
    before = np.zeros((n, length + 1), U64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    inverse = U64(pow(int(BASE), -1, 1 << 64))
    raw = before[:, :-1] + (before[:, -1:] - before[:, 1:]) * inverse
    fresh = np.ones((n, length), bool)
    fresh[:, :-1] = codes[:, :-1] != codes[:, 1:]
    return raw, fresh


def replacements(codes: np.ndarray, raw: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(raw hashes, is to be probed) per row, place from ``low`` to ``high`` and letter; only later letters."""
    own = codes[:, low:high, None]
    power = _powers(high)[low:high]
    return raw[:, None, None] + (VALUES[ALPHABET] - VALUES[own]) * power[None, :, None], ALPHABET > own


# ---- Bloom filter --------------------------------------------------------------


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(blocks) >> U64(32)).astype(np.int64)


def _bits(hashes: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
    """(word of the block, mask) of one probe; nine fresh bits a probe."""
    nine = mix(hashes ^ U64(0x5851F42D4C957F2D)) >> U64(9 * probe)
    return (nine & U64(7)).astype(np.int64), U64(1) << ((nine >> U64(3)) & U64(63))


def add(words: np.ndarray, blocks: np.ndarray, hashes: np.ndarray) -> None:
    for probe in range(PROBES):
        lane, mask = _bits(hashes, probe)
        np.bitwise_or.at(words, (blocks, lane), mask)


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter holds; each probe looks only at those that passed the last."""
    at = np.arange(len(hashes))
    for probe in range(PROBES):
        lane, mask = _bits(hashes[at], probe)
        at = at[(words[block_of(hashes[at], len(words)), lane] & mask) != 0]
        if not len(at):
            break
    out = np.zeros(len(hashes), bool)
    out[at] = True
    return out


# ---- Spark steps ---------------------------------------------------------------

BIT_DDL = "length int, segment int, bits binary"
BITS = pa.schema([("length", pa.int32()), ("segment", pa.int32()), ("bits", pa.binary())])
HASHED_DDL = "length int, segment int, hash bigint"
CANDIDATE = pa.schema([("word", pa.string()), ("other", pa.string())])


def _by_length(column: pa.Array):
    """(letters as a matrix of Latin-1 codes) per word length of a batch."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        joined = b"".join(words[i] for i in np.flatnonzero(lengths == length))
        yield int(length), np.frombuffer(joined, np.uint8).reshape(-1, length).astype(np.int64)


def share_of(hashes: np.ndarray, shares: int) -> np.ndarray:
    return (mix(hashes ^ U64(0xC2B2AE3D27D4EB4F)) % U64(shares)).astype(np.int64)


def _hashed(blocks: dict[int, int], share: int, shares: int):
    def run(batches):
        for batch in batches:
            for length, codes in _by_length(batch.column("word")):
                hashes = finish(raw_hashes(codes), length)
                hashes = hashes[share_of(hashes, shares) == share]
                segment = block_of(hashes, blocks[length]) // SEGMENT_BLOCKS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), length, np.int32)), pa.array(segment.astype(np.int32)), pa.array(hashes.view(np.int64))],
                    names=["length", "segment", "hash"],
                )

    return run


def _segment(blocks: dict[int, int]):
    def run(table: pa.Table) -> pa.Table:
        length, segment = table.column("length")[0].as_py(), table.column("segment")[0].as_py()
        hashes = table.column("hash").to_numpy().view(U64)
        low = segment * SEGMENT_BLOCKS
        words = np.zeros((min(SEGMENT_BLOCKS, blocks[length] - low), BLOCK_WORDS), U64)
        add(words, block_of(hashes, blocks[length]) - low, hashes)
        return pa.Table.from_pylist([{"length": length, "segment": segment, "bits": words.tobytes()}], schema=BITS)

    return run


def filters(vocabulary: DataFrame, blocks: dict[int, int], share: int, shares: int) -> dict[int, np.ndarray]:
    """Bloom filter per word length, of the words of one share; at most FILTER_BYTES in all reach the driver."""
    hashed = vocabulary.select("word").mapInArrow(_hashed(blocks, share, shares), HASHED_DDL)
    built = hashed.groupBy("length", "segment").applyInArrow(_segment(blocks), BIT_DDL)
    out = {length: np.zeros((n, BLOCK_WORDS), U64) for length, n in blocks.items()}
    for r in built.collect():
        bits = np.frombuffer(r["bits"], U64).reshape(-1, BLOCK_WORDS)
        low = r["segment"] * SEGMENT_BLOCKS
        out[r["length"]][low : low + len(bits)] = bits
    return out


def probed(codes: np.ndarray, bloom: dict[int, np.ndarray], share: int, shares: int):
    """(rows, edited letters) of the edits of words of one length that pass the filters."""
    length = codes.shape[1]

    def held(raw: np.ndarray, fresh: np.ndarray, size: int) -> np.ndarray:
        at = np.flatnonzero(fresh)
        hashes = finish(raw.ravel()[at], size)
        mine = share_of(hashes, shares) == share if shares > 1 else slice(None)
        return at[mine][passes(bloom[size], hashes[mine])]

    if length - 1 in bloom:
        rows, places = np.divmod(held(*deletions(codes), length - 1), length)
        left = np.arange(length)[None, :] != places[:, None]
        yield rows, codes[rows][left].reshape(len(rows), length - 1)
    if length in bloom:
        raw = raw_hashes(codes)
        step = max(1, PROBE_STEP // (len(codes) * len(ALPHABET)))
        for low in range(0, length, step):
            high = min(low + step, length)
            at, letters = np.divmod(held(*replacements(codes, raw, low, high), length), len(ALPHABET))
            rows, places = np.divmod(at, high - low)
            edited = codes[rows]
            edited[np.arange(len(rows)), low + places] = ALPHABET[letters]
            yield rows, edited


def _candidates(bloom, share: int, shares: int):
    def text(codes: np.ndarray) -> list[str]:
        return [bytes(c).decode("latin-1") for c in codes.astype(np.uint8)]

    def run(batches):
        for batch in batches:
            for length, codes in _by_length(batch.column("word")):
                step = max(1, PROBE_STEP // (length + len(ALPHABET)))
                for low in range(0, len(codes), step):
                    part = codes[low : low + step]
                    for rows, edited in probed(part, bloom.value, share, shares):
                        if len(rows):
                            yield pa.RecordBatch.from_arrays([pa.array(text(part[rows])), pa.array(text(edited))], schema=CANDIDATE)

    return run


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, other): each pair of words one inserted, deleted or replaced letter apart, once.

    ``vocabulary`` has distinct words (word) of letters a-z and U+00C0 to U+00FF.
    """
    counted = vocabulary.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["length"]: r["n"] for r in counted}  # one row per word length
    asked = sum(sizes.values()) * BITS_A_WORD // 8
    shares = max(1, -(-asked // filter_bytes))
    blocks = {length: max(1, -(-n * BITS_A_WORD // (shares * 64 * BLOCK_WORDS))) for length, n in sizes.items()}
    spark, found = vocabulary.sparkSession, []
    for share in range(shares):
        bloom = spark.sparkContext.broadcast(filters(vocabulary, blocks, share, shares))
        edits = vocabulary.select("word").mapInArrow(_candidates(bloom, share, shares), "word string, other string")
        found.append(stored(edits.join(vocabulary.select(F.col("word").alias("other")), "other").select("word", "other")))
        bloom.destroy()
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) for (word, form), where no chain of forms is longer than ``steps``."""
    further = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    ahead = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps - 1):
        ahead = ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return ahead


def spelling_variants(
    docs: DataFrame, min_letters: int = 6, min_count: int = 5, factor: int = 5, slip_every: int | None = None
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of ``docs`` (doc_id, text).

    Words are maximal runs of Latin-1 letters, A-Z lowered, of at least ``min_letters``
    letters and ``min_count`` occurrences. A word's form is its near word of largest n
    (ties: least word), if that n is at least ``factor`` times its own; root follows the
    forms to the last. A word without near words has n_near 0 and null form and form_n.

    Null and empty texts hold no word. Rows may repeat or share a doc_id; every
    occurrence counts. No text, or none with a word frequent enough, gives no rows.
    ``slip_every`` plants slips, see ``slipped_words``; documents without id then count
    as having an empty one. ``factor`` must be at least 2, or forms could run in circles.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2")
    vocabulary = stored(word_counts(documents(docs), slip_every, min_letters, min_count))
    pairs = near_pairs(vocabulary)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    others = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(others, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("best")
    )
    form_n = -F.col("best.least")
    likely = form_n >= F.col("n") * factor
    named = stored(vocabulary.join(best, "word", "left").select(
        "word",
        F.when(likely, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(likely, form_n).alias("form_n"),
    ))
    forms = named.filter("form IS NOT NULL").select("word", "form")
    most = named.agg(F.max("form_n")).first()[0] or 1
    roots = _roots(forms, int(math.log(most, factor)) + 1)
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
