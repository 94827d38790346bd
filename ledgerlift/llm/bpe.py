"""Byte-level BPE encoding and decoding.

Within each task the texts flow through three steps without a shuffle:

1. Spark splits a text by the pattern; the distinct pieces that this task has not
   met yet are listed, and each text becomes a row of piece numbers.
2. Higher-order functions fold the ranked merges over the bytes of every new piece.
   The rank map is a constant: an array of small maps, so that a look-up costs the
   same for any vocabulary. A step merges the leftmost pair of the least rank.
3. Piece numbers become ids, and ids become bytes again by concatenation.

Joining ids back to texts by piece would move every piece of every text, which is
more than the texts themselves; numbering pieces per task moves nothing.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlift.llm.common import documents, tidy

BUCKETS = 1 << 16
ID_BITS, RANK_BITS = 20, 26
SHIFT, NO_PAIR = 1 << ID_BITS, 1 << 50
LOW_MASK, FIRST_MASK = (1 << RANK_BITS) - 1, (1 << RANK_BITS) - (1 << ID_BITS)
CHUNK_DOCS = 256
FOLD_BYTES = 64  # longer pieces (runs of one letter, say) are merged with a heap
MOST_PIECES = 500_000  # then a task starts a new list of pieces


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 token and rank; ids are ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """Rank of every pair of tokens whose bytes together are a token."""
    return {
        (ranks[t[:i]], ranks[t[i:]]): rank
        for t, rank in ranks.items()
        for i in range(1, len(t))
        if t[:i] in ranks and t[i:] in ranks
    }


def rank_map(spark: SparkSession, pairs: dict[tuple[int, int], int]) -> Column:
    """The pairs as a constant: bucket -> (pair -> rank, in the high bits). Its size is that of the vocabulary."""
    buckets: list[dict[int, int]] = [{} for _ in range(BUCKETS)]
    for (a, b), rank in pairs.items():
        buckets[(a * 31 + b) % BUCKETS][a * SHIFT + b] = rank << RANK_BITS
    one = spark.createDataFrame([(buckets,)], "ranks array<map<bigint,bigint>>")
    return one.select("ranks").scalar()


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def fold_merges(word: Column, ranks: Column) -> Column:
    """Ids of one piece of at most FOLD_BYTES bytes, given as the ids of its bytes.

    The state is one number per token: the rank of its pair with the next token,
    the token's first byte and its id, from high bits to low. So the least number
    is the leftmost pair of the least rank, and a merge changes two numbers.
    """

    def pair(a: Column, b: Column) -> Column:
        bucket = F.get(ranks, (a * 31 + b).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
        return F.coalesce(F.try_element_at(bucket, a * SHIFT + b), F.lit(NO_PAIR))

    def merge(tokens: Column, least: Column) -> Column:
        merged = F.shiftright(least, RANK_BITS)

        def at(p: Column) -> Column:
            after = pair(merged, F.get(tokens, p + 1).bitwiseAND(F.lit(SHIFT - 1)))
            middle = after.bitwiseOR(least.bitwiseAND(F.lit(FIRST_MASK))).bitwiseOR(merged)

            def with_before(before: Column) -> Column:
                low = before.bitwiseAND(F.lit(LOW_MASK))
                left = pair(before.bitwiseAND(F.lit(SHIFT - 1)), merged).bitwiseOR(low)
                return F.concat(F.slice(tokens, 1, p - 2), F.array(left, middle), F.slice(tokens, p + 2, FOLD_BYTES))

            joined = _let(F.get(tokens, p - 2), with_before)
            return F.when(p > 1, joined).otherwise(F.concat(F.array(middle), F.slice(tokens, 3, FOLD_BYTES)))

        return _let(F.array_position(tokens, least).cast("int"), at)

    def step(tokens: Column, _: Column) -> Column:
        return _let(F.array_min(tokens), lambda least: F.when(least < NO_PAIR, merge(tokens, least)).otherwise(tokens))

    def start(token: Column, i: Column) -> Column:
        low = F.shiftleft(i.cast("bigint"), ID_BITS).bitwiseOR(token.cast("bigint"))
        return pair(token.cast("bigint"), F.get(word, i + 1).cast("bigint")).bitwiseOR(low)

    folded = F.aggregate(F.sequence(F.lit(2), F.size(word)), F.transform(word, start), step)
    ids = F.transform(folded, lambda x: x.bitwiseAND(F.lit(SHIFT - 1)).cast("int"))
    return F.when(F.size(word) > 1, ids).otherwise(word)


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long piece, in n log n."""
    n = len(word)
    ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(word[i : ends[j]])) is not None:
            heapq.heappush(heap, (r, i, ends[j]))

    for i in range(n):
        offer(i)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or ends[after[i]] != end:
            continue
        j = after[i]
        ends[i], after[i], alive[j] = end, after[j], False
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : ends[i]]])
        i = after[i]
    return out


LIST_DDL = "doc_ids array<bigint>, counts array<int>, codes binary, fresh boolean, words array<array<int>>, long array<binary>"
LIST = pa.schema([
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("codes", pa.binary()), ("fresh", pa.bool_()),
    ("words", pa.list_(pa.list_(pa.int32()))), ("long", pa.list_(pa.binary())),
])


def _number_pieces(byte_ids: list[int]):
    """Texts as piece numbers; ``words`` are the new pieces (byte ids), or null where ``long`` holds the bytes."""
    to_ids = np.array(byte_ids, np.int32)

    def run(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK_DOCS):
                part = batch.slice(low, CHUNK_DOCS)
                pieces = part.column("pieces")
                counts = pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                found = pieces.flatten().cast(pa.binary()).dictionary_encode()
                fresh = len(seen) > MOST_PIECES
                if fresh:
                    seen.clear()
                short, sizes, long, numbers = [], [], [], np.empty(len(found.dictionary), np.int32)
                for i, word in enumerate(found.dictionary.to_pylist()):
                    number = seen.get(word)
                    if number is None:
                        number = seen[word] = len(seen)
                        sizes.append(len(word))
                        (short if len(word) <= FOLD_BYTES else long).append(word)
                    numbers[i] = number
                sizes = np.array(sizes, np.int32)
                is_long = sizes > FOLD_BYTES
                ends = np.cumsum(np.where(is_long, 0, sizes), dtype=np.int32)
                ids = to_ids[np.frombuffer(bytearray().join(short), np.uint8)]
                words = pa.ListArray.from_arrays(np.r_[np.int32(0), ends], ids, mask=pa.array(is_long))
                codes = numbers[found.indices.to_numpy()] if len(found) else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("doc_id").to_pylist()], LIST.field("doc_ids").type),
                        pa.array([counts], LIST.field("counts").type),
                        pa.array([codes.tobytes()], pa.binary()),
                        pa.array([fresh]),
                        pa.ListArray.from_arrays(np.array([0, len(words)], np.int32), words),
                        pa.array([long], LIST.field("long").type),
                    ],
                    schema=LIST,
                )

    return run


COUNT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
DIGEST = pa.schema([*COUNT, ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
RESULT = pa.schema([*COUNT, ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
FORMS = {
    "count": (COUNT, "doc_id bigint, n_tokens bigint"),
    "digest": (DIGEST, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"),
    "full": (RESULT, "doc_id bigint, n_tokens bigint, ids array<int>, decoded binary"),
}


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start .. start + size - 1 of every run, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class _Pieces:
    """Ids of the pieces of a task, in the order in which they were numbered."""

    def __init__(self):
        self.size, self.ids, self.sizes, self.starts = 0, np.zeros(1024, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.size + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros(len(self.ids), np.int32)]
        self.ids[self.size : self.size + len(ids)] = ids
        self.starts = np.r_[self.starts, self.size + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.size += len(ids)


def _assemble(tokens: list[bytes], form: str):
    schema = FORMS[form][0]

    def run(batches):
        pieces = _Pieces()
        by_bytes, by_id = {t: i for i, t in enumerate(tokens)}, np.array(tokens, object)
        for batch in batches:
            for r in range(batch.num_rows):
                if batch.column("fresh")[r].as_py():
                    pieces = _Pieces()
                new, long = batch.column("folded")[r].values, iter(batch.column("long")[r].as_py())
                if new.null_count:
                    new = pa.array([heap_merges(next(long), by_bytes) if x is None else x for x in new.to_pylist()], new.type)
                pieces.add(new.flatten().to_numpy(), new.value_lengths().to_numpy())
                codes = np.frombuffer(batch.column("codes")[r].as_buffer(), np.int32)
                counts = batch.column("counts")[r].values.to_numpy()
                sizes = pieces.sizes[codes]
                edges = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
                doc_ids = batch.column("doc_ids")[r].values
                columns = [doc_ids, pa.array(np.diff(edges))]
                if form != "count":
                    ids = pieces.ids[_ragged(pieces.starts[codes], sizes)]
                    each = [ids[a:b] for a, b in zip(edges, edges[1:])]
                    texts = [b"".join(by_id[x].tolist()) for x in each]
                    if form == "full":
                        columns += [pa.array(each, RESULT.field("ids").type), pa.array(texts, pa.binary())]
                    else:
                        columns += [
                            pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each], pa.string()),
                            pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                        ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def bpe(docs: DataFrame, path: str, pattern: str, form: str = "full") -> DataFrame:
    """Encode every text by the ranks in ``path``, each match of ``pattern`` separately, and decode the ids.

    Per row of ``docs``: doc_id, n_tokens and, by ``form``, nothing else ("count"),
    ids and decoded bytes ("full"), or the SHA-256 of the ids as little-endian
    unsigned 32-bit integers and of the decoded bytes ("digest").

    A null text is an empty one: no ids. Special tokens are ordinary text.
    Characters that ``pattern`` does not match are left out, as in the tokenizer
    library; the usual patterns match all. Very long texts are encoded whole; repeated
    rows return each, an empty table nothing. ``path`` is read by the driver.
    """
    ranks = load_ranks(path)
    tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    byte_ids = [ranks[bytes([b])] for b in range(256)]
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0))
    numbered = documents(docs).select("doc_id", pieces.alias("pieces")).mapInArrow(tidy(_number_pieces(byte_ids)), LIST_DDL)
    ranked = numbered.withColumn("ranks", rank_map(docs.sparkSession, pair_ranks(ranks)))
    folded = ranked.withColumn("folded", F.transform("words", lambda w: fold_merges(w, F.col("ranks"))))
    return folded.drop("words", "ranks").mapInArrow(tidy(_assemble(tokens, form)), FORMS[form][1])
