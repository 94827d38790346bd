"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark texts are cut into passages, weighted by TF-IDF (document frequencies
   over all documents), and a distributed randomised SVD gives their latent space.
2. Every passage of every document is folded into that space; its cosine to each
   benchmark passage picks the candidates. Words that no benchmark passage holds
   have no latent direction but count in the length of the passage.
3. A candidate is decided on the words around the hit, over twice the item's length
   (at least 96 words) and placed by where in the item the hit is. It is a copy if the longest common
   subsequence covers most of the item, and a paraphrase if it covers less but the
   item's answer (its last words) stands in the passage in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlift.llm.common import PUNCTUATION, documents, member, pack, strings
from ledgerlift.llm.tfidf import bin_counts, lower_words, plain_idf, word_bins

BIN_BITS = 16
STEP = 24
PASSAGE = 2 * STEP
RANK, SPARE, POWERS = 256, 16, 2
COSINE = 0.3
COPY, PARAPHRASE = 0.6, 0.4
ANSWER = 5
ITEMS_AT_ONCE = 5_000
SPACES_AT_ONCE = 4  # latent spaces that a pass over the documents holds
CHUNK = 1024
SEED = 7


def window_starts(size: int) -> list[int]:
    last = max(0, size - PASSAGE)
    return sorted({*range(0, last + 1, STEP), last}) if size else []


def item_windows(words: np.ndarray) -> list[np.ndarray]:
    """Passages of an item: all of it, or runs of PASSAGE words that overlap by half."""
    return [words[s : s + PASSAGE] for s in window_starts(len(words))]


def split_words(array: pa.LargeBinaryArray, size: int = 1 << 20):
    """(place, word hashes) of each text: lower-cased runs of letters and digits."""
    for low, words, counts in lower_words(array, PUNCTUATION, size):
        ends = np.cumsum(counts)
        for i, (a, b) in enumerate(zip(ends - counts, ends)):
            yield low + i, words[a:b]


# ---- latent space --------------------------------------------------------------


def _matrix(texts: pa.LargeBinaryArray, bins: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length of all passages of items, over the bins that items hold."""
    rows = []
    for _, words in split_words(texts):
        for window in item_windows(words):
            row = np.zeros(len(bins), np.float32)
            np.add.at(row, member(word_bins(window, BIN_BITS), bins)[1], idf[word_bins(window, BIN_BITS)])
            rows.append(row / np.linalg.norm(row))
    return np.array(rows, np.float32).reshape(-1, len(bins))


SUM_DDL = "chunk int, part binary"
SUM = pa.schema([("chunk", pa.int32()), ("part", pa.binary())])


def _products(bins: np.ndarray, idf: np.ndarray, basis: np.ndarray, small: bool):
    """Per task, a share of A' (A Q), or of (A Q)' (A Q), in chunks of rows."""

    def run(batches):
        total = 0.0
        for batch in batches:
            a = _matrix(strings(batch.column("text")), bins, idf)
            y = a @ basis
            total = total + (y.T @ y if small else a.T @ y)
        if not np.isscalar(total):
            rows = [{"chunk": c, "part": pack(total[c : c + CHUNK].astype(np.float32))} for c in range(0, len(total), CHUNK)]
            yield pa.RecordBatch.from_pylist(rows, schema=SUM)

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float32) for x in table.column("part").to_pylist())
    return pa.Table.from_pylist([{"chunk": table.column("chunk")[0].as_py(), "part": pack(total)}], schema=SUM)


def _summed(items: DataFrame, step, width: int) -> np.ndarray:
    rows = items.mapInArrow(step, SUM_DDL).groupBy("chunk").applyInArrow(_add, SUM_DDL).collect()
    parts = [np.frombuffer(r["part"], np.float32) for r in sorted(rows, key=lambda r: r["chunk"])]
    return np.concatenate(parts).reshape(-1, width).astype(np.float64)


def latent_space(items: DataFrame, bins: np.ndarray, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (bins x rank) of the passages' matrix, by randomised subspace iteration.

    The matrix stays in Spark; the driver holds its small factors (at most 2^16 bins times rank + SPARE).
    Up to ``rank`` passages lie in the space in full, so that cosines in it are those of the whole vectors.
    """
    width = min(len(bins), rank + SPARE)
    basis = np.random.default_rng(SEED).standard_normal((len(bins), width)).astype(np.float32)
    for _ in range(POWERS):
        basis = np.linalg.qr(_summed(items, _products(bins, idf, basis, False), width))[0].astype(np.float32)
    values, vectors = np.linalg.eigh(_summed(items, _products(bins, idf, basis, True), width))
    lead = np.argsort(-values)[:rank]
    return (basis @ vectors[:, lead[values[lead] > 1e-6]]).astype(np.float32)


# ---- candidates and checks -----------------------------------------------------


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel; ``masks`` has each item word's places."""
    full = state = (1 << size) - 1
    for w in words:
        if w in masks:  # others change nothing
            hit = state & masks[w]
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


class Item:
    def __init__(self, item_id: int, words: np.ndarray):
        self.id, self.words = item_id, words.tolist()
        self.masks: dict[int, int] = {}
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | (1 << i)
        self.answer = self.words[-ANSWER:]

    def may_hold(self, words: list[int]) -> bool:
        """Whether the words in common, in any order, are enough for a leak; no subsequence has more."""
        common = sum(self.masks[w].bit_count() for w in self.masks.keys() & words)
        return common / len(self.words) >= PARAPHRASE

    def judge(self, words: list[int]) -> tuple[float, str | None]:
        share = common_subsequence(self.masks, len(self.words), words) / len(self.words)
        if share >= COPY:
            return share, "copy"
        n = len(self.answer)
        if share >= PARAPHRASE and any(words[i : i + n] == self.answer for i in range(len(words) - n + 1)):
            return share, "paraphrase"
        return share, None


class Index:
    """The benchmark's passages in latent space, and the items' words."""

    def __init__(self, items: list[Item], bins: np.ndarray, idf: np.ndarray, space: np.ndarray):
        self.items, self.idf = items, idf
        self.row_of = np.zeros(1 << BIN_BITS, np.int32)  # 0: no item holds the bin
        self.row_of[bins] = np.arange(1, len(bins) + 1)
        self.directions = np.vstack([np.zeros((1, space.shape[1]), np.float32), space * idf[bins][:, None]]).astype(np.float32)
        passages, owners, floors, starts = [], [], [], []
        for i, item in enumerate(items):
            own = np.array(item.words, np.uint64)
            for start, window in zip(window_starts(len(own)), item_windows(own)):
                binned = word_bins(window, BIN_BITS)
                passages.append(self.directions[self.row_of[binned]].sum(axis=0) / self._norm(binned))
                owners.append(i)
                starts.append(start)
                floors.append(COSINE * np.sqrt(len(window) / PASSAGE))  # even a full copy of a short item fills a passage in part
        self.starts = np.array(starts)
        self.passages, self.owners, self.floors = np.array(passages, np.float32), np.array(owners), np.array(floors, np.float32)

    def _norm(self, binned: np.ndarray) -> float:
        kinds, tf = np.unique(binned, return_counts=True)
        return float(np.sqrt(((tf * self.idf[kinds]) ** 2).sum()))

    def _sums(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sum of the directions of each run of rows; the k-th row of all runs is added at once."""
        sizes = np.diff(np.r_[first, len(rows)])
        order = np.argsort(-sizes, kind="stable")
        sums = self.directions[rows[first[order]]]
        for k in range(1, int(sizes.max())):
            more = first[order[: np.count_nonzero(sizes > k)]]
            sums[: len(more)] += self.directions[rows[more + k]]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return sums[back]

    def candidates(self, words: np.ndarray, counts: np.ndarray):
        """(document, passage, item) with a cosine of COSINE or more (less for short items), for a run of documents."""
        return {(d, p, int(self.owners[k])) for d, p, k in self._hits(words, counts)}

    def _hits(self, words: np.ndarray, counts: np.ndarray):
        """Like candidates, with the place of the item's passage instead of the item."""
        blocks = np.maximum(1, -(-counts // STEP))
        edge = np.cumsum(blocks) - blocks
        binned = word_bins(words, BIN_BITS)
        within = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        block = np.repeat(edge, counts) + within // STEP
        total = int(blocks.sum())
        known = np.flatnonzero(self.row_of[binned])
        latent = np.zeros((total, self.directions.shape[1]), np.float32)
        if len(known):  # words come in the order of their blocks
            first = np.flatnonzero(np.r_[True, np.diff(block[known]) > 0])
            latent[block[known][first]] = self._sums(self.row_of[binned[known]], first)
        square = np.bincount(block, self.idf[binned] ** 2, total)
        owner = np.repeat(np.arange(len(counts)), blocks)
        pair = np.r_[owner[1:] == owner[:-1], False] if total else np.zeros(0, bool)
        latent[:-1][pair[:-1]] += latent[1:][pair[:-1]].copy()
        both = square.copy()
        both[:-1][pair[:-1]] += square[1:][pair[:-1]]
        near = np.flatnonzero(np.abs(latent).sum(axis=1) > 0)
        cosines = (latent[near] @ self.passages.T) / np.sqrt(np.maximum(both[near], 1e-9))[:, None]
        row, passage = np.nonzero(cosines >= self.floors)
        doc = owner[near[row]]
        return zip(doc.tolist(), (near[row] - edge[doc]).tolist(), passage.tolist())

    def _regions(self, words: np.ndarray, counts: np.ndarray):
        """(document, item, start, stop): the words of a document to hold against an item.

        A region reaches half the item's length beyond where the hit would put its ends, so
        a copy may be half as long or half longer. Hits a step apart share a region.
        """
        regions = set()
        for doc, passage, k in self._hits(words, counts):
            item = int(self.owners[k])
            size = max(PASSAGE, len(self.items[item].words))
            first = (passage * STEP - int(self.starts[k])) // STEP * STEP
            more = STEP if size > PASSAGE else 0  # what rounding took
            regions.add((doc, item, max(0, first - size // 2), first + size + size // 2 + more))
        return regions

    def leaks(self, words: np.ndarray, counts: np.ndarray):
        """(document, item, share of the item, kind) of every leak, the best share per document and item."""
        ends = np.cumsum(counts)
        best: dict[tuple[int, int], tuple[float, str]] = {}
        for doc, item, start, stop in self._regions(words, counts):
            near = words[ends[doc] - counts[doc] : ends[doc]][start:stop].tolist()
            share, kind = self.items[item].judge(near) if self.items[item].may_hold(near) else (0.0, None)
            if kind and share > best.get((doc, item), (0.0, ""))[0]:
                best[doc, item] = share, kind
        for (doc, item), (share, kind) in sorted(best.items()):
            yield doc, self.items[item].id, share, kind


def _found(indexes: list[Index], texts: pa.LargeBinaryArray):
    """(place, item, share, kind) of the leaks of all indexes; words are hashed once."""
    for low, words, counts in lower_words(texts, PUNCTUATION, 1 << 18):
        for index in indexes:
            for doc, *leak in index.leaks(words, counts):
                yield low + doc, *leak


LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64()), ("kind", pa.string())])
LEAK_DDL = "doc_id bigint, item_id bigint, share double, kind string"


def _search(indexes: list[Index]):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            rows = [
                {"doc_id": ids[i].as_py(), "item_id": item, "share": share, "kind": kind}
                for i, item, share, kind in _found(indexes, strings(batch.column("text")))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=LEAK)

    return run


def _clean(indexes: list[Index]):
    def run(batches):
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[i for i, *_ in _found(indexes, strings(batch.column("text")))]] = False
            yield batch.filter(pa.array(clean))

    return run


def by_rank(items: list[Item]) -> list[tuple[int, int, int]]:
    """(start, stop, passages) of runs of items with at most RANK passages; a longer item stands alone."""
    runs, start, held = [], 0, 0
    for i, item in enumerate(items):
        n = len(item_windows(np.array(item.words, np.uint64)))
        if held and held + n > RANK:
            runs.append((start, i, held))
            start, held = i, 0
        held += n
    return [*runs, (start, len(items), held)] if items else []


def _indexes(docs: DataFrame, benchmark: DataFrame):
    """Lists of up to SPACES_AT_ONCE indexes, one per run of items; document frequencies come from all documents."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    groups = max(1, -(-items.count() // ITEMS_AT_ONCE))
    idf = plain_idf(*bin_counts(docs, BIN_BITS, PUNCTUATION))
    for g in range(groups):
        group = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g)
        rows = group.orderBy("item_id", "text").toArrow()  # about ITEMS_AT_ONCE items
        ids = rows.column("item_id").to_pylist()
        place, known = [], []
        for i, w in split_words(strings(rows.column("text"))):
            if len(w):
                place.append(i)
                known.append(Item(ids[i], w))
        indexes = []
        for start, stop, passages in by_rank(known):
            mine = known[start:stop]
            bins = np.unique(np.concatenate([word_bins(np.array(x.words, np.uint64), BIN_BITS) for x in mine]))
            texts = docs.sparkSession.createDataFrame(rows.take(place[start:stop]).select(["text"]))
            indexes.append(Index(mine, bins, idf, latent_space(texts, bins, idf, max(RANK, passages))))
            if len(indexes) == SPACES_AT_ONCE:
                yield indexes
                indexes = []
        if indexes:
            yield indexes


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, share, kind) for every benchmark item that a document holds.

    ``benchmark`` has item_id and text. share is the part of the item's words in
    the longest common subsequence with the words around the hit, whatever the item's
    length; kind is "copy" (0.6 or more)
    or "paraphrase" (0.4 or more, and the last five words of the item in a row).
    Words are lower-cased runs of letters and digits.

    Null and empty texts, on either side, leak nothing; so do items without an id.
    An item repeated under several ids is found under each; a document row yields
    one row per item. Items are searched in runs of at most RANK passages, each with
    its own latent space that holds them in full; a pass over the documents searches
    four runs, so what a task holds does not grow with the benchmark.
    """
    docs = documents(docs)
    found = docs.sparkSession.createDataFrame([], LEAK_DDL)
    for indexes in _indexes(docs, benchmark):
        found = found.unionByName(docs.mapInArrow(_search(indexes), LEAK_DDL))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; see leaks."""
    kept = docs
    for indexes in _indexes(docs, benchmark):
        kept = kept.mapInArrow(_clean(indexes), docs.schema)
    return kept
