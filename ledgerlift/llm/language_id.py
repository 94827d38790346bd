"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams (one to three characters) in order. The
out-of-place distance between a document's profile and a language's adds up how
far each n-gram of the document stands from its place in the language's list, or
the length of a list where it is missing. The nearest language wins.

Profiles of languages are counted over all training documents: each task counts
its n-grams per language, Spark adds them up and ranks them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlift.llm.common import member

PROFILE = 300
MOST_LANGUAGES = 1000
BITS = 21  # of a code point
GAP = ord("_")
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def letters_and_gaps(text: str) -> np.ndarray:
    """Lower-cased letters, with one gap for each run of anything else, at both ends too."""
    codes = np.frombuffer(f"_{text.lower()}_".encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    return np.where(letter, codes, GAP)[keep].astype(np.int64)


def ngrams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of one to three characters as numbers; gaps alone are left out."""
    one = codes[codes != GAP]
    two = (codes[:-1] << BITS) | codes[1:]
    three = (codes[:-2] << (2 * BITS)) | (codes[1:-1] << BITS) | codes[2:]
    return np.concatenate([one, two, three])


def profile(codes: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, ties by number."""
    grams, counts = np.unique(ngrams(codes), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:PROFILE]]


COUNT = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def _tally(codes: list[np.ndarray]):
    """(n-grams, counts) of the documents of one language, through a compact alphabet."""
    alphabet = np.unique(np.concatenate(codes))
    size = len(alphabet)
    if size**3 > 1 << 23:  # a large script: sort instead
        return np.unique(np.concatenate([ngrams(c) for c in codes]), return_counts=True)
    place = np.zeros(int(alphabet[-1]) + 1, np.int64)
    place[alphabet] = np.arange(size)
    # a -1 between documents keeps their n-grams apart
    spaced = np.concatenate([part for c in codes for part in (c, np.full(1, -1))])
    part = np.where(spaced < 0, 0, place[spaced])
    apart = spaced < 0
    totals = []
    for n in (1, 2, 3):
        whole, number = ~apart[: len(apart) - n + 1], part[: len(part) - n + 1]
        for k in range(1, n):
            whole = whole & ~apart[k : len(apart) - n + 1 + k]
            number = number * size + part[k : len(part) - n + 1 + k]
        totals.append(np.bincount(number[whole], minlength=size**n))
    grams, counts = [], []
    for n, total in enumerate(totals, start=1):
        cells = np.flatnonzero(total)
        number, rest = np.zeros(len(cells), np.int64), cells.copy()
        for k in range(n):
            number |= alphabet[rest % size] << (BITS * k)
            rest //= size
        keep = number != GAP
        grams.append(number[keep])
        counts.append(total[cells][keep])
    return np.concatenate(grams), np.concatenate(counts)


def _count_ngrams(batches):
    for batch in batches:
        by_language: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_language.setdefault(lang, []).append(letters_and_gaps(text))
        for lang, codes in by_language.items():
            grams, counts = _tally(codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], schema=COUNT
            )


def language_profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    """Language to its ranked n-grams, from rows (lang, text)."""
    counted = docs.mapInArrow(_count_ngrams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    rows = ranked.filter(F.col("rank") <= PROFILE).orderBy("lang", "rank").limit(MOST_LANGUAGES * PROFILE + 1).collect()
    if len(rows) > MOST_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    out: dict[str, list[int]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["gram"])
    return {lang: np.array(grams) for lang, grams in out.items()}


class Languages:
    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = sorted(profiles)
        self.grams = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.grams), len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), k] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = letters_and_gaps(text) if text else np.zeros(0, np.int64)
        if not self.names or not (codes != GAP).any():
            return UNKNOWN, 0.0
        own = profile(codes)
        hit, place = member(own, self.grams)
        ranks = self.ranks[place]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        apart[(ranks < 0) | ~hit[:, None]] = PROFILE
        distance = apart.sum(axis=0) / (PROFILE * len(own))
        best = int(np.argmin(distance))
        if len(self.names) == 1:
            return self.names[0], float(max(0.0, 1 - distance[0]))
        others = np.delete(distance, best).min()
        return self.names[best], float((others - distance[best]) / others) if others > 0 else 0.0


def _predict(languages: Languages):
    def run(batches):
        for batch in batches:
            found = [languages.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learn"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "learn", "lang_pred", "score"],
            )

    return run


def language_id(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs`` (doc_id, text, lang).

    Profiles are learned from the rows where ``learn`` holds (null: it does not)
    and text and lang are not null; a prediction sees the text only. The score is
    the lead over the second nearest language, (d2 - d1) / d2. A text that is null
    or has no letter gives ``und`` and 0, and so does every text if nothing was
    learned; equal distances go to the first language by name.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    known = rows.filter("learn AND text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    languages = Languages(language_profiles(known))
    found = rows.select("doc_id", "learn", "text").mapInArrow(_predict(languages), "doc_id bigint, learn boolean, lang_pred string, score double")
    return found.select("doc_id", (~F.col("learn")).alias("held_out"), "lang_pred", "score")
