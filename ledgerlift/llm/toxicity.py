"""Toxicity by class-conditional Kneser-Ney models.

Two models over the bytes of words, one learned from toxic and one from ordinary
documents, give every word a log-likelihood under each class. Both back off, order
by order, to continuation counts; the lowest level is shared by the classes, and
n-grams seen fewer than RARE times keep no count of their own, so a rare expression
is judged by its shorter parts. Per word and for the whole text the two
log-likelihoods are compared after division by length. A logistic curve, fitted on
labelled documents that the models have not seen, turns the comparison into a score.

The models are fitted on a bounded sample: at most SAMPLE_DOCS labelled documents
per class, those with the least hash of their id. Every text is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlift.llm.common import LOWER, U64, bytes_of, documents, give_back, mix, slices, strings, tidy, word_hashes, word_spans

SAMPLE_DOCS = 2000
ORDER = 6
RARE = 3
DISCOUNT = 0.75
THRESHOLD = 0.7
PAD = 3  # added to the bytes of a word, so that a short one cannot stand out by a single letter
GRAM = U64(0x9E3779B97F4A7C15)


POWERS = np.multiply.accumulate(np.r_[U64(1), np.full(ORDER - 1, GRAM)])


def gram_hash(buf: np.ndarray, first: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes that end at each of ``places``; 0 where they would start before the word.

    ``first`` is the place of the mark before the word that each place belongs to.
    """
    total = np.full(len(places), n, U64)
    for k in range(n):
        total += (buf[np.maximum(places - k, 0)].astype(U64) + U64(1)) * POWERS[k]
    return np.where(places - n + 1 >= first, mix(total), U64(0))


def marked_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a mark before and after every word, first place of each byte's word, word of each byte)."""
    joined = b"".join(b" " + w + b" " for w in words)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    return np.frombuffer(joined, np.uint8), np.repeat(starts, sizes), np.repeat(np.arange(len(words)), sizes)


class KneserNey:
    """Interpolated models of two classes; per order sorted n-grams with (own share, weight of the shorter history)."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        """``counts``: (words, 2), in how many toxic and ordinary documents a word occurs."""
        buf, first, word = marked_words(words)
        predicted = np.flatnonzero(np.arange(len(buf)) > first)  # the mark before a word is given
        self.levels = []
        for n in range(ORDER, 0, -1):
            here = predicted[gram_hash(buf, first[predicted], predicted, n) != 0]
            weights = counts[word[here]].T
            keys, at, group = np.unique(gram_hash(buf, first[here], here, n), return_index=True, return_inverse=True)
            own = np.stack([np.bincount(group, weights[k], len(keys)) for k in (0, 1)], axis=1)
            if n < ORDER:  # continuation counts; a history that starts the word has no longer one and keeps its counts
                longer = gram_hash(buf, first[here], here, n + 1)
                starts = longer == 0
                whole = np.stack([np.bincount(group[starts], weights[k][starts], len(keys)) for k in (0, 1)], axis=1)
                wide, w_at, w_group = np.unique(longer, return_index=True, return_inverse=True)
                seen = np.stack([np.bincount(w_group, weights[k], len(wide)) for k in (0, 1)], axis=1) > 0
                seen[wide == 0] = False
                ends = group[w_at]
                cont = np.stack([np.bincount(ends, seen[:, k], len(keys)) for k in (0, 1)], axis=1)
                own = cont + whole
            place = here[at]
            history = gram_hash(buf, first[place], place - 1, n - 1) if n > 1 else np.zeros(len(keys), U64)
            h_keys, h_group = np.unique(history, return_inverse=True)
            total = np.stack([np.bincount(h_group, own[:, k], len(h_keys)) for k in (0, 1)], axis=1)
            rare = own.sum(axis=1, keepdims=True) < RARE
            kept = np.where(rare, 0, np.maximum(own - DISCOUNT, 0))
            left = total - np.stack([np.bincount(h_group, kept[:, k], len(h_keys)) for k in (0, 1)], axis=1)
            share = kept / np.maximum(total[h_group], 1e-9)
            weight = np.where(total > 0, left / np.maximum(total, 1e-9), 1.0)
            keep = share.sum(axis=1) > 0
            if n > 1:
                self.levels.append((keys[keep], share[keep].astype(np.float32), h_keys, weight.astype(np.float32)))
            else:  # the shared lowest level
                both = own.sum(axis=1)
                self.base = (keys, ((both + 0.5) / (both.sum() + 128)).astype(np.float32), np.float32(0.5 / (both.sum() + 128)))
        self.levels.reverse()

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray):
        place = np.searchsorted(keys, wanted)
        place[place == len(keys)] = 0
        return place, keys[place] == wanted if len(keys) else np.zeros(len(wanted), bool)

    def ratios(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood under the toxic model less that under the ordinary one, per word."""
        if not words:
            return np.zeros(0)
        buf, first, word = marked_words(words)
        at = np.flatnonzero(np.arange(len(buf)) > first)
        start = first[at]
        place, known = self._find(self.base[0], gram_hash(buf, start, at, 1))
        p = np.where(known, self.base[1][place], self.base[2])[:, None].repeat(2, axis=1)
        for n, (keys, share, h_keys, weight) in enumerate(self.levels, start=2):
            history = gram_hash(buf, start, at - 1, n - 1)
            place, known = self._find(h_keys, history)
            known &= history != 0
            p[known] *= weight[place[known]]
            gram = gram_hash(buf, start, at, n)
            place, known = self._find(keys, gram)
            known &= gram != 0
            p[known] += share[place[known]]
        odds = np.log(np.maximum(p[:, 0], 1e-12)) - np.log(np.maximum(p[:, 1], 1e-12))
        return np.bincount(word[at], odds, len(words))


def features(model: KneserNey, texts: pa.LargeBinaryArray) -> np.ndarray:
    """Per text: its ratio per byte, the highest ratio per byte of a word, and the log of its length in words."""
    out = np.zeros((len(texts), 3))
    for low, high in slices(texts):
        buf, offsets = bytes_of(texts.slice(low, high - low))
        starts, ends, counts = word_spans(buf, offsets)
        lower = LOWER[buf]
        _, at, group = np.unique(word_hashes(lower, starts, ends), return_index=True, return_inverse=True)
        data = lower.tobytes()
        ratio = model.ratios([data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])[group]
        owner = np.repeat(np.arange(high - low), counts)
        size = np.bincount(owner, ends - starts + 1, high - low)
        out[low:high, 0] = np.bincount(owner, ratio, high - low) / np.maximum(size, 1)
        top = np.zeros(high - low)
        np.maximum.at(top, owner, ratio / (ends - starts + PAD))
        out[low:high, 1] = top
        out[low:high, 2] = np.log1p(counts)
    return out


# ---- fitting and scoring -------------------------------------------------------


def logistic_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression in which both classes count alike."""
    x = np.c_[x, np.ones(len(x))]
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    penalty = np.diag(np.r_[np.full(x.shape[1] - 1, ridge), 1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (balance * (y - p)) - penalty @ w
        curvature = (x.T * (balance * p * (1 - p))) @ x + penalty
        w = w + np.linalg.solve(curvature, gradient)
    return w


class Scorer:
    """Features of a text to a score from 0 to 1."""

    def __init__(self, model: KneserNey, sample: np.ndarray, toxic: np.ndarray):
        self.model = model
        self.mean, self.spread = sample.mean(axis=0), sample.std(axis=0) + 1e-9
        self.weights = logistic_curve((sample - self.mean) / self.spread, toxic)

    def __call__(self, texts: pa.LargeBinaryArray) -> np.ndarray:
        x = (features(self.model, texts) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.weights, -60, 60)))


def _count_words(batches):
    for batch in batches:
        toxic, counts = batch.column("toxic").to_pylist(), {}
        for y, text in zip(toxic, strings(batch.column("text")).to_pylist()):
            for word in set(text.lower().split()):  # repeats within a document count once
                pair = counts.setdefault(word, [0, 0])
                pair[0 if y else 1] += 1
        words = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), *(pa.array([counts[w][k] for w in words], pa.int64()) for k in (0, 1))],
            names=["word", "toxic", "ordinary"],
        )


def _features_of(model: KneserNey):
    def run(batches):
        for batch in batches:
            x = features(model, strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c) for c in x.T)], names=["toxic", "a", "b", "c"])

    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Scorer | None:
    """Models from one half of the sample, the curve from the other; None where a class has no labelled document.

    Where the labels are so few that a half lacks a class, both are fitted on the whole sample.
    """
    known = labels.filter(F.coalesce(learn, F.lit(False)) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    place = F.xxhash64("doc_id")
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("toxic") == y).orderBy(place, "doc_id").limit(sample_docs)
        chosen = part if chosen is None else chosen.unionByName(part)
    half = F.pmod(F.shiftright(place, 8), F.lit(2))
    sample = documents(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic", half.alias("half"))
    return _fitted(sample, "half = 0", "half = 1") or _fitted(sample, "true", "true")


def _fitted(sample: DataFrame, models: str, curve: str) -> Scorer | None:
    """Models from the rows that meet one condition, the curve from those that meet the other; None where either lacks a class."""
    counted = (
        sample.filter(models).select("text", "toxic")
        .mapInArrow(tidy(_count_words), "word binary, toxic bigint, ordinary bigint")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    ).toArrow()  # the words of at most 2 * sample_docs documents
    counts = np.stack([counted.column(c).to_numpy().astype(np.int64) for c in ("toxic", "ordinary")], axis=1)
    if not (counts.sum(axis=0) > 0).all() or not len(counts):
        return None
    model = KneserNey(counted.column("word").to_pylist(), counts)
    del counted
    give_back()
    seen = sample.filter(curve).select("text", "toxic").mapInArrow(tidy(_features_of(model)), "toxic int, a double, b double, c double").toArrow()
    toxic = seen.column("toxic").to_numpy()
    if len(set(toxic.tolist())) < 2:
        return None
    return Scorer(model, np.stack([seen.column(c).to_numpy() for c in "abc"], axis=1), toxic)


def _score(scorer: Scorer | None):
    def run(batches):
        for batch in batches:
            texts = strings(batch.column("text"))
            scores = scorer(texts) if scorer else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``; ``labels`` has doc_id and toxic (0 or 1).

    Only labels where ``learn`` holds are learned from, and nothing but the text is
    scored. Repeated rows are scored each. predicted is 1 from a score of 0.7. Labels that are null, neither 0 nor
    1 or without a doc_id are ignored; a document labelled twice counts as toxic if
    one label says so. Null and empty texts are scored as texts without words. If
    a class has no labelled document, every score is 0.
    """
    scored = documents(docs).mapInArrow(tidy(_score(fit(docs, labels, learn))), "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted is 0; see toxicity_scores."""
    scorer = fit(docs, labels, learn)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scorer(strings(batch.column("text"))) < THRESHOLD)) if scorer else batch

    return docs.mapInArrow(tidy(run), docs.schema)
