"""Top-k search, language ID, decontamination, toxicity, near-duplicates and the pipeline."""

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlift.llm import decontamination as dec, near_dedup as near
from ledgerlift.llm.common import PUNCTUATION, crc_mod, strings, table
from ledgerlift.llm.language_id import language_id
from ledgerlift.llm.queries import QUERIES
from ledgerlift.llm.tfidf import bin_counts, lower_words, plain_idf, smooth_idf, word_bins
from ledgerlift.llm.topk_search import best_of_block, exact_top_k
from ledgerlift.llm.toxicity import toxicity_scores

FOLDER = Path("/root/testdata/sf0.001")
LARGER = Path("/root/testdata/sf0.01")
mounted = pytest.mark.skipif(not LARGER.exists(), reason="test tables not mounted")
DDL = "doc_id bigint, text string, lang string, tid string, id string, label int, bucket double, learn int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, None, "x", 1, None, 2) for i, t, g in rows], DDL)


def words(seed, n, stems="abcdefgh"):
    pick = random.Random(seed)
    return [f"{pick.choice(stems)}{pick.choice(stems)}{pick.randrange(400)}" for _ in range(n)]


# ---- top-k ---------------------------------------------------------------------


def test_top_k_edges(spark):
    pick = random.Random(5)
    rows = [(i, [pick.choice([-0.5, 0.25, 0.013, 1.0]) for _ in range(6)]) for i in range(60)]
    rows += [(60, None), (61, [0.1, None]), (62, [float("nan")] * 6), (63, [float("inf")] * 6), (64, []), (None, [1.0] * 6)]
    rows += [(65, [1.0, 2.0]), (80, [3.0, -1.0]), rows[7], (40, rows[3][1])]  # another length, a repeat, an id twice
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, dim int, block string")
    got = exact_top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault((i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v)))
    expected = set()
    for q in {i for i, _ in whole if i % 20 == 0}:
        best = {(-sum(a * b for a, b in zip(u, v)), j) for i, u in whole if i == q for j, v in whole if j != q and len(u) == len(v)}
        expected |= {(q, r, j, -s) for r, (s, j) in enumerate(sorted(best)[:5], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == expected
    assert exact_top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_prunes_nothing_that_counts():
    rng = np.random.default_rng(3)
    v = (rng.standard_normal((900, 64)) * 40).astype(np.int64)
    q, ids = v[::50], np.arange(900)
    for i, best, scores in best_of_block(ids[::50], q, ids, v, 20):
        all_scores = v @ q[i]
        all_scores[i * 50] = -(10**15)
        order = np.lexsort((ids, -all_scores))[:20]
        assert best.tolist() == order.tolist() and scores.tolist() == all_scores[order].tolist()


# ---- language ------------------------------------------------------------------


def test_language_edges(spark):
    train = [(i, "the quick brown fox jumps over the lazy dog " * 3, "en") for i in range(12)]
    train += [(20 + i, "der schnelle braune fuchs springt über den faulen hund " * 3, "de") for i in range(12)]
    rest = [(50, None, "en"), (51, "", "de"), (52, "123 !!! 😀", "en"), (53, "über den hund", None), (None, "the dog", "en"), (54, "日本語", None)]
    got = {r.doc_id: r for r in language_id(frame(spark, train + rest), crc_mod(4) != 2).collect()}
    assert [got[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and got[50].score == 0.0
    assert got[53].lang_pred == "de" and got[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1].held_out == (zlib.crc32(b"1") % 4 == 2)
    assert language_id(frame(spark, []), crc_mod(4) != 2).count() == 0
    assert {r.lang_pred for r in language_id(frame(spark, train[:3]), F.lit(False)).collect()} == {"und"}


@mounted
def test_language_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in table(spark, str(LARGER), "documents").select("doc_id", "lang").collect()}
    held = [r for r in QUERIES["op5_language_id"](spark, str(LARGER)).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


# ---- decontamination -----------------------------------------------------------


def test_leaks_and_recall(spark):
    items = [(i, " ".join(words(i, 15 + 5 * i))) for i in range(9)] + [(20, None), (21, ""), (None, "no id")]
    docs, expected = [], set()
    for d in range(60):
        text = words(1000 + d, 150)
        if d % 3 == 0:
            i, cut = d % 9, random.Random(d).randrange(120)
            item = items[i][1].upper().split()
            if d % 2:  # every sixth word replaced, with punctuation
                item = [f"{w}," if k % 6 else "other" for k, w in enumerate(item)]
            text[cut:cut] = item
            expected.add((d, i))
        docs.append((d, " ".join(text), "en"))
    near_answer = words(4, 35)
    docs += [(70, " ".join(w if k % 2 == 0 or k >= 30 else "q" for k, w in enumerate(near_answer)), "en")]  # a paraphrase that keeps the answer
    docs += [(71, None, "en"), (72, "", "en"), (None, items[2][1], "en")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, share int")
    got = dec.leaks(frame(spark, docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected | {(None, 2), (70, 4)}
    assert {r.kind for r in got if r.doc_id == 70} == {"paraphrase"}
    kept = dec.without_leaks(frame(spark, docs), bench)
    assert kept.columns == frame(spark, []).columns and kept.count() == len(docs) - len(expected) - 2
    assert dec.leaks(frame(spark, []), bench).count() == 0 and dec.leaks(frame(spark, docs), bench.limit(0)).count() == 0


def test_leaks_of_a_large_benchmark(spark):
    """Over 1,000 items: every copy, and every one with a fifth of the words replaced, is found."""
    items = [(i, " ".join(words(2000 + i, 40))) for i in range(1100)]
    docs = []
    for i, item in items[::4]:
        text = words(9000 + i, 100)
        text[30:30] = ["other" if i % 8 and k % 5 == 0 else w for k, w in enumerate(item.split())]
        docs.append((i, " ".join(text), "en"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dec.leaks(frame(spark, docs), bench).collect()}
    assert got == {(i, i) for i, *_ in docs}


def test_leaks_of_long_items(spark):
    """Items of 200 to 1,000 words: copies, and those with every fourth word replaced, dropped or followed by others."""
    items = [(i, " ".join(words(3000 + i, n))) for i, n in enumerate([200, 240, 300, 600, 1000])]
    change = [lambda k, w: [w], lambda k, w: [w if k % 4 else "other"], lambda k, w: [w] * (k % 4 > 0), lambda k, w: [w] + ["more"] * (k % 4 == 0)]
    docs = []
    for i, item in items:
        for c, f in enumerate(change):
            text = words(7000 + 10 * i + c, 1500)
            at = 300 * c + 7
            text[at:at] = [x for k, w in enumerate(item.split()) for x in f(k, w)]
            docs.append((10 * i + c, " ".join(text), "en"))
        docs.append((10 * i + 9, " ".join(words(8000 + i, 800) + item.split()[: len(item.split()) // 2]), "en"))  # half is no copy
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dec.leaks(frame(spark, docs), bench).collect()}
    assert got == {(10 * i + c, i) for i, _ in items for c in range(len(change))}


@mounted
def test_candidates_reach_the_brute_force_cosines(spark):
    """Of the passages whose full TF-IDF cosine to an item's is 0.5 or more, the latent index finds nine in ten."""
    docs, bench = (table(spark, str(FOLDER), t).select("text") for t in ("documents", "benchmark"))
    idf = plain_idf(*bin_counts(docs, dec.BIN_BITS, PUNCTUATION))
    items = [dec.Item(i, w) for i, w in dec.split_words(strings(pa.array([r.text for r in bench.collect()])))]
    bins = np.unique(np.concatenate([word_bins(np.array(x.words, np.uint64), dec.BIN_BITS) for x in items]))
    index = dec.Index(items, bins, idf, dec.latent_space(bench, bins, idf))
    found, wanted = set(), set()

    def unit(w):
        row = np.zeros(1 << dec.BIN_BITS)
        np.add.at(row, word_bins(w, dec.BIN_BITS), idf[word_bins(w, dec.BIN_BITS)])
        return row[bins] / max(np.linalg.norm(row), 1e-9)

    passages = [(i, unit(w)) for i, x in enumerate(items) for w in dec.item_windows(np.array(x.words, np.uint64))]
    matrix = np.array([p for _, p in passages])
    for low, all_words, counts in lower_words(strings(pa.array([r.text for r in docs.collect()])), PUNCTUATION):
        found |= {(low + d, p, i) for d, p, i in index.candidates(all_words, counts)}
        for d, (end, n) in enumerate(zip(np.cumsum(counts), counts)):
            own = all_words[end - n : end]
            for p in range(max(1, -(-n // dec.STEP))):
                near_items = np.flatnonzero(matrix @ unit(own[p * dec.STEP : p * dec.STEP + dec.PASSAGE]) >= 0.5)
                wanted |= {(low + d, p, passages[k][0]) for k in near_items}
    assert wanted and len(wanted & found) >= 0.9 * len(wanted)


def test_common_subsequence():
    pick = random.Random(1)
    for _ in range(50):
        a, b = ([pick.randrange(6) for _ in range(pick.randrange(1, 20))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        item = dec.Item(0, np.array(a))
        assert dec.common_subsequence(item.masks, len(a), b) == best[-1][-1]


def test_regions_with_too_few_common_words_are_not_aligned(monkeypatch):
    pick, aligned = random.Random(2), []
    monkeypatch.setattr(dec, "common_subsequence", lambda *x, f=dec.common_subsequence: aligned.append(x) or f(*x))
    item = dec.Item(0, np.arange(40, dtype=np.uint64))
    idf, bins = np.ones(1 << dec.BIN_BITS, np.float32), np.array([0])  # all words in one bin: every passage is a candidate
    index = dec.Index([item], bins, idf, np.ones((1, 1), np.float32))
    far = np.array([*range(12), *range(100, 148)], np.uint64)
    pick.shuffle(far)
    assert list(index.leaks(far, np.array([len(far)]))) == [] and not aligned
    near = np.array([*range(24), *range(100, 116)], np.uint64)
    assert list(index.leaks(near, np.array([len(near)]))) == [(0, 0, 0.6, "copy")] and aligned
    for n in range(1, 40):  # at the edge of a paraphrase too
        item = dec.Item(0, np.arange(n, dtype=np.uint64))
        for common in range(n + 1):
            words = [*range(n - common, n), *range(100, 140)]
            assert item.may_hold(words) or item.judge(words)[1] is None


def test_sums_of_directions():
    pick = np.random.default_rng(3)
    index = object.__new__(dec.Index)
    index.directions = pick.integers(-9, 9, (50, 7)).astype(np.float32)
    rows, first = pick.integers(0, 50, 200), np.array([0, 1, 30, 31, 90, 199])
    assert np.array_equal(index._sums(rows, first), np.add.reduceat(index.directions[rows], first, axis=0))


# ---- toxicity ------------------------------------------------------------------


def test_toxicity(spark):
    rows, labels = [], []
    for i in range(400):
        text, toxic = words(i, 60, "kmprst"), int(i % 4 == 0)
        if toxic:
            for k in (5, 25, 45):
                text[k] = random.Random(i + k).choice(["zzidiot", "zzmoron", f"zzscu{i % 7}"])
        rows.append((i, " ".join(text), "en"))
        if i % 5:
            labels.append((i, toxic))
    rows += [(900, None, None), (901, "", "en"), (None, "zzidiot zzidiot", "en"), (902, " ".join(words(7, 30_000)), "en")]
    labels += [(None, 1), (7, None), (8, 5), (12, 1)]
    known = spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity_scores(frame(spark, rows), known, crc_mod(3) != 1).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].predicted == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert got[None].predicted == 1 and [got[i].predicted for i in (900, 901, 902)] == [0, 0, 0]
    assert {r.score for r in toxicity_scores(frame(spark, rows[:5]), known.limit(0), F.lit(True)).collect()} == {0.0}
    assert toxicity_scores(frame(spark, []), known, F.lit(True)).count() == 0


# ---- near-duplicates -----------------------------------------------------------


def classes_by_brute_force(texts, idf):
    vectors = []
    for _, w, counts in lower_words(strings(pa.array(texts))):
        ends = np.cumsum(counts)
        vectors += [near.weighted_shingles(w[e - n : e], idf) for e, n in zip(ends, counts)]
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or len(vectors[i][0]) and near.weighted_jaccard(vectors[i], vectors[j]) >= near.SIMILARITY:
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return [top(i) for i in range(len(texts))]


def test_near_duplicates(spark):
    rows = []
    for g in range(12):
        base = words(g, 120)
        for c in range(6):
            text = list(base)
            for k in random.Random(g * 10 + c).sample(range(120), c // 2):
                text[k] = "changed"
            rows.append((len(rows), " ".join(text), "en"))
    rows += [(100 + i, " ".join(words(500 + i, 40)), "en") for i in range(10)]
    rows += [(200, "a b", "x"), (201, "A  b", "x"), (202, None, None), (203, "", "x"), (204, " ", "x"), (None, "a b", "x"), (200, "a b", "x")]
    docs = frame(spark, rows)
    texts = [t for _, t, _ in rows]
    idf = smooth_idf(*bin_counts(docs, near.BIN_BITS))
    label = classes_by_brute_force(texts, idf)
    least = {}
    for (i, _, _), top in zip(rows, label):
        least[top] = min(least.get(top, near.LAST), near.LAST if i is None else i)
    expected = sorted((str(i), least[top]) for (i, _, _), top in zip(rows, label))
    assert sorted((str(r.doc_id), r.class_id) for r in near.near_duplicates(docs).collect()) == expected
    kept = near.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert near.near_duplicates(frame(spark, [])).count() == 0 and near.without_near_duplicates(frame(spark, [])).count() == 0


def test_near_duplicates_of_large_buckets(spark, monkeypatch):
    """A chain of edited copies and three families under shared boilerplate, some hundred texts each, against brute force."""
    monkeypatch.setattr(near, "CELL_TEXTS", 100)  # several cells a bucket
    shared, chain, texts = words(1, 400), words(2, 300), []
    for k in range(150):  # each version replaces two more words, so that only near versions are alike
        chain[2 * k : 2 * k + 2] = [f"v{k}x", f"v{k}y"]
        texts.append(" ".join(shared[:100] + chain))
    for f in range(3):
        for c in range(70):
            own = words(10 + f, 100)
            for k in random.Random(100 * f + c).sample(range(100), 4):
                own[k] = f"w{f}x{c}x{k}"
            texts.append(" ".join(shared[100:] + own))
    random.Random(9).shuffle(texts)
    docs = frame(spark, [(i, t, "en") for i, t in enumerate(texts)])
    expected = classes_by_brute_force(texts, smooth_idf(*bin_counts(docs, near.BIN_BITS)))
    assert len(set(expected)) >= 4
    got = {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def test_samples_estimate_the_weighted_similarity():
    rng = np.random.default_rng(4)
    shingles = np.sort(rng.integers(1, 2**63, 600).astype(np.uint64))
    a, b = (shingles[:500], rng.uniform(1, 6, 500)), (shingles[80:], None)
    b = (b[0], np.r_[a[1][80:], rng.uniform(1, 6, 100)])
    agree = np.mean(near.sample(*a) == near.sample(*b))
    assert abs(agree - near.weighted_jaccard(a, b)) < 0.2
    assert (near.sample(*a) == near.sample(*a)).all()


def test_components(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(30)] + [("x", "y"), ("y", "x"), ("z", "y"), ("k", "k")]
    got = {r.node: r.label for r in near.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"n{i:03}"] for i in range(31)} == {"n000"} and {got[c] for c in "xyz"} == {"x"} and "k" not in got


# ---- pipeline ------------------------------------------------------------------


@mounted
def test_pipeline_stages(spark, tmp_path):
    """Each stage against brute force or its operator, on its own input."""
    sf_dir, docs, seen = str(FOLDER), table(spark, str(FOLDER), "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            assert after.columns == docs.columns
        seen[name] = (docs.collect(), after.collect())
        docs = after
    ids = lambda rows: {r.doc_id for r in rows}
    toxic = {r.doc_id for r in QUERIES["op7_toxicity"](spark, sf_dir).collect() if r.predicted}
    before, after = seen["toxicity"]
    assert ids(before) - ids(after) == toxic and {tuple(r) for r in after} <= {tuple(r) for r in before}
    before, after = seen["line_dedup"]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()  # noqa: E731  the texts' capitals here fold alike
    held = {}
    for r in before:
        for k in {key(x) for x in r.text.split("\n")} - {""}:
            held[k] = held.get(k, 0) + 1
    assert {r.doc_id: r.text for r in after} == {
        r.doc_id: "\n".join(x for x in r.text.split("\n") if held.get(key(x), 0) < 10) for r in before
    }
    before, after = seen["near_dedup"]
    idf = smooth_idf(*bin_counts(spark.read.parquet(str(tmp_path / "line_dedup")), near.BIN_BITS))
    ordered = sorted(before, key=lambda r: r.doc_id)
    label = classes_by_brute_force([r.text for r in ordered], idf)
    assert ids(after) == {ordered[i].doc_id for i in set(label)}
    before, after = seen["decontamination"]
    leaked = dec.leaks(spark.createDataFrame(before), table(spark, sf_dir, "benchmark"))
    assert ids(before) - ids(after) == {r.doc_id for r in leaked.collect()}
    before, after = seen["byte_bpe"]
    assert {r.doc_id: r.text for r in before} == {r.doc_id: r.text for r in after}
    assert corpus_pipeline.run(spark, sf_dir).count() == len(after)
