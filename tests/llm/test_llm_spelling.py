"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlift.llm import spelling
from ledgerlift.llm.spelling import finish, near_pairs, raw_hashes, spelling_variants

DDL = "doc_id bigint, text string, word string, n string, form int, other double, length string"
UPPER = {c: c + 32 for c in range(65, 91)}


def frame(spark, rows):
    """Extra columns with names that the operator uses inside."""
    return spark.createDataFrame([(i, t, "w", None, 1, 0.5, "x") for i, t in rows], DDL)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, every=199, letters=6, least=5, factor=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= letters and c >= least}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= factor * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def texts(seed, documents, words=300):
    pick = random.Random(seed)
    letters = "abcdezßàéÿ×"
    base = ["".join(pick.choice(letters) for _ in range(pick.randrange(5, 10))) for _ in range(40)]
    rows = []
    for i in range(documents):
        drawn = []
        for _ in range(words):
            w = base[min(int(pick.expovariate(0.15)), 39)]
            if pick.random() < 0.25:
                at = pick.randrange(len(w))
                w = pick.choice([w[:at] + w[at + 1 :], w[:at] + pick.choice(letters) + w[at:], w[:at] + pick.choice(letters) + w[at + 1 :]])
            drawn.append(w.title() if pick.random() < 0.1 else w)
        rows.append((i, pick.choice([" ", ", ", "\n", "3"]).join(drawn)))
    return rows


@pytest.mark.parametrize("every", [199, 7])
def test_variants_match_brute_force(spark, every):
    rows = texts(1, 60) + [(100, "kettled " * 900 + "kettlez " * 150 + "kettzez " * 25 + "kettzezz " * 5)]
    got = spelling_variants(frame(spark, rows), slip_every=every).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, every)
    assert any(r.form for r in got) and any(r.root != (r.form or r.word) for r in got)


def test_edges(spark):
    long_run = "abcdefgh" * 4000
    rows = texts(2, 8) + [(None, None), (90, ""), (91, "12 .. ÷× Œ œ ā"), (3, "Straße STRASSE straße")] * 6
    rows += [(i, f"{long_run} {long_run[:-1]} {long_run[1:]}x") for i in range(5)]
    rows += [(95, "Füße-füße fußé naïveté naivete naïvete 😀naïveté😀")] * 9 + [(None, "naïveté aaaaaa aaaaaaa aaaaaaaa")] * 5
    got = spelling_variants(frame(spark, rows), slip_every=199).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_no_words(spark):
    for rows in ([], [(1, None)], [(1, "few words only once each")]):
        df = spelling_variants(frame(spark, rows), slip_every=199)
        assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and df.collect() == []


def test_pairs_are_whole_when_the_filter_takes_several_passes(spark):
    vocabulary = sorted({w for _, t in texts(3, 20) for w in re.findall("[a-zÀ-ÿ]{4,}", t)})
    df = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    whole = sorted(map(tuple, near_pairs(df).collect()))
    passes = sorted(map(tuple, near_pairs(df, filter_bytes=512).collect()))
    found = sorted(tuple(sorted(p)) for p in whole)
    assert found == sorted((a, b) for i, a in enumerate(vocabulary) for b in vocabulary[i + 1 :] if one_edit(a, b))
    assert whole == passes


def test_the_filter_holds_its_words_and_few_others():
    rng = np.random.default_rng(5)
    codes = spelling.ALPHABET[rng.integers(0, len(spelling.ALPHABET), (40_000, 9))]
    hashes = finish(raw_hashes(codes), 9)
    words = np.zeros((40_000 * spelling.BITS_A_WORD // 512 // 2, 8), np.uint64)
    spelling.add(words, spelling.block_of(hashes[:20_000], len(words)), hashes[:20_000])
    assert spelling.passes(words, hashes[:20_000]).all()
    assert spelling.passes(words, hashes[20_000:]).mean() < 0.005
