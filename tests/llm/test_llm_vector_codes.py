"""Vector codes against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerlift.llm.vector_codes import nearest, sequency_order, vector_codes, walsh_hadamard

DDL = "vec_id bigint, embedding array<double>, label int, code string, error string, part int, entry int, v int"


def frame(spark, rows):
    """Extra columns with names that the operator uses inside."""
    return spark.createDataFrame([(*r, None, "e", 1, 2, 3) for r in rows], DDL)


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) and abs(np.floor(256 * x)) <= 1 << 24 for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    whole = [[int(np.floor(256 * x)) for x in v] for _, v, _ in kept]
    cut = [[(w + [0] * (parts * width - len(w)))[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, whole[n]))
    books = [[cut[n][p] for n in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            ranked = [min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            out.append(ranked)
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for c, found in zip(cut, assign()):
            for p, (_, k) in enumerate(found):
                members[p, k].append(c[p])
        for (p, k), held in members.items():
            books[p][k] = [sum(x) // len(held) for x in zip(*held)]
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    found = assign()
    by_label = defaultdict(int)
    for (_, _, g), f in zip(kept, found):
        by_label[g] += sum(d for d, _ in f)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[g], sha) for (i, _, g), f in zip(kept, found)]


def check(spark, rows, **options):
    got = vector_codes(frame(spark, rows), **options).collect()
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got), key=order) == sorted(brute(rows, **options), key=order)


def test_transform_keeps_distances_in_sequency_order():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 5, 8, 13):
        x, y = rng.integers(-900, 900, (40, width)), rng.integers(-900, 900, (40, width))
        a, b = walsh_hadamard(x), walsh_hadamard(y)
        assert (((a - b) ** 2).sum(axis=1) == a.shape[1] * ((x - y) ** 2).sum(axis=1)).all()
    order = sequency_order(8)
    matrix = walsh_hadamard(np.eye(8, dtype=np.int64)).T
    assert sorted(order) == list(range(8))
    assert [int((r[1:] != r[:-1]).sum()) for r in matrix] == list(range(8))


def test_nearest_eliminates_early_and_keeps_ties_low():
    rng = np.random.default_rng(4)
    x, entries = rng.integers(-50, 50, (300, 4)), rng.integers(-50, 50, (64, 4))
    entries[[20, 40]] = entries[7]
    index, distance, left = nearest(x, entries)
    full = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert left[0] < x.shape[0] * len(entries) and (np.diff(left) <= 0).all()


@pytest.mark.parametrize("width", [16, 32, 48, 80])
def test_codes_match_brute_force(spark, width):
    rng = np.random.default_rng(width)
    rows = [(int(i), rng.normal(0, 0.3, width).tolist(), int(i) % 5) for i in rng.permutation(150)]
    check(spark, rows)


def test_edges(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 1, 20).round(1).tolist(), None if i % 3 else 1) for i in range(90)]
    rows += [(3, rows[3][1], 1), rows[4], rows[4], (None, rows[5][1], 2), (None, [0.5] * 20, None)]  # repeats, no id
    rows += [(200, None, 1), (201, [0.1, None], 1), (202, [float("nan")] * 20, 1), (203, [float("-inf")], None), (204, [1e9], 1)]
    rows += [(205, [], 1), (206, [0.25] * 7, None), (-1, [0.25] * 30, 4)]  # other lengths; parts of two components
    check(spark, rows)
    check(spark, rows[:10])
    check(spark, rows, parts=3, entries=5, rounds=0)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_nothing_to_code(spark, rows):
    df = vector_codes(frame(spark, rows))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and df.collect() == []
