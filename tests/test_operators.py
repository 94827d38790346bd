import bisect
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import cluster_metrics as cm
from ledgerlift.operators.dedup import keep_greatest, keep_least
from ledgerlift.operators.fingerprint import fingerprint
from ledgerlift.operators.fx import asof_by_key, asof_within, slices
from ledgerlift.operators.kmeans import best_fits, fit_all, squared_distances
from ledgerlift.operators.keys import dense_numbers, fact_numbers
from ledgerlift.operators.ordering import ntile_of, quantiles, rank_descending
from ledgerlift.operators.quality import quality_score
from ledgerlift.operators.sizing import broadcast_if_small, hot_keys, spread_left_join


def test_dedup_keeps_least_and_greatest(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", None, "y"), ("b", 1, "z"), (None, 3, "w"), (None, 4, "v")], "k string, n int, t string")
    assert rows(keep_least(df, ["k"])) == [("a", None, "y"), ("b", 1, "z"), (None, 3, "w")]
    assert rows(keep_greatest(df, ["k"])) == [("a", 2, "x"), ("b", 1, "z"), (None, 4, "v")]


def test_dedup_leaves_single_keys_alone(spark, rows, monkeypatch):
    data = [(None if i % 50 == 0 else f"k{i // 2 if i % 5 == 0 else i}", i % 7, None if i % 3 else "t") for i in range(2_000)]
    data += [("hot", i % 11, "x" * 50) for i in range(1_000)]
    df = spark.createDataFrame(data, "k string, n int, t string")
    least = {}
    for k, n, t in data:
        low = least.get(k)
        if low is None or (n, t is not None, t or "") < (low[0], low[1] is not None, low[1] or ""):
            least[k] = (n, t)
    wanted = sorted(((k, *v) for k, v in least.items()), key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(keep_least(df, ["k"])) == wanted
    plan = keep_least(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    monkeypatch.setattr("ledgerlift.operators.sizing.BROADCAST_ROWS", 0)
    monkeypatch.setattr("ledgerlift.operators.dedup.broadcast_if_small", lambda x: (x, False))
    assert rows(keep_least(df, ["k"])) == wanted


def test_many_repeats_meet_in_one_shuffle(spark, rows, monkeypatch):
    data = [(None if i % 9 == 0 else f"k{i % 300}", [None, 1.5, float("nan"), -1.0][i % 4], None if i % 5 else f"t{i % 7}") for i in range(2_000)]
    data += [("hot", float(i % 11), "x") for i in range(1_000)]
    df = spark.createDataFrame(data, "k string, n double, t string").repartition(5)
    aggregated = [rows(keep(df, ["k"])) for keep in (keep_least, keep_greatest)]
    monkeypatch.setattr("ledgerlift.operators.dedup.BROADCAST_ROWS", 0)
    for keep, wanted in zip((keep_least, keep_greatest), aggregated):
        got = keep(df, ["k"])
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # one exchange by key, each task's first rows only; no join and no second read
        assert plan.count("hashpartitioning(k") == 1 and "Left" not in plan and "Partial" in plan
        assert [(k, str(n), t) for k, n, t in rows(got)] == [(k, str(n), t) for k, n, t in wanted]


def test_many_repeats_without_a_hot_key_are_sorted_once(spark, rows, monkeypatch):
    data = [(f"k{i % 300}", [None, 1.5, float("nan"), -1.0][i % 4], None if i % 5 else f"t{i % 7}") for i in range(2_000)]
    df = spark.createDataFrame(data, "k string, n double, t string").repartition(5)
    aggregated = [rows(keep(df, ["k"])) for keep in (keep_least, keep_greatest)]
    monkeypatch.setattr("ledgerlift.operators.dedup.BROADCAST_ROWS", 0)
    for keep, wanted in zip((keep_least, keep_greatest), aggregated):
        got = keep(df, ["k"])
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("hashpartitioning(k") == 1 and plan.count("Sort [") == 1 and "WindowGroupLimit" not in plan
        assert [(k, str(n), t) for k, n, t in rows(got)] == [(k, str(n), t) for k, n, t in wanted]


def test_fingerprints_tell_nulls_apart(spark):
    data = [(None, "a", [1]), ("a", None, [1]), (None, None, [1]), ("a", "a", [1]), ("", "a", [1]), ("a", "a", [1, None]), ("a", "a", None)]
    df = spark.createDataFrame(data + data, "x string, y string, z array<int>")
    marks = df.select(*fingerprint(df, df.columns))
    assert marks.distinct().count() == len(data)
    assert quality_score(df).first()[0] == pytest.approx(round((14 * 3 - 10) / 42 * 100 - 25, 2))


def test_spread_join_with_hot_and_null_keys(spark, rows):
    big = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE cast(id % 50 AS string) END AS k"
    )
    small = spark.range(40).selectExpr("cast(id AS string) AS k", "id * 10 AS v").union(
        spark.createDataFrame([("hot", -1)], "k string, v long")
    )
    plain = big.join(small, "k", "left").select("id", "k", "v")
    assert rows(spread_left_join(big, small, "k", "id")) == rows(plain)
    assert "hot" in {r.k for r in hot_keys(big, "k").collect()}
    nothing_hot = hot_keys(big, "k").filter("false")
    assert rows(spread_left_join(big, small, "k", "id", nothing_hot)) == rows(plain)


def test_broadcast_is_measured(spark):
    assert broadcast_if_small(spark.range(10), 10)[1]
    assert not broadcast_if_small(spark.range(11), 10)[1]


def test_dense_and_fact_numbers(spark):
    df = spark.range(5000).selectExpr("concat('c', id) AS code", "'t' AS kind")
    ids = [r.key for r in dense_numbers(df, "code", "key", F.lit(7)).collect()]
    assert sorted(ids) == list(range(8, 5008))
    facts = fact_numbers(df, ["kind", "code"], "key")
    first = {r.code: r.key for r in facts.collect()}
    again = {r.code: r.key for r in fact_numbers(df.repartition(3), ["kind", "code"], "key").collect()}
    assert len(set(first.values())) == 5000 and first == again
    twins = spark.createDataFrame([("t", "c", n) for n in (3, 1, 2)], "kind string, code string, n int")
    ordered = sorted(fact_numbers(twins, ["kind", "code"], "key").collect(), key=lambda r: r.key)
    assert [r.n for r in ordered] == [1, 2, 3]  # equal keys are told apart by the other columns


def test_rank_with_one_value_on_a_third_of_the_rows(spark):
    data = [(f"i{n}", 0 if n % 3 == 0 else random.Random(n).randint(1, 400)) for n in range(3000)]
    df = spark.createDataFrame(data, "id string, m long")
    got = rank_descending(df, "m", "id", "pos", "run").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 3001))
    values = [r.m for r in got]
    assert values == sorted((m for _, m in data), reverse=True)
    assert [r.run for r in got] == list(np.cumsum(values))
    assert {r.id for r in got} == {i for i, _ in data}


def test_ntile(spark):
    for total in (2, 3, 7, 9, 11):
        df = spark.range(1, total + 1)
        got = [r[0] for r in df.orderBy("id").select(ntile_of(F.col("id"), F.lit(total), 3)).collect()]
        want = [r[0] for r in df.selectExpr("ntile(3) OVER (ORDER BY id)").collect()]
        assert got == want


def test_quantiles_match_numpy(spark):
    rng = random.Random(3)
    data = [(g, i, rng.choice([rng.random(), 0.5])) for g in (0, 1) for i in range(501 + g)] + [(2, 0, 1.5)]
    df = spark.createDataFrame(data, "g int, id int, m double")
    probes = {"q1": 0.25, "q2": 0.5, "q3": 0.9}
    for r in quantiles(df, "g", "m", "id", probes).collect():
        mine = [m for g, _, m in data if g == r.g]
        assert [r.q1, r.q2, r.q3] == pytest.approx(list(np.quantile(mine, list(probes.values()))))


@pytest.mark.parametrize("slice_rows", [1, 7, 200_000])
def test_asof_against_brute_force(spark, slice_rows):
    rng, base = random.Random(5), datetime(2024, 1, 1)
    users = ["hot"] * 5 + ["a", "b", "only_left"]
    left = [(i, rng.choice(users), base + timedelta(minutes=rng.randint(0, 5000))) for i in range(400)]
    right = [(rng.choice(users[:-1]), base + timedelta(minutes=m), m) for m in rng.sample(range(300, 6000), 150)]
    right.append(("hot", left[0][2], -1))
    got = asof_by_key(
        spark.createDataFrame(left, "id int, u string, t timestamp"),
        spark.createDataFrame(right, "u string, rt timestamp, v int"),
        "u", "t", "rt", "v", "found", slice_rows=slice_rows,
    )

    def want(user, at):
        mine = sorted((t, v) for u, t, v in right if u == user)
        before = [v for t, v in mine if t <= at]
        return before[-1] if before else (mine[0][1] if mine else None)

    assert {r.id: r.found for r in got.collect()} == {i: want(u, t) for i, u, t in left}


def crowded_events(n):
    """90% of the rows in one second of one user, a third of those at one instant; some without time or user."""
    rng, base = random.Random(8), datetime(2024, 5, 1)
    rows = []
    for i in range(n):
        user, at = "hot", base + timedelta(microseconds=rng.choice([500_000, rng.randrange(1_000_000), rng.randrange(1_000_000)]))
        if i % 10 == 0:
            user, at = rng.choice(["hot", "a", "b", None]), rng.choice([base + timedelta(minutes=rng.randrange(-600, 600)), None])
        rows.append((i, user, at, rng.choice(["ask", "ask", "tell", "both", "no"]), i))
    return rows


def test_asof_within_a_crowded_second(spark):
    rows = crowded_events(6_000)
    df = spark.createDataFrame(rows, "id int, u string, t timestamp, kind string, v int")
    asks, tells = F.col("kind").isin("ask", "both"), F.col("kind").isin("tell", "both")
    got = {r.id: r.found for r in asof_within(df, "u", "t", asks, tells, "v", ["id", "u"], "found", slice_rows=300).collect()}
    history = {}
    for _, u, t, kind, v in rows:
        if u is not None and t is not None and kind in ("tell", "both"):
            history.setdefault(u, []).append((t, v))
    asked = [r for r in rows if r[3] in ("ask", "both")]
    for i, u, t, _, _ in asked:
        mine = sorted(history.get(u, []))
        at = bisect.bisect_right(mine, (t, math.inf)) if t is not None else 0
        assert got.pop(i) == (mine[at - 1][1] if at else mine[0][1] if mine else None), (i, u, t)
    assert got == {}


def test_slices_of_a_crowded_second_are_even(spark):
    df = spark.createDataFrame(crowded_events(20_000), "_number int, _key string, _time timestamp, kind string, v int")
    rows = df.filter("_key IS NOT NULL").select("_number", "_key", "_time", (F.col("kind") == "ask").alias("_asks"))
    placed = slices(rows, slice_rows=400)
    sizes = [r["count"] for r in placed.groupBy("_key", "_bucket", "_slice", "_part").count().collect()]
    assert sum(sizes) == rows.count()
    told = placed.filter("_single AND NOT _asks").count()  # these go into the carried row map-side
    assert max(sizes) <= max(2 * 400, told)
    scanned = placed.filter("_asks OR NOT _single").groupBy("_key", "_bucket", "_slice", "_part").count()
    assert scanned.agg(F.max("count")).first()[0] <= 2 * 400


def test_asof_within_reads_its_table_once(spark, tmp_path):
    spark.createDataFrame(crowded_events(500), "id int, u string, t timestamp, kind string, v int").write.parquet(str(tmp_path / "e"))
    df = spark.read.parquet(str(tmp_path / "e"))
    got = asof_within(df, "u", "t", F.col("kind") == "ask", F.col("kind") == "tell", "v", ["id"], "found")
    assert str(tmp_path) not in got._jdf.queryExecution().toString()  # read for the written rows alone


def test_asof_null_keys_find_nothing(spark, rows):
    at = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, None, at), (2, "a", at), (3, None, at)], "id int, u string, t timestamp")
    right = spark.createDataFrame([(None, at, 7), ("a", at, 8)], "u string, rt timestamp, v int")
    got = asof_by_key(left, right, "u", "t", "rt", "v", "found")
    assert rows(got, "id", "found") == [(1, None), (2, 8), (3, None)]


def test_estimated_silhouette_within_its_error(spark):
    rng = np.random.default_rng(2)
    data = [(i, (rng.normal(0, 1, 3) + 2.0 * (i % 3)).tolist(), i % 3) for i in range(900)] + [(900, [9.0, 9.0, 9.0], 7)]
    points = spark.createDataFrame(data, "id int, features array<double>, cluster int").repartition(5)
    exact = cm.silhouette_euclidean(points).first()[0]
    whole, no_error = cm.silhouette_estimate(points, per_cluster=1_000)
    assert whole == pytest.approx(exact, abs=1e-9) and no_error == 0.0
    part, error = cm.silhouette_estimate(points, per_cluster=60)
    assert 0 < error < 0.15 and abs(part - exact) <= error
    assert cm.silhouette_score(points, "estimated") == pytest.approx(exact, abs=1e-9)


def test_kmeans_restarts_share_scans_and_match_a_plain_one(spark):
    rng = np.random.default_rng(4)
    data = [(f"p{i}", (rng.normal(0, 0.6, 2) + [4 * (i % 4 // 2), 4 * (i % 2)]).tolist()) for i in range(400)]
    points = spark.createDataFrame(data, "id string, features array<double>").repartition(3)
    fits = fit_all(points, [1, 2, 4], [1, 2, 3], total_shift=1e-12)
    assert sorted((f.k, f.restart) for f in fits) == [(k, r) for k in (1, 2, 4) for r in (1, 2, 3)]
    x = np.array([f for _, f in data])
    for f in fits:
        label = squared_distances(x, f.centres).argmin(axis=1)  # at rest: centres are the means of their points
        means = np.array([x[label == c].mean(axis=0) for c in range(f.k)])
        assert np.allclose(means, f.centres, atol=1e-5)
        assert f.cost == pytest.approx(((x - f.centres[label]) ** 2).sum()) and f.sizes.tolist() == np.bincount(label).tolist()
    best = best_fits(fits)
    assert best[4].cost < best[2].cost < best[1].cost and best[4].sizes.min() > 80
    again = best_fits(fit_all(points.repartition(1), [1, 2, 4], [1, 2, 3], total_shift=1e-12))
    assert all(np.allclose(again[k].centres, best[k].centres) for k in best)
    few = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [1.0, 1.0]), ("c", [2.0, 2.0])], "id string, features array<double>")
    assert [len(f.centres) for f in fit_all(few, [3], [1])] == [2]  # no more different points


def test_silhouette_metric_is_the_callers(spark):
    points = spark.createDataFrame([(i, [float(i % 2 * 9 + i % 3), 1.0], i % 2) for i in range(12)], "id int, features array<double>, cluster int")
    data = [(r.id, r.features[0], r.cluster) for r in points.collect()]

    def score(power):
        total = 0
        for i, x, c in data:
            mean = lambda k: np.mean([abs(x - y) ** power for j, y, d in data if d == k and j != i])  # noqa: E731, B023
            a, b = mean(c), mean(1 - c)
            total += (b - a) / max(a, b)
        return total / len(data)

    assert cm.silhouette_score(points) == pytest.approx(score(2))
    assert cm.silhouette_score(points, "euclidean") == pytest.approx(score(1))
    with pytest.raises(ValueError):
        cm.silhouette_score(points, "auto")


def labelled(n=120, k=3, d=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + rng.integers(0, k, size=(n, 1)) * 2
    labels = rng.integers(0, k, size=n)
    labels[0] = k  # a cluster of one
    return x, labels


def frame(spark, x, labels):
    return spark.createDataFrame(
        [(i, [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, labels))],
        "id long, features array<double>, cluster int",
    )


def test_metrics_against_brute_force(spark):
    x, labels = labelled()
    df = frame(spark, x, labels)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i, c in enumerate(labels):
        own = (labels == c).sum()
        if own == 1:
            scores.append(0.0)
            continue
        a = dist[i][labels == c].sum() / (own - 1)
        b = min(dist[i][labels == o].mean() for o in set(labels) - {c})
        scores.append((b - a) / max(a, b))
    for block in (1000, 25):
        got = {r.id: r.silhouette for r in cm.silhouette_points(df, block_rows=block).collect()}
        assert [got[i] for i in range(len(labels))] == pytest.approx(scores)

    centres = {c: x[labels == c].mean(0) for c in set(labels)}
    spread = {c: np.sqrt(((x[labels == c] - m) ** 2).sum(1)).mean() for c, m in centres.items()}
    bouldin = np.mean(
        [max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in centres if j != i) for i in centres]
    )
    assert cm.davies_bouldin(df).first()[0] == pytest.approx(bouldin)
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in centres.items())
    between = sum((labels == c).sum() * ((m - x.mean(0)) ** 2).sum() for c, m in centres.items())
    n, k = len(labels), len(centres)
    assert cm.calinski_harabasz(df).first()[0] == pytest.approx(between / (k - 1) / (within / (n - k)))
    assert cm.inertia(df).first()[0] == pytest.approx(within)


def test_exact_silhouette_sends_points_once_and_keeps_close_pairs_exact(spark):
    x, labels = labelled(n=90, seed=5)
    x = x * 1e-4 + 1e4  # close together and far from the origin: a product of vectors alone would cancel
    x[60:] = x[:30]  # copies
    df = frame(spark, x, labels)
    got = cm.silhouette_points(df, block_rows=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan  # blocks meet without a shuffle of points
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    values = {r.id: r.silhouette for r in got.collect()}
    for i, c in enumerate(labels):
        own = (labels == c).sum()
        a = dist[i][labels == c].sum() / max(own - 1, 1)
        b = min(dist[i][labels == o].mean() for o in set(labels) - {c})
        assert values[i] == pytest.approx((b - a) / max(a, b) if own > 1 else 0.0, abs=1e-9)


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = sorted(tuple(r) for r in cm.scale_features(df, ["a", "b"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]
