"""K-Means with many values of k and many restarts that share every scan of the points.

Starting centres are drawn as k-means++ does, with a chance in proportion to the squared
distance from the centres drawn so far. The draw is an exponential race: each point gets
a number from the hash of its id, the restart and the step, and the least -ln(u) / d2
wins. So it needs one aggregate per step and depends on neither order nor partitions.
The restarts of all k share their draws: k takes the first k centres of a restart.

Then all sets of centres move in the same pass over the points. A set that has come to
rest takes one more pass for its cost and leaves. Jobs grow with the number of steps of
the slowest set, not with k times the restarts.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ROWS_AT_ONCE = 4_096


@dataclass
class Fit:
    k: int
    restart: int
    centres: np.ndarray
    sizes: np.ndarray
    cost: float


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def race_number(point: str, restart: int, step: int) -> float:
    """A number between 0 and 1 from the hash of the three."""
    return (int(hashlib.md5(f"{point}|{restart}|{step}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    gaps = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :]
    return np.maximum(gaps, 0.0)


def _race(drawn: dict[int, np.ndarray], step: int):
    def run(batches):
        best: dict[int, tuple] = {}
        for batch in batches:
            x, ids = _features(batch), batch.column("id").to_pylist()
            for restart, centres in drawn.items():
                near = squared_distances(x, centres).min(axis=1) if step else np.ones(len(x))
                for i in np.flatnonzero(near > 1e-12):
                    mine = (-math.log(race_number(ids[i], restart, step)) / near[i], ids[i])
                    if restart not in best or mine < best[restart][:2]:
                        best[restart] = (*mine, x[i].tolist())
        yield pa.RecordBatch.from_pylist(
            [{"restart": r, "race": b[0], "id": b[1], "features": b[2]} for r, b in best.items()],
            schema=pa.schema([("restart", pa.int32()), ("race", pa.float64()), ("id", pa.string()), ("features", pa.list_(pa.float64()))]),
        )

    return run


def draw_centres(points: DataFrame, most: int, restarts: list[int], width: int) -> dict[int, np.ndarray]:
    """Up to ``most`` starting centres per restart; fewer where there are no more different points."""
    drawn = {r: np.zeros((0, width)) for r in restarts}
    for step in range(most):
        ran = points.mapInArrow(_race(drawn, step), "restart int, race double, id string, features array<double>")
        won = ran.groupBy("restart").agg(F.min(F.struct("race", "id", "features")).alias("w")).collect()
        for r in won:
            drawn[r["restart"]] = np.vstack([drawn[r["restart"]], r["w"]["features"]])
    return drawn


def _move(sets: list[np.ndarray]):
    every, width = np.vstack(sets), sets[0].shape[1]
    ends = np.cumsum([len(s) for s in sets])

    def run(batches):
        counts, costs, sums = np.zeros(len(every), np.int64), np.zeros(len(every)), np.zeros((len(every), width))
        for batch in batches:
            whole = _features(batch)
            for low in range(0, len(whole), ROWS_AT_ONCE):
                x = whole[low : low + ROWS_AT_ONCE]
                gaps = squared_distances(x, every)
                for centres, end in zip(sets, ends):
                    mine = gaps[:, end - len(centres) : end]
                    label = mine.argmin(axis=1)
                    own = slice(end - len(centres), end)
                    counts[own] += np.bincount(label, minlength=len(centres))
                    costs[own] += np.bincount(label, weights=mine[np.arange(len(x)), label], minlength=len(centres))
                    sums[own] += np.eye(len(centres))[label].T @ x
        used = np.flatnonzero(counts)
        columns = [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(costs[used])]
        columns += [pa.array(sums[used, j]) for j in range(width)]
        yield pa.RecordBatch.from_arrays(columns, names=["centre", "n", "cost", *[f"s{j}" for j in range(width)]])

    return run


def fit_all(
    points: DataFrame, ks: list[int], restarts: list[int], max_steps: int = 300, total_shift: float = 1e-4
) -> list[Fit]:
    """Every k from every restart over points (id string, features array<double>).

    A set is at rest when the squared shifts of its centres add up to ``total_shift``
    at most, or after ``max_steps``. A centre without points stays where it is.
    """
    width = len(points.first()["features"])
    drawn = draw_centres(points, max(ks), restarts, width)
    moving = {(k, r): drawn[r][:k] for k in ks for r in restarts}
    resting: set[tuple[int, int]] = set()
    done: list[Fit] = []
    ddl = f"centre int, n bigint, cost double, {', '.join(f's{j} double' for j in range(width))}"
    for step in range(max_steps + 1):
        if not moving:
            break
        keys = list(moving)
        parts = points.mapInArrow(_move([moving[key] for key in keys]), ddl)
        sums = [F.sum(c).alias(c) for c in ("n", "cost", *[f"s{j}" for j in range(width)])]
        found = {r["centre"]: r for r in parts.groupBy("centre").agg(*sums).collect()}  # one row per centre
        first = 0
        for key in keys:
            centres = moving[key]
            rows = [found.get(first + i) for i in range(len(centres))]
            first += len(centres)
            if key in resting or step == max_steps:
                sizes = np.array([r["n"] if r else 0 for r in rows])
                done.append(Fit(*key, centres, sizes, sum(r["cost"] for r in rows if r)))
                del moving[key]
                continue
            moved = np.array([[r[f"s{j}"] / r["n"] for j in range(width)] if r else c for r, c in zip(rows, centres)])
            moving[key] = moved
            if ((moved - centres) ** 2).sum() <= total_shift:
                resting.add(key)
    return done


def best_fits(fits: list[Fit]) -> dict[int, Fit]:
    """Per k the fit of least cost (to six digits behind the point; ties: the earliest restart)."""
    best: dict[int, Fit] = {}
    for f in sorted(fits, key=lambda f: (f.k, round(f.cost, 6), f.restart)):
        best.setdefault(f.k, f)
    return best


def nearest_centre(features: Column, centres: np.ndarray) -> Column:
    """Place of the nearest centre, in built-in functions; ties go to the first."""
    def distance(centre: np.ndarray) -> Column:
        target = F.array(*[F.lit(float(x)) for x in centre])
        gaps = F.zip_with(features, target, lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    gaps = F.array(*[distance(c) for c in centres])
    return F.array_min(F.transform(gaps, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))["i"].cast("int")
