"""Cluster quality metrics on (id, features array<double>, cluster)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlift.sources.readers import scratch_path, write_parquet

BLOCK_ROWS = 2_000
BLOCK_FILES = 256
# Squares below this share of the squared lengths are taken exactly, so many pairs at once.
NEAR, NEAR_AT_ONCE = 1e-6, 1 << 15
# Sums that a task holds before it returns them.
SUMS_HELD = 1 << 23


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)


def scale_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each feature by (x - mean) / population deviation; a constant one becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
        ).alias("_stats")
    ).scalar()
    ready = df.withColumn("_stats", stats)
    scaled = {
        c: F.when(F.col(f"_stats.s_{c}") == 0, 0.0).otherwise((F.col(c) - F.col(f"_stats.m_{c}")) / F.col(f"_stats.s_{c}"))
        for c in columns
    }
    return ready.withColumns(scaled).drop("_stats")


def centroids(points: DataFrame) -> DataFrame:
    """(cluster, size, centre): one row per cluster, means merged map-side."""
    return points.groupBy("cluster").agg(
        F.count("*").alias("size"),
        vector_to_array(Summarizer.mean(array_to_vector("features"))).alias("centre"),
    )


def _with_centre(points: DataFrame) -> DataFrame:
    return points.join(F.broadcast(centroids(points)), "cluster").withColumn(
        "_d2", squared_distance(F.col("features"), F.col("centre"))
    )


def inertia(points: DataFrame) -> DataFrame:
    """Within-cluster sum of squared distances."""
    return _with_centre(points).agg(F.sum("_d2").alias("inertia"))


def calinski_harabasz(points: DataFrame) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k)); 1.0 when the points coincide with their centres."""
    overall = points.agg(vector_to_array(Summarizer.mean(array_to_vector("features")))).scalar()
    per_cluster = _with_centre(points).groupBy("cluster", "size", "centre").agg(F.sum("_d2").alias("within"))
    spread = per_cluster.withColumn("_overall", overall).withColumn(
        "between", F.col("size") * squared_distance(F.col("centre"), F.col("_overall"))
    )
    sums = spread.agg(
        F.sum("between").alias("b"), F.sum("within").alias("w"), F.sum("size").alias("n"), F.count("*").alias("k")
    )
    ratio = F.col("b") * (F.col("n") - F.col("k")) / (F.col("w") * (F.col("k") - 1))
    return sums.select(
        F.when(F.col("k") < 2, 0.0).when(F.col("w") == 0, 1.0).otherwise(ratio).alias("calinski_harabasz_index")
    )


def davies_bouldin(points: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (S_i + S_j) / d_ij.

    The k centroids meet inside one array of k structs; no join of clusters.
    """
    scatter = _with_centre(points).groupBy("cluster", "centre").agg(F.avg(F.sqrt("_d2")).alias("scatter"))
    packed = scatter.agg(F.collect_list(F.struct("cluster", "centre", "scatter")).alias("_all"))

    def worst(one: Column) -> Column:
        others = F.filter("_all", lambda o: o["cluster"] != one["cluster"])

        def ratio(other: Column) -> Column:
            gap = F.sqrt(squared_distance(one["centre"], other["centre"]))
            return F.when(gap == 0, 0.0).otherwise((one["scatter"] + other["scatter"]) / gap)

        return F.coalesce(F.array_max(F.transform(others, ratio)), F.lit(0.0))

    total = F.aggregate(F.transform("_all", worst), F.lit(0.0), lambda s, x: s + x)
    return packed.select((total / F.size("_all")).alias("davies_bouldin_index"))


# ---- silhouette ----------------------------------------------------------------


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of all pairs by one matrix product; pairs so close that it cancels are taken by their differences."""
    scale = (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1)[None, :]
    squares = scale - 2.0 * (left @ right.T)
    near = np.flatnonzero(~(squares >= NEAR * scale))
    for low in range(0, len(near), NEAR_AT_ONCE):
        at = near[low : low + NEAR_AT_ONCE]
        i, j = np.divmod(at, len(right))
        squares.ravel()[at] = ((left[i] - right[j]) ** 2).sum(axis=1)
    return np.sqrt(squares, out=squares)


class _Block:
    """One packed block: ids, clusters, vectors and the membership of its rows in its labels (a null is no cluster)."""

    def __init__(self, points: pa.StructArray):
        self.ids, self.clusters = points.field("id"), points.field("cluster")
        features = points.field("features")
        if features.null_count:
            raise ValueError("features must not be null")
        self.x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(points), -1)
        codes, self.labels = pd.factorize(self.clusters.to_pandas())
        self.member = (codes[:, None] == np.arange(len(self.labels))).astype(float)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed distances from every point to each cluster of the blocks its own block meets in this task."""
    totals: dict[tuple[int, int], np.ndarray] = {}
    seen: dict[int, _Block] = {}

    def add(number: int, block: _Block, first: int, labels: np.ndarray, sums: np.ndarray) -> None:
        seen.setdefault(number, block)
        for label, column in zip(labels, sums.T):
            held = totals.setdefault((number, int(label)), np.zeros(len(block.ids)))
            held[first : first + len(column)] += column

    def done() -> Iterator[pa.RecordBatch]:
        for (number, label), held in totals.items():
            block = seen[number]
            other = pa.array(np.full(len(held), label, np.int32))
            yield pa.RecordBatch.from_arrays([block.ids, block.clusters, other, pa.array(held)], ["id", "cluster", "other", "total"])
        totals.clear()
        seen.clear()

    for batch in batches:
        for row in range(batch.num_rows):
            i, j = batch.column("_i")[row].as_py(), batch.column("_j")[row].as_py()
            left, right = _Block(batch.column("_left")[row].values), _Block(batch.column("_right")[row].values)
            for first in range(0, len(left.x), 512):
                gaps = _distances(left.x[first : first + 512], right.x)
                add(i, left, first, right.labels, gaps @ right.member)
                if i != j:
                    add(j, right, 0, left.labels, gaps.T @ left.member[first : first + 512])
            if sum(map(len, totals.values())) > SUMS_HELD:
                yield from done()
    yield from done()


def silhouette_points(points: DataFrame, rows: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, cluster, silhouette) with exact mean Euclidean distances.

    Points are hashed into blocks of about ``block_rows``, one row each, which are written
    once to the shared folder. Every two blocks meet in a product of the written table with
    itself, so the points are shuffled once and only read again for each share of the other
    side; a task returns sums per (point, cluster) for all the blocks it holds, and no pair
    of points is ever a row. Two blocks meet once, for both of them. The work is quadratic
    by definition of the metric. ``id`` must be unique.
    """
    rows = points.count() if rows is None else rows
    blocks = max(1, -(-rows // block_rows))
    base = points.select("id", F.col("cluster").cast("int").alias("cluster"), "features")
    # An explicit number of partitions: little data but much work, which coalescing by size would pile up.
    dealt = base.withColumn("_i", F.pmod(F.xxhash64("id"), F.lit(blocks))).repartition(min(blocks, BLOCK_FILES), "_i")
    packed = dealt.groupBy("_i").agg(F.collect_list(F.struct(*base.columns)).alias("_left"))
    left = write_parquet(packed, scratch_path(points.sparkSession, "blocks"))
    right = left.select(F.col("_i").alias("_j"), F.col("_left").alias("_right")).hint("shuffle_replicate_nl")
    i, j = F.col("_i"), F.col("_j")
    once = (i == j) | ((i < j) == ((i + j) % 2 == 0))  # of (i, j) and (j, i) the one that spreads them evenly
    id_type = points.schema["id"].dataType.simpleString()
    sums = (
        left.join(right, once)
        .mapInArrow(_block_sums, f"id {id_type}, cluster int, other int, total double")
        .groupBy("id", "cluster", "other")
        .agg(F.sum("total").alias("total"))
    )
    sizes = base.groupBy(F.col("cluster").alias("other")).agg(F.count("*").alias("size"))
    same = F.col("cluster") == F.col("other")
    per_point = (
        sums.join(F.broadcast(sizes), "other")
        .groupBy("id", "cluster")
        .agg(
            F.max(F.when(same, F.col("size"))).alias("_size"),
            F.max(F.when(same, F.col("total") / F.nullif(F.col("size") - 1, F.lit(0)))).alias("a"),
            F.min(F.when(~same, F.col("total") / F.col("size"))).alias("b"),
        )
    )
    a, b = F.col("a"), F.col("b")
    value = F.when((F.col("_size") == 1) | (F.greatest(a, b) == 0), 0.0).otherwise((b - a) / F.greatest(a, b))
    return per_point.select("id", "cluster", F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def silhouette_euclidean(points: DataFrame, rows: int | None = None) -> DataFrame:
    return silhouette_points(points, rows).agg(F.avg("silhouette").alias("silhouette_score"))


def _sample_sums(sample: dict[int, np.ndarray]):
    """Per task: summed distances from every sampled point to each cluster's points of the task."""
    spots = np.concatenate(list(sample.values()))

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for frame in batches:
            for cluster, rows in frame.groupby("cluster"):
                x = np.stack(rows["features"].to_numpy())
                for low in range(0, len(x), 1_024):
                    part = x[low : low + 1_024]
                    gaps = np.zeros((len(spots), len(part)))
                    for d in range(spots.shape[1]):
                        gaps += np.subtract.outer(spots[:, d], part[:, d]) ** 2
                    totals[cluster] = totals.get(cluster, 0.0) + np.sqrt(gaps).sum(axis=1)
        for cluster, sums in totals.items():
            yield pd.DataFrame({"spot": np.arange(len(spots)), "cluster": int(cluster), "total": sums})

    return run


def silhouette_estimate(points: DataFrame, per_cluster: int = 1_000, z: float = 2.576) -> tuple[float, float]:
    """(mean Euclidean silhouette, half width of its confidence interval), linear in the rows.

    Up to ``per_cluster`` points of every cluster, the least by the hash of their id, get their
    exact silhouette against all points. The clusters are strata: their means are weighted by
    their sizes, and the half width is ``z`` standard errors (99% by default) with the finite
    population correction, so it is 0 where every point is in the sample. Clusters of the sample
    reach the driver: at most ``per_cluster`` rows each.
    """
    base = points.select(F.xxhash64("id").alias("_h"), "id", F.col("cluster").cast("int").alias("cluster"), "features")
    sizes = {r["cluster"]: r["count"] for r in base.groupBy("cluster").count().collect()}
    place = F.row_number().over(W.partitionBy("cluster").orderBy("_h", "id"))
    taken = base.withColumn("_place", place).filter(F.col("_place") <= per_cluster).select("cluster", "features").collect()
    sample = {c: np.array([r["features"] for r in taken if r["cluster"] == c]) for c in sorted(sizes)}
    sums = base.select("cluster", "features").mapInPandas(_sample_sums(sample), "spot bigint, cluster int, total double")
    totals = {(r["spot"], r["cluster"]): r["total"] for r in sums.groupBy("spot", "cluster").agg(F.sum("total").alias("total")).collect()}
    rows, mean, variance, spot = sum(sizes.values()), 0.0, 0.0, 0
    for own, spots in sample.items():
        values = []
        for _ in spots:
            others = [totals[spot, c] / sizes[c] for c in sizes if c != own]
            a = totals[spot, own] / (sizes[own] - 1) if sizes[own] > 1 else 0.0
            b = min(others, default=0.0)
            values.append((b - a) / max(a, b) if sizes[own] > 1 and max(a, b) > 0 and others else 0.0)
            spot += 1
        share, n = sizes[own] / rows, len(values)
        mean += share * float(np.mean(values))
        if n > 1:
            variance += share**2 * float(np.var(values, ddof=1)) / n * (1 - n / sizes[own])
    return mean, z * variance**0.5


def silhouette_score(points: DataFrame, metric: str = "squared") -> float:
    """Mean silhouette of all points, by the metric the caller names, at every size.

    ``squared`` is Spark's squared-Euclidean form, linear in the rows;
    ``euclidean`` is the usual definition, quadratic in the rows, and ``estimated``
    its estimate from a sample against all rows (see ``silhouette_estimate``).
    """
    if metric == "estimated":
        return silhouette_estimate(points)[0]
    if metric == "euclidean":
        return float(silhouette_euclidean(points).first()[0])
    if metric != "squared":
        raise ValueError(f"unknown silhouette metric: {metric}")
    vectors = points.select(array_to_vector("features").alias("features"), F.col("cluster").alias("prediction"))
    return float(ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(vectors))
