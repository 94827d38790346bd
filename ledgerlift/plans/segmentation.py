"""Customer segmentation: features, scaling, choice of k, K-Means and its report."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ledgerlift.functions.columns import zero_if_null
from ledgerlift.operators.cluster_metrics import (
    calinski_harabasz,
    davies_bouldin,
    inertia,
    scale_features,
    silhouette_score,
)
from ledgerlift.operators.kmeans import Fit, best_fits, fit_all, nearest_centre
from ledgerlift.plans.insights import REVENUE, cluster_profile
from ledgerlift.sources.readers import scratch_path, write_parquet

# Description and feature columns of the customer summary.
DESCRIPTION = ["id_cliente", "nome_cliente", "pais_cliente", "currency"]
FEATURES = [
    "total_receita_brl",
    "ticket_medio_brl",
    "quantidade_transacoes",
    "desvio_padrao_brl",
    "percentual_atraso",
    "percentual_pago",
    "dias_ativos",
]
ROWS_PER_PARTITION = 50_000
# Converged when the squared shifts of all centres add up to this, on unit-variance features.
TOTAL_SHIFT = 1e-5
MANDATORY = {"id_cliente", "total_receita_brl", "ticket_medio_brl", "quantidade_transacoes"}


@dataclass
class Settings:
    """``n_clusters`` above 1 presets k; otherwise the best silhouette in min_k..max_k wins."""

    n_clusters: int = 0
    min_k: int = 2
    max_k: int = 6
    seed: int = 42
    restarts: int = 10
    silhouette: str = "squared"


@dataclass
class Segmentation:
    segments: DataFrame
    metrics: dict[str, float]
    analysis: list[tuple[int, float, float]] = field(default_factory=list)
    fit: Fit | None = None

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        """(metrica, valor), one row per metric."""
        wide = spark.createDataFrame([tuple(float(v) for v in self.metrics.values())], list(self.metrics))
        return wide.unpivot([], list(self.metrics), "metrica", "valor")

    def analysis_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.analysis, "k int, silhouette_score double, inercia double")

    def profile(self) -> DataFrame:
        return cluster_profile(self.segments)


def prepare_features(base: DataFrame) -> DataFrame:
    """The known description and feature columns, features as numbers with 0 for missing."""
    missing = MANDATORY - set(base.columns)
    if missing:
        raise ValueError(f"columns missing from the customer summary: {sorted(missing)}")
    kept = [c for c in DESCRIPTION + FEATURES if c in base.columns]
    return base.select(*[zero_if_null(c).alias(c) if c in FEATURES else F.col(c) for c in kept])


def scaled_points(features: DataFrame) -> DataFrame:
    """(id, features array<double>) standardised with population deviations.

    A customer summary has one row per (customer, name, country, currency), so the
    id joins all four.
    """
    present = [c for c in DESCRIPTION if c in features.columns]
    key = F.to_json(F.struct(*present), {"ignoreNullFields": "false"}) if len(present) > 1 else F.col("id_cliente")
    scaled = scale_features(features, FEATURES)
    return scaled.select(key.alias("id"), F.array(*FEATURES).alias("features"))


def _candidates(rows: int, settings: Settings) -> list[int]:
    """k = 1 below three rows, the preset k, else min_k..max_k; never more than rows - 1."""
    if rows < 3:
        return [1]
    top = min(settings.max_k, rows - 1)
    if settings.n_clusters > 1:
        return [min(settings.n_clusters, top)]
    return list(range(min(settings.min_k, top), top + 1))


def _labelled(points: DataFrame, fit: Fit) -> DataFrame:
    return points.withColumn("cluster", nearest_centre(F.col("features"), fit.centres))


def _choose(points: DataFrame, rows: int, settings: Settings) -> tuple[Fit, float, list[tuple[int, float, float]]]:
    """(fit of the best silhouette, its score, analysis rows); ties keep the smaller k.

    All values of k and all restarts share their scans; the silhouettes are taken side by side.
    """
    seeds = [settings.seed + r for r in range(settings.restarts)]
    fits = list(best_fits(fit_all(points, _candidates(rows, settings), seeds, total_shift=TOTAL_SHIFT)).values())
    split = [f for f in fits if (f.sizes > 0).sum() > 1]
    if not split:
        return fits[0], 0.0, []
    with ThreadPool(len(split)) as pool:
        scores = pool.map(lambda f: silhouette_score(_labelled(points, f), settings.silhouette), split, chunksize=1)
    best = max(range(len(split)), key=lambda i: (scores[i], -split[i].k))
    return split[best], scores[best], [(f.k, score, float(f.cost)) for f, score in zip(split, scores)]


def _points(features: DataFrame, rows: int) -> DataFrame:
    """Scaled points, written once: every pass of the fits reads them."""
    laid_out = scaled_points(features).repartition(max(1, -(-rows // ROWS_PER_PARTITION)), "id")
    return write_parquet(laid_out, scratch_path(features.sparkSession, "points"))


def select_best_k(features: DataFrame, settings: Settings | None = None) -> int:
    settings = settings or Settings()
    rows = features.count()
    candidates = _candidates(rows, settings)
    if len(candidates) == 1:
        return candidates[0]
    return _choose(_points(features, rows), rows, settings)[0].k


def run_segmentation(summary: DataFrame, settings: Settings | None = None) -> Segmentation | None:
    """Features, chosen k, labels and metrics; None for an empty summary.

    Labels count from 0 by descending revenue.
    """
    settings = settings or Settings()
    features = prepare_features(summary)
    rows = features.count()
    if rows == 0:
        return None
    if _candidates(rows, settings) == [1]:
        return Segmentation(features.withColumn("cluster", F.lit(0)), _metrics(1, rows, 0.0, 0.0, 0.0, 0.0))
    scaled = _points(features, rows)
    fit, silhouette, analysis = _choose(scaled, rows, settings)
    points = _labelled(scaled, fit)
    with ThreadPool(3) as pool:
        rates = pool.map(lambda rate: rate(points).first()[0], [davies_bouldin, calinski_harabasz, inertia], chunksize=1)
    preset = settings.n_clusters > 1
    return Segmentation(_label_customers(features, points), _metrics(fit.k, rows, silhouette, *rates), [] if preset else analysis, fit)


def _metrics(k: int, rows: int, silhouette: float, bouldin: float, harabasz: float, cost: float) -> dict[str, float]:
    return {
        "k_escolhido": k,
        "silhouette_score": silhouette,
        "davies_bouldin_index": bouldin,
        "calinski_harabasz_index": harabasz,
        "inertia": cost,
        "n_amostras": rows,
    }


def _label_customers(features: DataFrame, points: DataFrame) -> DataFrame:
    present = [c for c in DESCRIPTION if c in features.columns]
    key = F.to_json(F.struct(*present), {"ignoreNullFields": "false"}) if len(present) > 1 else F.col("id_cliente")
    labelled = features.withColumn("id", key).join(points.select("id", "cluster"), "id").drop("id")
    order = labelled.groupBy("cluster").agg(F.sum(REVENUE).alias("_r")).select(
        "cluster", (F.row_number().over(W.orderBy(F.desc("_r"), "cluster")) - 1).alias("_label")
    )
    return labelled.join(F.broadcast(order), "cluster").select(*features.columns, F.col("_label").alias("cluster"))


def pca_projection(features: DataFrame) -> DataFrame:
    """(id_cliente, pc1, pc2) of the scaled features; each axis turned so its largest loading is positive."""
    points = scale_features(features, FEATURES).select(
        *[c for c in DESCRIPTION if c in features.columns], array_to_vector(F.array(*FEATURES)).alias("vector")
    )
    model = PCA(k=2, inputCol="vector", outputCol="pc").fit(points)
    loadings = model.pc.toArray()
    signs = [1.0 if max(axis, key=abs) >= 0 else -1.0 for axis in loadings.T]
    pc = vector_to_array("pc")
    return model.transform(points).select(
        "id_cliente", *[(F.get(pc, F.lit(i)) * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(2)]
    )
