"""Analytics over the gold tables. Cluster analytics take any label column."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerlift.operators.fingerprint import fingerprint
from ledgerlift.operators.ordering import ntile_of, quantiles, rank_descending
from ledgerlift.operators.quality import union_all

REVENUE = "total_receita_brl"


def percent(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100, 4)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [t.agg(F.count("*").alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for n, t in tables.items()]
    )


def table_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, filled rows, distinct values) of all tables, column by column.

    Numbers and times are grouped as they are, texts and nested values by a 128-bit hash. Each
    column is read and shuffled alone, so the few values of one do not queue behind the
    many of another. Equal cells are counted together before the shuffle, so a value that
    fills a third of a column is one row per task.
    """
    columns, values = [], []
    for name, table in tables.items():
        for i, f in enumerate(table.schema):
            cell = F.col(f"`{f.name}`")
            fixed = isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
            marks = [cell.alias("_value")] if fixed else fingerprint(table, [f.name])
            groups = table.filter(cell.isNotNull()).groupBy(*marks).agg(F.count("*").alias("n"))
            values.append(groups.select(F.lit(len(columns)).alias("numero"), "n"))
            columns.append((len(columns), name, i + 1, f.name, f.dataType.simpleString()))
    counted = union_all(values).groupBy("numero").agg(F.sum("n").alias("preenchidas"), F.count("*").alias("distintas"))
    spark = next(iter(tables.values())).sparkSession
    known = spark.createDataFrame(columns, "numero int, tabela string, posicao bigint, coluna string, tipo string")
    return known.join(F.broadcast(counted), "numero", "left").select(
        "tabela", "posicao", "coluna", "tipo", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("preenchidas", "distintas")]
    )


def _revenue_by(enriched: DataFrame, key: str) -> DataFrame:
    """Totals per key and share of the grand total; the window sees one row per key."""
    grouped = enriched.groupBy(key).agg(
        F.sum("valor_brl").alias("receita_brl"), F.count("*").alias("quantidade_transacoes")
    )
    return grouped.withColumn("participacao", percent(F.col("receita_brl"), F.sum("receita_brl").over(W.partitionBy())))


def revenue_by_account_type(enriched: DataFrame) -> DataFrame:
    return _revenue_by(enriched, "tipo_conta")


def revenue_by_currency(enriched: DataFrame) -> DataFrame:
    """Receivable revenue by currency."""
    return _revenue_by(enriched.filter(F.col("tipo_conta") == "receber"), "currency")


def monthly_trend(enriched: DataFrame) -> DataFrame:
    """Receivable revenue per month, growth on the previous month and on the first month."""
    monthly = (
        enriched.filter(F.col("tipo_conta") == "receber")
        .groupBy(F.date_format("data_referencia", "yyyy-MM").alias("ano_mes"))
        .agg(F.sum("valor_brl").alias("receita_brl"), F.count("*").alias("quantidade_transacoes"))
    )
    order = W.orderBy("ano_mes")
    first = F.first("receita_brl").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    revenue = F.col("receita_brl")

    def growth(base: Column) -> Column:
        return F.round((revenue.cast("double") / F.nullif(base.cast("double"), F.lit(0.0)) - 1) * 100, 4)

    return monthly.withColumn("crescimento_mes", growth(F.lag("receita_brl").over(order))).withColumn(
        "crescimento_periodo", growth(first)
    )


def top_categories(category_summary: DataFrame, n: int = 10) -> DataFrame:
    return category_summary.orderBy(
        F.desc("total_brl"), "tipo_conta", "codigo_categoria"
    ).limit(n)


def top_customers(summary: DataFrame, n: int = 15) -> DataFrame:
    return (
        summary.select("id_cliente", "nome_cliente", "pais_cliente", REVENUE)
        .orderBy(F.desc(REVENUE), "id_cliente")
        .limit(n)
    )


def avg_rate_by_currency(rates: DataFrame) -> DataFrame:
    rate = F.col("average_rate").cast("decimal(18,4)")
    mean = F.round(F.sum(rate).cast("double") / F.count(rate), 6)
    return rates.groupBy("currency").agg(mean.alias("taxa_media"), F.count("*").alias("cotacoes"))


# ---- concentration -------------------------------------------------------------


def _ranked(summary: DataFrame) -> DataFrame:
    return rank_descending(summary.select("id_cliente", REVENUE), REVENUE, "id_cliente", "posicao", "acumulado")


def pareto_curve(summary: DataFrame) -> DataFrame:
    """Cumulative revenue share by customer position."""
    totals = summary.agg(F.struct(F.sum(REVENUE).alias("s"), F.count("*").alias("n")).alias("t")).scalar()
    return (
        _ranked(summary)
        .withColumn("_t", totals)
        .select(
            "id_cliente",
            REVENUE,
            "posicao",
            "acumulado",
            percent(F.col("posicao"), F.col("_t.n")).alias("clientes_acumulado_pct"),
            percent(F.col("acumulado"), F.col("_t.s")).alias("receita_acumulada_pct"),
        )
    )


def vip_split(summary: DataFrame, top_share: Decimal = Decimal("0.2")) -> DataFrame:
    """Customers ranked within the top ``top_share`` (rounded up) against the rest."""
    vips = summary.agg(F.ceil(F.count("*") * F.lit(top_share))).scalar()
    group = F.when(F.col("posicao") <= vips, "VIP").otherwise("DEMAIS")
    split = (
        _ranked(summary)
        .groupBy(group.alias("grupo"))
        .agg(F.count("*").alias("clientes"), F.sum(REVENUE).alias("receita_brl"))
    )
    return split.withColumn("participacao", percent(F.col("receita_brl"), F.sum("receita_brl").over(W.partitionBy())))


def revenue_tiers(summary: DataFrame, tiles: int = 3, label: str = "cluster") -> DataFrame:
    """Deterministic label: ``ntile`` of revenue, highest first, from 0."""
    total = summary.agg(F.count("*")).scalar()
    ranks = rank_descending(summary, REVENUE, "id_cliente", "_posicao", "_acumulado")
    return ranks.withColumn(label, (ntile_of(F.col("_posicao"), total, tiles) - 1).cast("int")).drop(
        "_posicao", "_acumulado"
    )


# ---- clusters ------------------------------------------------------------------


def cluster_profile(segments: DataFrame, label: str = "cluster") -> DataFrame:
    return segments.groupBy(label).agg(
        F.count("id_cliente").alias("quantidade_clientes"),
        F.sum(REVENUE).alias(REVENUE),
        F.avg("ticket_medio_brl").alias("ticket_medio_brl"),
        F.avg("quantidade_transacoes").alias("quantidade_transacoes"),
        F.avg("percentual_atraso").alias("percentual_atraso"),
    )


def clusters_size_revenue(segments: DataFrame, label: str = "cluster") -> DataFrame:
    return segments.groupBy(label).agg(F.count("*").alias("clientes"), F.sum(REVENUE).alias("receita_brl"))


def country_cluster_matrix(segments: DataFrame, labels: list[int], label: str = "cluster") -> DataFrame:
    """Customers per country (rows) and cluster (columns)."""
    counts = segments.groupBy("pais_cliente").pivot(label, labels).count()
    renamed = [F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"cluster_{v}") for v in labels]
    return counts.select("pais_cliente", *renamed)


def cluster_distribution(segments: DataFrame, label: str = "cluster") -> DataFrame:
    sizes = segments.groupBy(label).agg(F.count("*").alias("clientes"))
    return sizes.withColumn("percentual", percent(F.col("clientes"), F.sum("clientes").over(W.partitionBy())))


def cluster_rankings(segments: DataFrame, label: str = "cluster") -> DataFrame:
    """Rank of each cluster by size and by revenue."""
    return (
        clusters_size_revenue(segments, label)
        .withColumn("posicao_tamanho", F.rank().over(W.orderBy(F.desc("clientes"))))
        .withColumn("posicao_receita", F.rank().over(W.orderBy(F.desc("receita_brl"))))
    )


def cluster_ticket(segments: DataFrame, label: str = "cluster") -> DataFrame:
    return segments.groupBy(label).agg(
        (F.sum(REVENUE).cast("double") / F.count("*")).alias("receita_media_brl"),
        F.avg("ticket_medio_brl").alias("ticket_medio_brl"),
    )


def cluster_efficiency(segments: DataFrame, label: str = "cluster") -> DataFrame:
    """Revenue share over customer share."""
    sized = clusters_size_revenue(segments, label)
    customers = F.col("clientes") / F.sum("clientes").over(W.partitionBy())
    revenue = F.col("receita_brl").cast("double") / F.sum("receita_brl").over(W.partitionBy()).cast("double")
    return sized.select(
        label,
        F.round(customers * 100, 4).alias("clientes_pct"),
        F.round(revenue * 100, 4).alias("receita_pct"),
        F.round(revenue / customers, 4).alias("eficiencia"),
    )


def variation(segments: DataFrame) -> Column:
    """Coefficient of variation of a customer's ticket; null without a ticket."""
    return F.col("desvio_padrao_brl") / F.nullif(F.col("ticket_medio_brl"), F.lit(0.0))


def purchase_stability(segments: DataFrame, label: str = "cluster") -> DataFrame:
    """Quartiles of the variation per cluster and the customers outside 1.5 IQR."""
    rated = segments.select("id_cliente", label, variation(segments).alias("variacao")).filter(
        F.col("variacao").isNotNull()
    )
    quartiles = quantiles(rated, label, "variacao", "id_cliente", {"q1": 0.25, "mediana": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    outside = (F.col("variacao") < F.col("q1") - reach) | (F.col("variacao") > F.col("q3") + reach)
    return (
        rated.join(F.broadcast(quartiles), label)
        .groupBy(label, "q1", "mediana", "q3")
        .agg(F.count("*").alias("clientes"), F.count(F.when(outside, 1)).alias("atipicos"))
    )


def country_currency_mix(segments: DataFrame, label: str = "cluster") -> DataFrame:
    return segments.groupBy("pais_cliente", "currency", label).agg(
        F.count("*").alias("clientes"), F.sum(REVENUE).alias("receita_brl")
    )


def cluster_profile_full(segments: DataFrame, label: str = "cluster") -> DataFrame:
    """Profile, mean revenue and stability of each cluster side by side (one row per cluster)."""
    stability = purchase_stability(segments, label).drop("clientes")
    means = cluster_ticket(segments, label).drop("ticket_medio_brl")
    return (
        cluster_profile(segments, label).join(F.broadcast(means), label).join(F.broadcast(stability), label, "left")
    )
