"""Registered queries: every operator over the test tables.

Each entry maps a name to a function of (spark, sf_dir). Decimals leave as
doubles and integers as bigints so that the results compare by value.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from datetime import date, datetime
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlift.functions.columns import normalize_columns
from ledgerlift.functions.country import country_currency, currency_country, currency_name, with_country
from ledgerlift.operators import cluster_metrics as cm, fx, quality
from ledgerlift.operators.sizing import hot_keys
from ledgerlift.plans import gold, insights, segmentation, silver
from ledgerlift.sources import quotes as quote_source, readers, star_inputs as inputs

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2001, 7, 31)
STALE_AS_OF = date(2023, 12, 31)
FIRST_LOAD_TS = datetime(2024, 1, 1, 6, 30, 0)
LABELS = [0, 1, 2]

QUERIES: dict[str, Query] = {}


class Lake:
    """The layers of one test folder, for one query.

    Tables that a query reads several times are written once to the shared folder,
    as the layers of a pipeline run are, and read back (``stored``): recomputing
    them took twice as long. Tables read once stay lazy. Tables that do not depend on
    one another are submitted together (``each``); one that does waits for the others.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, Lock] = defaultdict(Lock)

    def stored(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._built:
                built = self.silver(name) if name in inputs.INPUTS else getattr(self, name)()
                self._built[name] = readers.write_parquet(built, readers.scratch_path(self.spark, name))
            return self._built[name]

    @staticmethod
    def each(build: Callable[[str], DataFrame], names: Iterable[str]) -> list[DataFrame]:
        """``build`` of every name; the jobs that this takes run side by side."""
        names = list(names)
        with ThreadPool(len(names)) as pool:
            return pool.map(build, names, chunksize=1)

    def table(self, name: str) -> DataFrame:
        return inputs.table(self.spark, self.sf_dir, name)

    def bronze(self, name: str, lineage: bool = False) -> DataFrame:
        return inputs.INPUTS[name](self.spark, self.sf_dir, lineage)

    def silver(self, name: str, lineage: bool = False) -> DataFrame:
        return silver.CLEANERS[name](self.bronze(name, lineage))

    def hot_customers(self) -> DataFrame:
        """Read off the raw orders: a hint only, so no need to wait for the dedup."""
        ids = self.table("orders").select(F.col("o_custkey").cast("string").alias("id_cliente"))
        return hot_keys(ids, "id_cliente")

    def enriched(self, dims: dict[str, DataFrame] | None = None) -> DataFrame:
        """With dimensions the account tables are read twice (calendar and facts), so they are stored; stored ones are read."""

        def accounts(name: str) -> DataFrame:
            return self.silver(name) if dims is None and name not in self._built else self.stored(name)

        builds = {n: accounts for n in ("conta_pagar", "conta_receber")} | {n: self.stored for n in ("cliente", "categoria", "exchange_rates")}
        tables = self.each(lambda n: builds[n](n), builds)
        return gold.enrich(*tables, self.hot_customers(), dims)

    def customer_summary(self) -> DataFrame:
        return gold.customer_summary(self.enriched())

    def segments(self) -> DataFrame:
        """Customers with a deterministic label: revenue terciles."""
        return insights.revenue_tiers(self.stored("customer_summary"))

    def currency_dim(self) -> DataFrame:
        return gold.currency_dim(self.stored("exchange_rates"), self.stored("cliente"))

    def early_customer_dim(self) -> DataFrame:
        """First load of the two-batch dimension: customers registered before 1993."""
        early = self.stored("cliente").filter("data_cadastro_cliente < '1993-01-01'")
        return gold.customer_dim(early, FIRST_LOAD_TS)

    def customer_dim(self) -> DataFrame:
        return gold.customer_dim(self.stored("cliente"), inputs.RUN_TS, self.stored("early_customer_dim"))

    def early_category_dim(self) -> DataFrame:
        return gold.category_dim(self.stored("categoria").filter("tipo_categoria = 'receita'"))

    def category_dim(self) -> DataFrame:
        return gold.category_dim(self.stored("categoria"), self.stored("early_category_dim"))

    def account_dim(self) -> DataFrame:
        return gold.account_dim(self.stored("category_dim"))

    def date_dim(self) -> DataFrame:
        return gold.date_dim(gold.date_range(*self.each(self.stored, ("conta_pagar", "conta_receber"))))

    def dims(self) -> dict[str, DataFrame]:
        names = ("currency", "customer", "category", "account", "date")
        return dict(zip(names, self.each(lambda n: self.stored(f"{n}_dim"), names)))

    def transaction_fact(self) -> DataFrame:
        return gold.transaction_fact(self.enriched(self.dims()), inputs.RUN_TS)

    def exchange_rate_fact(self) -> DataFrame:
        return gold.exchange_rate_fact(self.stored("exchange_rates"), self.stored("currency_dim"), inputs.RUN_TS)

    def points(self) -> DataFrame:
        """Labelled vectors for the metrics on fixed labels."""
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"),
            F.col("embedding").cast("array<double>").alias("features"),
            F.col("label").alias("cluster"),
        )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as bigints, timestamps as text."""
    casts = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        casts.append(column.alias(f.name))
    return df.select(*casts)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles whose last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def query(name: str):
    def register(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: plain(build(Lake(spark, sf_dir)))
        return build

    return register


# ---- sources and sinks ---------------------------------------------------------


def _as_text(df: DataFrame, schema: str) -> DataFrame:
    wanted = T._parse_datatype_string(schema)
    return df.select(*[F.col(f.name).cast("string").alias(f.name) for f in wanted])


@query("bronze_csv")
def bronze_csv(lake: Lake) -> DataFrame:
    """Written with another column order and a column nobody declared; read back by name."""
    rows = normalize_columns(lake.bronze("meta")).select("meta", F.lit("planilha").alias("origem"), "mes_meta")
    path = readers.scratch_path(lake.spark, "meta_csv")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return readers.read_csv(lake.spark, path, readers.SCHEMAS["meta"])


@query("bronze_json")
def bronze_json(lake: Lake) -> DataFrame:
    """Customers landed as JSON arrays of a thousand ids."""
    rows = _as_text(lake.bronze("cliente"), readers.SCHEMAS["cliente"])
    arrays = (
        rows.groupBy(F.floor(F.col("id_cliente").cast("bigint") / 1000).alias("_chunk"))
        .agg(F.collect_list(F.struct(*rows.columns)).alias("_rows"))
        .select(F.to_json("_rows").alias("value"))
    )
    path = readers.scratch_path(lake.spark, "cliente_json")
    arrays.write.text(path)
    return readers.read_json_array(lake.spark, path, readers.SCHEMAS["cliente"])


@query("bronze_tabular")
def bronze_tabular(lake: Lake) -> DataFrame:
    text = _as_text(lake.bronze("conta_receber"), readers.SCHEMAS["conta_receber"])
    rows = text.select(F.lit("planilha").alias("origem"), *reversed(text.columns))
    path = readers.scratch_path(lake.spark, "conta_receber_csv")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    read = readers.read_tabular(lake.spark, path, readers.SCHEMAS["conta_receber"])
    return read.withColumn("valor_conta", F.col("valor_conta").try_cast("double"))


@query("bronze_metadata")
def bronze_metadata(lake: Lake) -> DataFrame:
    """Lineage straight from the scan; the run-dependent path is reduced to its file name."""
    stamped = readers.with_lineage(lake.table("orders"), "conta_receber", inputs.RUN_TS)
    folder = F.element_at(F.split("_raw_file_path", "/"), -1)
    is_table = F.col("_raw_file_path").contains("orders.parquet")
    return stamped.select(
        "o_orderkey",
        "_ingestion_date",
        "_source",
        F.when(is_table, "orders.parquet").otherwise(folder).alias("_raw_file_path"),
    )


@query("fx_payload_flatten")
def fx_payload_flatten(lake: Lake) -> DataFrame:
    return quote_source.flatten_payloads(inputs.payloads(lake.spark, lake.sf_dir))


def _latest(lake: Lake, as_of: date) -> DataFrame:
    landed = quote_source.flatten_payloads(inputs.payloads(lake.spark, lake.sf_dir))
    return quote_source.latest_quotes(landed, F.lit(as_of))


@query("fx_latest_in_lookback")
def fx_latest_in_lookback(lake: Lake) -> DataFrame:
    return _latest(lake, AS_OF)


@query("fx_missing_currencies")
def fx_missing_currencies(lake: Lake) -> DataFrame:
    return quote_source.missing_currencies(lake.spark, _latest(lake, AS_OF))


@query("fx_fallback_cache")
def fx_fallback_cache(lake: Lake) -> DataFrame:
    """A batch with quotes is taken as it is; a batch without takes the persisted one."""
    persisted = _latest(lake, AS_OF)
    newer = _latest(lake, date(2001, 7, 20))
    return quality.union_all(
        [
            quote_source.fresh_or_cached(newer, persisted).withColumn("lote", F.lit("novo")),
            quote_source.fresh_or_cached(_latest(lake, STALE_AS_OF), persisted).withColumn("lote", F.lit("vazio")),
        ]
    )


def _star(lake: Lake, *others: str) -> dict[str, DataFrame]:
    """The seven star tables; ``others`` are stored beside the facts and read the same account tables."""
    dims = {f"{n}_dim": t for n, t in lake.dims().items()}
    names = ("transaction_fact", "exchange_rate_fact", *others)
    return dims | dict(zip(names, lake.each(lake.stored, names)))


@query("star_tables")
def star_tables(lake: Lake) -> DataFrame:
    """Star tables written as Parquet, read back and counted."""
    return insights.table_row_counts(_star(lake))


def _outputs(lake: Lake) -> dict[str, DataFrame]:
    raw = {("bcb_exchange_rates" if n == "exchange_rates" else n) + "_raw": lake.bronze(n) for n in inputs.INPUTS}
    clean = {f"{n}_transformed": t for n, t in zip(inputs.INPUTS, lake.each(lake.stored, inputs.INPUTS))}
    return raw | clean | {
        "transactions_enriched": lake.stored("enriched"),
        "customer_summary": gold.customer_summary(lake.stored("enriched")),
        "category_summary": gold.category_summary(lake.stored("enriched")),
        "monthly_summary": gold.monthly_summary(lake.stored("enriched")),
    }


@query("output_audit")
def output_audit(lake: Lake) -> DataFrame:
    """All layers but the segments, which the audit must report as missing."""
    return gold.output_audit(lake.spark, _outputs(lake))


# ---- silver --------------------------------------------------------------------


@query("normalize_columns")
def normalized_columns(lake: Lake) -> DataFrame:
    return normalize_columns(lake.bronze("categoria"))


@query("silver_targets")
def silver_targets(lake: Lake) -> DataFrame:
    return lake.silver("meta")


@query("silver_categories")
def silver_categories(lake: Lake) -> DataFrame:
    return lake.silver("categoria")


@query("silver_payables")
def silver_payables(lake: Lake) -> DataFrame:
    return lake.silver("conta_pagar")


@query("silver_receivables")
def silver_receivables(lake: Lake) -> DataFrame:
    return lake.silver("conta_receber")


@query("silver_customers")
def silver_customers(lake: Lake) -> DataFrame:
    return lake.silver("cliente")


@query("silver_rates")
def silver_rates(lake: Lake) -> DataFrame:
    return lake.silver("exchange_rates")


@query("dedup_targets")
def dedup_targets(lake: Lake) -> DataFrame:
    return silver.dedup_targets(lake.bronze("meta"))


@query("dedup_categories")
def dedup_categories(lake: Lake) -> DataFrame:
    return silver.dedup_categories(lake.bronze("categoria"))


@query("dedup_payables")
def dedup_payables(lake: Lake) -> DataFrame:
    return silver.dedup_accounts(lake.bronze("conta_pagar"))


@query("dedup_receivables")
def dedup_receivables(lake: Lake) -> DataFrame:
    return silver.dedup_accounts(lake.bronze("conta_receber"))


@query("dedup_customers")
def dedup_customers(lake: Lake) -> DataFrame:
    return silver.dedup_customers(lake.bronze("cliente"))


@query("dedup_rates")
def dedup_rates(lake: Lake) -> DataFrame:
    return lake.silver("exchange_rates").select("currency", "date", "average_rate")


@query("column_completeness")
def column_completeness(lake: Lake) -> DataFrame:
    tables = lake.each(lambda n: quality.column_completeness(lake.silver(n, lineage=True)).withColumn("tabela", F.lit(n)), inputs.INPUTS)
    return quality.union_all(tables)


@query("quality_score")
def quality_scores(lake: Lake) -> DataFrame:
    scores = lake.each(
        lambda n: quality.quality_score(lake.silver(n, lineage=True)).select(F.lit(n).alias("tabela"), "score"), inputs.INPUTS
    )
    return quality.union_all(scores)


@query("silver_finalized")
def silver_finalized(lake: Lake) -> DataFrame:
    """Receivables with the run time and the score on every row."""
    done = silver.finalize(lake.silver("conta_receber", lineage=True), inputs.RUN_TS)
    return done.select("id_conta", "_source", "_ingestion_date", "_transformation_date", "_data_quality_score")


# ---- gold lookups and conversion -----------------------------------------------


@query("country_normalize")
def country_normalize(lake: Lake) -> DataFrame:
    named = with_country(lake.bronze("cliente"), "pais_cliente", "pais_normalizado")
    return named.select("id_cliente", "nome_cliente", "pais_normalizado")


@query("country_currency")
def country_currencies(lake: Lake) -> DataFrame:
    named = with_country(lake.silver("cliente"), "pais_cliente", "_country")
    return named.select("id_cliente", country_currency("_country").alias("currency")).select(
        "id_cliente", "currency", currency_name("currency").alias("moeda"), currency_country("currency").alias("pais_moeda")
    )


def _receivable_stream(lake: Lake) -> DataFrame:
    people = fx.settle_currency(
        gold.customer_lookup(lake.stored("cliente")).withColumn("currency", country_currency("pais_cliente")),
        fx.rate_history(lake.stored("exchange_rates")),
        "currency",
    )
    rows = gold.common_columns(lake.silver("conta_receber"), "receber")
    return gold.receivables_with_customer(rows, people, lake.hot_customers())


@query("receivables_customer")
def receivables_customer(lake: Lake) -> DataFrame:
    return _receivable_stream(lake).select("id_conta", "id_cliente", "nome_cliente", "pais_cliente", "currency")


@query("fx_asof")
def fx_asof(lake: Lake) -> DataFrame:
    rows = _receivable_stream(lake).select(
        "id_conta", "currency", "data_referencia", "first_quote", "last_quote"
    )
    dated = rows.filter(F.col("data_referencia").isNotNull())
    return fx.resolve_rates(dated, fx.rate_history(lake.stored("exchange_rates")), "currency", "data_referencia", span=True)


@query("fx_asof_large")
def fx_asof_large(lake: Lake) -> DataFrame:
    """Each purchase with the value of the user's last view, else of the first view."""
    kind = F.col("event_type")
    return fx.asof_within(
        lake.table("events"), "user_id", "ts", kind == "purchase", kind == "view", "value", ["event_id", "user_id"], "view_value"
    )


@query("fx_unavailable")
def fx_unavailable(lake: Lake) -> DataFrame:
    """Customers whose currency was never quoted and is treated as the home currency."""
    wanted = gold.customer_lookup(lake.stored("cliente")).withColumn("moeda_pais", country_currency("pais_cliente"))
    settled = fx.settle_currency(
        wanted.withColumn("currency", F.col("moeda_pais")), fx.rate_history(lake.stored("exchange_rates")), "currency"
    )
    return settled.filter("moeda_pais <> currency").select("id_cliente", "pais_cliente", "moeda_pais", "currency")


@query("rejected_transactions")
def rejected_transactions(lake: Lake) -> DataFrame:
    return gold.rejected(
        lake.stored("conta_pagar"), lake.stored("conta_receber"), lake.stored("categoria"), lake.stored("date_dim")
    )


@query("transactions_enriched")
def transactions_enriched(lake: Lake) -> DataFrame:
    """All columns, the dimension keys among them."""
    return lake.enriched(lake.dims())


# ---- star schema ---------------------------------------------------------------


@query("date_range")
def date_range(lake: Lake) -> DataFrame:
    return gold.date_range(lake.silver("conta_pagar"), lake.silver("conta_receber"))


@query("date_dim")
def date_dim(lake: Lake) -> DataFrame:
    """Two loads: the receivable days first, then the days only payables reach."""
    receivables = lake.stored("conta_receber")
    receivable_days = gold.date_range(receivables, receivables)
    both = gold.date_range(lake.silver("conta_pagar"), receivables)
    return gold.date_dim(both, gold.date_dim(receivable_days))


@query("currency_dim")
def currency_dim(lake: Lake) -> DataFrame:
    """Two loads: the quoted currencies first, then those customer countries add."""
    none = lake.stored("cliente").select(F.lit("Brasil").alias("pais_cliente"))
    return gold.currency_dim(lake.stored("exchange_rates"), lake.stored("cliente"), gold.currency_dim(lake.stored("exchange_rates"), none))


@query("customer_dim")
def customer_dim(lake: Lake) -> DataFrame:
    return lake.customer_dim()


@query("category_dim")
def category_dim(lake: Lake) -> DataFrame:
    return lake.category_dim()


@query("account_dim")
def account_dim(lake: Lake) -> DataFrame:
    """Two loads: accounts of the income categories first."""
    income = gold.account_dim(lake.stored("category_dim").filter("description = 'receita'"))
    return gold.account_dim(lake.stored("category_dim"), income)


@query("transaction_fact")
def transaction_fact(lake: Lake) -> DataFrame:
    return lake.transaction_fact()


@query("exchange_rate_fact")
def exchange_rate_fact(lake: Lake) -> DataFrame:
    return lake.exchange_rate_fact()


@query("customer_clusters")
def customer_clusters(lake: Lake) -> DataFrame:
    lake.each(lake.stored, ("early_customer_dim", "customer_summary"))
    return gold.write_back_clusters(lake.customer_dim(), lake.segments()).select(
        "customer_id", "customer_code", "customer_name", "country", "ml_cluster"
    )


@query("check_unique")
def check_unique(lake: Lake) -> DataFrame:
    """Uniqueness over the raw keys (where copies exist) and the dimension codes (where none may)."""
    star = _star(lake)
    raw = [(lake.bronze(n), f"{n}_raw", ["id_conta"]) for n in ("conta_pagar", "conta_receber")]
    checks = raw + [(star[t], t, keys) for t, keys in gold.UNIQUE_KEYS.items()]
    return quality.union_all([quality.duplicate_keys(*c) for c in checks])


@query("check_foreign_keys")
def check_foreign_keys(lake: Lake) -> DataFrame:
    """Orphans in the raw receivables (closed customers) and none in the facts."""
    facts, rates = lake.stored("transaction_fact"), lake.stored("exchange_rate_fact")
    registry = lake.bronze("cliente")
    checks = [
        (lake.bronze("conta_receber"), registry, "conta_receber_raw", "id_cliente", "id_cliente"),
        (lake.stored("account_dim"), lake.stored("category_dim"), "account_dim", "category_id", "category_id"),
        (facts, lake.stored("customer_dim"), "transaction_fact", "customer_id", "customer_id"),
        (facts, lake.stored("account_dim"), "transaction_fact", "account_id", "account_id"),
        (facts, lake.stored("currency_dim"), "transaction_fact", "currency_id", "currency_id"),
        (facts, lake.stored("date_dim"), "transaction_fact", "date_id", "date_id"),
        (rates, lake.stored("currency_dim"), "exchange_rate_fact", "currency_id", "currency_id"),
    ]
    return quality.union_all([quality.orphan_rows(*c) for c in checks])


@query("check_not_null")
def check_not_null(lake: Lake) -> DataFrame:
    """Required columns, text lengths and number precisions of every column of the seven star tables."""
    star = _star(lake)
    return quality.union_all([quality.limit_violations(star[t], t, limit) for t, limit in gold.LIMITS.items()])


# ---- summaries -----------------------------------------------------------------


@query("customer_summary")
def customer_summary(lake: Lake) -> DataFrame:
    return rounded(lake.customer_summary(), 2, "desvio_padrao_brl")


@query("late_pct")
def late_pct(lake: Lake) -> DataFrame:
    return lake.customer_summary().select("id_cliente", "percentual_atraso")


@query("paid_pct")
def paid_pct(lake: Lake) -> DataFrame:
    return lake.customer_summary().select("id_cliente", "percentual_pago")


@query("category_summary")
def category_summary(lake: Lake) -> DataFrame:
    return gold.category_summary(lake.enriched())


@query("monthly_summary")
def monthly_summary(lake: Lake) -> DataFrame:
    return gold.monthly_summary(lake.enriched())


# ---- insights ------------------------------------------------------------------


@query("table_row_counts")
def table_row_counts(lake: Lake) -> DataFrame:
    return insights.table_row_counts(_star(lake, "customer_summary", "cliente", "categoria", "exchange_rates"))


@query("table_columns")
def table_columns(lake: Lake) -> DataFrame:
    """Every column of the seven star tables."""
    return insights.table_columns(_star(lake))


@query("revenue_by_account_type")
def revenue_by_account_type(lake: Lake) -> DataFrame:
    return insights.revenue_by_account_type(lake.enriched())


@query("revenue_by_currency")
def revenue_by_currency(lake: Lake) -> DataFrame:
    return insights.revenue_by_currency(lake.enriched())


@query("monthly_trend")
def monthly_trend(lake: Lake) -> DataFrame:
    return insights.monthly_trend(lake.enriched())


@query("top_categories")
def top_categories(lake: Lake) -> DataFrame:
    return insights.top_categories(gold.category_summary(lake.enriched()))


@query("top_customers")
def top_customers(lake: Lake) -> DataFrame:
    return insights.top_customers(lake.customer_summary())


@query("avg_rate_by_currency")
def avg_rate_by_currency(lake: Lake) -> DataFrame:
    return insights.avg_rate_by_currency(lake.silver("exchange_rates"))


@query("pareto_curve")
def pareto_curve(lake: Lake) -> DataFrame:
    return insights.pareto_curve(lake.stored("customer_summary"))


@query("vip_split")
def vip_split(lake: Lake) -> DataFrame:
    return insights.vip_split(lake.stored("customer_summary"))


@query("clusters_size_revenue")
def clusters_size_revenue(lake: Lake) -> DataFrame:
    return insights.clusters_size_revenue(lake.segments())


@query("country_cluster_matrix")
def country_cluster_matrix(lake: Lake) -> DataFrame:
    return insights.country_cluster_matrix(lake.segments(), LABELS)


@query("cluster_distribution")
def cluster_distribution(lake: Lake) -> DataFrame:
    return insights.cluster_distribution(lake.segments())


@query("cluster_rankings")
def cluster_rankings(lake: Lake) -> DataFrame:
    return insights.cluster_rankings(lake.segments())


@query("cluster_ticket")
def cluster_ticket(lake: Lake) -> DataFrame:
    return rounded(insights.cluster_ticket(lake.segments()), 2, "receita_media_brl", "ticket_medio_brl")


@query("cluster_efficiency")
def cluster_efficiency(lake: Lake) -> DataFrame:
    return insights.cluster_efficiency(lake.segments())


@query("purchase_stability")
def purchase_stability(lake: Lake) -> DataFrame:
    return rounded(insights.purchase_stability(lake.stored("segments")), 6, "q1", "mediana", "q3")


@query("country_currency_mix")
def country_currency_mix(lake: Lake) -> DataFrame:
    return insights.country_currency_mix(lake.segments())


@query("cluster_profile")
def cluster_profile(lake: Lake) -> DataFrame:
    means = ("ticket_medio_brl", "quantidade_transacoes", "percentual_atraso")
    return rounded(insights.cluster_profile(lake.segments()), 2, *means)


@query("cluster_profile_full")
def cluster_profile_full(lake: Lake) -> DataFrame:
    full = insights.cluster_profile_full(lake.stored("segments"))
    full = rounded(full, 2, "ticket_medio_brl", "quantidade_transacoes", "percentual_atraso", "receita_media_brl")
    return rounded(full, 6, "q1", "mediana", "q3")


# ---- segmentation --------------------------------------------------------------


@query("segment_features")
def segment_features(lake: Lake) -> DataFrame:
    return rounded(segmentation.prepare_features(lake.customer_summary()), 2, "desvio_padrao_brl")


@query("scaled_features")
def scaled_features(lake: Lake) -> DataFrame:
    scaled = cm.scale_features(segmentation.prepare_features(lake.stored("customer_summary")), segmentation.FEATURES)
    return rounded(scaled.select("id_cliente", *segmentation.FEATURES), 6, *segmentation.FEATURES)


@query("silhouette_exact")
def silhouette_exact(lake: Lake) -> DataFrame:
    return rounded(cm.silhouette_points(lake.points()), 6, "silhouette")


@query("silhouette_squared")
def silhouette_squared(lake: Lake) -> DataFrame:
    """The default metric of the segmentation, on fixed labels."""
    score = cm.silhouette_score(lake.points())
    return lake.spark.createDataFrame([(round(score, 6),)], "silhouette_score double")


@query("davies_bouldin")
def davies_bouldin(lake: Lake) -> DataFrame:
    return rounded(cm.davies_bouldin(lake.points()), 6, "davies_bouldin_index")


@query("calinski_harabasz")
def calinski_harabasz(lake: Lake) -> DataFrame:
    return rounded(cm.calinski_harabasz(lake.points()), 6, "calinski_harabasz_index")


@query("inertia")
def inertia(lake: Lake) -> DataFrame:
    return rounded(cm.inertia(lake.points()), 4, "inertia")


@query("single_cluster")
def single_cluster(lake: Lake) -> DataFrame:
    """The fallback of one cluster, as a largest k of 1 asks for."""
    result = segmentation.run_segmentation(lake.stored("customer_summary"), segmentation.Settings(max_k=1))
    return result.segments.select("id_cliente", "cluster")


@query("customer_segments")
def customer_segments(lake: Lake) -> DataFrame:
    return rounded(segmentation.run_segmentation(lake.stored("customer_summary")).segments, 2, "desvio_padrao_brl")


@query("select_k")
def select_k(lake: Lake) -> DataFrame:
    k = segmentation.select_best_k(segmentation.prepare_features(lake.stored("customer_summary")))
    return lake.spark.createDataFrame([(k,)], "k int")


@query("k_analysis")
def k_analysis(lake: Lake) -> DataFrame:
    table = segmentation.run_segmentation(lake.stored("customer_summary")).analysis_table(lake.spark)
    return rounded(rounded(table, 6, "silhouette_score"), 4, "inercia")


@query("cluster_metrics")
def cluster_metrics(lake: Lake) -> DataFrame:
    """Metrics of a preset k, skipping the search."""
    preset = segmentation.Settings(n_clusters=3)
    return rounded(segmentation.run_segmentation(lake.stored("customer_summary"), preset).metrics_table(lake.spark), 4, "valor")


@query("pca_2d")
def pca_2d(lake: Lake) -> DataFrame:
    projected = segmentation.pca_projection(segmentation.prepare_features(lake.stored("customer_summary")))
    return rounded(projected, 6, "pc1", "pc2")
