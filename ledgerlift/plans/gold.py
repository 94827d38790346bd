"""Star schema, transaction enrichment and the summary tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ledgerlift.functions.columns import MONEY, RATE, instant, percent_equal, safe_text, stripped
from ledgerlift.functions.country import (
    HOME_COUNTRY,
    HOME_CURRENCY,
    country_currency,
    currency_country,
    currency_name,
    with_country,
)
from ledgerlift.operators.dedup import keep_greatest
from ledgerlift.operators.fx import rate_history, resolve_rates, settle_currency
from ledgerlift.operators.keys import dense_numbers, fact_numbers, next_key, small_numbers
from ledgerlift.operators.quality import union_all
from ledgerlift.operators.sizing import broadcast_if_small, spread_left_join

# Account types and English day names.
ACCOUNT_TYPES = ["PAGAR", "RECEBER"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
ENRICHED = [
    "id_conta",
    "tipo_conta",
    "id_cliente",
    "nome_cliente",
    "pais_cliente",
    "codigo_categoria",
    "nome_categoria",
    "status_conta",
    "currency",
    "taxa_cambio",
    "valor_original",
    "valor_brl",
    "data_referencia",
]
KEYS = ["customer_dim_id", "account_id", "currency_id", "date_id"]
# Enriched columns that the id of the customer or the code of the category decides, and that no fact holds.
DECIDED = ["nome_cliente", "pais_cliente", "nome_categoria", "currency"]
# Unique keys, foreign keys and limits (nullable, longest text) of the star schema.
UNIQUE_KEYS = {
    "currency_dim": ["currency_code"],
    "customer_dim": ["customer_code"],
    "category_dim": ["category_code"],
    "account_dim": ["account_code"],
    "date_dim": ["date"],
    "exchange_rate_fact": ["currency_id", "date"],
    "transaction_fact": ["transaction_id"],
}
FOREIGN_KEYS = [
    ("account_dim", "category_id", "category_dim"),
    ("transaction_fact", "customer_id", "customer_dim"),
    ("transaction_fact", "account_id", "account_dim"),
    ("transaction_fact", "currency_id", "currency_dim"),
    ("transaction_fact", "date_id", "date_dim"),
    ("exchange_rate_fact", "currency_id", "currency_dim"),
]
REQUIRED, OPTIONAL = (False, None, None), (True, None, None)
MONEY_LIMIT, RATE_LIMIT = (False, None, (18, 2)), (False, None, (10, 4))


def _text(longest: int, nullable: bool = False):
    return (nullable, longest, None)


LIMITS = {
    "currency_dim": {"currency_id": REQUIRED, "currency_code": _text(3), "currency_name": _text(100), "country": _text(100)},
    "customer_dim": {
        "customer_id": REQUIRED, "customer_code": _text(50), "customer_name": _text(150), "country": _text(100), "created_at": REQUIRED,
        "ml_cluster": OPTIONAL,
    },
    "category_dim": {"category_id": REQUIRED, "category_code": _text(50), "category_name": _text(150), "description": _text(500, True)},
    "account_dim": {"account_id": REQUIRED, "account_code": _text(80), "account_type": _text(50), "category_id": REQUIRED},
    "date_dim": {
        "date_id": REQUIRED, "date": REQUIRED, "year": REQUIRED, "month": REQUIRED, "day": REQUIRED, "quarter": REQUIRED, "week": REQUIRED,
        "day_of_week": _text(20), "is_weekend": REQUIRED,
    },
    "transaction_fact": {
        "transaction_id": REQUIRED, "customer_id": OPTIONAL, "account_id": REQUIRED, "currency_id": REQUIRED, "date_id": REQUIRED,
        "amount_original": MONEY_LIMIT, "amount_brl": MONEY_LIMIT, "exchange_rate": RATE_LIMIT, "transaction_date": REQUIRED, "created_at": REQUIRED,
    },
    "exchange_rate_fact": {
        "rate_id": REQUIRED, "currency_id": REQUIRED, "date": REQUIRED, "buy_rate": (True, None, (10, 4)), "sell_rate": (True, None, (10, 4)),
        "average_rate": RATE_LIMIT, "created_at": REQUIRED,
    },
}
# The group keys of the summaries, which also order their exports.
SUMMARY_KEYS = {
    "customer_summary": ["id_cliente", "nome_cliente", "pais_cliente", "currency"],
    "category_summary": ["tipo_conta", "codigo_categoria", "nome_categoria"],
    "monthly_summary": ["ano_mes", "tipo_conta"],
}
# Days outside are no booking days; their rows are reported by ``rejected``.
DECLARED_SPAN = (date(1900, 1, 1), date(2199, 12, 31))


# ---- lookups -------------------------------------------------------------------


def customer_lookup(customers: DataFrame) -> DataFrame:
    """One row per trimmed customer id: name and normalised country. Null ids are no customer."""
    rows = with_country(customers.filter("id_cliente IS NOT NULL"), "pais_cliente", "_country").selectExpr(
        f"{stripped('id_cliente')} AS id_cliente",
        f"{safe_text('nome_cliente')} AS nome_cliente",
        "_country AS pais_cliente",
    )
    return keep_greatest(rows, ["id_cliente"])


def category_lookup(categories: DataFrame) -> DataFrame:
    """One row per trimmed category code; of padded duplicates the greatest (name, type) wins."""
    rows = categories.selectExpr(
        *[f"{safe_text(c)} AS {c}" for c in ("codigo_categoria", "nome_categoria", "tipo_categoria")]
    )
    return keep_greatest(rows, ["codigo_categoria"])


def customer_currencies(lookup: DataFrame, history: DataFrame) -> DataFrame:
    """Resolve the currency and its quoted span once per customer, not once per transaction."""
    priced = lookup.withColumn("currency", country_currency("pais_cliente"))
    return settle_currency(priced, history, "currency")


# ---- dimensions ----------------------------------------------------------------


def used_currencies(rates: DataFrame, customers: DataFrame) -> DataFrame:
    """Quoted currencies, the home currency and every currency a customer country maps to."""
    home = rates.sparkSession.range(1).select(F.lit(HOME_CURRENCY).alias("currency_code"))
    quoted = rates.filter(F.col("currency").isNotNull()).select(F.upper(F.trim("currency")).alias("currency_code"))
    by_country = with_country(customers, "pais_cliente", "_country").select(
        country_currency("_country").alias("currency_code")
    )
    return union_all([home, quoted.distinct(), by_country.distinct()]).distinct()


def currency_dim(rates: DataFrame, customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Insert-only; new codes are numbered in code order after the largest key in use."""
    codes = used_currencies(rates, customers)
    if existing is not None:
        codes = codes.join(F.broadcast(existing.select("currency_code")), "currency_code", "left_anti")
    new = small_numbers(codes, ["currency_code"], "currency_id", next_key(existing, "currency_id")).select(
        "currency_id",
        "currency_code",
        currency_name("currency_code").alias("currency_name"),
        currency_country("currency_code").alias("country"),
    )
    return new if existing is None else existing.select(*new.columns).unionByName(new)


def _upsert(
    existing: DataFrame | None, incoming: DataFrame, key: str, code: str, changing: list[str], kept: dict[str, Column]
) -> DataFrame:
    """New snapshot of a dimension with unique codes.

    Known codes keep their key and the ``kept`` columns and take the incoming
    ``changing`` columns; new codes are numbered after the largest key in use;
    codes missing from the batch stay as they are.
    """
    columns = [key, code, *changing, *kept]
    if existing is None:
        return dense_numbers(incoming.select(code, *changing), code, key).withColumns(kept).select(*columns)
    old = existing.select(*columns)
    new = incoming.select(code, *[F.col(c).alias(f"_new_{c}") for c in changing], F.lit(True).alias("_new"))
    updated = old.join(new, code, "left").select(
        key, code, *[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in changing], *kept
    )
    added = incoming.select(code, *changing).join(old.select(code), code, "left_anti")
    numbered = dense_numbers(added, code, key, next_key(existing, key)).withColumns(kept).select(*columns)
    return updated.unionByName(numbered)


def customer_dim(customers: DataFrame, run_ts: datetime, existing: DataFrame | None = None) -> DataFrame:
    """Upsert of name and country; created_at and ml_cluster survive."""
    incoming = customer_lookup(customers).select(
        F.col("id_cliente").alias("customer_code"),
        F.col("nome_cliente").alias("customer_name"),
        F.col("pais_cliente").alias("country"),
    )
    kept = {"created_at": instant(run_ts), "ml_cluster": F.lit(None).cast("int")}
    return _upsert(existing, incoming, "customer_id", "customer_code", ["customer_name", "country"], kept)


def category_dim(categories: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Upsert of name and description (the category type)."""
    incoming = category_lookup(categories).select(
        F.col("codigo_categoria").alias("category_code"),
        F.col("nome_categoria").alias("category_name"),
        F.col("tipo_categoria").alias("description"),
    )
    return _upsert(existing, incoming, "category_id", "category_code", ["category_name", "description"], {})


def account_dim(categories: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Both account types for every category of ``category_dim``; insert-only."""
    kind = F.explode(F.array(*[F.lit(t) for t in ACCOUNT_TYPES])).alias("account_type")
    wanted = categories.select(kind, "category_code", "category_id").select(
        F.concat_ws("|", "account_type", "category_code").alias("account_code"), "account_type", "category_id"
    )
    if existing is None:
        new = wanted
    else:
        new = wanted.join(existing.select("account_code"), "account_code", "left_anti")
    numbered = dense_numbers(new, "account_code", "account_id", next_key(existing, "account_id")).select(
        "account_id", "account_code", "account_type", "category_id"
    )
    return numbered if existing is None else existing.select(*numbered.columns).unionByName(numbered)


def date_range(payables: DataFrame, receivables: DataFrame, declared: tuple[date, date] = DECLARED_SPAN) -> DataFrame:
    """One row (start, end) over the due and payment dates of both tables inside ``declared``; today when there is none."""

    def span(df: DataFrame) -> DataFrame:
        days = {c: F.when(F.col(c).between(*map(F.lit, declared)), F.col(c)) for c in ("data_vencimento", "data_pagamento")}
        low = F.least(*[F.min(d) for d in days.values()])
        high = F.greatest(*[F.max(d) for d in days.values()])
        return df.agg(low.alias("start"), high.alias("end"))

    return union_all([span(payables), span(receivables)]).agg(
        F.coalesce(F.min("start"), F.current_date()).alias("start"),
        F.coalesce(F.max("end"), F.current_date()).alias("end"),
    )


def date_dim(span: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per calendar day of ``span`` that is not there yet.

    A key is the day's distance from the day before the first one of the first load, so it
    needs no numbering and no window; days before that day get keys of 0 and below.
    """
    days = span.select(F.explode(F.sequence("start", "end")).alias("date"), F.col("start").alias("_first"))
    if existing is not None:
        days = days.join(F.broadcast(existing.select("date")), "date", "left_anti")
        anchor = existing.agg(F.min(F.date_sub("date", (F.col("date_id") - 1).cast("int")))).scalar()
        days = days.withColumn("_first", F.coalesce(anchor, "_first"))
    names = ", ".join(f"'{n}'" for n in DAY_NAMES)
    new = days.selectExpr(
        "cast(datediff(date, _first) + 1 AS bigint) AS date_id",
        "date",
        "year(date) AS year",
        "month(date) AS month",
        "day(date) AS day",
        "quarter(date) AS quarter",
        "weekofyear(date) AS week",
        f"element_at(array({names}), weekday(date) + 1) AS day_of_week",
        "if(weekday(date) >= 5, 1, 0) AS is_weekend",
    )
    return new if existing is None else existing.select(*new.columns).unionByName(new)


# ---- transactions --------------------------------------------------------------


# Beyond this an amount, converted, no longer fits its column.
AMOUNT_LIMIT = "1e13"
# Payment day, else due day.
REFERENCE_DAY = "coalesce(data_pagamento, data_vencimento)"


def common_columns(df: DataFrame, kind: str) -> DataFrame:
    """The columns both account tables share, with gold types."""
    return df.selectExpr(
        f"{safe_text('id_conta')} AS id_conta",
        f"'{kind}' AS tipo_conta",
        (stripped("id_cliente") if kind == "receber" else "cast(NULL AS string)") + " AS _client",
        f"{safe_text('codigo_categoria')} AS codigo_categoria",
        f"{safe_text('status_conta')} AS status_conta",
        f"try_cast(valor_conta AS {MONEY}) AS valor_original",
        f"{REFERENCE_DAY} AS data_referencia",
        f"coalesce(abs(valor_conta) >= {AMOUNT_LIMIT}, false) AS _too_large",
    )


def receivables_with_customer(
    receivables: DataFrame, customers: DataFrame, hot_customers: DataFrame | None = None
) -> DataFrame:
    """Receivables with name, country, currency and quoted span of a known customer.

    ``customers`` has one row per ``id_cliente``. Unknown customers stay, as home
    country and currency without an id.
    """
    fields = [c for c in customers.columns if c != "id_cliente"]
    lookup = customers.select(F.col("id_cliente").alias("_client"), F.col("id_cliente").alias("_found"), *fields)
    hot = hot_customers.select(F.col("id_cliente").alias("_client")) if hot_customers is not None else None
    joined = spread_left_join(receivables, lookup, "_client", "id_conta", hot)
    home = {"pais_cliente": HOME_COUNTRY, "currency": HOME_CURRENCY}
    return joined.selectExpr(
        *[c for c in receivables.columns if c != "_client"],
        "_found AS id_cliente",
        *[f"coalesce({c}, '{home[c]}') AS {c}" if c in home else c for c in fields],
    )


def enrich(
    payables: DataFrame,
    receivables: DataFrame,
    customers: DataFrame,
    categories: DataFrame,
    rates: DataFrame,
    hot_customers: DataFrame | None = None,
    dims: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Payables and receivables as one stream, priced in the home currency.

    Rows without a reference day or known category and amounts out of range are
    left out (``rejected`` lists them). With ``dims`` (currency, customer, account, date) the rows also
    carry the dimension keys and must hit the calendar.

    Shuffles: only the receivable-customer join, spread for hot customers.
    Category, calendar and rate lookups are broadcast (measured or bounded).
    """
    history = rate_history(rates)
    people = customer_currencies(customer_lookup(customers), history)
    if dims is not None:
        people = people.join(
            dims["customer"].select(
                F.col("customer_code").alias("id_cliente"), F.col("customer_id").alias("customer_dim_id")
            ),
            "id_cliente",
            "left",
        )
    home = {"pais_cliente": HOME_COUNTRY, "currency": HOME_CURRENCY}
    outgoing = common_columns(payables, "pagar").drop("_client").selectExpr(
        "*",
        *[
            f"'{home[f.name]}' AS {f.name}" if f.name in home else f"cast(NULL AS {f.dataType.simpleString()}) AS {f.name}"
            for f in people.schema
        ],
    )
    incoming = receivables_with_customer(common_columns(receivables, "receber"), people, hot_customers)

    lookup, small = broadcast_if_small(_account_lookup(categories, dims))
    rows = union_all([_with_account(side, lookup, small, dims is not None) for side in (outgoing, incoming)])
    rows = rows.filter(F.col("data_referencia").isNotNull() & ~F.col("_too_large")).drop("_too_large")
    if dims is not None:
        rows = rows.join(
            F.broadcast(dims["date"].select(F.col("date").alias("data_referencia"), "date_id")), "data_referencia"
        ).join(
            F.broadcast(dims["currency"].select(F.col("currency_code").alias("currency"), "currency_id")),
            "currency",
            "left",
        )
    priced = resolve_rates(rows, history, "currency", "data_referencia", span=True)
    brl = F.round(F.col("valor_original") * F.col("taxa_cambio"), 2).cast(MONEY)
    return priced.withColumn("valor_brl", brl).select(*ENRICHED, *(KEYS if dims is not None else []))


def _account_lookup(categories: DataFrame, dims: dict[str, DataFrame] | None) -> DataFrame:
    """Category names by code; with dimensions by (code, account type) and with the account key."""
    names = category_lookup(categories).select("codigo_categoria", "nome_categoria")
    if dims is None:
        return names
    accounts = dims["account"].select(
        F.lower("account_type").alias("tipo_conta"),
        F.expr("substr(account_code, instr(account_code, '|') + 1)").alias("codigo_categoria"),
        "account_id",
    )
    return names.join(accounts, "codigo_categoria")


def _with_account(rows: DataFrame, lookup: DataFrame, small: bool, typed: bool) -> DataFrame:
    """Inner join on the account key (type and category code)."""
    on = ["codigo_categoria", "tipo_conta"] if typed else ["codigo_categoria"]
    if small:
        return rows.join(lookup, on)
    # A catalogue beyond the broadcast limit: shuffle join on one text key, hot keys spread.
    code = F.concat_ws("|", *reversed(on))
    keyed = lookup.select(code.alias("_code"), *[c for c in lookup.columns if c not in on], F.lit(True).alias("_hit"))
    joined = spread_left_join(rows.withColumn("_code", code), keyed, "_code", "id_conta")
    return joined.filter("_hit").drop("_hit", "_code")


def rejected(
    payables: DataFrame, receivables: DataFrame, categories: DataFrame, calendar: DataFrame | None = None
) -> DataFrame:
    """Rows ``enrich`` leaves out, with the first reason that applies."""
    codes, small = broadcast_if_small(category_lookup(categories).select("codigo_categoria", F.lit(True).alias("_known")))
    rows = union_all([common_columns(payables, "pagar"), common_columns(receivables, "receber")])
    rows = rows.select("id_conta", "tipo_conta", "codigo_categoria", "data_referencia", "_too_large")
    if small:
        rows = rows.join(codes, "codigo_categoria", "left")
    else:
        rows = spread_left_join(rows, codes, "codigo_categoria", "id_conta")
    reason = F.when(F.col("_known").isNull(), "unknown account").when(F.col("data_referencia").isNull(), "no date")
    reason = reason.when(F.col("_too_large"), "amount out of range")
    if calendar is not None:
        rows = rows.join(
            F.broadcast(calendar.select(F.col("date").alias("data_referencia"), "date_id")), "data_referencia", "left"
        )
        reason = reason.when(F.col("date_id").isNull(), "outside the calendar")
    return (
        rows.withColumn("motivo", reason)
        .filter(F.col("motivo").isNotNull())
        .select("id_conta", "tipo_conta", "codigo_categoria", "data_referencia", "motivo")
    )


# ---- facts ---------------------------------------------------------------------


def transaction_fact(enriched: DataFrame, run_ts: datetime) -> DataFrame:
    """Facts of enriched rows that carry the dimension keys, all months or some; keys are numbered per month.

    Rows of one account id are numbered in the order of their other columns. The ``DECIDED``
    ones follow from an earlier column, so they are left out of the shuffle.
    """
    since = (F.year("data_referencia") - DECLARED_SPAN[0].year) * 12 + F.month("data_referencia") - 1
    rows = enriched.select(*[c for c in ENRICHED if c not in DECIDED], *KEYS)
    numbered = fact_numbers(rows, ["tipo_conta", "id_conta"], "transaction_id", since)
    return numbered.select(
        "transaction_id",
        F.col("customer_dim_id").alias("customer_id"),
        "account_id",
        "currency_id",
        "date_id",
        F.col("valor_original").alias("amount_original"),
        F.col("valor_brl").alias("amount_brl"),
        F.col("taxa_cambio").alias("exchange_rate"),
        F.col("data_referencia").cast("timestamp").alias("transaction_date"),
        instant(run_ts).alias("created_at"),
    )


def exchange_rate_fact(rates: DataFrame, currencies: DataFrame, run_ts: datetime) -> DataFrame:
    """Full refresh; quotes in a currency outside the dimension are skipped."""
    typed = rates.filter(F.col("date").isNotNull()).select(
        F.upper(F.trim("currency")).alias("currency_code"),
        "date",
        *[F.col(c).try_cast("decimal(18,6)").try_cast(RATE).alias(c) for c in ("buy_rate", "sell_rate", "average_rate")],
    )
    known = keep_greatest(typed, ["currency_code", "date"]).join(
        F.broadcast(currencies.select("currency_code", "currency_id")), "currency_code"
    )
    # numbered within each currency and shifted by the quotes of the earlier ones
    before = W.orderBy("currency_id").rowsBetween(W.unboundedPreceding, -1)
    shifts = known.groupBy("currency_id").count().select(
        "currency_id", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")
    )
    place = F.row_number().over(W.partitionBy("currency_id").orderBy("date"))
    numbered = known.join(shifts, "currency_id").withColumn("rate_id", (F.col("_shift") + place).cast("bigint"))
    return numbered.select(
        "rate_id",
        "currency_id",
        "date",
        "buy_rate",
        "sell_rate",
        "average_rate",
        instant(run_ts).alias("created_at"),
    )


def write_back_clusters(customers: DataFrame, labels: DataFrame) -> DataFrame:
    """Customer dimension with new labels where the code matches; other columns untouched."""
    fresh = labels.select(
        F.expr(stripped("id_cliente")).alias("customer_code"), F.col("cluster").cast("int").alias("_cluster")
    )
    fresh = keep_greatest(fresh, ["customer_code"])
    return (
        customers.join(fresh, "customer_code", "left")
        .withColumn("ml_cluster", F.coalesce("_cluster", "ml_cluster"))
        .select(*customers.columns)
    )


# ---- summaries -----------------------------------------------------------------


def require_transactions(enriched: DataFrame) -> DataFrame:
    if enriched.isEmpty():
        raise ValueError("no enriched transaction to consolidate")
    return enriched


def _total(name: str) -> str:
    """Sum where no amount counts as zero, even in a group without any."""
    return f"coalesce(sum({name}), cast(0 AS {MONEY}))"


def customer_summary(enriched: DataFrame) -> DataFrame:
    """Receivables of known customers, per customer, country and currency."""
    keys = ["id_cliente", "nome_cliente", "pais_cliente", "currency"]
    measures = {
        "total_receita_original": _total("valor_original"),
        "total_receita_brl": _total("valor_brl"),
        "ticket_medio_brl": "cast(sum(valor_brl) AS double) / nullif(count(valor_brl), 0)",
        "quantidade_transacoes": "count(id_conta)",
        "desvio_padrao_brl": "coalesce(stddev_samp(cast(valor_brl AS double)), 0D)",
        "percentual_atraso": percent_equal("status_conta", "atrasado"),
        "percentual_pago": percent_equal("status_conta", "pago"),
        "primeira_transacao": "min(data_referencia)",
        "ultima_transacao": "max(data_referencia)",
        "dias_ativos": "coalesce(datediff(max(data_referencia), min(data_referencia)), 0)",
    }
    base = enriched.filter("tipo_conta = 'receber'").dropna(subset=keys)
    return base.groupBy(*keys).agg(*[F.expr(e).alias(n) for n, e in measures.items()])


def _volume(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.expr(_total("valor_original")).alias("total_original"),
        F.expr(_total("valor_brl")).alias("total_brl"),
        F.count("id_conta").alias("quantidade_transacoes"),
    )


def category_summary(enriched: DataFrame) -> DataFrame:
    return _volume(enriched, "tipo_conta", "codigo_categoria", "nome_categoria")


def monthly_summary(enriched: DataFrame) -> DataFrame:
    month = F.date_format("data_referencia", "yyyy-MM")
    return _volume(enriched.withColumn("ano_mes", month), "ano_mes", "tipo_conta")


# ---- audit ---------------------------------------------------------------------

# The tables a complete run leaves behind.
EXPECTED_OUTPUTS = [
    "meta_raw",
    "categoria_raw",
    "conta_pagar_raw",
    "conta_receber_raw",
    "cliente_raw",
    "bcb_exchange_rates_raw",
    "meta_transformed",
    "categoria_transformed",
    "conta_pagar_transformed",
    "conta_receber_transformed",
    "cliente_transformed",
    "exchange_rates_transformed",
    "transactions_enriched",
    "customer_summary",
    "category_summary",
    "monthly_summary",
    "customer_segments",
]


def output_audit(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, present, rows) for every expected output."""
    counts = [t.agg(F.count("*").alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for n, t in tables.items()]
    expected = spark.createDataFrame([(n,) for n in EXPECTED_OUTPUTS], "tabela string")
    if not counts:
        return expected.select("tabela", F.lit(False).alias("presente"), F.lit(None).cast("bigint").alias("linhas"))
    found = union_all(counts)
    return expected.join(F.broadcast(found), "tabela", "left").select(
        "tabela", F.col("linhas").isNotNull().alias("presente"), "linhas"
    )
