from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions.country import country_currency, with_country
from ledgerlift.operators.fx import rate_history, resolve_rates
from ledgerlift.plans import gold, insights

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.mark.parametrize(
    "text,country,currency",
    [
        ("Brasil", "BRASIL", "BRL"),
        (" Canadá ", "CANADA", "CAD"),
        ("França", "FRANCA", "EUR"),
        ("EUA", "ESTADOS UNIDOS", "USD"),
        ("UK", "REINO UNIDO", "GBP"),
        ("Inglaterra", "REINO UNIDO", "GBP"),
        ("America do Norte", "ESTADOS UNIDOS", "USD"),
        ("Portugal!!", "PORTUGAL", "EUR"),
        ("República  Argentina", "ARGENTINA", "ARS"),
        ("Chile", "CHILE", "BRL"),
        ("", "NAO INFORMADO", "BRL"),
        (None, "NAO INFORMADO", "BRL"),
    ],
)
def test_country(spark, text, country, currency):
    df = with_country(spark.createDataFrame([(text,)], "p string"), "p", "c")
    assert tuple(df.select("c", country_currency("c")).first()) == (country, currency)


RATES = [
    ("USD", date(2024, 1, 2), 5.0), ("USD", date(2024, 1, 5), 5.5), ("USD", date(2024, 2, 1), 6.0), ("EUR", date(2024, 1, 10), 5.4),
]


def rates(spark):
    return spark.createDataFrame(
        [(c, d, r, r, r) for c, d, r in RATES], "currency string, date date, buy_rate double, sell_rate double, average_rate double"
    )


@pytest.mark.parametrize(
    "currency,day,expected",
    [
        ("USD", date(2023, 12, 1), "5.0000"),
        ("USD", date(2024, 1, 2), "5.0000"),
        ("USD", date(2024, 1, 4), "5.0000"),
        ("USD", date(2024, 1, 5), "5.5000"),
        ("USD", date(2030, 1, 1), "6.0000"),
        ("EUR", date(2020, 1, 1), "5.4000"),
        ("EUR", date(2025, 1, 1), "5.4000"),
        ("BRL", date(2024, 1, 1), "1.0000"),
        ("ARS", date(2024, 1, 1), None),
    ],
)
def test_asof_rate(spark, currency, day, expected):
    df = spark.createDataFrame([(currency, day)], "currency string, d date")
    got = resolve_rates(df, rate_history(rates(spark)), "currency", "d").first().taxa_cambio
    assert got == (None if expected is None else D(expected))


def inputs(spark):
    customers = spark.createDataFrame(
        [("1", " Ana\t", "EUA"), ("2", "Bia", "Argentina"), (None, "Sem id", "EUA")],
        "id_cliente string, nome_cliente string, pais_cliente string",
    )
    categories = spark.createDataFrame(
        [("A", "Venda", "receita"), ("A ", "Venda B", "receita"), ("X", "Luz", "despesa")],
        "codigo_categoria string, nome_categoria string, tipo_categoria string",
    )
    schema = "id_conta string, id_cliente string, codigo_categoria string, valor_conta double, data_vencimento date, data_pagamento date, status_conta string"
    receivables = spark.createDataFrame(
        [
            ("r1", "1", "A", 100.0, date(2024, 1, 1), date(2024, 1, 5), "pago"),
            ("r2", "1", "A", 0.015, date(2024, 1, 3), None, None),
            ("r3", "2", "A", 10.0, date(2024, 1, 3), None, "atrasado"),
            ("r4", "9", "A", 10.0, date(2024, 1, 3), None, "pago"),
            ("r5", "1", "Z", 10.0, date(2024, 1, 3), None, "pago"),
            ("r6", "1", "A", 10.0, None, None, "pago"),
            ("r7", "1", "A", None, date(2024, 1, 3), None, "atrasado"),
        ],
        schema,
    )
    payables = spark.createDataFrame(
        [("p1", "X", 7.5, date(2024, 1, 2), None, "pago")],
        "id_conta string, codigo_categoria string, valor_conta double, data_vencimento date, data_pagamento date, status_conta string",
    )
    return payables, receivables, customers, categories, rates(spark)


def test_enrichment(spark):
    got = {r.id_conta: r for r in gold.enrich(*inputs(spark)).collect()}
    assert set(got) == {"p1", "r1", "r2", "r3", "r4", "r7"}
    assert (got["r1"].currency, got["r1"].taxa_cambio, got["r1"].valor_brl) == ("USD", D("5.5000"), D("550.00"))
    assert got["r1"].nome_categoria == "Venda B"  # padded duplicate: the greatest wins
    assert got["r1"].nome_cliente == "Ana"
    assert (got["r2"].valor_original, got["r2"].taxa_cambio) == (D("0.02"), D("5.0000"))
    # never quoted: the whole row counts as home currency
    assert (got["r3"].pais_cliente, got["r3"].currency, got["r3"].taxa_cambio) == ("ARGENTINA", "BRL", D("1.0000"))
    # unknown customer: kept as home country without an id
    assert (got["r4"].id_cliente, got["r4"].pais_cliente, got["r4"].currency) == (None, "BRASIL", "BRL")
    assert got["r7"].valor_brl is None
    assert (got["p1"].tipo_conta, got["p1"].pais_cliente, got["p1"].valor_brl) == ("pagar", "BRASIL", D("7.50"))


def test_large_catalogue_takes_the_shuffle_join(spark, rows, monkeypatch):
    broadcast = rows(gold.enrich(*inputs(spark)))
    monkeypatch.setattr(gold, "broadcast_if_small", lambda df: (df, False))
    assert rows(gold.enrich(*inputs(spark))) == broadcast


def test_rejected(spark):
    payables, receivables, _, categories, _ = inputs(spark)
    calendar = spark.createDataFrame([(1, date(2024, 1, 3)), (2, date(2024, 1, 5))], "date_id int, date date")
    got = {r.id_conta: r.motivo for r in gold.rejected(payables, receivables, categories, calendar).collect()}
    assert got == {"r5": "unknown account", "r6": "no date", "p1": "outside the calendar"}


def test_oversized_amounts_are_listed_not_fatal(spark):
    payables, receivables, customers, categories, rates = inputs(spark)
    huge = receivables.withColumn("valor_conta", F.when(F.col("id_conta") == "r1", 1e17).otherwise(F.col("valor_conta")))
    got = {r.id_conta: r.motivo for r in gold.rejected(payables, huge, categories).collect()}
    assert got["r1"] == "amount out of range"
    kept = {r.id_conta for r in gold.enrich(payables, huge, customers, categories, rates).collect()}
    assert "r1" not in kept and kept


def test_customer_summary(spark):
    got = {r.id_cliente: r for r in gold.customer_summary(gold.enrich(*inputs(spark))).collect()}
    ana, bia = got["1"], got["2"]
    assert (ana.quantidade_transacoes, ana.percentual_atraso, ana.percentual_pago) == (3, 33.33, 33.33)
    assert ana.total_receita_brl == D("550.10") and ana.ticket_medio_brl == pytest.approx(275.05)
    assert (ana.primeira_transacao, ana.dias_ativos) == (date(2024, 1, 3), 2)
    assert bia.desvio_padrao_brl == 0.0 and bia.dias_ativos == 0
    assert set(got) == {"1", "2"}


def test_dimension_upsert(spark):
    def batch(*people):
        return spark.createDataFrame(list(people), "id_cliente string, nome_cliente string, pais_cliente string")

    first = gold.customer_dim(batch(("1", "Ana", "EUA"), ("2", "Bia", "UK"), ("3", "Caio", "Brasil")), T1)
    labels = spark.createDataFrame([("1", 4), ("77", 1)], "id_cliente string, cluster int")
    first = gold.write_back_clusters(first, labels)
    second = gold.customer_dim(batch(("1", "Ana Lima", "UK"), ("2", "Bia", "UK"), ("9", "Davi", "Chile")), T2, first)
    before = {r.customer_code: r for r in first.collect()}
    after = {r.customer_code: r for r in second.collect()}
    assert set(after) == {"1", "2", "3", "9"}
    assert all(after[c].customer_id == before[c].customer_id for c in before)
    assert (after["1"].customer_name, after["1"].country, after["1"].ml_cluster) == ("Ana Lima", "REINO UNIDO", 4)
    assert (after["1"].created_at, after["9"].created_at) == (T1, T2)
    assert after["9"].customer_id == 4


def test_star_and_facts(spark):
    payables, receivables, customers, categories, quotes = inputs(spark)
    kinds = gold.category_dim(categories)
    dims = {
        "date": gold.date_dim(gold.date_range(payables, receivables)),
        "currency": gold.currency_dim(quotes, customers),
        "customer": gold.customer_dim(customers, T1),
        "account": gold.account_dim(kinds),
    }
    assert {r.currency_code for r in dims["currency"].collect()} == {"BRL", "USD", "EUR", "ARS"}
    assert {r.account_code for r in dims["account"].collect()} == {"PAGAR|A", "RECEBER|A", "PAGAR|X", "RECEBER|X"}
    days = {r.date: r for r in dims["date"].collect()}
    assert min(days) == date(2024, 1, 1) and max(days) == date(2024, 1, 5)
    assert (days[date(2024, 1, 1)].day_of_week, days[date(2024, 1, 1)].week) == ("Monday", 1)
    enriched = gold.enrich(payables, receivables, customers, categories, quotes, dims=dims)
    facts = gold.transaction_fact(enriched, T1).collect()
    assert len(facts) == 6 and len({f.transaction_id for f in facts}) == 6
    assert sum(f.customer_id is None for f in facts) == 2
    assert gold.exchange_rate_fact(quotes, dims["currency"], T1).count() == 4


def test_names_that_an_id_decides_take_no_part_in_the_numbering(spark):
    payables, receivables, customers, categories, quotes = inputs(spark)
    dims = {
        "date": gold.date_dim(gold.date_range(payables, receivables)),
        "currency": gold.currency_dim(quotes, customers),
        "customer": gold.customer_dim(customers, T1),
        "account": gold.account_dim(gold.category_dim(categories)),
    }
    enriched = gold.enrich(payables, receivables, customers, categories, quotes, dims=dims)
    plan = gold.transaction_fact(enriched, T1)._jdf.queryExecution().optimizedPlan().toString()
    numbering = [line for line in plan.splitlines() if "row_number()" in line and "Window [" in line and "id_conta" in line]
    assert len(numbering) == 1 and "id_cliente" in numbering[0] and not any(f"{c}#" in numbering[0] for c in gold.DECIDED)


def test_column_profile_counts_numbers_as_they_are(spark, rows):
    numbers = spark.createDataFrame(
        [(1, 0.0, date(2024, 1, 1)), (1, -0.0, None), (None, float("nan"), date(2024, 1, 2)), (3, float("nan"), date(2024, 1, 2))],
        "n int, x double, d date",
    )
    texts = spark.createDataFrame([("a", [1, None]), ("a", [1]), (None, [1, None]), ("", None)], "t string, a array<int>")
    profile = insights.table_columns({"numbers": numbers, "texts": texts, "none": numbers.filter("false")})
    assert rows(profile.filter("tabela <> 'none'"), "tabela", "posicao", "coluna", "tipo", "preenchidas", "distintas") == [
        ("numbers", 1, "n", "int", 3, 2), ("numbers", 2, "x", "double", 4, 2), ("numbers", 3, "d", "date", 3, 2),
        ("texts", 1, "t", "string", 3, 2), ("texts", 2, "a", "array<int>", 3, 2),
    ]
    assert rows(profile.filter("tabela = 'none'"), "coluna", "preenchidas", "distintas") == [("d", 0, 0), ("n", 0, 0), ("x", 0, 0)]
    plan = insights.table_columns({"numbers": numbers})._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "xxhash64" not in plan


def test_calendar_keys_and_the_declared_span(spark):
    def booked(*days):
        return spark.createDataFrame([(d, None) for d in days], "data_vencimento date, data_pagamento date")

    none = booked().limit(0)
    span = gold.date_range(booked(date(2024, 3, 1), date(9999, 12, 31), date(1, 1, 1)), booked(date(2024, 2, 27)))
    assert tuple(span.first()) == (date(2024, 2, 27), date(2024, 3, 1))
    first = gold.date_dim(span)
    assert {r.date_id for r in first.collect()} == {1, 2, 3, 4}
    second = gold.date_dim(gold.date_range(booked(date(2024, 2, 25), date(2024, 3, 3)), none), first)
    keys = {r.date: r.date_id for r in second.collect()}
    assert len(keys) == 8 and all(keys[d] == (d - date(2024, 2, 26)).days for d in keys)
    assert all(keys[r.date] == r.date_id for r in first.collect())
    assert "Window" not in second._jdf.queryExecution().executedPlan().toString()
    payables, receivables, _, categories, _ = inputs(spark)
    far = receivables.withColumn("data_pagamento", F.when(F.col("id_conta") == "r1", F.lit(date(9999, 12, 31))).otherwise(F.col("data_pagamento")))
    calendar = gold.date_dim(gold.date_range(payables, far))
    got = {r.id_conta: r.motivo for r in gold.rejected(payables, far, categories, calendar).collect()}
    assert got["r1"] == "outside the calendar" and calendar.count() < 10


def test_concentration(spark):
    data = [(f"c{i}", float(100 - i)) for i in range(10)]
    summary = spark.createDataFrame(data, "id_cliente string, total_receita_brl double")
    curve = insights.pareto_curve(summary).orderBy("posicao").collect()
    assert curve[-1].receita_acumulada_pct == 100.0 and curve[0].id_cliente == "c0"
    split = {r.grupo: r.clientes for r in insights.vip_split(summary).collect()}
    assert split == {"VIP": 2, "DEMAIS": 8}
