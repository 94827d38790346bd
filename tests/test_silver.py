from datetime import date, datetime

import pytest

from ledgerlift.functions.columns import normalize_columns
from ledgerlift.operators import quality
from ledgerlift.plans import silver


def test_column_names(spark):
    df = spark.range(1).selectExpr("id AS ` Id`", "id AS NOME")
    assert normalize_columns(df).columns == ["id", "nome"]
    with pytest.raises(ValueError):
        normalize_columns(spark.range(1).selectExpr("id AS ` Id`", "id AS ID"))


def test_categories(spark, rows):
    df = spark.createDataFrame(
        [("A", " Venda ", "RECEITA"), ("A", " Venda ", "RECEITA"), ("B", "Compra", " DESPESA "), ("A ", "Outra", None)],
        "codigo_categoria string, nome_categoria string, tipo_categoria string",
    )
    # dedup comes before the trim: the padded code survives
    assert rows(silver.clean_categories(df)) == [
        ("A", "Outra", None),
        ("A", "Venda", "receita"),
        ("B", "Compra", "despesa"),
    ]


def receivable(spark, **changes):
    row = dict(
        id_conta=1, descricao_conta=" Mensalidade ", id_cliente=10.0, codigo_categoria=" A ", observacao_conta=None,
        valor_conta="1500.5", data_vencimento="2024-01-10", data_pagamento="2024-01-09", status=" PAGO ",
    ) | changes
    schema = (
        "id_conta int, descricao_conta string, id_cliente double, codigo_categoria string, observacao_conta string, "
        "valor_conta string, data_vencimento string, data_pagamento string, status string"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


def test_receivable(spark):
    got = silver.clean_receivables(receivable(spark)).first()
    assert (got.tipo_conta, got.status_conta, got.valor_conta) == ("receber", "pago", 1500.5)
    assert got.id_cliente == "10"
    assert got.data_vencimento == date(2024, 1, 10)
    assert "status" not in got.asDict()


@pytest.mark.parametrize("value,expected", [("abc", None), ("NaN", None), (None, None), ("0", 0.0)])
def test_bad_amount_is_null(spark, value, expected):
    got = silver.clean_receivables(receivable(spark, valor_conta=value, data_vencimento="31/31/2024")).first()
    assert got.valor_conta == expected
    assert got.data_vencimento is None


@pytest.mark.parametrize(
    "text,expected", [("150k", 150000.0), (" 150K ", 150000.0), ("1.5k", 1.5), ("900", 900.0), ("x", None)]
)
def test_target_amount(spark, text, expected):
    df = spark.createDataFrame([("2025-01", text)], "mes_meta string, meta string")
    assert silver.clean_targets(df).first().meta_valor == expected


def test_rates_are_deduplicated_after_normalisation(spark, rows):
    df = spark.createDataFrame(
        [("usd ", "2024-01-02", 5.00004, 5.1, 5.05), ("USD", "2024-01-02", 4.9, 5.0, 4.95), ("EUR", "bad", 1.0, 1.0, 1.0)],
        "currency string, date string, buy_rate double, sell_rate double, average_rate double",
    )
    assert rows(silver.clean_rates(df), "currency", "date", "buy_rate") == [
        ("EUR", None, 1.0),
        ("USD", date(2024, 1, 2), 4.9),
    ]


def test_quality_score(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", float("nan")), (None, 2.0)], "k string, v double")
    # 6 of 8 cells filled, one duplicate of four rows
    assert quality.quality_score(df).first().score == 62.5
    assert quality.quality_score(df.filter("false")).first().score == 0.0
    done = silver.finalize(df, datetime(2024, 1, 1))
    assert {r._data_quality_score for r in done.collect()} == {62.5}


def test_constraint_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "abc"), (9, None), (9, "toolong"), (None, "x")], "fk int, nome string")
    assert quality.orphan_rows(child, parent, "child", "fk", "id").first().orfaos == 2
    assert quality.duplicate_keys(child, "child", ["fk"]).first().linhas_a_mais == 1
    got = quality.limit_violations(child, "child", {"nome": (False, 3, None)}).first()
    assert (got.nulos_indevidos, got.longos_demais) == (1, 1)
