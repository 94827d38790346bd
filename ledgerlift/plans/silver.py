"""Silver cleaners: DataFrame in, DataFrame out. Unknown columns pass through."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlift.functions.columns import (
    day,
    id_text,
    instant,
    lowered,
    normalize_columns,
    number,
    target_amount,
    trimmed,
    uppered,
)
from ledgerlift.operators.dedup import keep_least
from ledgerlift.operators.quality import quality_score


def _trim(*names: str) -> dict[str, Column]:
    return {n: trimmed(n) for n in names}


def _days(df: DataFrame, *names: str) -> dict[str, Column]:
    return {n: day(df, n) for n in names}


def dedup_targets(df: DataFrame) -> DataFrame:
    return keep_least(normalize_columns(df), ["mes_meta"])


def dedup_categories(df: DataFrame) -> DataFrame:
    return keep_least(normalize_columns(df), ["codigo_categoria"])


def dedup_accounts(df: DataFrame) -> DataFrame:
    """Payables and receivables, by raw account id."""
    return keep_least(normalize_columns(df), ["id_conta"])


def dedup_customers(df: DataFrame) -> DataFrame:
    return keep_least(normalize_columns(df), ["id_cliente"])


def clean_targets(df: DataFrame) -> DataFrame:
    df = dedup_targets(df)
    return df.withColumns(_trim("mes_meta", "meta") | {"meta_valor": target_amount(trimmed("meta"))})


def clean_categories(df: DataFrame) -> DataFrame:
    df = dedup_categories(df)
    return df.withColumns(_trim("codigo_categoria", "nome_categoria") | {"tipo_categoria": lowered("tipo_categoria")})


def clean_payables(df: DataFrame) -> DataFrame:
    df = dedup_accounts(df)
    return df.withColumns(
        _trim("descricao_conta", "destino_pagamento_conta", "codigo_categoria")
        | _days(df, "data_vencimento", "data_pagamento")
        | {
            "valor_conta": number("valor_conta"),
            "status_conta": lowered("status_conta"),
            "tipo_conta": F.lit("pagar"),
        }
    )


def clean_receivables(df: DataFrame) -> DataFrame:
    df = dedup_accounts(df)
    return df.withColumns(
        _trim("descricao_conta", "codigo_categoria")
        | _days(df, "data_vencimento", "data_pagamento")
        | {
            "id_cliente": id_text(df, "id_cliente"),
            "valor_conta": number("valor_conta"),
            "status_conta": lowered("status"),
            "tipo_conta": F.lit("receber"),
        }
    ).drop("status")


def clean_customers(df: DataFrame) -> DataFrame:
    df = dedup_customers(df)
    return df.withColumns(
        _trim("nome_cliente", "pais_cliente")
        | _days(df, "data_cadastro_cliente")
        | {"id_cliente": id_text(df, "id_cliente"), "pais_cliente_normalizado": uppered("pais_cliente")}
    )


def clean_rates(df: DataFrame) -> DataFrame:
    """Normalise first, then keep one quote per (currency, day)."""
    df = normalize_columns(df)
    rates = {c: F.round(number(c), 4) for c in ("buy_rate", "sell_rate", "average_rate")}
    tidy = df.withColumns({"currency": uppered("currency"), "date": day(df, "date")} | rates)
    return keep_least(tidy, ["currency", "date"])


CLEANERS = {
    "meta": clean_targets,
    "categoria": clean_categories,
    "conta_pagar": clean_payables,
    "conta_receber": clean_receivables,
    "cliente": clean_customers,
    "exchange_rates": clean_rates,
}


def finalize(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the run time and the table's quality score (measured before these two columns)."""
    return df.select(
        "*",
        instant(run_ts).alias("_transformation_date"),
        quality_score(df).scalar().alias("_data_quality_score"),
    )
