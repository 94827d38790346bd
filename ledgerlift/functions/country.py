"""Country normalisation and the country/currency reference values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Currency code -> (name, country).
CURRENCY_REFERENCE = {
    "BRL": ("Real Brasileiro", "Brasil"),
    "USD": ("Dolar Americano", "Estados Unidos"),
    "EUR": ("Euro", "Uniao Europeia"),
    "GBP": ("Libra Esterlina", "Reino Unido"),
    "JPY": ("Iene", "Japao"),
    "CAD": ("Dolar Canadense", "Canada"),
    "ARS": ("Peso Argentino", "Argentina"),
}
UNKNOWN_COUNTRY = "Nao informado"

# Normalised country -> currency; every other country uses BRL.
COUNTRY_CURRENCY = {
    "BRASIL": "BRL",
    "ESTADOS UNIDOS": "USD",
    "PORTUGAL": "EUR",
    "FRANCA": "EUR",
    "REINO UNIDO": "GBP",
    "CANADA": "CAD",
    "ARGENTINA": "ARS",
}
HOME_CURRENCY = "BRL"
HOME_COUNTRY = "BRASIL"

# Accented letters and their plain forms.
ACCENTED = "ÃÁÀÂÉÊÍÓÔÕÚÇ"
PLAIN = "AAAAEEIOOOUC"

# Fixed values: (country, whole-text spellings, contained spellings), first hit wins.
COUNTRY_RULES = [
    ("ESTADOS UNIDOS", ["USA", "EUA"], ["ESTADOS UNIDOS", "AMERICA"]),
    ("REINO UNIDO", ["UK"], ["REINO UNIDO", "INGLATERRA"]),
    ("BRASIL", [], ["BRASIL"]),
    ("PORTUGAL", [], ["PORTUGAL"]),
    ("FRANCA", [], ["FRAN"]),
    ("CANADA", [], ["CANADA"]),
    ("ARGENTINA", [], ["ARGENTINA"]),
]
BLANK_COUNTRY = "NAO INFORMADO"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _case(subject: str, values: dict[str, str], otherwise: str) -> str:
    whens = " ".join(f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in values.items())
    return f"CASE {subject} {whens} ELSE {otherwise} END"


def _rules(text: str) -> str:
    whens = []
    for country, whole, parts in COUNTRY_RULES:
        tests = [f"{text} = {_literal(w)}" for w in whole] + [f"contains({text}, {_literal(p)})" for p in parts]
        whens.append(f"WHEN {' OR '.join(tests)} THEN {_literal(country)}")
    return f"CASE {' '.join(whens)} WHEN {text} = '' THEN {_literal(BLANK_COUNTRY)} ELSE {text} END"


def with_country(df: DataFrame, source: str, country: str) -> DataFrame:
    """Add ``country``: the free-text ``source`` folded to one spelling.

    The cleaned text is a column of its own, so that the rules read it and do not
    recompute it.
    """
    letters = f"translate(upper(coalesce(cast({source} AS string), '')), '{ACCENTED}', '{PLAIN}')"
    text = f"trim(regexp_replace(regexp_replace({letters}, '[^A-Z ]', ' '), ' +', ' '))"
    return df.withColumn("_place", F.expr(text)).withColumn(country, F.expr(_rules("_place"))).drop("_place")


def country_currency(country: str) -> Column:
    """Currency of a normalised country column."""
    return F.expr(_case(country, COUNTRY_CURRENCY, _literal(HOME_CURRENCY)))


def currency_name(code: str) -> Column:
    return F.expr(_case(code, {c: name for c, (name, _) in CURRENCY_REFERENCE.items()}, code))


def currency_country(code: str) -> Column:
    return F.expr(_case(code, {c: place for c, (_, place) in CURRENCY_REFERENCE.items()}, _literal(UNKNOWN_COUNTRY)))
