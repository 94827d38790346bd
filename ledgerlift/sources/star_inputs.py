"""The six bronze inputs, derived by Spark from the star-schema test tables.

Each function reads whole tables; duplicates, padding, malformed text, unknown
customers, missing dates and missing amounts come from predicates on the data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlift.functions.columns import MONEY, RATE
from ledgerlift.sources.readers import with_lineage

RUN_TS = datetime(2024, 2, 1, 6, 30, 0)
FIRST_QUOTE = "1995-03-01"
# Orders of unknown customers: every so many, with the customer key moved out of the registry.
ORPHAN_EVERY, ORPHAN_SHIFT = 97, 1_000_000_000_000
# One spelling per nation key; the last nation has none.
COUNTRY_SPELLINGS = [
    "Brasil",
    " Canadá ",
    "EUA",
    "França",
    "Reino-Unido",
    "Chile",
    "",
    "Portugal!!",
    "Argentina",
    "Estados Unidos",
    "Inglaterra",
    "UK",
    "America do Norte",
    "BRASIL",
    "Brasil (SP)",
    "México",
    "USA",
    "FRANCE",
    "Canada",
    "portugal",
    "República Argentina",
    "Estados-Unidos",
    "reino  unido",
    "Japão",
]
# Quoted currencies and the base of their derived rates.
QUOTE_BASES = {"USD": "5.0", "EUR": "5.4", "GBP": "6.2", "CAD": "3.7"}

# Declared schemas of the tables in use: no inference job per read.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _stamp(df: DataFrame, source: str, lineage: bool) -> DataFrame:
    return with_lineage(df, source, RUN_TS, f"{source}.parquet") if lineage else df


def customers(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """Registry: customers in debit were registered twice."""
    spellings = ", ".join(f"'{s}'" for s in COUNTRY_SPELLINGS)
    source = table(spark, sf_dir, "customer")

    def rows(df: DataFrame, name: str, country: str) -> DataFrame:
        return df.selectExpr(
            "c_custkey AS id_cliente",
            f"{name} AS nome_cliente",
            f"{country} AS pais_cliente",
            """if(c_mktsegment = 'HOUSEHOLD', 'sem data',
                  date_format(date_add(DATE'1990-01-01', cast(c_custkey % 1500 AS int)), 'yyyy-MM-dd'))
               AS data_cadastro_cliente""",
        )

    first = rows(source, "concat(' ', c_name, ' ')", f"get(array({spellings}), c_nationkey)")
    again = rows(source.filter("c_acctbal < 0"), "upper(c_name)", "'Brasil'")
    return _stamp(first.unionByName(again), "cliente", lineage)


def receivables(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """Orders; pending ones were exported twice, and some name a customer whom the registry lacks."""
    orders = table(spark, sf_dir, "orders")

    def rows(df: DataFrame, text: str) -> DataFrame:
        return df.selectExpr(
            "o_orderkey AS id_conta",
            f"{text} AS descricao_conta",
            f"if(o_orderkey % {ORPHAN_EVERY} = 0, o_custkey + {ORPHAN_SHIFT}, o_custkey) AS id_cliente",
            "concat(o_orderpriority, ' ') AS codigo_categoria",
            "cast(NULL AS string) AS observacao_conta",
            "if(o_totalprice >= 2000, o_totalprice, NULL) AS valor_conta",
            "if(o_orderstatus = 'P' AND o_totalprice < 6000, NULL, cast(o_orderdate AS date)) AS data_vencimento",
            """if(o_orderstatus = 'P', NULL, date_add(cast(o_orderdate AS date), cast(o_orderkey % 45 AS int)))
               AS data_pagamento""",
            "CASE o_orderstatus WHEN 'F' THEN ' Pago ' WHEN 'O' THEN 'ATRASADO' ELSE 'Pendente' END AS status",
        )

    first = rows(orders, "concat(' Pedido ', o_orderkey, ' ')")
    again = rows(orders.filter("o_orderstatus = 'P'"), "concat('Pedido ', o_orderkey, ' (2a via)')")
    return _stamp(first.unionByName(again), "conta_receber", lineage)


def payables(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """Line items; (order, line) repeats, so the account id does too."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) AS id_conta",
        "concat(' Item ', l_partkey) AS descricao_conta",
        "concat('Fornecedor ', l_suppkey, ' ') AS destino_pagamento_conta",
        "concat(l_returnflag, '-', l_linestatus, ' ') AS codigo_categoria",
        f"""cast(round(cast(l_extendedprice AS {MONEY}) * (1 - cast(l_discount AS decimal(4,2))), 2) AS double)
            AS valor_conta""",
        "cast(l_shipdate AS date) AS data_vencimento",
        """if(l_returnflag <> 'N', date_add(cast(l_shipdate AS date), cast(l_orderkey % 30 AS int)), NULL)
           AS data_pagamento""",
        "CASE l_returnflag WHEN 'R' THEN ' Atrasado' WHEN 'A' THEN 'PAGO ' ELSE 'pendente' END AS status_conta",
    )
    return _stamp(rows, "conta_pagar", lineage)


def categories(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """Income categories from order priorities, expense ones from line flags.

    "4-NOT SPECIFIED" is in no catalogue. Codes repeat exactly (status F and O)
    and with padding (status P).
    """
    income = (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority <> '4-NOT SPECIFIED'")
        .selectExpr("o_orderpriority AS p", "o_orderstatus AS s")
        .distinct()
        .selectExpr(
            "if(s = 'P', concat(p, ' '), p) AS ` Codigo_Categoria`",
            """CASE s WHEN 'P' THEN concat('Receita ', substr(p, 3), ' (revisada)')
                      WHEN 'F' THEN concat(' Receita ', substr(p, 3))
                      ELSE concat('RECEITA ', substr(p, 3)) END AS NOME_CATEGORIA""",
            "'RECEITA ' AS tipo_categoria",
        )
    )
    expense = (
        table(spark, sf_dir, "lineitem")
        .selectExpr("l_returnflag AS f", "l_linestatus AS s")
        .distinct()
        .selectExpr(
            "concat(f, '-', s) AS ` Codigo_Categoria`",
            "concat(' Despesa ', f, s, ' ') AS NOME_CATEGORIA",
            "' Despesa' AS tipo_categoria",
        )
    )
    return _stamp(income.unionByName(expense), "categoria", lineage)


def targets(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """Monthly targets from order counts: "25k", " 25.5K " and plain amounts; months repeat, also padded."""
    counted = (
        table(spark, sf_dir, "orders")
        .selectExpr("date_format(o_orderdate, 'yyyy-MM') AS m", "o_orderstatus AS s")
        .groupBy("m", "s")
        .count()
    )
    rows = counted.selectExpr(
        "if(s = 'O', concat(m, ' '), m) AS Mes_Meta",
        """CASE s WHEN 'F' THEN concat(count, 'k') WHEN 'O' THEN concat(' ', count, '.5K ')
                  ELSE cast(count * 1000 AS string) END AS ` META `""",
    )
    return _stamp(rows, "meta", lineage)


def _bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per currency and order day: the opening (status F) and closing (any other status) buying rates."""
    seed = "sum(o_orderkey) FILTER (WHERE o_orderstatus {} 'F') % 3000"
    days = (
        table(spark, sf_dir, "orders")
        .selectExpr("cast(o_orderdate AS date) AS day", "o_orderkey", "o_orderstatus")
        .groupBy("day")
        .agg(*[F.expr(seed.format(s)).alias(name) for s, name in (("=", "opening"), ("<>", "closing"))])
    )
    bases = ", ".join(f"struct('{c}' AS code, cast({b} AS {RATE}) AS base)" for c, b in QUOTE_BASES.items())
    rate = f"cast(base + cast({{0}} AS decimal(8,0)) * cast(0.0001 AS decimal(5,4)) AS {RATE}) AS {{0}}"
    return days.selectExpr("*", f"inline(array({bases}))").selectExpr(
        "code", "day", rate.format("opening"), rate.format("closing")
    )


def _sell(buy: str) -> str:
    return f"cast({buy} + cast(0.0101 AS decimal(5,4)) AS {RATE})"


def quotes(spark: SparkSession, sf_dir: str, lineage: bool = False) -> DataFrame:
    """Weekday quotes from FIRST_QUOTE on; opening and closing share a day once codes are normalised."""
    slots = "stack(2, concat(lower(code), ' '), opening, code, closing) AS (currency, buy_rate)"
    rows = (
        _bulletins(spark, sf_dir)
        .filter(f"weekday(day) < 5 AND day >= DATE'{FIRST_QUOTE}'")
        .selectExpr("day AS date", slots)
        .filter("buy_rate IS NOT NULL")
        .selectExpr(
            "currency",
            "date",
            "buy_rate",
            f"{_sell('buy_rate')} AS sell_rate",
            f"cast(round((buy_rate + {_sell('buy_rate')}) / 2, 4) AS {RATE}) AS average_rate",
        )
    )
    return _stamp(rows, "exchange_rates", lineage)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed quote payloads, one per currency and order day; empty at weekends."""

    def quote(buy: str) -> str:
        return f"if({buy} IS NULL, NULL, struct({buy} AS cotacaoCompra, {_sell(buy)} AS cotacaoVenda))"

    both = f"array_compact(array({quote('opening')}, {quote('closing')}))"
    return _bulletins(spark, sf_dir).selectExpr(
        "code AS currency",
        "day AS quote_date",
        f"to_json(struct(if(weekday(day) < 5, {both}, slice({both}, 1, 0)) AS value)) AS payload",
    )


INPUTS = {
    "meta": targets,
    "categoria": categories,
    "conta_pagar": payables,
    "conta_receber": receivables,
    "cliente": customers,
    "exchange_rates": quotes,
}
