"""DuckDB statements that compute the registered queries independently from the raw tables."""

from __future__ import annotations

import re

from ledgerlift.sources.star_inputs import COUNTRY_SPELLINGS

# The values below are stated here on their own: a slip in the engine's tables must not repeat in its check.
FIRST_QUOTE = "1995-03-01"
QUOTE_BASES = {"USD": "5.0", "EUR": "5.4", "GBP": "6.2", "CAD": "3.7"}
RUN_TS = "2024-02-01 06:30:00"
FIRST_LOAD_TS = "2024-01-01 06:30:00"


def _case(expr: str, pairs: dict, otherwise: str) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {k} THEN {v}" for k, v in pairs.items()) + f" ELSE {otherwise} END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def country(expr: str) -> str:
    letters = f"translate(upper(coalesce({expr}, '')), 'ÃÁÀÂÉÊÍÓÔÕÚÇ', 'AAAAEEIOOOUC')"
    text = f"trim(regexp_replace(regexp_replace({letters}, '[^A-Z ]', ' ', 'g'), ' +', ' ', 'g'))"
    return f"""CASE
        WHEN {text} IN ('USA', 'EUA') OR contains({text}, 'ESTADOS UNIDOS') OR contains({text}, 'AMERICA') THEN 'ESTADOS UNIDOS'
        WHEN {text} = 'UK' OR contains({text}, 'REINO UNIDO') OR contains({text}, 'INGLATERRA') THEN 'REINO UNIDO'
        WHEN contains({text}, 'BRASIL') THEN 'BRASIL'
        WHEN contains({text}, 'PORTUGAL') THEN 'PORTUGAL'
        WHEN contains({text}, 'FRAN') THEN 'FRANCA'
        WHEN contains({text}, 'CANADA') THEN 'CANADA'
        WHEN contains({text}, 'ARGENTINA') THEN 'ARGENTINA'
        WHEN {text} = '' THEN 'NAO INFORMADO' ELSE {text} END"""


def currency(expr: str) -> str:
    return f"""CASE {expr} WHEN 'ESTADOS UNIDOS' THEN 'USD' WHEN 'PORTUGAL' THEN 'EUR' WHEN 'FRANCA' THEN 'EUR'
        WHEN 'REINO UNIDO' THEN 'GBP' WHEN 'CANADA' THEN 'CAD' WHEN 'ARGENTINA' THEN 'ARS' ELSE 'BRL' END"""


SPELLING = _case("c_nationkey", {i: _quoted(s) for i, s in enumerate(COUNTRY_SPELLINGS)}, "NULL")
CURRENCY_NAME = """CASE currency_code WHEN 'BRL' THEN 'Real Brasileiro' WHEN 'USD' THEN 'Dolar Americano' WHEN 'EUR' THEN 'Euro'
    WHEN 'GBP' THEN 'Libra Esterlina' WHEN 'JPY' THEN 'Iene' WHEN 'CAD' THEN 'Dolar Canadense' WHEN 'ARS' THEN 'Peso Argentino'
    ELSE currency_code END"""
CURRENCY_COUNTRY = """CASE currency_code WHEN 'BRL' THEN 'Brasil' WHEN 'USD' THEN 'Estados Unidos' WHEN 'EUR' THEN 'Uniao Europeia'
    WHEN 'GBP' THEN 'Reino Unido' WHEN 'JPY' THEN 'Japao' WHEN 'CAD' THEN 'Canada' WHEN 'ARS' THEN 'Argentina'
    ELSE 'Nao informado' END"""
BASES = " UNION ALL ".join(f"SELECT '{c}' AS code, CAST({b} AS DECIMAL(10,4)) AS base" for c, b in QUOTE_BASES.items())


def _least(source: str, keys: str, rest: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in rest.split(","))
    return (
        f"SELECT {keys}, {rest} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _r "
        f"FROM {source}) WHERE _r = 1"
    )


def _number(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


PAGAR_COLUMNS = "descricao_conta, destino_pagamento_conta, codigo_categoria, valor_conta, data_vencimento, data_pagamento, status_conta"
RECEBER_COLUMNS = "descricao_conta, id_cliente, codigo_categoria, observacao_conta, valor_conta, data_vencimento, data_pagamento, status"

CTES = {
    # ---- bronze
    "b_meta": """
        SELECT CASE WHEN o_orderstatus = 'O' THEN m || ' ' ELSE m END AS mes_meta,
               CASE o_orderstatus WHEN 'F' THEN n || 'k' WHEN 'O' THEN ' ' || n || '.5K '
                    ELSE CAST(n * 1000 AS VARCHAR) END AS meta
        FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)""",
    "b_categoria": """
        SELECT CASE WHEN s = 'P' THEN p || ' ' ELSE p END AS codigo_categoria,
               CASE s WHEN 'P' THEN 'Receita ' || substr(p, 3) || ' (revisada)'
                      WHEN 'F' THEN ' Receita ' || substr(p, 3) ELSE 'RECEITA ' || substr(p, 3) END AS nome_categoria,
               'RECEITA ' AS tipo_categoria
        FROM (SELECT DISTINCT o_orderpriority AS p, o_orderstatus AS s FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED')
        UNION ALL
        SELECT f || '-' || s, ' Despesa ' || f || s || ' ', ' Despesa'
        FROM (SELECT DISTINCT l_returnflag AS f, l_linestatus AS s FROM lineitem)""",
    "b_conta_pagar": """
        SELECT l_orderkey || '-' || l_linenumber AS id_conta, ' Item ' || l_partkey AS descricao_conta,
               'Fornecedor ' || l_suppkey || ' ' AS destino_pagamento_conta,
               l_returnflag || '-' || l_linestatus || ' ' AS codigo_categoria,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS valor_conta,
               CAST(l_shipdate AS DATE) AS data_vencimento,
               CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 30 AS INTEGER) END AS data_pagamento,
               CASE l_returnflag WHEN 'R' THEN ' Atrasado' WHEN 'A' THEN 'PAGO ' ELSE 'pendente' END AS status_conta
        FROM lineitem""",
    "b_conta_receber": """
        SELECT o_orderkey AS id_conta, texto AS descricao_conta,
               CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 1000000000000 ELSE o_custkey END AS id_cliente,
               o_orderpriority || ' ' AS codigo_categoria, CAST(NULL AS VARCHAR) AS observacao_conta,
               CASE WHEN o_totalprice >= 2000 THEN o_totalprice END AS valor_conta,
               CASE WHEN NOT (o_orderstatus = 'P' AND o_totalprice < 6000) THEN CAST(o_orderdate AS DATE) END AS data_vencimento,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) END AS data_pagamento,
               CASE o_orderstatus WHEN 'F' THEN ' Pago ' WHEN 'O' THEN 'ATRASADO' ELSE 'Pendente' END AS status
        FROM (SELECT *, ' Pedido ' || o_orderkey || ' ' AS texto FROM orders
              UNION ALL SELECT *, 'Pedido ' || o_orderkey || ' (2a via)' FROM orders WHERE o_orderstatus = 'P')""",
    "b_cliente": f"""
        SELECT c_custkey AS id_cliente, nome AS nome_cliente, pais AS pais_cliente,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'sem data'
                    ELSE strftime(DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER), '%Y-%m-%d') END AS data_cadastro_cliente
        FROM (SELECT *, ' ' || c_name || ' ' AS nome, {SPELLING} AS pais FROM customer
              UNION ALL SELECT *, upper(c_name), 'Brasil' FROM customer WHERE c_acctbal < 0)""",
    "bulletins": """
        SELECT CAST(o_orderdate AS DATE) AS day,
               CAST(sum(o_orderkey) FILTER (o_orderstatus = 'F') % 3000 AS DECIMAL(8,0)) AS opening,
               CAST(sum(o_orderkey) FILTER (o_orderstatus <> 'F') % 3000 AS DECIMAL(8,0)) AS closing
        FROM orders GROUP BY 1""",
    "b_exchange_rates": f"""
        SELECT currency, day AS date, buy AS buy_rate, buy + CAST(0.0101 AS DECIMAL(5,4)) AS sell_rate,
               CAST((buy + buy + CAST(0.0101 AS DECIMAL(5,4))) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(10,4)) AS average_rate
        FROM (SELECT CASE WHEN slot = 'o' THEN lower(code) || ' ' ELSE code END AS currency, day,
                     CAST(base + seed * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) AS buy
              FROM (SELECT 'o' AS slot, day, opening AS seed FROM bulletins UNION ALL SELECT 'c', day, closing FROM bulletins) b,
                   ({BASES}) bases
              WHERE seed IS NOT NULL AND isodow(day) < 6 AND day >= DATE '{FIRST_QUOTE}')""",
    # ---- silver
    "d_meta": _least("b_meta", "mes_meta", "meta"),
    "d_categoria": _least("b_categoria", "codigo_categoria", "nome_categoria, tipo_categoria"),
    "d_conta_pagar": _least("b_conta_pagar", "id_conta", PAGAR_COLUMNS),
    "d_conta_receber": _least("b_conta_receber", "id_conta", RECEBER_COLUMNS),
    "d_cliente": _least("b_cliente", "id_cliente", "nome_cliente, pais_cliente, data_cadastro_cliente"),
    "s_meta": """
        SELECT trim(mes_meta) AS mes_meta, trim(meta) AS meta,
               try_cast(replace(lower(trim(meta)), 'k', '000') AS DOUBLE) AS meta_valor FROM d_meta""",
    "s_categoria": """
        SELECT trim(codigo_categoria) AS codigo_categoria, trim(nome_categoria) AS nome_categoria,
               lower(trim(tipo_categoria)) AS tipo_categoria FROM d_categoria""",
    "s_conta_pagar": """
        SELECT id_conta, trim(descricao_conta) AS descricao_conta, trim(destino_pagamento_conta) AS destino_pagamento_conta,
               trim(codigo_categoria) AS codigo_categoria, valor_conta, data_vencimento, data_pagamento,
               lower(trim(status_conta)) AS status_conta, 'pagar' AS tipo_conta FROM d_conta_pagar""",
    "s_conta_receber": """
        SELECT id_conta, trim(descricao_conta) AS descricao_conta, CAST(id_cliente AS VARCHAR) AS id_cliente,
               trim(codigo_categoria) AS codigo_categoria, observacao_conta, valor_conta, data_vencimento, data_pagamento,
               lower(trim(status)) AS status_conta, 'receber' AS tipo_conta FROM d_conta_receber""",
    "s_cliente": """
        SELECT CAST(id_cliente AS VARCHAR) AS id_cliente, trim(nome_cliente) AS nome_cliente, trim(pais_cliente) AS pais_cliente,
               try_cast(data_cadastro_cliente AS DATE) AS data_cadastro_cliente,
               upper(trim(pais_cliente)) AS pais_cliente_normalizado FROM d_cliente""",
    "n_exchange_rates": """
        SELECT upper(trim(currency)) AS currency, date, CAST(buy_rate AS DOUBLE) AS buy_rate,
               CAST(sell_rate AS DOUBLE) AS sell_rate, CAST(average_rate AS DOUBLE) AS average_rate FROM b_exchange_rates""",
    "s_exchange_rates": _least("n_exchange_rates", "currency, date", "buy_rate, sell_rate, average_rate"),
    # ---- gold lookups
    "clientes": f"""
        SELECT id_cliente, nome_cliente, pais_cliente, {currency('pais_cliente')} AS moeda_pais FROM (
          SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY nome_cliente DESC, pais_cliente DESC) AS _r FROM (
            SELECT trim(id_cliente) AS id_cliente, coalesce(trim(nome_cliente), '') AS nome_cliente, {country('pais_cliente')} AS pais_cliente
            FROM s_cliente WHERE id_cliente IS NOT NULL)) WHERE _r = 1""",
    "categorias": """
        SELECT codigo_categoria, nome_categoria, tipo_categoria FROM (
          SELECT *, row_number() OVER (PARTITION BY codigo_categoria ORDER BY nome_categoria DESC, tipo_categoria DESC) AS _r
          FROM s_categoria) WHERE _r = 1""",
    "hist": "SELECT currency, date AS rate_date, CAST(average_rate AS DECIMAL(10,4)) AS rate FROM s_exchange_rates",
    "first_rates": "SELECT currency, min_by(rate, rate_date) AS first_rate FROM hist GROUP BY currency",
    "clientes_moeda": """
        SELECT c.*, CASE WHEN c.moeda_pais IN (SELECT currency FROM first_rates) THEN c.moeda_pais ELSE 'BRL' END AS currency
        FROM clientes c""",
    "recebiveis": """
        SELECT CAST(r.id_conta AS VARCHAR) AS id_conta, 'receber' AS tipo_conta, c.id_cliente, c.nome_cliente,
               coalesce(c.pais_cliente, 'BRASIL') AS pais_cliente, r.codigo_categoria, r.status_conta,
               coalesce(c.currency, 'BRL') AS currency, CAST(r.valor_conta AS DECIMAL(18,2)) AS valor_original,
               coalesce(r.data_pagamento, r.data_vencimento) AS data_referencia
        FROM s_conta_receber r LEFT JOIN clientes_moeda c ON trim(r.id_cliente) = c.id_cliente""",
    "movimentos": """
        SELECT * FROM recebiveis
        UNION ALL
        SELECT id_conta, 'pagar', NULL, NULL, 'BRASIL', codigo_categoria, status_conta, 'BRL',
               CAST(valor_conta AS DECIMAL(18,2)), coalesce(data_pagamento, data_vencimento) FROM s_conta_pagar""",
    "com_taxa": """
        SELECT m.*, CASE WHEN m.currency = 'BRL' THEN CAST(1 AS DECIMAL(10,4)) ELSE coalesce(h.rate, f.first_rate) END AS taxa_cambio
        FROM (SELECT * FROM movimentos WHERE data_referencia IS NOT NULL) m
        ASOF LEFT JOIN hist h ON m.currency = h.currency AND m.data_referencia >= h.rate_date
        LEFT JOIN first_rates f ON m.currency = f.currency""",
    "enriched": """
        SELECT t.id_conta, t.tipo_conta, t.id_cliente, t.nome_cliente, t.pais_cliente, t.codigo_categoria, k.nome_categoria,
               t.status_conta, t.currency, t.taxa_cambio, t.valor_original,
               CAST(t.valor_original * t.taxa_cambio AS DECIMAL(18,2)) AS valor_brl, t.data_referencia
        FROM com_taxa t JOIN categorias k ON t.codigo_categoria = k.codigo_categoria""",
    # ---- summaries
    "customer_summary": """
        SELECT id_cliente, nome_cliente, pais_cliente, currency,
               coalesce(sum(valor_original), 0) AS total_receita_original, coalesce(sum(valor_brl), 0) AS total_receita_brl,
               CAST(sum(valor_brl) AS DOUBLE) / nullif(count(valor_brl), 0) AS ticket_medio_brl,
               count(id_conta) AS quantidade_transacoes,
               coalesce(stddev_samp(CAST(valor_brl AS DOUBLE)), 0) AS desvio_padrao_brl,
               round_even(avg(CASE WHEN status_conta = 'atrasado' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 2) AS percentual_atraso,
               round_even(avg(CASE WHEN status_conta = 'pago' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 2) AS percentual_pago,
               min(data_referencia) AS primeira_transacao, max(data_referencia) AS ultima_transacao,
               date_diff('day', min(data_referencia), max(data_referencia)) AS dias_ativos
        FROM enriched WHERE tipo_conta = 'receber' AND id_cliente IS NOT NULL GROUP BY ALL""",
    "features": """
        SELECT id_cliente, nome_cliente, pais_cliente, currency, CAST(total_receita_brl AS DOUBLE) AS total_receita_brl,
               coalesce(ticket_medio_brl, 0) AS ticket_medio_brl, CAST(quantidade_transacoes AS DOUBLE) AS quantidade_transacoes,
               desvio_padrao_brl, CAST(percentual_atraso AS DOUBLE) AS percentual_atraso,
               CAST(percentual_pago AS DOUBLE) AS percentual_pago, CAST(dias_ativos AS DOUBLE) AS dias_ativos
        FROM customer_summary""",
    "ranked": """
        SELECT *, row_number() OVER w AS posicao,
               sum(total_receita_brl) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acumulado,
               ntile(3) OVER w - 1 AS cluster
        FROM customer_summary WINDOW w AS (ORDER BY total_receita_brl DESC, substr(md5(id_cliente), 1, 2), id_cliente)""",
    "by_cluster": """
        SELECT cluster, count(*) AS clientes, sum(total_receita_brl) AS receita_brl FROM ranked GROUP BY cluster""",
    "variacao": """
        SELECT id_cliente, cluster, desvio_padrao_brl / nullif(ticket_medio_brl, 0) AS variacao FROM ranked""",
    "quartis": """
        SELECT cluster, quantile_cont(variacao, 0.25) AS q1, quantile_cont(variacao, 0.5) AS mediana, quantile_cont(variacao, 0.75) AS q3
        FROM variacao WHERE variacao IS NOT NULL GROUP BY cluster""",
    "stability": """
        SELECT v.cluster, round(q1, 6) AS q1, round(mediana, 6) AS mediana, round(q3, 6) AS q3, count(*) AS clientes,
               count(*) FILTER (variacao < q1 - 1.5 * (q3 - q1) OR variacao > q3 + 1.5 * (q3 - q1)) AS atipicos
        FROM variacao v JOIN quartis q USING (cluster) WHERE variacao IS NOT NULL GROUP BY v.cluster, q1, mediana, q3""",
    "profile": """
        SELECT cluster, count(*) AS quantidade_clientes, CAST(sum(total_receita_brl) AS DOUBLE) AS total_receita_brl,
               round(avg(ticket_medio_brl), 2) AS ticket_medio_brl, round(avg(quantidade_transacoes), 2) AS quantidade_transacoes,
               round(avg(percentual_atraso), 2) AS percentual_atraso FROM ranked GROUP BY cluster""",
    # ---- quotes
    "landed": f"""
        SELECT currency, date, buy AS buy_rate, buy + CAST(0.0101 AS DECIMAL(5,4)) AS sell_rate,
               CAST((buy + buy + CAST(0.0101 AS DECIMAL(5,4))) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(10,4)) AS average_rate
        FROM (SELECT code AS currency, day AS date,
                     CAST(base + coalesce(closing, opening) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) AS buy
              FROM bulletins, ({BASES}) bases WHERE isodow(day) < 6 AND coalesce(closing, opening) IS NOT NULL)""",
    # ---- star schema
    "span": """
        SELECT least(min(a), min(b)) AS s, greatest(max(a), max(b)) AS e FROM (
          SELECT data_vencimento AS a, data_pagamento AS b FROM s_conta_pagar
          UNION ALL SELECT data_vencimento, data_pagamento FROM s_conta_receber)""",
    "days": "SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM span",
    "date_dim1": "SELECT row_number() OVER (ORDER BY date) AS date_id, date FROM days",
    "span_r": """
        SELECT least(min(data_vencimento), min(data_pagamento)) AS s, greatest(max(data_vencimento), max(data_pagamento)) AS e
        FROM s_conta_receber""",
    "codes1": f"""
        SELECT DISTINCT code AS currency_code FROM (SELECT 'BRL' AS code UNION ALL SELECT currency FROM s_exchange_rates)""",
    "codes2": f"""
        SELECT DISTINCT currency_code FROM (SELECT currency_code FROM codes1
          UNION ALL SELECT {currency(country('pais_cliente'))} FROM s_cliente)""",
    "currency_dim1": "SELECT row_number() OVER (ORDER BY currency_code) AS currency_id, currency_code FROM codes2",
    "customer_dim": f"""
        SELECT row_number() OVER (ORDER BY early DESC, substr(md5(id_cliente), 1, 3), id_cliente) AS customer_id,
               id_cliente AS customer_code, nome_cliente AS customer_name, pais_cliente AS country,
               CASE WHEN early = 1 THEN '{FIRST_LOAD_TS}' ELSE '{RUN_TS}' END AS created_at, CAST(NULL AS BIGINT) AS ml_cluster
        FROM (SELECT c.*, CASE WHEN c.id_cliente IN (SELECT trim(id_cliente) FROM s_cliente
                                   WHERE data_cadastro_cliente < DATE '1993-01-01') THEN 1 ELSE 0 END AS early FROM clientes c)""",
    "category_dim": """
        SELECT row_number() OVER (ORDER BY tipo_categoria = 'receita' DESC, substr(md5(codigo_categoria), 1, 3), codigo_categoria) AS category_id,
               codigo_categoria AS category_code, nome_categoria AS category_name, tipo_categoria AS description FROM categorias""",
    "accounts": """
        SELECT t || '|' || category_code AS account_code, t AS account_type, category_id, description, category_code
        FROM category_dim, (SELECT unnest(['PAGAR', 'RECEBER']) AS t)""",
    "account_dim1": """
        SELECT row_number() OVER (ORDER BY substr(md5(account_code), 1, 3), account_code) AS account_id, account_code, account_type,
               category_id, category_code FROM accounts""",
    "transaction_fact": f"""
        SELECT (b << 40) + (mes << 28) + row_number() OVER (PARTITION BY b, mes ORDER BY e.tipo_conta, e.id_conta) AS transaction_id,
               c.customer_id, a.account_id, m.currency_id, d.date_id, e.valor_original AS amount_original,
               e.valor_brl AS amount_brl, e.taxa_cambio AS exchange_rate,
               strftime(e.data_referencia, '%Y-%m-%d') || ' 00:00:00' AS transaction_date, '{RUN_TS}' AS created_at
        FROM (SELECT *, CAST((year(data_referencia) - 1900) * 12 + month(data_referencia) - 1 AS BIGINT) AS mes, CAST(CAST('0x' || substr(md5(tipo_conta || '|' || id_conta), 1, 4) AS INTEGER) AS BIGINT) AS b FROM enriched) e
        JOIN account_dim1 a ON a.account_type = upper(e.tipo_conta) AND a.category_code = e.codigo_categoria
        JOIN date_dim1 d ON d.date = e.data_referencia
        JOIN currency_dim1 m ON m.currency_code = e.currency
        LEFT JOIN customer_dim c ON c.customer_code = e.id_cliente""",
    "exchange_rate_fact": f"""
        SELECT row_number() OVER (ORDER BY currency_id, date) AS rate_id, currency_id, date, buy_rate, sell_rate, average_rate,
               '{RUN_TS}' AS created_at
        FROM s_exchange_rates JOIN currency_dim1 ON currency = currency_code""",
    # ---- cluster metrics on fixed labels
    "pts": "SELECT vec_id AS id, label AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "flat": "SELECT id, cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM pts",
    "centres": "SELECT cluster, d, avg(x) AS c FROM flat GROUP BY cluster, d",
    "dist2": """
        SELECT f.id, f.cluster, sum((x - c) * (x - c)) AS d2 FROM flat f JOIN centres k ON f.cluster = k.cluster AND f.d = k.d
        GROUP BY f.id, f.cluster""",
}


# ---- segmentation: the same draws and moves of centres, written out in SQL
SEGMENT_FEATURES = [
    "total_receita_brl", "ticket_medio_brl", "quantidade_transacoes", "desvio_padrao_brl", "percentual_atraso",
    "percentual_pago", "dias_ativos",
]
GAPS = "list_transform(cs, lambda c: list_distance(c, v) ** 2)"


def _segmentation_ctes(largest: int = 6, first_seed: int = 42, restarts: int = 10, shift: str = "1e-5", steps: int = 300) -> dict[str, str]:
    scaled = ", ".join(f"CAST(CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END AS DOUBLE)" for c in SEGMENT_FEATURES)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SEGMENT_FEATURES)
    key = " || ".join(f"""'"{c}":"' || {c} || '"{"," if c != "currency" else ""}'""" for c in ("id_cliente", "nome_cliente", "pais_cliente", "currency"))
    out = {
        "km_z": f"SELECT '{{' || {key} || '}}' AS id, [{scaled}] AS v, features.* FROM features, (SELECT {stats} FROM features)",
        "km_seeds": f"SELECT CAST(r AS BIGINT) AS r FROM range({first_seed}, {first_seed + restarts}) t(r)",
    }
    for step in range(largest):
        race = f"-ln((CAST('0x' || substr(md5(id || '|' || r || '|{step}'), 1, 12) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE))"
        if step == 0:
            out["km_d0"] = f"SELECT r, [arg_min(v, {race})] AS cs FROM km_seeds, km_z GROUP BY r"
        else:
            out[f"km_d{step}"] = f"""SELECT r, list_append(cs, arg_min(v, {race} / near)) AS cs
                FROM (SELECT r, cs, id, v, list_min({GAPS}) AS near FROM km_d{step - 1}, km_z) WHERE near > 1e-12 GROUP BY r, cs"""
    means = ", ".join(f"avg(v[{j + 1}])" for j in range(len(SEGMENT_FEATURES)))
    sums = ", ".join(f"sum(v[{j + 1}])" for j in range(len(SEGMENT_FEATURES)))
    places = "range(1, len(cs) + 1)"
    out |= {
        "km_moves": f"""
            SELECT CAST(k AS BIGINT) AS k, r, 0 AS step, cs[1:k] AS cs, false AS rests FROM km_d{largest - 1}, range(2, {largest + 1}) t(k)
            UNION ALL
            SELECT k, r, step + 1, moved, list_sum(list_transform({places}, lambda i: list_distance(moved[i], cs[i]) ** 2)) <= {shift} OR step + 1 >= {steps}
            FROM (
                SELECT k, r, step, cs, list_transform({places}, lambda i: coalesce(map_from_entries(list((p, c)))[i], cs[i])) AS moved
                FROM (
                    SELECT k, r, step, cs, list_position(ds, list_min(ds)) AS p, [{means}] AS c
                    FROM (SELECT k, r, step, cs, v, {GAPS} AS ds FROM km_moves, km_z WHERE NOT rests) GROUP BY ALL
                ) GROUP BY k, r, step, cs)""",
        "km_costs": f"SELECT k, r, cs, sum(list_min({GAPS})) AS cost FROM km_moves, km_z WHERE rests GROUP BY k, r, cs",
        "km_best": "SELECT k, cs, cost FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(cost, 6), r) AS n FROM km_costs) WHERE n = 1",
        "km_labels": f"""SELECT k, id, v, list_position(ds, list_min(ds)) - 1 AS label, total_receita_brl
            FROM (SELECT k, id, v, total_receita_brl, {GAPS} AS ds FROM km_best, km_z)""",
        "km_sums": f"SELECT k, label, count(*) AS n, [{sums}] AS y, sum(list_inner_product(v, v)) AS psi FROM km_labels GROUP BY k, label",
        "km_points": """SELECT k, id, max(n) FILTER (own) AS n, max(t / nullif(n - 1, 0)) FILTER (own) AS a, min(t / n) FILTER (NOT own) AS b
            FROM (SELECT l.k, l.id, l.label = s.label AS own, s.n, s.n * list_inner_product(l.v, l.v) + s.psi - 2 * list_inner_product(l.v, s.y) AS t
                  FROM km_labels l JOIN km_sums s ON l.k = s.k) GROUP BY k, id""",
        "km_scores": """SELECT k, avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS score
            FROM km_points GROUP BY k""",
        "km_pick": "SELECT k FROM km_scores ORDER BY score DESC, k LIMIT 1",
        "km_order": """SELECT k, label, row_number() OVER (PARTITION BY k ORDER BY sum(total_receita_brl) DESC, label) - 1 AS cluster
            FROM km_labels GROUP BY k, label""",
        "km_centres": """SELECT k, label, n, list_transform(y, lambda x: x / n) AS c FROM km_sums""",
        "km_gaps": "SELECT k, l.label, list_distance(l.v, c.c) ** 2 AS d2 FROM km_labels l JOIN km_centres c USING (k, label)",
        "km_spread": "SELECT k, label, c, n, avg(sqrt(d2)) AS s, sum(d2) AS w FROM km_gaps JOIN km_centres USING (k, label) GROUP BY k, label, c, n",
        "km_bouldin": """SELECT k, avg(worst) AS davies_bouldin_index FROM (
            SELECT a.k, a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM km_spread a JOIN km_spread b ON a.k = b.k AND a.label <> b.label
            GROUP BY a.k, a.label) GROUP BY k""",
        # the scaled features have mean 0, so the length of a centre is its distance from the overall mean
        "km_harabasz": """SELECT k, sum(n * list_inner_product(c, c)) * (sum(n) - k) / (sum(w) * (k - 1)) AS calinski_harabasz_index, sum(w) AS inertia, sum(n) AS rows
            FROM km_spread GROUP BY k""",
    }
    return out


CTES |= _segmentation_ctes()


def _principal_axes(steps: int = 3000) -> dict[str, str]:
    """Two leading eigenvectors of the covariance of the scaled features: power iteration, then deflation."""
    d = len(SEGMENT_FEATURES)
    times = "list_transform(m, lambda row: list_inner_product(row, x))"
    start = f"[CAST(x AS DOUBLE) FOR x IN range(1, {d + 1})]"
    cells = ", ".join("[" + ", ".join(f"sum(v[{i + 1}] * v[{j + 1}]) / (count(*) - 1)" for j in range(d)) + "]" for i in range(d))

    def power(matrix: str, own: str) -> str:
        return f"""
            SELECT 0 AS step, m, {start} AS x FROM {matrix}
            UNION ALL
            SELECT step + 1, m, list_transform(y, lambda a: a / sqrt(list_inner_product(y, y)))
            FROM (SELECT step, m, {times} AS y FROM {own} WHERE step < {steps})"""

    def axis(own: str) -> str:  # turned so that its largest loading is positive
        big = "list_extract(x, list_position(list_transform(x, lambda a: abs(a)), list_max(list_transform(x, lambda a: abs(a)))))"
        return f"SELECT m, list_transform(x, lambda a: a * sign({big})) AS x, list_inner_product({times}, x) AS worth FROM {own} WHERE step = {steps}"

    return {
        "pca_cov": f"SELECT [{cells}] AS m FROM km_z",
        "pca_p1": power("pca_cov", "pca_p1"),
        "pca_a1": axis("pca_p1"),
        "pca_rest": f"SELECT list_transform(range(1, {d + 1}), lambda i: list_transform(range(1, {d + 1}), lambda j: m[i][j] - worth * x[i] * x[j])) AS m FROM pca_a1",
        "pca_p2": power("pca_rest", "pca_p2"),
        "pca_a2": axis("pca_p2"),
    }


CTES |= _principal_axes()


def _with(select: str) -> str:
    """``select`` with the CTEs it needs, in definition order."""
    needed, frontier = set(), [select]
    while frontier:
        text = frontier.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                frontier.append(CTES[name])
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    again = "RECURSIVE " if any(re.search(rf"\b{n}\b", CTES[n]) for n in needed) else ""
    return (f"WITH {again}{', '.join(parts)} " if parts else "") + select


def _replaced(names: str, casts: dict[str, str]) -> str:
    return ", ".join(f"{casts[n]} AS {n}" if n in casts else n for n in (c.strip() for c in names.split(",")))


LINEAGE = ["_ingestion_date", "_source", "_raw_file_path"]
SILVER_COLUMNS = {
    "meta": ["mes_meta", "meta", "meta_valor"],
    "categoria": ["codigo_categoria", "nome_categoria", "tipo_categoria"],
    "conta_pagar": ["id_conta", *[c.strip() for c in PAGAR_COLUMNS.split(",")], "tipo_conta"],
    "conta_receber": [
        "id_conta", "descricao_conta", "id_cliente", "codigo_categoria", "observacao_conta", "valor_conta",
        "data_vencimento", "data_pagamento", "status_conta", "tipo_conta",
    ],
    "cliente": ["id_cliente", "nome_cliente", "pais_cliente", "data_cadastro_cliente", "pais_cliente_normalizado"],
    "exchange_rates": ["currency", "date", "buy_rate", "sell_rate", "average_rate"],
}


def _completeness() -> str:
    rows = []
    for table, columns in SILVER_COLUMNS.items():
        for c in columns:
            rows.append(f"SELECT '{c}' AS coluna, count(*) AS linhas, count({c}) AS preenchidas, '{table}' AS tabela FROM s_{table}")
        for c in LINEAGE:
            rows.append(f"SELECT '{c}', count(*), count(*), '{table}' FROM s_{table}")
    return " UNION ALL ".join(rows)


def _score(table: str) -> str:
    columns = SILVER_COLUMNS[table]
    filled = " + ".join(f"count({c})" for c in columns) + f" + {len(LINEAGE)} * count(*)"
    width = len(columns) + len(LINEAGE)
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM s_{table}))"
    return (
        f"SELECT CASE WHEN count(*) = 0 THEN 0 ELSE round(least(100, greatest(0, "
        f"CAST({filled} AS DOUBLE) / (CAST(count(*) AS DOUBLE) * {width}) * 100 "
        f"- CAST(count(*) - {distinct} AS DOUBLE) / count(*) * 100 * 0.5)), 2) END AS score FROM s_{table}"
    )


def _unique(table: str, keys: str, label: str | None = None) -> str:
    return (
        f"SELECT '{label or table}' AS tabela, '{keys}' AS chave, count(*) AS chaves_repetidas, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS linhas_a_mais "
        f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
    )


def _orphans(child: str, column: str, parent: str, parent_column: str, label: str | None = None) -> str:
    return (
        f"SELECT '{label or child}' AS tabela, '{column}' AS coluna, count(*) AS orfaos FROM {child} c "
        f"WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    )


def _limits(table: str, label: str, limits: dict) -> list[str]:
    """limits[column] = (required, longest text, number precision or None)."""
    rows = []
    for c, (required, length, precision) in limits.items():
        wide = f"abs({c}) >= 10 ** {precision[0] - precision[1]} OR round({c}, {precision[1]}) <> {c}" if precision else "false"
        rows.append(
            f"SELECT '{label}' AS tabela, '{c}' AS coluna, count(*) FILTER ({f'{c} IS NULL' if required else 'false'}) AS nulos_indevidos, "
            f"count(*) FILTER ({f'length({c}) > {length}' if length else 'false'}) AS longos_demais, "
            f"count(*) FILTER ({wide}) AS fora_da_precisao FROM {table}"
        )
    return rows


def _latest(as_of: str) -> str:
    return (
        f"SELECT currency, max(date) AS date, max_by(buy_rate, date) AS buy_rate, max_by(sell_rate, date) AS sell_rate, "
        f"max_by(average_rate, date) AS average_rate FROM landed "
        f"WHERE date BETWEEN DATE '{as_of}' - 9 AND DATE '{as_of}' GROUP BY currency"
    )


QUOTE_DOUBLES = "CAST(buy_rate AS DOUBLE) AS buy_rate, CAST(sell_rate AS DOUBLE) AS sell_rate, CAST(average_rate AS DOUBLE) AS average_rate"
PCT = "round(CAST({0} AS DOUBLE) / CAST(sum({0}) OVER () AS DOUBLE) * 100, 4)"
FEATURES = [
    "total_receita_brl", "ticket_medio_brl", "quantidade_transacoes", "desvio_padrao_brl", "percentual_atraso",
    "percentual_pago", "dias_ativos",
]
VOLUME = "CAST(coalesce(sum(valor_original), 0) AS DOUBLE) AS total_original, CAST(coalesce(sum(valor_brl), 0) AS DOUBLE) AS total_brl, count(id_conta) AS quantidade_transacoes"
CATEGORY_SUMMARY = f"SELECT tipo_conta, codigo_categoria, nome_categoria, {VOLUME} FROM enriched GROUP BY ALL"
STAR_COUNTS = " UNION ALL ".join(
    f"SELECT '{label}' AS tabela, count(*) AS linhas FROM {table}"
    for label, table in {
        "currency_dim": "currency_dim1", "customer_dim": "customer_dim", "category_dim": "category_dim",
        "account_dim": "account_dim1", "date_dim": "date_dim1", "transaction_fact": "transaction_fact",
        "exchange_rate_fact": "exchange_rate_fact",
    }.items()
)
STAR_TYPES = {
    "customer_dim": "customer_id bigint, customer_code string, customer_name string, country string, created_at timestamp, ml_cluster int",
    "category_dim": "category_id bigint, category_code string, category_name string, description string",
    "currency_dim": "currency_id bigint, currency_code string, currency_name string, country string",
    "account_dim": "account_id bigint, account_code string, account_type string, category_id bigint",
    "date_dim": "date_id bigint, date date, year int, month int, day int, quarter int, week int, day_of_week string, is_weekend int",
    "transaction_fact": (
        "transaction_id bigint, customer_id bigint, account_id bigint, currency_id bigint, date_id bigint, amount_original decimal(18;2), "
        "amount_brl decimal(18;2), exchange_rate decimal(10;4), transaction_date timestamp, created_at timestamp"
    ),
    "exchange_rate_fact": (
        "rate_id bigint, currency_id bigint, date date, buy_rate decimal(10;4), sell_rate decimal(10;4), average_rate decimal(10;4), created_at timestamp"
    ),
}
CALENDAR = """
    date, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day,
    CAST(quarter(date) AS BIGINT) AS quarter, CAST(weekofyear(date) AS BIGINT) AS week, dayname(date) AS day_of_week,
    CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend"""
STAR_SOURCES = {
    "currency_dim": f"(SELECT *, {CURRENCY_NAME} AS currency_name, {CURRENCY_COUNTRY} AS country FROM currency_dim1)",
    "account_dim": "account_dim1",
    "date_dim": f"(SELECT date_id, {CALENDAR} FROM date_dim1)",
}
ID, MONEY, RATE = (1, None, None), (1, None, (18, 2)), (1, None, (10, 4))
STAR_LIMITS = {
    "currency_dim": {"currency_id": ID, "currency_code": (1, 3, None), "currency_name": (1, 100, None), "country": (1, 100, None)},
    "customer_dim": {
        "customer_id": ID, "customer_code": (1, 50, None), "customer_name": (1, 150, None), "country": (1, 100, None), "created_at": ID,
        "ml_cluster": (0, None, None),
    },
    "category_dim": {"category_id": ID, "category_code": (1, 50, None), "category_name": (1, 150, None), "description": (0, 500, None)},
    "account_dim": {"account_id": ID, "account_code": (1, 80, None), "account_type": (1, 50, None), "category_id": ID},
    "date_dim": {
        "date_id": ID, "date": ID, "year": ID, "month": ID, "day": ID, "quarter": ID, "week": ID, "day_of_week": (1, 20, None), "is_weekend": ID,
    },
    "transaction_fact": {
        "transaction_id": ID, "customer_id": (0, None, None), "account_id": ID, "currency_id": ID, "date_id": ID, "amount_original": MONEY,
        "amount_brl": MONEY, "exchange_rate": RATE, "transaction_date": ID, "created_at": ID,
    },
    "exchange_rate_fact": {
        "rate_id": ID, "currency_id": ID, "date": ID, "buy_rate": (0, None, (10, 4)), "sell_rate": (0, None, (10, 4)), "average_rate": RATE,
        "created_at": ID,
    },
}
AUDIT = {
    "meta_raw": "b_meta", "categoria_raw": "b_categoria", "conta_pagar_raw": "b_conta_pagar", "conta_receber_raw": "b_conta_receber",
    "cliente_raw": "b_cliente", "bcb_exchange_rates_raw": "b_exchange_rates", "meta_transformed": "s_meta",
    "categoria_transformed": "s_categoria", "conta_pagar_transformed": "s_conta_pagar",
    "conta_receber_transformed": "s_conta_receber", "cliente_transformed": "s_cliente",
    "exchange_rates_transformed": "s_exchange_rates", "transactions_enriched": "enriched", "customer_summary": "customer_summary",
    "category_summary": f"({CATEGORY_SUMMARY})",
    "monthly_summary": "(SELECT DISTINCT strftime(data_referencia, '%Y-%m'), tipo_conta FROM enriched)",
}

STATEMENTS = {
    "bronze_csv": "SELECT mes_meta, meta, 'planilha' AS origem FROM b_meta",
    "bronze_json": "SELECT CAST(id_cliente AS VARCHAR) AS id_cliente, nome_cliente, pais_cliente, data_cadastro_cliente FROM b_cliente",
    "bronze_tabular": """SELECT CAST(id_conta AS VARCHAR) AS id_conta, descricao_conta, CAST(id_cliente AS VARCHAR) AS id_cliente,
        codigo_categoria, observacao_conta, valor_conta, strftime(data_vencimento, '%Y-%m-%d') AS data_vencimento,
        strftime(data_pagamento, '%Y-%m-%d') AS data_pagamento, status, 'planilha' AS origem FROM b_conta_receber""",
    "bronze_metadata": f"""SELECT o_orderkey, '{RUN_TS}' AS _ingestion_date, 'conta_receber' AS _source,
        'orders.parquet' AS _raw_file_path FROM orders""",
    "fx_payload_flatten": f"SELECT currency, date, {QUOTE_DOUBLES} FROM landed",
    "fx_latest_in_lookback": f"SELECT currency, date, {QUOTE_DOUBLES} FROM ({_latest('2001-07-31')})",
    "fx_missing_currencies": f"""SELECT currency FROM (SELECT unnest(['USD', 'EUR', 'GBP', 'JPY', 'CAD', 'ARS']) AS currency)
        WHERE currency NOT IN (SELECT currency FROM ({_latest('2001-07-31')}))""",
    "fx_fallback_cache": f"""SELECT currency, date, {QUOTE_DOUBLES}, lote FROM (
        SELECT *, 'novo' AS lote FROM ({_latest('2001-07-20')})
        UNION ALL SELECT *, 'novo' FROM ({_latest('2001-07-31')}) WHERE (SELECT count(*) FROM ({_latest('2001-07-20')})) = 0
        UNION ALL SELECT *, 'vazio' FROM ({_latest('2023-12-31')})
        UNION ALL SELECT *, 'vazio' FROM ({_latest('2001-07-31')}) WHERE (SELECT count(*) FROM ({_latest('2023-12-31')})) = 0)""",
    "star_tables": STAR_COUNTS,
    "output_audit": " UNION ALL ".join(
        [f"SELECT '{n}' AS tabela, true AS presente, count(*) AS linhas FROM {t}" for n, t in AUDIT.items()]
        + ["SELECT 'customer_segments', false, NULL"]
    ),
    "normalize_columns": "SELECT * FROM b_categoria",
    "silver_targets": "SELECT * FROM s_meta",
    "silver_categories": "SELECT * FROM s_categoria",
    "silver_payables": "SELECT * FROM s_conta_pagar",
    "silver_receivables": "SELECT * FROM s_conta_receber",
    "silver_customers": "SELECT * FROM s_cliente",
    "silver_rates": "SELECT * FROM s_exchange_rates",
    "dedup_targets": "SELECT * FROM d_meta",
    "dedup_categories": "SELECT * FROM d_categoria",
    "dedup_payables": "SELECT * FROM d_conta_pagar",
    "dedup_receivables": "SELECT * FROM d_conta_receber",
    "dedup_customers": "SELECT * FROM d_cliente",
    "dedup_rates": "SELECT currency, date, average_rate FROM s_exchange_rates",
    "column_completeness": _completeness(),
    "quality_score": " UNION ALL ".join(f"SELECT '{t}' AS tabela, score FROM ({_score(t)})" for t in SILVER_COLUMNS),
    "silver_finalized": f"""SELECT id_conta, 'conta_receber' AS _source, '{RUN_TS}' AS _ingestion_date, '{RUN_TS}' AS _transformation_date,
        (SELECT score FROM ({_score('conta_receber')})) AS _data_quality_score FROM s_conta_receber""",
    "country_normalize": f"SELECT id_cliente, nome_cliente, {country('pais_cliente')} AS pais_normalizado FROM b_cliente",
    "country_currency": f"""SELECT id_cliente, currency_code AS currency, {CURRENCY_NAME} AS moeda, {CURRENCY_COUNTRY} AS pais_moeda
        FROM (SELECT id_cliente, {currency(country('pais_cliente'))} AS currency_code FROM s_cliente)""",
    "receivables_customer": "SELECT id_conta, id_cliente, nome_cliente, pais_cliente, currency FROM recebiveis",
    "fx_asof": """SELECT id_conta, currency, data_referencia, CAST(taxa_cambio AS DOUBLE) AS taxa_cambio FROM com_taxa
        WHERE tipo_conta = 'receber'""",
    "fx_asof_large": """SELECT p.event_id, p.user_id, coalesce(v.value, f.value) AS view_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts
        LEFT JOIN (SELECT user_id, min_by(value, ts) AS value FROM events WHERE event_type = 'view' GROUP BY user_id) f
        ON p.user_id = f.user_id""",
    "fx_unavailable": "SELECT id_cliente, pais_cliente, moeda_pais, currency FROM clientes_moeda WHERE moeda_pais <> currency",
    "rejected_transactions": """SELECT id_conta, tipo_conta, codigo_categoria, data_referencia, motivo FROM (
        SELECT *, CASE WHEN codigo_categoria NOT IN (SELECT codigo_categoria FROM categorias) THEN 'unknown account'
                       WHEN data_referencia IS NULL THEN 'no date' END AS motivo FROM movimentos) WHERE motivo IS NOT NULL""",
    "transactions_enriched": """SELECT e.* REPLACE (CAST(e.taxa_cambio AS DOUBLE) AS taxa_cambio,
        CAST(e.valor_original AS DOUBLE) AS valor_original, CAST(e.valor_brl AS DOUBLE) AS valor_brl),
        c.customer_id AS customer_dim_id, a.account_id, m.currency_id, d.date_id
        FROM enriched e
        JOIN account_dim1 a ON a.account_type = upper(e.tipo_conta) AND a.category_code = e.codigo_categoria
        JOIN date_dim1 d ON d.date = e.data_referencia
        JOIN currency_dim1 m ON m.currency_code = e.currency
        LEFT JOIN customer_dim c ON c.customer_code = e.id_cliente""",
    "date_range": "SELECT s AS start, e AS \"end\" FROM span",
    "date_dim": f"SELECT date_diff('day', (SELECT s FROM span_r), date) + 1 AS date_id, {CALENDAR} FROM days",
    "currency_dim": f"""SELECT row_number() OVER (ORDER BY late, currency_code) AS currency_id, currency_code,
        {CURRENCY_NAME} AS currency_name, {CURRENCY_COUNTRY} AS country
        FROM (SELECT currency_code, currency_code NOT IN (SELECT currency_code FROM codes1) AS late FROM codes2)""",
    "customer_dim": "SELECT * FROM customer_dim",
    "category_dim": "SELECT * FROM category_dim",
    "account_dim": """SELECT row_number() OVER (ORDER BY description = 'receita' DESC, substr(md5(account_code), 1, 3), account_code) AS account_id,
        account_code, account_type, category_id FROM accounts""",
    "transaction_fact": """SELECT * REPLACE (CAST(amount_original AS DOUBLE) AS amount_original, CAST(amount_brl AS DOUBLE) AS amount_brl,
        CAST(exchange_rate AS DOUBLE) AS exchange_rate) FROM transaction_fact""",
    "exchange_rate_fact": "SELECT * FROM exchange_rate_fact",
    "customer_clusters": """SELECT customer_id, customer_code, customer_name, country, r.cluster AS ml_cluster
        FROM customer_dim d LEFT JOIN ranked r ON d.customer_code = r.id_cliente""",
    "check_unique": " UNION ALL ".join(
        [
            _unique("b_conta_pagar", "id_conta", "conta_pagar_raw"), _unique("b_conta_receber", "id_conta", "conta_receber_raw"),
            _unique("currency_dim1", "currency_code", "currency_dim"), _unique("customer_dim", "customer_code"),
            _unique("category_dim", "category_code"), _unique("account_dim1", "account_code", "account_dim"),
            _unique("date_dim1", "date", "date_dim"), _unique("exchange_rate_fact", "currency_id,date"),
            _unique("transaction_fact", "transaction_id"),
        ]
    ),
    "check_foreign_keys": " UNION ALL ".join(
        [
            _orphans("b_conta_receber", "id_cliente", "b_cliente", "id_cliente", "conta_receber_raw"),
            _orphans("account_dim1", "category_id", "category_dim", "category_id", "account_dim"),
            _orphans("transaction_fact", "customer_id", "customer_dim", "customer_id"),
            _orphans("transaction_fact", "account_id", "account_dim1", "account_id"),
            _orphans("transaction_fact", "currency_id", "currency_dim1", "currency_id"),
            _orphans("transaction_fact", "date_id", "date_dim1", "date_id"),
            _orphans("exchange_rate_fact", "currency_id", "currency_dim1", "currency_id"),
        ]
    ),
    "check_not_null": " UNION ALL ".join(
        row for table, limits in STAR_LIMITS.items() for row in _limits(STAR_SOURCES.get(table, table), table, limits)
    ),
    "customer_summary": """SELECT * REPLACE (CAST(total_receita_original AS DOUBLE) AS total_receita_original,
        CAST(total_receita_brl AS DOUBLE) AS total_receita_brl, round(desvio_padrao_brl, 2) AS desvio_padrao_brl) FROM customer_summary""",
    "late_pct": "SELECT id_cliente, percentual_atraso FROM customer_summary",
    "paid_pct": "SELECT id_cliente, percentual_pago FROM customer_summary",
    "category_summary": CATEGORY_SUMMARY,
    "monthly_summary": f"SELECT strftime(data_referencia, '%Y-%m') AS ano_mes, tipo_conta, {VOLUME} FROM enriched GROUP BY 1, 2",
    "table_row_counts": STAR_COUNTS + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{n}', count(*) FROM {t}"
        for n, t in {"customer_summary": "customer_summary", "cliente": "s_cliente", "categoria": "s_categoria", "exchange_rates": "s_exchange_rates"}.items()
    ),
    "table_columns": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, CAST({i} AS BIGINT) AS posicao, '{c}' AS coluna, '{kind.replace(';', ',')}' AS tipo, "
        f"count({c}) AS preenchidas, count(DISTINCT {c}) AS distintas FROM {STAR_SOURCES.get(t, t)}"
        for t, columns in STAR_TYPES.items()
        for i, (c, kind) in enumerate((column.strip().split(" ") for column in columns.split(",")), 1)
    ),
    "revenue_by_account_type": f"""SELECT tipo_conta, CAST(receita AS DOUBLE) AS receita_brl, n AS quantidade_transacoes, {PCT.format('receita')} AS participacao
        FROM (SELECT tipo_conta, sum(valor_brl) AS receita, count(*) AS n FROM enriched GROUP BY 1)""",
    "revenue_by_currency": f"""SELECT currency, CAST(receita AS DOUBLE) AS receita_brl, n AS quantidade_transacoes, {PCT.format('receita')} AS participacao
        FROM (SELECT currency, sum(valor_brl) AS receita, count(*) AS n FROM enriched WHERE tipo_conta = 'receber' GROUP BY 1)""",
    "monthly_trend": """SELECT ano_mes, r AS receita_brl, n AS quantidade_transacoes,
        round((r / nullif(lag(r) OVER (ORDER BY ano_mes), 0) - 1) * 100, 4) AS crescimento_mes,
        round((r / nullif(first_value(r) OVER (ORDER BY ano_mes), 0) - 1) * 100, 4) AS crescimento_periodo
        FROM (SELECT strftime(data_referencia, '%Y-%m') AS ano_mes, CAST(sum(valor_brl) AS DOUBLE) AS r, count(*) AS n
              FROM enriched WHERE tipo_conta = 'receber' GROUP BY 1)""",
    "top_categories": f"{CATEGORY_SUMMARY} ORDER BY total_brl DESC, tipo_conta, codigo_categoria LIMIT 10",
    "top_customers": """SELECT id_cliente, nome_cliente, pais_cliente, CAST(total_receita_brl AS DOUBLE) AS total_receita_brl
        FROM customer_summary ORDER BY customer_summary.total_receita_brl DESC, id_cliente LIMIT 15""",
    "avg_rate_by_currency": """SELECT currency, round(CAST(sum(CAST(average_rate AS DECIMAL(18,4))) AS DOUBLE) / count(*), 6) AS taxa_media,
        count(*) AS cotacoes FROM s_exchange_rates GROUP BY 1""",
    "pareto_curve": """SELECT id_cliente, CAST(total_receita_brl AS DOUBLE) AS total_receita_brl, posicao, CAST(acumulado AS DOUBLE) AS acumulado,
        round(CAST(posicao AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE) * 100, 4) AS clientes_acumulado_pct,
        round(CAST(acumulado AS DOUBLE) / CAST(sum(ranked.total_receita_brl) OVER () AS DOUBLE) * 100, 4) AS receita_acumulada_pct FROM ranked""",
    "vip_split": f"""SELECT grupo, clientes, CAST(r AS DOUBLE) AS receita_brl, {PCT.format('r')} AS participacao FROM (
        SELECT CASE WHEN posicao <= (SELECT ceil(count(*) * 0.2) FROM customer_summary) THEN 'VIP' ELSE 'DEMAIS' END AS grupo,
               count(*) AS clientes, sum(total_receita_brl) AS r FROM ranked GROUP BY 1)""",
    "clusters_size_revenue": "SELECT cluster, clientes, CAST(receita_brl AS DOUBLE) AS receita_brl FROM by_cluster",
    "country_cluster_matrix": """SELECT pais_cliente, count(*) FILTER (cluster = 0) AS cluster_0, count(*) FILTER (cluster = 1) AS cluster_1,
        count(*) FILTER (cluster = 2) AS cluster_2 FROM ranked GROUP BY 1""",
    "cluster_distribution": f"SELECT cluster, clientes, {PCT.format('clientes')} AS percentual FROM by_cluster",
    "cluster_rankings": """SELECT cluster, clientes, CAST(receita_brl AS DOUBLE) AS receita_brl, rank() OVER (ORDER BY clientes DESC) AS posicao_tamanho,
        rank() OVER (ORDER BY by_cluster.receita_brl DESC) AS posicao_receita FROM by_cluster""",
    "cluster_ticket": """SELECT cluster, round(CAST(sum(total_receita_brl) AS DOUBLE) / count(*), 2) AS receita_media_brl,
        round(avg(ticket_medio_brl), 2) AS ticket_medio_brl FROM ranked GROUP BY 1""",
    "cluster_efficiency": """SELECT cluster, round(c * 100, 4) AS clientes_pct, round(r * 100, 4) AS receita_pct, round(r / c, 4) AS eficiencia FROM (
        SELECT cluster, CAST(clientes AS DOUBLE) / CAST(sum(clientes) OVER () AS DOUBLE) AS c,
               CAST(receita_brl AS DOUBLE) / CAST(sum(receita_brl) OVER () AS DOUBLE) AS r FROM by_cluster)""",
    "purchase_stability": "SELECT * FROM stability",
    "country_currency_mix": """SELECT pais_cliente, currency, cluster, count(*) AS clientes, CAST(sum(total_receita_brl) AS DOUBLE) AS receita_brl
        FROM ranked GROUP BY 1, 2, 3""",
    "cluster_profile": "SELECT * FROM profile",
    "cluster_profile_full": """SELECT p.*, m.receita_media_brl, s.q1, s.mediana, s.q3, s.atipicos FROM profile p
        JOIN (SELECT cluster, round(CAST(sum(total_receita_brl) AS DOUBLE) / count(*), 2) AS receita_media_brl FROM ranked GROUP BY 1) m USING (cluster)
        LEFT JOIN stability s USING (cluster)""",
    "segment_features": "SELECT * REPLACE (round(desvio_padrao_brl, 2) AS desvio_padrao_brl) FROM features",
    "scaled_features": "SELECT id_cliente, " + ", ".join(
        f"round(CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in FEATURES
    ) + " FROM features, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + " FROM features)",
    "silhouette_exact": """SELECT id, CAST(cluster AS BIGINT) AS cluster, round(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM (
        SELECT id, cluster, max(n) FILTER (own) AS n, max(t / nullif(n - 1, 0)) FILTER (own) AS a, min(t / n) FILTER (NOT own) AS b FROM (
          SELECT p.id, p.cluster, p.cluster = q.cluster AS own, q.cluster AS other, count(*) AS n, sum(list_distance(p.v, q.v)) AS t
          FROM pts p, pts q GROUP BY ALL) GROUP BY id, cluster)""",
    "silhouette_squared": """SELECT round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_score FROM (
        SELECT id, max(n) FILTER (own) AS n, max(t / nullif(n - 1, 0)) FILTER (own) AS a, min(t / n) FILTER (NOT own) AS b FROM (
          SELECT p.id, p.cluster = q.cluster AS own, q.cluster AS other, count(*) AS n, sum(list_distance(p.v, q.v) ** 2) AS t
          FROM pts p, pts q GROUP BY ALL) GROUP BY id)""",
    "davies_bouldin": """SELECT round(avg(worst), 6) AS davies_bouldin_index FROM (
        SELECT i.cluster, max((i.s + j.s) / g.gap) AS worst FROM (SELECT cluster, avg(sqrt(d2)) AS s FROM dist2 GROUP BY 1) i
        JOIN (SELECT cluster, avg(sqrt(d2)) AS s FROM dist2 GROUP BY 1) j ON i.cluster <> j.cluster
        JOIN (SELECT a.cluster AS x, b.cluster AS y, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS gap
              FROM centres a JOIN centres b ON a.d = b.d GROUP BY 1, 2) g ON g.x = i.cluster AND g.y = j.cluster GROUP BY 1)""",
    "calinski_harabasz": """SELECT round(bt * (n - k) / (w * (k - 1)), 6) AS calinski_harabasz_index FROM
        (SELECT sum(d2) AS w, count(*) AS n, count(DISTINCT cluster) AS k FROM dist2),
        (SELECT sum(z.n * g.d2) AS bt FROM (SELECT cluster, count(*) AS n FROM pts GROUP BY 1) z
         JOIN (SELECT cluster, sum((c - m) * (c - m)) AS d2 FROM centres JOIN (SELECT d, avg(x) AS m FROM flat GROUP BY 1) USING (d) GROUP BY 1) g
         USING (cluster))""",
    "inertia": "SELECT round(sum(d2), 4) AS inertia FROM dist2",
    "single_cluster": "SELECT id_cliente, CAST(0 AS BIGINT) AS cluster FROM customer_summary",
    "select_k": "SELECT k FROM km_pick",
    "k_analysis": "SELECT k, round(score, 6) AS silhouette_score, round(cost, 4) AS inercia FROM km_scores JOIN km_best USING (k)",
    "customer_segments": """SELECT f.* REPLACE (round(f.desvio_padrao_brl, 2) AS desvio_padrao_brl), o.cluster
        FROM km_pick JOIN km_labels l USING (k) JOIN km_order o USING (k, label)
        JOIN (SELECT * EXCLUDE (v) FROM km_z) z ON l.id = z.id JOIN features f ON f.id_cliente = z.id_cliente""",
    "cluster_metrics": "SELECT metrica, round(valor, 4) AS valor FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS metrica, CAST({value} AS DOUBLE) AS valor FROM {source} WHERE k = 3"
        for name, value, source in [
            ("k_escolhido", "k", "km_harabasz"), ("silhouette_score", "score", "km_scores"),
            ("davies_bouldin_index", "davies_bouldin_index", "km_bouldin"),
            ("calinski_harabasz_index", "calinski_harabasz_index", "km_harabasz"), ("inertia", "inertia", "km_harabasz"),
            ("n_amostras", "rows", "km_harabasz"),
        ]
    ) + ")",
    "pca_2d": """SELECT id_cliente, round(list_inner_product(v, a.x), 6) AS pc1, round(list_inner_product(v, b.x), 6) AS pc2
        FROM km_z, pca_a1 a, pca_a2 b""",
}

ORACLES = {name: _with(statement) for name, statement in STATEMENTS.items()}
