import json
import pathlib
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlift.plans import gold, pipeline
from ledgerlift.plans.segmentation import Settings
from ledgerlift.sources.readers import SCHEMAS


def land(folder, customers):
    (folder / "meta.csv").write_text("mes_meta,meta\n2024-01,150k\n")
    (folder / "categoria.csv").write_text("codigo_categoria,nome_categoria,tipo_categoria\nA,Venda,Receita\nX,Luz,Despesa\n")
    (folder / "pagar.csv").write_text(
        "id_conta,descricao_conta,destino_pagamento_conta,codigo_categoria,valor_conta,data_vencimento,data_pagamento,status_conta\n"
        "p1,Luz,CPFL,X,80.5,2024-01-05,,Pendente\n"
    )
    lines = "".join(
        f"r{i},Venda,{c['id_cliente']},A,,{100 + i},2024-01-0{i + 1},2024-01-0{i + 2},Pago\n" for i, c in enumerate(customers)
    )
    (folder / "receber.csv").write_text(
        "id_conta,descricao_conta,id_cliente,codigo_categoria,observacao_conta,valor_conta,data_vencimento,data_pagamento,status\n" + lines
    )
    (folder / "cliente.json").write_text(json.dumps(customers))
    names = {"meta": "meta.csv", "categoria": "categoria.csv", "conta_pagar": "pagar.csv", "conta_receber": "receber.csv", "cliente": "cliente.json"}
    return {k: str(folder / v) for k, v in names.items()}


def people(n):
    return [{"id_cliente": str(i), "nome_cliente": f"N{i}", "pais_cliente": "EUA", "data_cadastro_cliente": "2023-01-01"} for i in range(n)]


def test_two_runs(spark, tmp_path):
    body = json.dumps({"value": [{"cotacaoCompra": 4.9, "cotacaoVenda": 5.1}]})
    payloads = spark.createDataFrame([("USD", date(2024, 1, 2), body)], SCHEMAS["quote_payload"])
    preset = Settings(n_clusters=2, restarts=2)
    first = pipeline.Run(spark, str(tmp_path / "run1"), datetime(2024, 1, 31))
    pipeline.run_all(first, land(tmp_path, people(3)), payloads, date(2024, 1, 4), preset)
    assert first.read("transactions_enriched").count() == 4
    assert first.read("customer_summary").agg({"total_receita_brl": "sum"}).first()[0] == 1515
    labelled = {r.customer_code: r for r in first.read("customer_dim").collect()}
    assert all(r.ml_cluster in (0, 1) for r in labelled.values())

    # the second run finds no quote and takes the persisted one; known customers keep their keys
    second = pipeline.Run(spark, str(tmp_path / "run2"), datetime(2024, 2, 29), first.root)
    pipeline.run_all(second, land(tmp_path, people(4)), payloads, date(2024, 2, 28), preset)
    again = {r.customer_code: r for r in second.read("customer_dim").collect()}
    assert set(again) == {"0", "1", "2", "3"}
    assert all(again[c].customer_id == r.customer_id and again[c].created_at == r.created_at for c, r in labelled.items())
    assert all(r.ml_cluster in (0, 1) for r in again.values())  # the dimension carries this run's labels
    assert second.read("transaction_fact").count() == 5
    assert {r.currency for r in second.read("missing_quotes").collect()} == {"USD", "EUR", "GBP", "JPY", "CAD", "ARS"}
    assert {r.currency for r in first.read("missing_quotes").collect()} == {"EUR", "GBP", "JPY", "CAD", "ARS"}
    with pytest.raises(ValueError, match="folder"):
        pipeline.Run(spark, second.root, datetime(2024, 3, 31), second.root + "/")

    # facts are kept by month: a filter reads one folder, and a month is reloaded alone
    facts = second.read("transaction_fact")
    plan = facts.filter("ano_mes = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_mes" in plan
    held = {r.transaction_id: r for r in facts.collect()}
    old = pathlib.Path(second.path("transaction_fact") + ".parquet")
    stays = old / "ano_mes=1999-12"
    shutil.copytree(next(old.glob("ano_mes=*")), stays)
    before = {f.name for f in stays.iterdir()}
    pipeline.reload_months(second, ["2024-01"])
    assert {f.name for f in stays.iterdir()} == before
    again = second.read("transaction_fact").filter("ano_mes > '1999-12'").collect()
    assert {r.transaction_id: r for r in again} == held
    shutil.rmtree(stays)
    exported = sorted(pathlib.Path(second.path("monthly_summary") + ".csv").glob("*.csv"))
    lines = [line for f in exported for line in f.read_text().splitlines()[1:]]
    assert [tuple(line.split(",")[:2]) for line in lines] == sorted(tuple(line.split(",")[:2]) for line in lines)
    assert second.broken["transaction_fact"] == [] and set(second.broken) == set(gold.LIMITS)

    # a broken dimension is refused before anything is published
    dims = {n: second.read(f"{n}_dim") for n in ("date", "currency", "customer", "category", "account")}
    facts, quoted = second.read("transaction_fact"), second.read("exchange_rate_fact")
    pipeline.require_constraints(dims, facts, quoted)
    twice = dims | {"customer": dims["customer"].union(dims["customer"].limit(1))}
    with pytest.raises(ValueError, match="customer_dim: repeated customer_code"):
        pipeline.require_constraints(twice, facts, quoted)
    nameless = dims | {"customer": dims["customer"].withColumn("customer_name", F.lit(None).cast("string"))}
    with pytest.raises(ValueError, match="customer_dim: customer_name"):
        pipeline.require_constraints(nameless, facts, quoted)
    with pytest.raises(ValueError, match="customer_dim: customer_name"):
        pipeline.require_constraints(dims, facts, quoted, {"customer_dim": ["customer_name"]})
    with pytest.raises(ValueError, match="transaction_fact: orphans in account_id"):
        pipeline.require_constraints(dims | {"account": dims["account"].limit(0)}, facts, quoted)
