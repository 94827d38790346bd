import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlift.sources import quotes, readers
from ledgerlift.sources.json_arrays import json_elements

RUN_TS = datetime(2024, 1, 1)


def test_csv_with_lineage(spark, tmp_path):
    path = tmp_path / "metas.csv"
    path.write_text("quantia,nota\n7.25,a\n9.5,b\n")
    df = readers.with_lineage(readers.read_csv(spark, str(path)), "metas", RUN_TS)
    got = df.collect()
    assert len(got) == 2
    assert {r._source for r in got} == {"metas"}
    assert {r._ingestion_date for r in got} == {RUN_TS}
    assert all(r._raw_file_path.endswith("metas.csv") for r in got)
    assert dict(df.dtypes)["quantia"] == "double"


def test_parquet_exports_follow_the_same_rules(spark, rows, tmp_path):
    path = str(tmp_path / "metas.parquet")
    spark.createDataFrame([(" 150k", 7, "2024-01")], "` Meta ` string, EXTRA int, MES_META string").write.option("x", 1).parquet(path)
    df = readers.read_tabular(spark, path, readers.SCHEMAS["meta"])
    assert df.columns == ["mes_meta", "meta", "extra"] and rows(df) == [("2024-01", " 150k", 7)]
    with pytest.raises(ValueError, match="id_conta"):
        readers.read_tabular(spark, path, readers.SCHEMAS["conta_pagar"])


def test_csv_is_read_by_header_name(spark, rows, tmp_path):
    """Another order, padded upper-case names and a column nobody declared."""
    path = tmp_path / "metas.csv"
    path.write_text(" Meta ,EXTRA,mes_meta\n150k,x,2024-01\n,y,2024-02\n")
    df = readers.read_csv(spark, str(path), readers.SCHEMAS["meta"])
    assert df.columns == ["mes_meta", "meta", "extra"]
    assert rows(df) == [("2024-01", "150k", "x"), ("2024-02", None, "y")]
    path.write_text("meta,extra\n150k,x\n")
    with pytest.raises(ValueError, match="mes_meta"):
        readers.read_csv(spark, str(path), readers.SCHEMAS["meta"])


def test_json_keeps_undeclared_fields(spark, rows, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps([{"nivel": 3, "nome_cliente": "Ana", "id_cliente": 7}]))
    df = readers.read_json(spark, str(path), readers.SCHEMAS["cliente"])
    assert rows(df, "id_cliente", "nome_cliente", "pais_cliente", "nivel") == [("7", "Ana", None, "3")]


def test_json_array_object_and_lines(spark, tmp_path):
    array, single, lines = tmp_path / "a.json", tmp_path / "o.json", tmp_path / "l.json"
    people = [{"id_cliente": "1", "nome_cliente": "Ana"}, {"id_cliente": "2", "nome_cliente": "Bia"}]
    array.write_text(json.dumps(people, indent=1))
    single.write_text(json.dumps(people[0]))
    lines.write_text(json.dumps(people) + "\n" + json.dumps(people[0]) + "\n")
    schema = readers.SCHEMAS["cliente"]
    assert readers.read_json(spark, str(array), schema).count() == 2
    assert readers.read_json(spark, str(single), schema).count() == 1
    assert readers.read_json(spark, str(lines), schema, multi_line=False).count() == 3


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    """Braces, brackets and quotes inside strings, nested objects, elements that cross byte ranges."""
    pick = random.Random(6)
    parts = ["}", "{", "]", "[", '"', "\\", '\\"}', "},{", "é", "日本", " ", "x", "\n", "]}"]
    people = []
    for i in range(1_500):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(12)))
        people.append({"id_cliente": str(i), "nome_cliente": text * (400 if i == 700 else 1), "extra": {"a": [{"b": text}], "}": None}})
    held = {(p["id_cliente"], p["nome_cliente"], json.dumps(p["extra"]["a"], ensure_ascii=False)) for p in people}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for name, text in {"flat": json.dumps(people), "pretty": json.dumps(people, indent=2, ensure_ascii=False), "mixed": " [1, \"}\", " + json.dumps(people)[1:]}.items():
            path = tmp_path / f"{name}.json"
            path.write_text(text)
            elements = json_elements(spark, str(path))
            assert sorted(r.value for r in elements.collect()) != [] and elements.rdd.getNumPartitions() > 20
            got = [json.loads(r.value) for r in elements.collect()]
            assert {(p["id_cliente"], p["nome_cliente"], json.dumps(p["extra"]["a"], ensure_ascii=False)) for p in got} == held and len(got) == 1_500
        read = readers.read_json_array(spark, str(path), readers.SCHEMAS["cliente"])
        assert {(r.id_cliente, r.nome_cliente) for r in read.collect()} == {h[:2] for h in held}
        (tmp_path / "one.json").write_text('{"id_cliente": "7", "nome_cliente": "{}", "x": {"y": {}}}\n')
        assert [r.nome_cliente for r in readers.read_json_array(spark, str(tmp_path / "one.json"), readers.SCHEMAS["cliente"]).collect()] == ["{}"]
        (tmp_path / "none.json").write_text("[]")
        assert json_elements(spark, str(tmp_path / "none.json")).collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_written_table_and_gold_copies(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, nome string")
    table = readers.write_gold(df, str(tmp_path / "t"))
    assert table.count() == 2
    assert readers.read_csv(spark, str(tmp_path / "t.csv")).count() == 2


def payloads(spark):
    def body(*pairs):
        return json.dumps({"value": [{"cotacaoCompra": b, "cotacaoVenda": s} for b, s in pairs]})

    return spark.createDataFrame(
        [
            ("USD", date(2024, 1, 2), body((4.9, 4.92), (5.0, 5.01))),
            ("USD", date(2024, 1, 6), body()),
            ("USD", date(2023, 12, 1), body((4.5, 4.6))),
            ("EUR", date(2023, 12, 20), body((5.3, 5.4))),
            ("GBP", date(2024, 1, 5), "{}"),
        ],
        readers.SCHEMAS["quote_payload"],
    )


def test_payload_takes_last_element(spark, rows):
    got = rows(quotes.flatten_payloads(payloads(spark)), "currency", "date", "buy_rate", "average_rate")
    assert [(c, str(d), float(b), float(a)) for c, d, b, a in got] == [
        ("EUR", "2023-12-20", 5.3, 5.35),
        ("USD", "2023-12-01", 4.5, 4.55),
        ("USD", "2024-01-02", 5.0, 5.005),
    ]


def test_latest_in_lookback_and_missing(spark, rows):
    flat = quotes.flatten_payloads(payloads(spark))
    latest = quotes.latest_quotes(flat, F.lit(date(2024, 1, 6)))
    assert rows(latest, "currency", "date") == [("USD", date(2024, 1, 2))]
    # the window holds ten days: 2024-01-11 still sees the second, the twelfth does not
    assert quotes.latest_quotes(flat, F.lit(date(2024, 1, 11))).count() == 1
    assert quotes.latest_quotes(flat, F.lit(date(2024, 1, 12))).count() == 0
    assert rows(quotes.missing_currencies(spark, latest)) == [("ARS",), ("CAD",), ("EUR",), ("GBP",), ("JPY",)]


def test_fallback_to_persisted(spark):
    flat = quotes.flatten_payloads(payloads(spark))
    empty = flat.filter("currency = 'none'")
    assert quotes.fresh_or_cached(empty, flat).count() == 3
    assert quotes.fresh_or_cached(flat.limit(1), flat).count() == 1
    with pytest.raises(RuntimeError):
        quotes.require_quotes(quotes.fresh_or_cached(empty, empty))
