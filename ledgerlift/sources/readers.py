"""File sources with declared schemas, lineage columns and sinks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlift.functions.columns import instant, normalize_columns
from ledgerlift.sources.json_arrays import json_elements

# Declared bronze schemas; text first, silver casts.
SCHEMAS = {
    "meta": "mes_meta STRING, meta STRING",
    "categoria": "codigo_categoria STRING, nome_categoria STRING, tipo_categoria STRING",
    "conta_pagar": (
        "id_conta STRING, descricao_conta STRING, destino_pagamento_conta STRING, codigo_categoria STRING, "
        "valor_conta STRING, data_vencimento STRING, data_pagamento STRING, status_conta STRING"
    ),
    "conta_receber": (
        "id_conta STRING, descricao_conta STRING, id_cliente STRING, codigo_categoria STRING, "
        "observacao_conta STRING, valor_conta STRING, data_vencimento STRING, data_pagamento STRING, status STRING"
    ),
    "cliente": "id_cliente STRING, nome_cliente STRING, pais_cliente STRING, data_cadastro_cliente STRING",
    "exchange_rates": (
        "currency STRING, date DATE, buy_rate DECIMAL(10,4), sell_rate DECIMAL(10,4), average_rate DECIMAL(10,4)"
    ),
    "quote_payload": "currency STRING, quote_date DATE, payload STRING",
}


def conform(df: DataFrame, schema: str, complete: bool = True) -> DataFrame:
    """The declared columns by name, cast to their types, then the undeclared ones as they are.

    Names are compared after normalisation. A declared column that is missing is an
    error, or all null unless the source must be ``complete``.
    """
    df = normalize_columns(df)
    declared = {f.name: f.dataType for f in T._parse_datatype_string(schema)}
    missing = [c for c in declared if c not in df.columns]
    if missing and complete:
        raise ValueError(f"columns missing from the file: {missing}")
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
    others = [c for c in df.columns if c not in declared]
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in declared.items()], *[F.col(f"`{c}`") for c in others])


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header, read by column name; undeclared columns stay, as text.

    Files of one folder must agree in their headers. Without a schema the types
    are inferred (one more pass over the files).
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return conform(reader.csv(path), schema) if schema else reader.option("inferSchema", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True) -> DataFrame:
    """JSON array or single object per file; with ``multi_line=False`` per line, which Spark can split.

    Undeclared fields stay, as text. Their names take one more pass over the files.
    """
    reader = spark.read.option("multiLine", multi_line)
    return conform(reader.option("primitivesAsString", True).json(path), schema, complete=False) if schema else reader.json(path)


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Like ``read_json`` for large arrays: many tasks a file. The elements are written as JSON lines and read from there."""
    lines = scratch_path(spark, "elements")
    json_elements(spark, path).write.text(lines)
    return read_json(spark, lines, schema, multi_line=False)


def read_tabular(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Tabular export of a spreadsheet sheet: Parquet when the path says so, else CSV.

    Both forms are read by the same rules: names normalised, declared columns cast and
    required, undeclared ones kept.
    """
    if path.rstrip("/").endswith(".parquet"):
        table = spark.read.parquet(path)
        return conform(table, schema) if schema else table
    return read_csv(spark, path, schema)


def with_lineage(df: DataFrame, source: str, run_ts: datetime, file_path: str | None = None) -> DataFrame:
    """Stamp _ingestion_date, _source and _raw_file_path (from the scan unless a path is given)."""
    path = F.col("_metadata.file_path") if file_path is None else F.lit(file_path)
    return df.select(
        "*",
        instant(run_ts).alias("_ingestion_date"),
        F.lit(source).alias("_source"),
        path.alias("_raw_file_path"),
    )


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite ``path`` and return the written table, so consumers never recompute the plan."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MONTH = "ano_mes"
MONTH_FILES = 16


def write_months(df: DataFrame, path: str, day: str) -> DataFrame:
    """Write ``df`` in folders by the month of ``day``; only the months that ``df`` holds are replaced.

    So a month can be reloaded alone, and a filter on ``ano_mes`` reads its folder alone. Rows
    gather by month in up to ``MONTH_FILES`` tasks each, so a month is a few files, not one per task.
    """
    by_month = df.withColumn(MONTH, F.date_format(day, "yyyy-MM"))
    salt = F.pmod(F.xxhash64(*[f"`{c}`" for c in df.columns]), F.lit(MONTH_FILES))
    spread = by_month.withColumn("_salt", salt).repartition(MONTH, "_salt").drop("_salt")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return df.sparkSession.read.schema(by_month.schema).parquet(path)


def write_gold(df: DataFrame, path: str, order: list[str] | None = None) -> DataFrame:
    """Parquet and CSV copies, the CSV written from the Parquet table, sorted by ``order`` (default: the first column)."""
    table = write_parquet(df, f"{path}.parquet")
    table.orderBy(*(order or df.columns[:1])).write.mode("overwrite").option("header", True).csv(f"{path}.csv")
    return table


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Full refresh of a relational table; one connection per partition."""
    df.write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=properties)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of spark.checkpoint.dir, else in the warehouse folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/ledgerlift/{uuid.uuid4().hex}/{name}"
