"""Exchange-rate quotes from landed payload files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlift.functions.columns import RATE, instant, mid_rate

# Days looked back and currencies quoted by default.
LOOKBACK_DAYS = 10
DEFAULT_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "ARS"]
PAYLOAD_SCHEMA = f"value array<struct<cotacaoCompra:{RATE},cotacaoVenda:{RATE}>>"


def flatten_payloads(payloads: DataFrame) -> DataFrame:
    """Last element of ``value`` as one quote row; payloads without quotes are left out."""
    last = F.try_element_at(F.from_json("payload", PAYLOAD_SCHEMA).getField("value"), F.lit(-1))
    buy, sell = F.col("_last.cotacaoCompra"), F.col("_last.cotacaoVenda")
    return (
        payloads.withColumn("_last", last)
        .filter(F.col("_last").isNotNull())
        .select(
            "currency",
            F.col("quote_date").alias("date"),
            buy.alias("buy_rate"),
            sell.alias("sell_rate"),
            mid_rate(buy, sell).alias("average_rate"),
        )
    )


def in_lookback(date: Column, as_of: Column, days: int = LOOKBACK_DAYS) -> Column:
    return date.between(F.date_sub(as_of, days - 1), as_of)


def latest_quotes(
    quotes: DataFrame, as_of: Column, currencies: list[str] | None = None, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Newest quote per configured currency inside the lookback window ending at ``as_of``."""
    fields = [c for c in quotes.columns if c != "currency"]
    newest = (
        quotes.filter(F.col("currency").isin(currencies or DEFAULT_CURRENCIES) & in_lookback(F.col("date"), as_of, days))
        .groupBy("currency")
        .agg(F.max(F.struct("date", *[c for c in fields if c != "date"])).alias("_q"))
    )
    return newest.select("currency", *[F.col(f"_q.{c}").alias(c) for c in fields])


def missing_currencies(spark: SparkSession, latest: DataFrame, currencies: list[str] | None = None) -> DataFrame:
    """Configured currencies that got no quote."""
    wanted = spark.createDataFrame([(c,) for c in (currencies or DEFAULT_CURRENCIES)], "currency string")
    return wanted.join(F.broadcast(latest.select("currency").distinct()), "currency", "left_anti")


def with_quote_lineage(quotes: DataFrame, run_ts: datetime, source: str = "bcb_ptax") -> DataFrame:
    return quotes.select("*", instant(run_ts).alias("_ingestion_date"), F.lit(source).alias("_source"))


def fresh_or_cached(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    """The fresh batch, or the last persisted batch when the fresh one is empty; decided inside the query."""
    empty = fresh.agg(F.count("*") == 0).scalar()
    return fresh.unionByName(cached.select(*fresh.columns).filter(empty))


def require_quotes(quotes: DataFrame) -> DataFrame:
    """Fail when neither a fresh nor a cached quote exists."""
    if quotes.isEmpty():
        raise RuntimeError("no exchange-rate quote in the lookback window and none persisted")
    return quotes
