"""Exchange-rate resolution: latest quote on or before a day, else the earliest quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlift.functions.columns import RATE
from ledgerlift.functions.country import COUNTRY_CURRENCY, HOME_CURRENCY
from ledgerlift.operators.sizing import broadcast_if_small
from ledgerlift.sources import readers

SLICE_ROWS = 200_000
EDGES = 1_024
PARTS = 256


def rate_history(rates: DataFrame) -> DataFrame:
    """(currency, rate_date, rate) for the currencies a country can map to, one row per day."""
    used = sorted(set(COUNTRY_CURRENCY.values()) - {HOME_CURRENCY})
    return (
        rates.filter(F.upper("currency").isin(used) & F.col("date").isNotNull() & F.col("average_rate").isNotNull())
        .groupBy(F.upper("currency").alias("currency"), F.col("date").alias("rate_date"))
        .agg(F.max(F.round(F.col("average_rate").try_cast("decimal(18,6)"), 4).try_cast(RATE)).alias("rate"))
    )


def quoted_span(history: DataFrame) -> DataFrame:
    """First and last quoted day per currency: at most one row per mapped currency (5)."""
    return history.groupBy("currency").agg(
        F.min("rate_date").alias("first_quote"), F.max("rate_date").alias("last_quote")
    )


def daily_rates(history: DataFrame) -> DataFrame:
    """One row per currency and calendar day between its first and last quote.

    Each quote holds until the day before the next one. Bound: mapped currencies
    (5) x calendar days, whatever the number of transactions.
    """
    following = F.lead("rate_date").over(W.partitionBy("currency").orderBy("rate_date"))
    until = F.coalesce(F.date_sub(following, 1), F.col("rate_date"))
    return history.withColumn("_until", until).select(
        "currency", F.explode(F.sequence("rate_date", "_until")).alias("quote_day"), "rate"
    )


def clamp_day(day: Column, first: Column, last: Column) -> Column:
    """The quoted day a reference day resolves to: before the span its first day, after it its last."""
    return F.when(first.isNotNull(), F.least(F.greatest(day, first), last))


def resolve_rates(df: DataFrame, history: DataFrame, currency: str, ref_day: str, span: bool = False) -> DataFrame:
    """Add ``taxa_cambio``: home currency 1.0, else the as-of rate; null when never quoted.

    An equi-join against the daily table, broadcast because its size is bounded by
    the calendar; the fact side is not shuffled. ``span=True`` says ``df`` already
    carries first_quote / last_quote.
    """
    columns = [c for c in df.columns if c not in ("first_quote", "last_quote")]
    if not span:
        df = df.join(
            F.broadcast(quoted_span(history).withColumnRenamed("currency", currency)), currency, "left"
        )
    table = daily_rates(history).select(F.col("currency").alias("_currency"), "quote_day", F.col("rate").alias("_rate"))
    at = clamp_day(F.col(ref_day), F.col("first_quote"), F.col("last_quote"))
    joined = df.withColumn("_quote_day", at).join(
        F.broadcast(table), (F.col(currency) == F.col("_currency")) & (F.col("_quote_day") == F.col("quote_day")), "left"
    )
    one = F.lit(1).cast(RATE)
    rate = F.when(F.col(currency) == HOME_CURRENCY, one).otherwise(F.col("_rate"))
    return joined.select(*columns, rate.alias("taxa_cambio"))


def settle_currency(df: DataFrame, history: DataFrame, currency: str) -> DataFrame:
    """Currencies without any quote fall back to the home currency; adds first_quote / last_quote."""
    span = quoted_span(history).withColumnRenamed("currency", currency)
    joined = df.join(F.broadcast(span), currency, "left")
    settled = F.when(F.col("first_quote").isNull(), HOME_CURRENCY).otherwise(F.col(currency))
    return joined.withColumn(currency, settled).select(*df.columns, "first_quote", "last_quote")


def asof_by_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    value: str,
    out: str,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """As-of join against a large history: last ``right.value`` at or before ``left_time``, else the earliest.

    Of right rows with equal time the greatest value counts. A null key or time on the
    left finds nothing or the earliest value; right rows without key or time take no part.
    """
    moment = left.schema[left_time].dataType.simpleString()
    right_side = right.filter(F.col(right_time).isNotNull() & F.col(key).isNotNull()).select(
        F.lit(False).alias("_asks"),
        F.col(key).alias("_key"),
        F.col(right_time).cast(moment).alias("_time"),
        F.col(value).alias("_value"),
    )
    left_side = left.select(
        F.lit(True).alias("_asks"), F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.struct(*left.columns).alias("_row")
    )
    return _prefix_scan(left_side.unionByName(right_side, allowMissingColumns=True), left.columns, out, slice_rows)


def asof_within(
    df: DataFrame, key: str, time: str, asks: Column, tells: Column, value: str, columns: list[str], out: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``asof_by_key`` where both sides are rows of one table, which is read once.

    Rows that meet ``tells`` are the history and those that meet ``asks`` look it up and
    return ``columns`` and ``out``; a row may be both, and then sees itself.
    """
    sides = F.array_compact(
        F.array(
            F.when(tells & F.col(time).isNotNull() & F.col(key).isNotNull(), F.lit(False)), F.when(asks, F.lit(True))
        )
    )
    marked = df.filter(asks | tells).select(
        F.explode(sides).alias("_asks"),
        F.col(key).alias("_key"),
        F.col(time).alias("_time"),
        F.col(value).alias("_value"),
        F.struct(*columns).alias("_row"),
    )
    rows = marked.withColumns({"_value": F.when(~F.col("_asks"), F.col("_value")), "_row": F.when(F.col("_asks"), F.col("_row"))})
    return _prefix_scan(rows, columns, out, slice_rows)


def slices(rows: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds _bucket, _slice, _part and _single to rows (_asks, _key, _time, _number): groups of about ``slice_rows``, in time order per key.

    Keys meet in hours. Where a (key, hour) holds more, it is cut at up to ``EDGES``
    measured quantiles of its times. A time that is itself an edge is a slice of
    its own; within it no order matters, so its asking rows are dealt over parts.
    """
    hour = F.floor(F.unix_seconds(F.col("_time").cast("timestamp")) / 3600)
    rows = rows.withColumn("_bucket", hour)
    counted = rows.filter("_key IS NOT NULL AND _time IS NOT NULL").groupBy("_key", "_bucket").agg(F.count("*").alias("_n"))
    crowded, small = broadcast_if_small(counted.filter(F.col("_n") > slice_rows))
    micros = F.unix_micros(F.col("_time").cast("timestamp"))
    inside = rows.select("_key", "_bucket", micros.alias("_at")).join(crowded, ["_key", "_bucket"])
    probes = [i / EDGES for i in range(EDGES + 1)]
    measured = inside.groupBy("_key", "_bucket").agg(F.percentile_approx("_at", probes, 10_000).alias("_edges"), F.first("_n").alias("_n"))
    # as many of the measured edges as the rows ask for; a time with more rows than a slice is always among them
    every = F.greatest(F.floor(F.lit(EDGES) * slice_rows / F.col("_n")), F.lit(1))
    edges = measured.select("_key", "_bucket", F.array_distinct(F.filter("_edges", lambda e, i: i % every == 0)).alias("_edges"))
    placed = rows.join(F.broadcast(edges) if small else edges, ["_key", "_bucket"], "left")
    single = F.coalesce(F.array_contains("_edges", micros), F.lit(False)) | F.col("_time").isNull()
    below = F.size(F.filter("_edges", lambda e: e < micros))
    slice_ = F.when(F.col("_edges").isNull(), 0).otherwise(below * 2 + F.when(single, 1).otherwise(0))
    part = F.when(single & F.col("_asks"), F.pmod("_number", F.lit(PARTS))).otherwise(0)
    return placed.select(*rows.columns, slice_.alias("_slice"), part.cast("int").alias("_part"), single.alias("_single"))


def _prefix_scan(rows: DataFrame, columns: list[str], out: str, slice_rows: int) -> DataFrame:
    """Answers of the asking rows: each slice is scanned alone, and one row per slice carries what earlier ones hold."""
    rows = rows.withColumn("_number", F.monotonically_increasing_id())
    rows = readers.write_parquet(rows, readers.scratch_path(rows.sparkSession, "asof"))
    nobody = rows.filter(F.col("_asks") & F.col("_key").isNull()).select("_row.*", F.lit(None).cast(rows.schema["_value"].dataType).alias(out))
    placed = slices(rows.filter("_key IS NOT NULL"), slice_rows)
    mark = F.when(~F.col("_asks"), F.struct(F.col("_time").alias("t"), F.col("_value").alias("v")))
    placed = placed.withColumn("_mark", mark)
    group = ["_key", "_bucket", "_slice"]
    per_slice = placed.groupBy(*group).agg(
        F.max("_mark").alias("_hi"), F.min("_mark").alias("_lo"), F.max("_part").alias("_parts"), F.first("_single").alias("_single")
    )
    order = W.partitionBy("_key").orderBy("_bucket", "_slice")
    last = F.last("_hi", ignorenulls=True)
    before = last.over(order.rowsBetween(W.unboundedPreceding, -1))
    upto = last.over(order.rowsBetween(W.unboundedPreceding, 0))
    first = F.first("_lo", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    carried = per_slice.select(
        *group,
        F.coalesce(F.when(F.col("_single"), upto).otherwise(before), first).alias("_mark"),
        F.explode(F.sequence(F.lit(0), "_parts")).alias("_part"),
        F.lit(False).alias("_asks"),
    )
    # what a slice of one time holds is in its carried row already
    scanned = placed.filter(F.col("_asks") | ~F.col("_single")).select(*group, "_mark", "_part", "_asks", "_time", "_row")
    both = scanned.unionByName(carried, allowMissingColumns=True)
    running = W.partitionBy(*group, "_part").orderBy(F.col("_time").asc_nulls_first(), "_asks", "_mark").rowsBetween(W.unboundedPreceding, 0)
    found = F.last("_mark", ignorenulls=True).over(running)
    return both.withColumn("_found", found).filter("_asks").select("_row.*", F.col("_found.v").alias(out)).unionByName(nobody)
