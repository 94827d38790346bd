"""Surrogate keys without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

PREFIX_DIGITS = 3
FACT_DIGITS = 4
FACT_SHIFT = 1 << 40
GROUP_SHIFT = 1 << 28


def dense_numbers(df: DataFrame, code: str, out: str, start: Column | None = None) -> DataFrame:
    """Number rows 1..n (plus ``start``) by (md5 prefix of ``code``, ``code``).

    Each of the 4,096 prefixes is numbered apart and shifted by the counts of the
    earlier ones: a table of at most 4,096 rows, whatever the input size.
    """
    prefixed = df.withColumn("_prefix", F.substring(F.md5(F.col(code)), 1, PREFIX_DIGITS))
    before = W.orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)
    offsets = prefixed.groupBy("_prefix").count().select(
        "_prefix", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(W.partitionBy("_prefix").orderBy(code))
    base = F.lit(0) if start is None else start
    return (
        prefixed.withColumn("_rn", within)
        .join(F.broadcast(offsets), "_prefix")
        .withColumn(out, (base + F.col("_offset") + F.col("_rn")).cast("bigint"))
        .select(*df.columns, out)
    )


def next_key(existing: DataFrame | None, column: str) -> Column:
    """Largest key in use, 0 for a first load."""
    if existing is None:
        return F.lit(0).cast("bigint")
    return F.coalesce(existing.agg(F.max(column)).scalar(), F.lit(0)).cast("bigint")


def small_numbers(df: DataFrame, order: list[str], out: str, start: Column | None = None) -> DataFrame:
    """Number a code table (currencies, calendar days) in natural order."""
    base = F.lit(0) if start is None else start
    return df.withColumn(out, (base + F.row_number().over(W.orderBy(*order))).cast("bigint"))


def fact_numbers(df: DataFrame, parts: list[str], out: str, group: Column | None = None) -> DataFrame:
    """Unique, repeatable fact keys from one shuffle and one pass.

    High bits: md5 prefix of the natural key; low 40 bits: position in that prefix. With
    ``group``, a number from 0 to 4,095, the upper 12 of the low bits are the group and the
    position counts within it, so one group can be numbered again without the others.
    """
    text = F.md5(F.concat_ws("|", *parts))
    bucket = F.conv(F.substring(text, 1, FACT_DIGITS), 16, 10).cast("bigint")
    rest = [c for c in df.columns if c not in parts]  # equal parts are told apart by the other columns
    group = (F.lit(0) if group is None else group).cast("bigint")
    # one number for both, so that the sort tells nearly all rows apart by its first eight bytes
    spec = W.partitionBy("_base").orderBy(*parts, *rest)
    return (
        df.withColumn("_base", bucket * FACT_SHIFT + group * GROUP_SHIFT)
        .withColumn(out, F.col("_base") + F.row_number().over(spec))
        .select(out, *df.columns)
    )
