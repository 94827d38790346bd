"""Scalar column expressions. All stay inside JVM codegen; none raises on bad text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = "decimal(18,2)"
RATE = "decimal(10,4)"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name; two names folding to one is an error."""
    names = [c.strip().lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalisation: {sorted(names)}")
    return df.toDF(*names)


def instant(moment: datetime) -> Column:
    """A fixed time read in the session's time zone, whatever the zone of the Python process."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def trimmed(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def lowered(name: str) -> Column:
    return F.lower(trimmed(name))


def uppered(name: str) -> Column:
    return F.upper(trimmed(name))


def number(name: str) -> Column:
    """Double; bad text and NaN become null."""
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def id_text(df: DataFrame, name: str) -> Column:
    """Id as text. A floating id goes through bigint so 10.0 reads "10"."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.col(name).try_cast("bigint").cast("string")
    return F.col(name).cast("string")


def day(df: DataFrame, name: str) -> Column:
    """Date; malformed text becomes null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(F.trim(name))
    return F.col(name).cast("date")


def target_amount(text: Column) -> Column:
    """"150k" reads 150000. Each k turns into 000, so "1.5k" reads 1.5000."""
    return F.regexp_replace(F.lower(text), "k", "000").try_cast("double")


def stripped(column: str) -> str:
    """Text without the white space around it (tabs and line breaks too)."""
    return f"btrim(cast({column} AS string), ' \\t\\n\\r\\u000B\\u000C')"


def safe_text(column: str) -> str:
    """Null reads as the empty string, other values are stripped text."""
    return f"coalesce({stripped(column)}, '')"


def mid_rate(buy: Column, sell: Column) -> Column:
    return F.round((buy + sell) / 2, 4).cast(RATE)


def percent_equal(column: str, value: str) -> str:
    """Share of rows equal to ``value`` in percent; null rows count in the denominator."""
    return f"bround(avg(if({column} = '{value}', 1D, 0D)) * 100, 2)"


def zero_if_null(name: str) -> Column:
    return F.coalesce(number(name), F.lit(0.0))
