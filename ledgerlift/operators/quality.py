"""Completeness, the quality score and the star-schema constraint checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlift.operators.fingerprint import NAMES, fingerprint


def _filled(df: DataFrame, name: str) -> Column:
    """1 for a filled cell; NaN counts as empty, as null does."""
    column = F.col(f"`{name}`")
    empty = column.isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        empty = empty | F.isnan(column)
    return F.when(~empty, 1)


def column_completeness(df: DataFrame) -> DataFrame:
    """(column, total rows, filled rows) from one aggregate."""
    counts = df.agg(
        F.count("*").alias("_total"),
        *[F.count(_filled(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("coluna"), F.col("_total").alias("linhas"), F.col(f"n{i}").alias("preenchidas"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(cells))


def quality_score(df: DataFrame) -> DataFrame:
    """One row ``score``: completeness % - half the duplicate %, clamped to 0..100.

    Rows are told apart by 128-bit fingerprints, so the shuffle carries four numbers per
    distinct row, whatever the width of the table.
    """
    filled = reduce(lambda a, b: a + b, [F.coalesce(_filled(df, c), F.lit(0)) for c in df.columns])
    rows = df.select(*fingerprint(df, df.columns), filled.cast("bigint").alias("_filled"))
    totals = rows.groupBy(*NAMES).agg(F.count("*").alias("_n"), F.sum("_filled").alias("_filled")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("_filled"), F.lit(0)).alias("filled"),
        F.count("*").alias("distinct_rows"),
    )
    total = F.greatest(F.col("total"), F.lit(1)).cast("double")
    completeness = F.col("filled") / (total * len(df.columns)) * 100
    duplicates = (F.col("total") - F.col("distinct_rows")) / total * 100
    score = F.least(F.lit(100.0), F.greatest(F.lit(0.0), completeness - duplicates * 0.5))
    return totals.select(F.when(F.col("total") == 0, 0.0).otherwise(F.round(score, 2)).alias("score"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Unique-key check: (table, key, number of keys held by several rows, rows over)."""
    groups = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return groups.agg(
        F.count("*").alias("chaves_repetidas"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("linhas_a_mais"),
    ).select(F.lit(table).alias("tabela"), F.lit(",".join(keys)).alias("chave"), "chaves_repetidas", "linhas_a_mais")


def orphan_rows(child: DataFrame, parent: DataFrame, child_name: str, column: str, parent_column: str) -> DataFrame:
    """Foreign-key check: filled child keys without a parent row.

    Child keys are counted first, so a hot key costs one row per task in the join.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_fk")).count()
    missing = used.join(parent.select(F.col(parent_column).alias("_fk")).distinct(), "_fk", "left_anti")
    return missing.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("orfaos")).select(
        F.lit(child_name).alias("tabela"), F.lit(column).alias("coluna"), "orfaos"
    )


# A limit of a column: (nullable, longest text, (precision, scale)); None where there is none.
Limit = tuple[bool, int | None, tuple[int, int] | None]
BROKEN = ["nulos_indevidos", "longos_demais", "fora_da_precisao"]


def limit_counts(limits: dict[str, Limit]) -> list[Column]:
    """Cells that break each limit, three counts per column; for an aggregate or for ``DataFrame.observe``."""
    never = F.lit(None).cast("int")
    counts = []
    for name, (nullable, length, precision) in limits.items():
        cell = F.col(name)
        wide = never
        if precision is not None:
            whole = F.lit(10 ** (precision[0] - precision[1])).cast("decimal(38,0)")
            wide = F.when((F.abs(cell) >= whole) | (F.round(cell, precision[1]) != cell), 1)
        broken = [
            F.when(cell.isNull(), 1) if not nullable else never,
            F.when(F.length(cell.cast("string")) > length, 1) if length is not None else never,
            wide,
        ]
        counts += [F.count(b).alias(f"{name}:{kind}") for b, kind in zip(broken, BROKEN)]
    return counts


def broken_limits(counts: dict[str, int]) -> list[str]:
    """Columns with a count above zero, from ``limit_counts`` as collected by an observation."""
    return sorted({name.split(":")[0] for name, n in counts.items() if n})


def limit_violations(df: DataFrame, table: str, limits: dict[str, Limit]) -> DataFrame:
    """(table, column, forbidden nulls, texts too long, numbers out of precision); one aggregate per table."""
    cells = [
        F.struct(F.lit(name).alias("coluna"), *[F.col(f"`{name}:{kind}`").alias(kind) for kind in BROKEN]) for name in limits
    ]
    packed = df.agg(*limit_counts(limits)).select(F.inline(F.array(*cells)))
    return packed.select(F.lit(table).alias("tabela"), "coluna", *BROKEN)
