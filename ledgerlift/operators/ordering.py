"""Global rank, running total and exact quantiles over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

EDGES = 256


def tie_digits(id_column: str) -> Column:
    """Two hex digits of the id; they order rows of equal measure before the id itself."""
    return F.substring(F.md5(F.col(id_column).cast("string")), 1, 2)


def rank_descending(
    df: DataFrame, measure: str, id_column: str, rank: str, running: str, group: list[str] | None = None
) -> DataFrame:
    """Add the 1-based position by (measure desc, tie digits, id) and the running sum of ``measure``.

    Rows are sliced at up to 256 measured quantiles. A value that is itself an
    edge gets its own slice and is split again by tie digits, so one value shared
    by a third of the rows still spreads over 256 tasks' groups. Slice totals (at
    most 514 * 256 rows) give each slice its starting rank and sum. Exact: the
    edges only steer the split. ``group`` ranks apart within a few groups
    (cluster labels). ``measure`` must not be null.
    """
    group = group or []
    probes = [i / EDGES for i in range(EDGES + 1)]
    edges = F.array_distinct(F.percentile_approx(measure, probes, 10_000))
    if group:
        edged = df.join(F.broadcast(df.groupBy(*group).agg(edges.alias("_edges"))), group)
    else:
        edged = df.withColumn("_edges", df.agg(edges).scalar())
    value = F.col(measure)
    at_edge = F.array_contains("_edges", value)
    placed = edged.select(
        *df.columns,
        tie_digits(id_column).alias("_tie"),
        (F.size(F.filter("_edges", lambda e: e > value)) * 2 + F.when(at_edge, 1).otherwise(0)).alias("_slice"),
        F.when(at_edge, tie_digits(id_column)).otherwise(F.lit("")).alias("_part"),
    )
    slices = [*group, "_slice", "_part"]
    earlier = W.partitionBy(*group).orderBy("_slice", "_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*slices)
        .agg(F.count("*").alias("_n"), F.sum(measure).alias("_s"))
        .select(
            *slices,
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
            F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s0"),
        )
    )
    inside = W.partitionBy(*slices).orderBy(F.desc(measure), "_tie", id_column)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        placed.withColumn("_rn", F.row_number().over(inside))
        .withColumn("_run", F.sum(measure).over(upto))
        .join(F.broadcast(starts), slices)
        .select(
            *df.columns,
            (F.col("_n0") + F.col("_rn")).cast("bigint").alias(rank),
            (F.col("_s0") + F.col("_run")).alias(running),
        )
    )


def quantiles(df: DataFrame, group: str, measure: str, id_column: str, probes: dict[str, float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one row per group.

    Read off the distributed rank, so no group is gathered into one buffer.
    """
    ranked = rank_descending(df.select(group, id_column, measure), measure, id_column, "_rank", "_sum", [group])
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"))
    placed = ranked.join(F.broadcast(sizes), group).withColumn("_up", F.col("_n") - F.col("_rank"))
    picks = []
    for name, p in probes.items():
        at = (F.col("_n") - 1) * p
        low = F.max(F.when(F.col("_up") == F.floor(at), F.col(measure)))
        high = F.max(F.when(F.col("_up") == F.ceil(at), F.col(measure)))
        weight = F.max(at - F.floor(at))
        picks.append((low + (high - low) * weight).alias(name))
    return placed.groupBy(group).agg(*picks)


def ntile_of(rank: Column, total: Column, tiles: int) -> Column:
    """SQL ``ntile`` from a rank and the row count."""
    size = F.floor(total / tiles)
    extra = total % tiles
    wide = extra * (size + 1)
    late = extra + F.ceil((rank - wide) / F.greatest(size, F.lit(1)))
    return F.when(rank <= wide, F.ceil(rank / (size + 1))).otherwise(late).cast("bigint")
