"""Broadcast only what has been measured; spread hot keys otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000
HOT_KEYS = 100
TRACKED_KEYS = 10_000
SPREAD = 4_096


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """(frame, True) with a broadcast hint when ``df`` holds at most ``max_rows`` rows.

    Counting stops once the limit is passed. Otherwise the frame comes back
    unhinted and the caller joins by shuffle.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df), True) if small else (df, False)


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """At most ``HOT_KEYS`` frequent values of ``key``, from one mergeable sketch.

    A value holding over 1% of the rows is always among them. The list only
    steers the join; a value listed or missed never changes a result.
    """
    top = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_KEYS})").alias("_top")
    )
    return top.select(F.inline("_top")).select(F.col("item").alias(key)).distinct()


def spread_left_join(
    big: DataFrame, small: DataFrame, key: str, spread_by: str, hot: DataFrame | None = None
) -> DataFrame:
    """``big LEFT JOIN small USING (key)`` where ``small`` has one row per key.

    Rows with a hot key meet the (at most ``HOT_KEYS``) matching rows by
    broadcast; for the shuffle join their key, and every null key, is swapped for
    a spread value that matches nothing. So no reducer gets a whole hot key, and
    a later grouping by ``key`` starts with a partial aggregate.
    ``key`` is text on both sides and ``hot`` lists keys of ``big``.
    """
    hot = hot_keys(big, key) if hot is None else hot
    fields = [c for c in small.columns if c != key]
    row = f"struct({', '.join(fields)})"
    few = small.join(F.broadcast(hot), key, "left_semi").selectExpr(f"{key} AS _hot_key", f"{row} AS _hot_row")
    rest = small.selectExpr(f"{key} AS _join_key", f"{row} AS _row")
    filler = f"concat('\\u0000', pmod(xxhash64({spread_by}), {SPREAD}))"
    marked = big.join(F.broadcast(few), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_spread_key", F.expr(f"if({key} IS NULL OR _hot_key IS NOT NULL, {filler}, {key})")
    )
    joined = marked.join(rest, F.col("_spread_key") == F.col("_join_key"), "left")
    return joined.selectExpr(*big.columns, *[f"coalesce(_hot_row, _row).{c} AS {c}" for c in fields])
