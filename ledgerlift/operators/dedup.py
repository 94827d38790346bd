"""One row per key, with a survivor that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerlift.operators.fingerprint import NAMES, fingerprint
from ledgerlift.operators.sizing import BROADCAST_ROWS, broadcast_if_small

# From this share of repeated rows on, all rows are ranked in one shuffle.
MANY_REPEATS = 0.1
# A key with a larger share of the rows is hot; the sketch that tells so tracks many more keys than can be.
HOT_SHARE = 0.01
TRACKED_KEYS = 1_000


def _repeated(df: DataFrame, keys: list[str]) -> tuple[DataFrame | None, bool]:
    """Fingerprints of the keys that several rows hold, to broadcast; None where they are too many. And whether a key is hot.

    One scan without a shuffle settles most tables: a repeated key takes two rows, and a
    sketch of the keys (good to 2%) tells when many rows repeat. Only between the two are
    they counted.
    """
    marks = fingerprint(df, keys)
    scanned = df.select(marks[0]).agg(
        F.count("*"), F.approx_count_distinct(NAMES[0], 0.02), F.expr(f"approx_top_k({NAMES[0]}, 1, {TRACKED_KEYS})")
    )
    rows, different, top = scanned.first()
    hot = any(item["count"] > HOT_SHARE * rows for item in top)
    repeated = df.select(*marks).groupBy(*NAMES).count().filter("count > 1").select(*NAMES)
    if rows <= 2 * BROADCAST_ROWS:
        return F.broadcast(repeated), hot
    if rows - different > max(MANY_REPEATS * rows, BROADCAST_ROWS):
        return None, hot
    repeated, small = broadcast_if_small(repeated)
    return (repeated if small else None), hot


def _one_per_key(df: DataFrame, keys: list[str], pick, ascending: bool) -> DataFrame:
    """Rows whose key stands alone pass as they are; only the others meet as structs.

    Which keys repeat comes from a hash aggregate over fingerprints of the keys, two
    numbers a row. Two keys that share a fingerprint by chance take the exact way too,
    so the result never rests on the hash. Where very many keys repeat, all rows meet in
    one shuffle and are sorted there; only if a key is hot does every task sort its own
    rows too, to send no more than its first row of each key.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    repeated, hot = _repeated(df, keys)
    if repeated is None:
        order = [F.col(f"`{c}`").asc_nulls_first() if ascending else F.col(f"`{c}`").desc_nulls_last() for c in rest]
        spec = W.partitionBy(*keys).orderBy(*order)
        # Spark limits a rank in every task before the shuffle, and so sorts twice; not so a row that has none before it
        first = F.row_number().over(spec) == 1 if hot else F.lag(F.lit(1)).over(spec).isNull()
        return df.withColumn("_first", first).filter("_first").select(*df.columns)
    marked = df.select("*", *fingerprint(df, keys))
    alone = marked.join(repeated, NAMES, "left_anti").select(*df.columns)
    kept = marked.join(repeated, NAMES, "left_semi").groupBy(*keys).agg(pick(F.struct(*rest)).alias("_kept"))
    return alone.unionByName(kept.select(*[c if c in keys else F.col(f"_kept.`{c}`").alias(c) for c in df.columns]))


def keep_least(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the least row of each key, comparing the other columns in order (nulls first).

    Copies of a hot key collapse before the shuffle, by an aggregate or by rank, so a key
    that holds a third of the rows sends one row per task.
    """
    return _one_per_key(df, keys, F.min, True)


def keep_greatest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the greatest row of each key ("last one wins" made repeatable)."""
    return _one_per_key(df, keys, F.max, False)
