"""Totals for every context limit from an exact histogram of encoded lengths.

Documents are counted per encoded length; everything else follows from suffix
sums of that histogram. The sums run within ranges of lengths, shifted by the
totals of the later ranges, so no task needs the whole histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerlift.llm.common import cut

RANGE = 1024


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs) over all rows."""
    return lengths.filter(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def token_counts(lengths: DataFrame) -> DataFrame:
    """One row per encoded length L that occurs, for a context limit of L tokens.

    ``lengths`` has one row per document with n_tokens. Columns:

    * context_limit, docs, tokens: the length and what has exactly that length;
    * docs_at_least, tokens_at_least: suffix sums, documents of L tokens or more;
    * docs_over: documents that a limit of L cuts;
    * kept_tokens: sum of min(n_tokens, L) over all documents; lost_tokens: the rest;
    * total_docs, total_tokens; quantile: share of documents of at most L tokens.

    Between two lengths that occur the sums are linear: for a limit l between L and
    the next length, kept_tokens(l) = kept_tokens(L) + (l - L) * docs_over(L).
    Null lengths are left out; empty documents count with length 0; an empty table
    gives no rows. Equal lengths are one row.
    """
    # read twice below: kept, so that texts are encoded once
    histogram = cut(length_histogram(lengths)).select(
        F.col("n_tokens").cast("bigint").alias("context_limit"),
        "docs",
        (F.col("docs") * F.col("n_tokens")).cast("bigint").alias("tokens"),
        F.floor(F.col("n_tokens") / RANGE).alias("part"),
    )
    later = W.orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    parts = histogram.groupBy("part").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    shifts = parts.select(
        "part",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("d").over(everything).alias("total_docs"),
        F.sum("t").over(everything).alias("total_tokens"),
    )
    within = W.partitionBy("part").orderBy(F.desc("context_limit")).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = histogram.join(shifts, "part").withColumns({
        "docs_at_least": F.sum("docs").over(within) + F.col("later_docs"),
        "tokens_at_least": F.sum("tokens").over(within) + F.col("later_tokens"),
    })
    kept = F.col("total_tokens") - F.col("tokens_at_least") + F.col("context_limit") * F.col("docs_at_least")
    return summed.select(
        "context_limit", "docs", "tokens", "docs_at_least", "tokens_at_least",
        (F.col("docs_at_least") - F.col("docs")).alias("docs_over"),
        kept.alias("kept_tokens"),
        (F.col("total_tokens") - kept).alias("lost_tokens"),
        "total_docs", "total_tokens",
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("total_docs")).alias("quantile"),
    )
