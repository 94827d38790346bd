"""128-bit fingerprints of rows and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NAMES = ["_f1", "_f2"]
MASK_BITS = 60


def fingerprint(df: DataFrame, columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of ``columns``; equal values, nulls included, have equal ones.

    Spark's hash skips nulls, so which cells are null is hashed as well. Nested values
    count as their JSON text.
    """
    cells = []
    for name in columns:
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType))
        cell = F.col(f"`{name}`")
        cells.append(F.to_json(cell, {"ignoreNullFields": "false"}) if nested else cell)
    masks = []
    for low in range(0, len(columns), MASK_BITS):
        mask = F.lit(0).cast("bigint")
        for bit, name in enumerate(columns[low : low + MASK_BITS]):
            mask = mask + F.when(F.col(f"`{name}`").isNull(), F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        masks.append(mask)
    return [F.xxhash64(*masks, *cells).alias(NAMES[0]), F.xxhash64(F.lit(1), *reversed(cells), *masks).alias(NAMES[1])]
