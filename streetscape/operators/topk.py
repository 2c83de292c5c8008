"""Skew-safe first-k-per-group.

A plain ``row_number`` window sends each group to one task; a group holding a third of all rows
would stall one executor. Here rows are first ranked inside (group, salt) buckets, only the best
k of every bucket survive, and a second window ranks those few (at most k x salts per group).
The result is exact: the global first k of a group are always among its buckets' first k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
    salts: int = 32,
    salt_on: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of every ``keys`` group under ``order``; add 1-based ``rank_col``.

    ``salt_on`` columns (default: all columns) feed the salt hash; ties in ``order`` must be broken
    by the caller for a deterministic result.
    """
    if k <= 0:
        return df.limit(0).withColumn(rank_col, F.lit(0))
    salt_cols = [F.col(c) for c in (salt_on or df.columns)]
    keyed = df
    if salts > 1:
        keyed = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_cols), F.lit(salts)))
        w1 = Window.partitionBy(*keys, "__salt").orderBy(*order)
        keyed = keyed.withColumn("__r1", F.row_number().over(w1)).filter(F.col("__r1") <= k).drop("__r1", "__salt")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return keyed.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)
