"""One row per key.

Spark puts a group limit below the shuffle of a ``row_number() = 1`` filter, so each task sends at most one row per
key and a key holding most of the rows is no bottleneck.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key: the least by its remaining columns, so that a recomputed task picks the same one.

    It is an aggregate, combined before the shuffle. Where only the keys are asked for, as by a count, the rest is
    pruned and neither read nor compared.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
    """Keep the row with the newest timestamp per key; NULL timestamps lose, the other columns break ties."""
    rest = [c for c in df.columns if c not in keys and c != newest_by]
    return _keep_first(df, keys, [F.col(newest_by).desc_nulls_last(), *rest])
