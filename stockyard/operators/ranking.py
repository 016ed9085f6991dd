"""Rank within a group without sorting the group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def rank_desc(df: DataFrame, by: list[str], measure: str, out: str) -> DataFrame:
    """``rank() over (partition by <by> order by <measure> desc)`` from the histogram of the measure.

    The window runs over one row per distinct measure value, so a group holding a third of all rows only costs as
    many rows as it has different values. Each row then looks its value up. The measure must not be NULL.
    """
    above = Window.partitionBy(*by).orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, measure]
    ranks = (
        df.groupBy(*keys).agg(F.count("*").alias("_n"))
        .withColumn(out, F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1)
        .selectExpr(*[f"{k} as _{k}" for k in keys], out)
    )
    on = F.expr(" and ".join(f"{k} <=> _{k}" for k in keys))
    return df.join(ranks, on, "left").drop(*[f"_{k}" for k in keys])
