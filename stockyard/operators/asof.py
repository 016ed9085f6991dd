"""First event strictly after a point in time, per key.

The plain form of this join compares every left row with every later right row of its key, and a window per key puts
a heavy key into one task. Here no pairs are formed and heavy keys are split:

1. Both sides shrink to distinct ``(key, instant)`` pairs, combined before the shuffle.
2. Every key is cut into hours, whatever its size. Inside one (key, hour) a framed minimum finds the next hit; the
   group is bounded by the microseconds of an hour, whatever share of the rows the key holds.
3. One row per ``(key, hour)`` is enough to find the first hit of the next non-empty hour; that window is bounded by
   the number of hours in the data's time span, under 90,000 a decade.
4. The left rows are moved once, to look up their own ``(key, instant)``. The lookup side is unique on it, so adaptive
   execution may split a heavy instant of the left side, or broadcast the lookup when it turns out to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKET_SECONDS = 3600
ASK, HIT = 1, 2


def first_after(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    out: str,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """``left`` plus the column ``out``: the earliest ``right_time`` of the same key later than ``left_time``.

    NULL keys and NULL times never match. Every left row is kept, and none is repeated.
    """

    def instants(df: DataFrame, time: str, side: int) -> DataFrame:
        return df.selectExpr(f"{by} as _k", f"{time} as _t", f"{side} as _side").where(
            "_k is not null and _t is not null"
        )

    # one aggregate for both sides keeps the uses of this frame alike, so they share its shuffle
    points = (
        instants(left, left_time, ASK)
        .unionByName(instants(right, right_time, HIT))
        .groupBy("_k", "_t")
        .agg(F.expr("bit_or(_side) as _side"))
    )
    bucket = f"unix_timestamp(_t) - pmod(unix_timestamp(_t), {bucket_seconds})"
    cut = points.selectExpr("_k", "_t", "_side", f"{bucket} as _b")
    hit_time = F.expr(f"if(_side <> {ASK}, _t, null)")

    later_here = Window.partitionBy("_k", "_b").orderBy(F.desc("_t")).rowsBetween(Window.unboundedPreceding, -1)
    near = cut.withColumn("_near", F.min(hit_time).over(later_here)).where(f"_side <> {HIT}")

    later_buckets = Window.partitionBy("_k").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    far = (
        cut.groupBy("_k", "_b")
        .agg(F.min(hit_time).alias("_first"), F.expr(f"bool_or(_side <> {HIT}) as _ask"))
        .withColumn("_far", F.min("_first").over(later_buckets))
        .where("_ask and _far is not null")
        .select("_k", "_b", "_far")
    )

    found = (
        near.join(far, ["_k", "_b"], "left")
        .selectExpr("_k", "_t", f"coalesce(_near, _far) as {out}")
        .where(f"{out} is not null")
    )
    on = F.expr(f"{by} = _k and {left_time} = _t")
    return left.join(found, on, "left").drop("_k", "_t")
