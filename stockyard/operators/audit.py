"""Audits over bronze and gold: layer summary, gaps, duplicates, orphans, coverage, freshness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from stockyard.functions.exprs import epoch, moment, percent, ratio, trunc_to
from stockyard.operators.marts import OUTBOUND_STATUS

# Fixed values shown by the gap report.
NO_DATA, HAS_DATA = "❌ SEM DADOS", "✅ OK"
# Fixed values naming the two classes of orphan movements.
BEFORE_EXTRACTION, WITHIN_PERIOD = "anterior_ao_periodo_de_extracao", "dentro_do_periodo"


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_summary(tables: dict[str, tuple[DataFrame, str | None, str]]) -> DataFrame:
    """Per table: rows, first and last date, rows without watermark. The value is (table, date column, watermark)."""

    def one(name: str, df: DataFrame, dated: str | None, watermark: str) -> DataFrame:
        at = F.col(dated) if dated else F.lit(None).cast("timestamp_ntz")
        return df.agg(
            F.count("*").alias("row_count"), F.min(at).alias("first_date"), F.max(at).alias("last_date"),
            F.count_if(F.col(watermark).isNull()).alias("null_watermarks"),
        ).select(F.lit(name).alias("table_name"), "*")

    return _stack([one(name, *spec) for name, spec in tables.items()])


def _days_seen(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    return (
        df.where((F.col(column) >= moment(start)) & (F.col(column) < moment(end)))
        .select(F.to_date(column).alias("day")).distinct()
    )


def gaps(
    orders: DataFrame, movements: DataFrame, as_of: date | datetime, days: int = 90, limit: int = 20,
) -> DataFrame:
    """Calendar days before ``as_of`` on which a table received nothing, newest first."""
    end = as_of.date() if isinstance(as_of, datetime) else as_of
    start = end - timedelta(days=days)
    spark = orders.sparkSession
    calendar = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end - timedelta(days=1)))).alias("day")
    )
    # at most `days` rows on either side
    had_orders = F.broadcast(_days_seen(orders, "dataemissao", start, end).withColumn("_o", F.lit(True)))
    had_moves = F.broadcast(_days_seen(movements, "datamovimento", start, end).withColumn("_m", F.lit(True)))
    return (
        calendar.join(had_orders, "day", "left").join(had_moves, "day", "left")
        .where("_o is null or _m is null")
        .select(
            "day",
            F.when(F.col("_o").isNull(), NO_DATA).otherwise(HAS_DATA).alias("orders"),
            F.when(F.col("_m").isNull(), NO_DATA).otherwise(HAS_DATA).alias("movements"),
        )
        .orderBy(F.desc("day")).limit(limit)
    )


def duplicate_keys(df: DataFrame, key: str, name: str, limit: int = 10) -> DataFrame:
    return (
        df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
        .select(F.lit(name).alias("table_name"), "key", "occurrences")
        .orderBy(F.desc("occurrences"), F.asc_nulls_last("key")).limit(limit)
    )


def orphans(movements: DataFrame, orders: DataFrame) -> DataFrame:
    """Outbound movements without an order of the same depositor on or before them.

    Some earlier order exists exactly when the depositor's first order is not later, so one row per depositor is
    enough and no movement is compared with every order.
    """
    first_order = (
        orders.where("depositor_id is not null").groupBy("depositor_id").agg(F.min("issued_at").alias("_first"))
    )
    covered = F.coalesce(F.col("_first") <= F.col("movement_date"), F.lit(False))
    return (
        movements.where(F.col("movement_status") == OUTBOUND_STATUS)
        .join(first_order, "depositor_id", "left").where(~covered).drop("_first")
    )


def orphan_count(movements: DataFrame, orders: DataFrame) -> DataFrame:
    return orphans(movements, orders).agg(F.count("*").alias("orphan_movements"))


def orphan_months(movements: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        orphans(movements, orders)
        .groupBy(F.to_date(trunc_to("month", "movement_date")).alias("month"), "movement_status")
        .agg(
            F.count("*").alias("total"),
            F.count_distinct("depositor_id").alias("distinct_depositors"),
            F.count_distinct("product_id").alias("distinct_products"),
            F.to_date(F.min("movement_date")).alias("first_day"),
            F.to_date(F.max("movement_date")).alias("last_day"),
        )
        .orderBy(F.desc_nulls_first("month"))
    )


def orphan_class(movements: DataFrame, orders: DataFrame) -> DataFrame:
    """Orphans before the first order of the whole table, and the others."""
    first_of_all = orders.agg(F.min("issued_at")).scalar()
    before = F.col("movement_date") < first_of_all
    return (
        orphans(movements, orders)
        .groupBy(F.when(before, BEFORE_EXTRACTION).otherwise(WITHIN_PERIOD).alias("orphan_class"))
        .agg(
            F.count("*").alias("total"),
            F.to_date(F.min("movement_date")).alias("first_day"),
            F.to_date(F.max("movement_date")).alias("last_day"),
        )
    )


def delivery_coverage(sla: DataFrame) -> DataFrame:
    real, proxy = F.col("delivered_at").isNotNull(), F.col("delivered_at_proxy").isNotNull()
    return sla.agg(
        F.count("*").alias("orders"),
        F.count_if(real).alias("with_delivery"),
        F.count_if(~real & proxy).alias("proxy_only"),
        F.count_if(~real & ~proxy).alias("with_neither"),
        percent(F.count("resolved_delivered_at"), F.count("*"), 1).alias("resolved_pct"),
    )


def status_share(sla: DataFrame, since: date | datetime) -> DataFrame:
    """Orders per status with their share of all. The total window sees one row per status, of which there are five."""
    counts = (
        sla.where(F.col("issued_at") >= moment(since)).groupBy("sla_status").agg(F.count("*").alias("orders"))
    )
    total = F.sum("orders").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("orders"), total, 1)).orderBy(F.desc("orders"), "sla_status")


def active_clients(sla: DataFrame, since: date | datetime) -> DataFrame:
    return (
        sla.where(F.col("issued_at") >= moment(since))
        .groupBy(F.to_date(trunc_to("month", "issued_at")).alias("month"))
        .agg(F.count_distinct("depositor_id").alias("active_clients"), F.count("*").alias("orders"))
        .orderBy(F.desc("month"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]).orderBy("table_name")


def freshness(
    tables: dict[str, DataFrame], as_of: datetime, limits: dict[str, int] | int = 26, loaded: str = "_cdc_loaded_at",
) -> DataFrame:
    """Last load and its age per table: OK or STALE against a limit in hours, WARN for an empty table."""

    def limit_of(name: str) -> int:
        return limits if isinstance(limits, int) else limits[name]

    rows = _stack([
        df.agg(F.max(loaded).alias("last_load"), F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "last_load", "row_count", F.lit(limit_of(name)).alias("limit_hours")
        )
        for name, df in tables.items()
    ])
    age = (epoch(moment(as_of)) - epoch("last_load")) / F.lit(3600.0)
    status = (
        F.when(F.col("last_load").isNull(), "WARN").when(age <= F.col("limit_hours"), "OK").otherwise("STALE")
    )
    return rows.select("*", age.alias("age_hours"), status.alias("status")).orderBy(
        F.desc_nulls_first("last_load"), "table_name"
    )


def recency(tables: dict[str, tuple[DataFrame, str]], as_of: datetime, max_days: int = 2) -> DataFrame:
    """Newest business date per gold table against a limit in days."""
    rows = _stack([
        df.agg(F.max(F.col(at).cast("timestamp_ntz")).alias("latest"), F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "latest", "row_count")
        for name, (df, at) in tables.items()
    ])
    age = (epoch(moment(as_of)) - epoch("latest")) / F.lit(86400.0)
    status = F.when(F.col("latest").isNull(), "WARN").when(age <= max_days, "OK").otherwise("STALE")
    return rows.select("*", age.alias("age_days"), status.alias("status"))


def freshness_summary(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and newest value of one column per table, across the layers."""
    return _stack([
        df.agg(F.count("*").alias("row_count"), F.max(F.col(at).cast("timestamp_ntz")).alias("latest"))
        .select(F.lit(label).alias("label"), "row_count", "latest")
        for label, (df, at) in tables.items()
    ])


def silver_metrics(entity: str, bronze: DataFrame, key: str, run_id: str) -> DataFrame:
    """Rows in, rows out and rows dropped as duplicates of one silver step."""
    per_key = bronze.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_read"), F.count("*").alias("rows_written"),
    ).select(
        F.lit(entity).alias("entity"), "rows_read", "rows_written",
        (F.col("rows_read") - F.col("rows_written")).alias("rows_deduplicated"), F.lit(run_id).alias("run_id"),
    )


def date_profile(df: DataFrame, first: str, second: str) -> DataFrame:
    """Range and gaps of two date columns and of the first one present."""
    either = F.coalesce(first, second)
    return df.agg(
        F.count("*").alias("row_count"),
        F.min(first).alias("min_first"), F.max(first).alias("max_first"),
        F.min(second).alias("min_second"), F.max(second).alias("max_second"),
        F.count_if(F.col(first).isNull()).alias("null_first"),
        F.min(either).alias("min_either"), F.max(either).alias("max_either"),
    )


def pending_alarm(sla: DataFrame, share: float = 0.95, days: int = 30) -> DataFrame:
    """Runs of more than ``days`` consecutive days on which more than ``share`` of the orders are pending.

    The orders shrink to one row per day first; the ordered window then covers the calendar only.
    """
    daily = (
        sla.groupBy(F.to_date("issued_at").alias("day"))
        .agg(ratio(F.count_if(F.col("sla_status") == "pending"), F.count("*")).alias("_share"))
        .where(F.col("_share") > share)
    )
    run = F.date_sub("day", F.row_number().over(Window.partitionBy().orderBy("day")))
    return (
        daily.withColumn("_run", run).groupBy("_run")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"))
        .where(F.col("days") > days).drop("_run")
    )


def daily_sketches(df: DataFrame, at: str, columns: Sequence[str], precision: int = 14) -> DataFrame:
    """One mergeable sketch of the different values of each column per day, to be stored beside a table: a few kilobytes,
    whatever the number of rows. The days of a load are added or replaced without reading any other."""
    return df.where(F.col(at).isNotNull()).groupBy(F.to_date(at).alias("day")).agg(
        *[F.hll_sketch_agg(c, F.lit(precision)).alias(c) for c in columns]
    )


def distinct_from_sketches(sketches: DataFrame, columns: Sequence[str], grain: str = "month") -> DataFrame:
    """Approximate number of different values per ``grain``, from the sketches of its days. With a precision of 14 the
    standard error is below one per cent."""
    return sketches.groupBy(F.to_date(F.date_trunc(grain, "day")).alias(grain)).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns]
    )


def distinct_check(df: DataFrame, at: str, column: str, bound: float = 0.03) -> DataFrame:
    """Per month the exact number of different values, and whether the sketches' answer lies within ``bound`` of it."""
    exact = df.where(F.col(at).isNotNull()).groupBy(F.to_date(trunc_to("month", at)).alias("month")).agg(F.count_distinct(column).alias("exact"))
    near = distinct_from_sketches(daily_sketches(df, at, [column]), [column]).withColumnRenamed(column, "approximate")
    return exact.join(near, "month").select(
        "month", "exact", (F.abs(F.col("approximate") - F.col("exact")) <= F.col("exact") * bound).alias("within")
    )
