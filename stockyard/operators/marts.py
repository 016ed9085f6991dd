"""The eight gold marts.

``since`` is the highest value of the mart's date column that is already stored. It is applied to the raw input
timestamp as well, where it reaches the scan, because a bound on a truncated date does not.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from stockyard.functions.exprs import (
    epoch, exact_avg, hour, hours_between, moment, money_sum, percent, ratio, rounded, today, trunc_to,
)
from stockyard.operators.asof import first_after
from stockyard.operators.ranking import rank_desc

SLA_TARGET_HOURS = 48
OUTBOUND_STATUS = "8"
SLA_STATUSES = ["pending", "on_time_express", "on_time", "at_risk", "late"]
HEALTH_LEVELS = ["critical", "high", "medium", "healthy"]
RISK_LEVELS = ["stockout", "critical", "high", "medium", "low"]
SHIFTS = ["morning", "afternoon", "night"]
PLACE = ["cidade", "uf", "estado", "regiao", "latitude", "longitude"]


def _newer(df: DataFrame, column: str, since: date | datetime | Column | None) -> DataFrame:
    if since is None:
        return df
    return df.where(F.col(column) > (since if isinstance(since, Column) else moment(since)))


def sla_status(hours: Column) -> Column:
    return (
        F.when(hours.isNull(), "pending")
        .when(hours <= 24, "on_time_express")
        .when(hours <= 48, "on_time")
        .when(hours <= 72, "at_risk")
        .otherwise("late")
    )


def order_sla(orders: DataFrame, movements: DataFrame, since: datetime | None = None) -> DataFrame:
    """Cycle time and service level per order; an order without delivery date takes the depositor's next outbound
    movement as its proxy."""
    issued = _newer(orders.where("issued_at is not null"), "issued_at", since).select(
        "order_id", "document_number", "document_type", "company_id", "depositor_id", "issued_at", "delivered_at",
        "total_value",
    )
    outbound = _newer(movements.where(F.col("movement_status") == OUTBOUND_STATUS), "movement_date", since)
    resolved = F.coalesce("delivered_at", "delivered_at_proxy")
    return (
        first_after(issued, outbound, "depositor_id", "issued_at", "movement_date", "delivered_at_proxy")
        .withColumn("resolved_delivered_at", resolved)
        .withColumn("cycle_time_hours", hours_between("issued_at", "resolved_delivered_at"))
        .select(
            "order_id", "document_number", "document_type", "company_id", "depositor_id", "issued_at",
            "delivered_at", "delivered_at_proxy", "resolved_delivered_at", "total_value",
            F.lit(SLA_TARGET_HOURS).alias("sla_target_hours"),
            trunc_to("day", "issued_at").alias("issued_date"),
            trunc_to("month", "issued_at").alias("issued_month"),
            "cycle_time_hours",
            sla_status(F.col("cycle_time_hours")).alias("sla_status"),
            F.col("resolved_delivered_at").isNotNull().alias("sla_met"),
        )
    )


def _days_of_cover() -> Column:
    used = F.col("avg_consumption")
    return F.when(used > 0, F.round(ratio(F.col("min_stock_qty"), used), 1))


def inventory_health(inventory: DataFrame) -> DataFrame:
    stock, used, ideal = F.col("min_stock_qty"), F.col("avg_consumption"), F.col("ideal_stock_qty")
    cover = ratio(stock, used)
    risk = (
        F.when((used == 0) & (stock == 0), "critical")
        .when(used == 0, "healthy")
        .when(cover <= 3, "critical")
        .when(cover <= 7, "high")
        .when(cover <= 14, "medium")
        .otherwise("healthy")
    )
    return inventory.select(
        "inventory_id", "product_id", "warehouse_id", "company_id", "product_class", "min_stock_qty",
        "max_stock_qty", "ideal_stock_qty", "safety_stock_qty", "reorder_point", "avg_consumption",
        _days_of_cover().alias("coverage_days"),
        F.when(ideal > 0, F.round(ratio(stock, ideal), 2)).alias("stock_utilization_rate"),
        risk.alias("stockout_risk"),
        F.coalesce(stock <= F.col("safety_stock_qty"), F.lit(False)).alias("below_safety_stock"),
        F.coalesce(stock <= F.col("reorder_point"), F.lit(False)).alias("below_reorder_point"),
    )


def stockout_risk(inventory: DataFrame, as_of: date | datetime) -> DataFrame:
    """Days until the stock runs out; the level is read off the rounded days."""
    days, stock = F.col("days_to_stockout"), F.col("current_stock")
    level = (
        F.when(days.isNull() & (stock == 0), "stockout")
        .when(days.isNull(), "low")
        .when(days <= 0, "stockout")
        .when(days <= 3, "critical")
        .when(days <= 7, "high")
        .when(days <= 14, "medium")
        .otherwise("low")
    )
    return inventory.select(
        "inventory_id", "product_id", "warehouse_id", "company_id", "product_class",
        F.col("min_stock_qty").alias("current_stock"), "safety_stock_qty", "reorder_point",
        F.col("avg_consumption").alias("avg_daily_consumption"),
        _days_of_cover().alias("days_to_stockout"),
    ).select("*", level.alias("risk_level"), today(as_of).alias("snapshot_date"))


def operator_productivity(movements: DataFrame, since: datetime | Column | None = None) -> DataFrame:
    """Movements per operator, warehouse and day, ranked inside the warehouse and day."""
    delta = F.col("qty_delta")
    daily = (
        _newer(movements.where("operator_user is not null and movement_date is not null"), "movement_date", since)
        .groupBy("operator_user", "warehouse_id", trunc_to("day", "movement_date").alias("period_date"))
        .agg(
            F.count("*").alias("movement_count"),
            F.sum(F.abs(delta)).alias("total_qty_handled"),
            F.count_if(delta < 0).alias("outbound_count"),
            F.count_if(delta > 0).alias("inbound_count"),
            F.count_distinct("product_id").alias("distinct_skus"),
        )
    )
    moves = F.col("movement_count")
    scored = _newer(daily, "period_date", since).select(
        "*",
        F.round(ratio(F.col("outbound_count") * 1.5 + F.col("inbound_count"), moves), 3).alias("complexity_index"),
        F.round(ratio(F.col("total_qty_handled"), moves), 2).alias("avg_qty_per_move"),
    )
    return rank_desc(scored, ["warehouse_id", "period_date"], "movement_count", "daily_ranking")


def picking_performance(movements: DataFrame, since: datetime | Column | None = None) -> DataFrame:
    """Outbound movements per operator, warehouse, day and shift. The hours of a night count with their own calendar
    date. The rate divides by the rounded hours."""
    at = hour("movement_date")
    shift = F.when(at.between(6, 13), "morning").when(at.between(14, 21), "afternoon").otherwise("night")
    picks = _newer(
        movements.where("qty_delta < 0 and operator_user is not null and movement_date is not null"),
        "movement_date", since,
    )
    grouped = picks.groupBy(
        "operator_user", "warehouse_id", trunc_to("day", "movement_date").alias("shift_date"), shift.alias("shift"),
    ).agg(
        F.count("*").alias("picks_count"),
        F.sum(F.abs("qty_delta")).alias("total_qty_picked"),
        F.count_distinct("product_id").alias("distinct_skus_picked"),
        F.min("movement_date").alias("shift_start"),
        F.max("movement_date").alias("shift_end"),
    )
    hours = F.col("active_hours")
    return (
        _newer(grouped, "shift_date", since)
        .withColumn("active_hours", rounded(hours_between("shift_start", "shift_end"), 2))
        .withColumn("picks_per_hour", F.when(hours > 0, F.round(ratio(F.col("picks_count"), hours), 2)))
    )


def _cycle_seconds() -> Column:
    return epoch("delivered_at") - epoch("issued_at")


def _mean_hours(seconds: str = "_seconds") -> Column:
    return ratio(F.sum(seconds), F.count(seconds)) / F.lit(3600.0)


def _place_of(geo: DataFrame, entity_type: str) -> DataFrame:
    return geo.where(F.col("entity_type") == entity_type).select(
        "entity_id", F.col("localidade").alias("cidade"), "uf", "estado", "regiao", "latitude", "longitude",
    )


def _without_place(df: DataFrame) -> DataFrame:
    types = ["string", "string", "string", "string", "decimal(10,6)", "decimal(11,6)"]
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(PLACE, types)])


def geo_performance(orders: DataFrame, geo: DataFrame | None = None, since: datetime | None = None) -> DataFrame:
    """Service level per company, depositor and month, measured on the recorded delivery date, with the company's
    place or else the depositor's. Both shares are of all orders of the group."""
    late_after = SLA_TARGET_HOURS * 3600
    monthly = (
        _newer(orders.where("issued_at is not null"), "issued_at", since)
        .withColumn("_seconds", _cycle_seconds())
        .groupBy("company_id", "depositor_id", trunc_to("month", "issued_at").alias("issued_month"))
        .agg(
            F.count("*").alias("order_count"),
            F.count("delivered_at").alias("delivered_count"),
            money_sum("total_value").alias("total_value"),
            _mean_hours().alias("avg_cycle_time_hours"),
            percent(F.count_if(F.col("_seconds") <= late_after), F.count("*"), 2).alias("sla_compliance_pct"),
            percent(F.count_if(F.col("_seconds") > late_after), F.count("*"), 2).alias("late_delivery_pct"),
        )
    )
    monthly = _newer(monthly, "issued_month", since)
    if geo is None:
        return _without_place(monthly)
    company = _place_of(geo, "company").alias("c")
    depositor = _place_of(geo, "warehouse").alias("d")
    return (
        monthly.alias("m")
        .join(company, F.col("c.entity_id") == F.col("m.company_id"), "left")
        .join(depositor, F.col("d.entity_id") == F.col("m.depositor_id"), "left")
        .select("m.*", *[F.coalesce(f"c.{p}", f"d.{p}").alias(p) for p in PLACE])
    )


def geo_inventory(inventory: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    """Stock position per warehouse, company and product class, with the warehouse's place."""
    stock, safety, used = F.col("min_stock_qty"), F.col("safety_stock_qty"), F.col("avg_consumption")
    grouped = inventory.groupBy("warehouse_id", "company_id", "product_class").agg(
        F.count_distinct("product_id").alias("product_count"),
        F.sum("min_stock_qty").alias("total_current_stock"),
        F.sum("safety_stock_qty").alias("total_safety_stock"),
        F.sum("ideal_stock_qty").alias("total_ideal_stock"),
        F.round(exact_avg(F.when(used > 0, ratio(stock, used))), 1).alias("avg_coverage_days"),
        F.count_if(stock <= safety).alias("stockout_count"),
        F.count_if(stock <= F.col("reorder_point")).alias("below_reorder_count"),
        percent(F.count_if(stock > safety), F.count("*"), 2).alias("stock_health_pct"),
    )
    if geo is None:
        return _without_place(grouped)
    place = _place_of(geo, "warehouse").alias("g")
    return (
        grouped.alias("i")
        .join(place, F.col("g.entity_id") == F.col("i.warehouse_id"), "left")
        .select("i.*", *[f"g.{p}" for p in PLACE])
    )


WEATHER = ["weather_condition", "avg_temperature_c", "precipitation_mm", "wind_speed_kmh"]


def weather_impact(
    orders: DataFrame,
    geo: DataFrame | None = None,
    weather: DataFrame | None = None,
    since: date | None = None,
) -> DataFrame:
    """Delays per company, depositor and day beside the weather in the company's state on that day."""
    late_after = SLA_TARGET_HOURS * 3600
    late = F.count_if(F.col("_seconds") > late_after)
    daily = (
        _newer(orders.where("issued_at is not null"), "issued_at", since)
        .withColumn("_seconds", _cycle_seconds())
        .groupBy(
            "company_id", "depositor_id", F.to_date("issued_at").alias("issued_date"),
            trunc_to("month", "issued_at").alias("issued_month"),
        )
        .agg(
            F.count("*").alias("order_count"),
            _mean_hours().alias("avg_cycle_time_hours"),
            late.alias("delayed_order_count"),
            percent(late, F.count("*"), 2).alias("delay_rate_pct"),
        )
    )
    if since is not None:
        daily = daily.where(F.col("issued_date") > today(since))
    if geo is None or weather is None:
        types = ["string", "decimal(5,2)", "decimal(8,2)", "decimal(6,2)"]
        return daily.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(WEATHER, types)])
    state = geo.where("entity_type = 'company'").select(F.col("entity_id"), F.col("uf")).alias("g")
    return (
        daily.alias("o")
        .join(state, F.col("g.entity_id") == F.col("o.company_id"), "left")
        .join(
            weather.select("location_uf", "weather_date", *WEATHER).alias("w"),
            (F.col("w.location_uf") == F.col("g.uf")) & (F.col("w.weather_date") == F.col("o.issued_date")),
            "left",
        )
        .select("o.*", *[f"w.{c}" for c in WEATHER])
    )
