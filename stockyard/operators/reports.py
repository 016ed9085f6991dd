"""Dashboard panels, chart queries, summaries and revenue reports over the gold layer."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from stockyard.functions.exprs import (
    epoch, exact_avg, lenient_double, moment, money_avg, money_sum, percent, ratio, today, trunc_to,
)

ON_TIME = ["on_time_express", "on_time"]
# Fixed values labelling the age classes of open orders.
AGE_CLASSES = ["1_0-7d", "2_7-30d", "3_30-90d", "4_>90d"]


def time_range(df: DataFrame, column: str, start: date | datetime, end: date | datetime) -> DataFrame:
    """Rows within a dashboard's time range, both ends included."""
    return df.where(F.col(column).between(moment(start), moment(end)))


def _on_time() -> Column:
    return F.count_if(F.col("sla_status").isin(ON_TIME))


# ---- operations panels

def kpis(sla: DataFrame) -> DataFrame:
    """Orders, open orders, late orders in one pass."""
    return sla.agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("sla_status") == "pending").alias("open_orders"),
        F.count_if(F.col("sla_status") == "late").alias("late_orders"),
    )


def movement_count(movements: DataFrame) -> DataFrame:
    return movements.agg(F.count("*").alias("movements"))


def items_at_risk(risk: DataFrame) -> DataFrame:
    return risk.agg(F.count_if(F.col("risk_level").isin("critical", "stockout")).alias("items_at_risk"))


def on_time_pct(sla: DataFrame) -> DataFrame:
    return sla.where("sla_status <> 'pending'").agg(percent(_on_time(), F.count("*"), 1).alias("on_time_pct"))


def moves_per_day(movements: DataFrame, start: datetime, end: datetime) -> DataFrame:
    return (
        time_range(movements, "movement_date", start, end)
        .groupBy(trunc_to("day", "movement_date").alias("time")).agg(F.count("*").alias("movements"))
        .orderBy("time")
    )


def status_pivot(sla: DataFrame) -> DataFrame:
    statuses = {"on_time_express": "express", "on_time": "on_time", "at_risk": "at_risk", "late": "late",
                "pending": "pending"}
    return sla.agg(*[F.count_if(F.col("sla_status") == s).alias(name) for s, name in statuses.items()])


def month_company(sla: DataFrame, limit: int = 24) -> DataFrame:
    return (
        sla.groupBy(F.date_format("issued_at", "yyyy-MM").alias("month"), "company_id")
        .agg(
            F.count("*").alias("orders"),
            F.round(money_sum("total_value"), 2).alias("total_value"),
            percent(_on_time(), F.count("*"), 1).alias("sla_pct"),
        )
        .orderBy(F.desc_nulls_first("month"), F.asc_nulls_last("company_id")).limit(limit)
    )


def monthly_revenue(orders: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    return (
        orders.where(F.col("issued_at") >= moment(as_of - timedelta(days=days)))
        .groupBy(F.date_format("issued_at", "yyyy-MM").alias("month"))
        .agg(F.round(money_sum("total_value"), 2).alias("revenue"))
        .orderBy("month")
    )


def document_types(orders: DataFrame, limit: int = 20) -> DataFrame:
    return (
        orders.groupBy("document_type", "company_id")
        .agg(F.count("*").alias("orders"), money_avg("total_value").alias("mean_value"))
        .orderBy(F.desc("orders"), F.asc_nulls_last("document_type"), F.asc_nulls_last("company_id")).limit(limit)
    )


def top_operators(productivity: DataFrame, limit: int = 20) -> DataFrame:
    """Means are of the daily rows, unweighted. The largest daily rank is the worst place; the best is beside it."""
    return (
        productivity.groupBy("operator_user")
        .agg(
            F.sum("movement_count").alias("movements"),
            F.round(exact_avg("avg_qty_per_move"), 2).alias("qty_per_move"),
            F.round(exact_avg("complexity_index"), 3).alias("complexity"),
            F.max("daily_ranking").alias("max_rank"),
            F.min("daily_ranking").alias("best_rank"),
        )
        .orderBy(F.desc("movements"), "operator_user").limit(limit)
    )


def _age_seconds(as_of: datetime) -> Column:
    return epoch(moment(as_of)) - epoch("issued_at")


def backlog_ageing(sla: DataFrame, as_of: datetime) -> DataFrame:
    days = _age_seconds(as_of) / F.lit(86400.0)
    a, b, c, d = AGE_CLASSES
    age = F.when(days <= 7, a).when(days <= 30, b).when(days <= 90, c).otherwise(d)
    return (
        sla.where("sla_status = 'pending'").groupBy(age.alias("age_class")).agg(F.count("*").alias("orders"))
        .orderBy("age_class")
    )


def oldest_open(sla: DataFrame, as_of: datetime, limit: int = 15) -> DataFrame:
    return (
        sla.where("sla_status = 'pending'")
        .select(
            "order_id", "document_number", "company_id", "issued_at",
            F.round(_age_seconds(as_of) / F.lit(3600.0), 1).alias("age_hours"),
            F.round("total_value", 2).alias("total_value"),
        )
        .orderBy(F.asc_nulls_last("issued_at"), "order_id").limit(limit)
    )


def stockout_table(risk: DataFrame, limit: int = 20) -> DataFrame:
    severity = (
        F.when(F.col("risk_level") == "stockout", 0).when(F.col("risk_level") == "critical", 1)
        .when(F.col("risk_level") == "high", 2).when(F.col("risk_level") == "medium", 3).otherwise(4)
    )
    return (
        risk.orderBy(severity, F.asc_nulls_last("product_id"), F.asc_nulls_last("warehouse_id"), "inventory_id")
        .limit(limit)
        .select(
            "product_id", "warehouse_id", "product_class", "current_stock",
            F.round("avg_daily_consumption", 1).alias("daily_consumption"),
            F.round("days_to_stockout", 1).alias("days_to_stockout"), "risk_level",
        )
    )


# ---- geographic panels

def _places_with_sla(geo: DataFrame, performance: DataFrame, keys: list[str]) -> DataFrame:
    """Every place is kept; only company places find figures, because the kind is part of the join condition.

    The mart is summed per company before the join, so a company with most of the rows is one row by then.
    """
    shares = [(c, F.coalesce(c, F.lit(0.0)).cast("decimal(28,10)")) for c in ("sla_compliance_pct", "late_delivery_pct")]
    per_company = performance.groupBy("company_id").agg(
        F.count("*").alias("_n"), F.sum("order_count").alias("_orders"),
        *[F.sum(value).alias(f"_{name}") for name, value in shares],
    )
    joined = geo.join(
        per_company, (F.col("company_id") == F.col("entity_id")) & (F.col("entity_type") == "company"), "left"
    )
    rows = F.sum(F.coalesce("_n", F.lit(1)))
    return joined.groupBy(*keys).agg(
        F.round(ratio(F.sum(F.coalesce("_sla_compliance_pct", F.lit(0))), rows), 1).alias("sla_pct"),
        F.sum(F.coalesce("_orders", F.lit(0))).alias("orders"),
        F.round(ratio(F.sum(F.coalesce("_late_delivery_pct", F.lit(0))), rows), 1).alias("late_pct"),
    )


def sla_by_place(geo: DataFrame, performance: DataFrame) -> DataFrame:
    keys = ["localidade", "uf", "estado", "regiao", "latitude", "longitude"]
    return (
        _places_with_sla(geo, performance, keys).withColumnRenamed("localidade", "name")
        .orderBy(F.asc_nulls_last("uf"))
    )


def state_rank(geo: DataFrame, performance: DataFrame) -> DataFrame:
    return _places_with_sla(geo, performance, ["uf", "estado", "regiao"]).orderBy(
        F.desc_nulls_first("sla_pct"), F.asc_nulls_last("uf")
    )


def region_sla(geo: DataFrame, performance: DataFrame) -> DataFrame:
    return _places_with_sla(geo, performance, ["regiao"]).orderBy(
        F.desc_nulls_first("sla_pct"), F.asc_nulls_last("regiao")
    )


def rain_by_day(weather: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        weather.where(F.col("weather_date") >= today(as_of - timedelta(days=days)))
        .groupBy(F.col("weather_date").alias("time"), F.col("location_uf").alias("metric"))
        .agg(F.round(exact_avg("precipitation_mm"), 1).alias("value"))
        .orderBy("time", "metric")
    )


def delay_by_day(impact: DataFrame, geo: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    state = geo.where("entity_type = 'company'").select("entity_id", "uf")
    return (
        impact.where(F.col("issued_date") >= today(as_of - timedelta(days=days)))
        .join(state, F.col("entity_id") == F.col("company_id"), "left")
        .groupBy(F.col("issued_date").alias("time"), "uf")
        .agg(F.round(exact_avg("delay_rate_pct"), 1).alias("value"))
        .select("time", F.coalesce("uf", F.lit("N/A")).alias("metric"), "value")
        .orderBy("time", "metric")
    )


def temperature_series(
    weather: DataFrame, as_of: datetime, ufs: tuple[str, ...] = ("SP", "RJ", "MG", "PR", "BA"), days: int = 30,
) -> DataFrame:
    return (
        weather.where((F.col("weather_date") >= today(as_of - timedelta(days=days))) & F.col("location_uf").isin(*ufs))
        .select(F.col("weather_date").alias("time"), F.col("location_uf").alias("metric"),
                F.round(F.col("avg_temperature_c").cast("double"), 1).alias("value"))
        .orderBy("time", "metric")
    )


# ---- job panels, over our own run records

def run_counts(runs: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    recent = F.col("started_at") >= moment(as_of - timedelta(hours=hours))
    return runs.agg(
        F.count_if(recent).alias("runs"),
        F.count_if(recent & (F.col("state") == "success")).alias("succeeded"),
        F.count_if(recent & (F.col("state") == "failed")).alias("failed"),
        F.count_if(F.col("state") == "running").alias("running"),
    )


def run_history(runs: DataFrame, as_of: datetime, limit: int = 30) -> DataFrame:
    end = F.coalesce("ended_at", moment(as_of))
    return (
        runs.select(
            "job", "state", "run_type", "started_at", "ended_at",
            F.round((epoch(end) - epoch("started_at")) / F.lit(60.0), 1).alias("minutes"), "run_id",
        )
        .orderBy(F.desc_nulls_first("started_at"), "run_id").limit(limit)
    )


def _seconds() -> Column:
    return (epoch("ended_at") - epoch("started_at")).cast("double")


def recent_failures(runs: DataFrame, limit: int = 20) -> DataFrame:
    return (
        runs.where(F.col("state").isin("failed", "up_for_retry"))
        .select("job", "task", "state", "started_at", F.round(_seconds(), 1).alias("seconds"), "attempt", "run_id")
        .orderBy(F.desc_nulls_first("started_at"), "run_id").limit(limit)
    )


def task_durations(runs: DataFrame, as_of: datetime, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        runs.where((F.col("started_at") >= moment(as_of - timedelta(days=days))) & F.col("ended_at").isNotNull())
        .withColumn("_s", _seconds())
        .groupBy("job", "task")
        .agg(
            F.count("*").alias("runs"), F.round(exact_avg("_s"), 1).alias("mean_seconds"),
            F.round(F.max("_s"), 1).alias("max_seconds"),
            F.count_if(F.col("state") == "success").alias("succeeded"),
            F.count_if(F.col("state") == "failed").alias("failed"),
        )
        .orderBy(F.desc_nulls_first("mean_seconds"), "job", "task").limit(limit)
    )


# ---- charts

GRAINS = {"PT1H": "hour", "P1D": "day"}


@dataclass(frozen=True)
class Chart:
    """A chart over one table: metrics are SQL aggregates by label, ordered by the first one."""

    table: str
    metrics: dict[str, str]
    groupby: tuple[str, ...] = ()
    where: str | None = None
    grain: str | None = None
    time_column: str | None = None
    limit: int | None = None
    desc: bool = True


def chart_query(
    df: DataFrame, groupby: tuple[str, ...] | list[str], metrics: dict[str, str], where: str | Column | None = None,
    grain: str | None = None, time_column: str | None = None, limit: int | None = None, desc: bool = True,
) -> DataFrame:
    if where is not None:
        df = df.where(where)
    keys = [F.col(k) for k in groupby]
    names = list(groupby)
    if grain:
        keys.insert(0, trunc_to(GRAINS[grain], time_column).alias(time_column))
        names.insert(0, time_column)
    out = df.groupBy(*keys).agg(*[F.expr(sql).alias(label) for label, sql in metrics.items()])
    first = next(iter(metrics))
    if grain:
        out = out.orderBy(time_column)
    elif names:
        by = F.desc_nulls_first(first) if desc else F.asc_nulls_last(first)
        out = out.orderBy(by, *[F.asc_nulls_last(n) for n in names])
    return out.limit(limit) if limit else out


_ON_TIME_SQL = "count_if(sla_status in ('on_time_express', 'on_time'))"
_MEAN = "round(avg(cast({0} as decimal(28,10))), 4)"


def _mean(column: str) -> str:
    return f"cast({_MEAN.format(column)} as double)"


def _money(sql: str) -> str:
    return f"cast({sql.format('cast(total_value as decimal(15,2))')} as double)"


def charts(as_of: datetime) -> dict[str, Chart]:
    """The chart definitions; relative time filters are bound to ``as_of``."""
    day = f"timestamp_ntz'{as_of:%Y-%m-%d}'"
    return {
        "order_count": Chart("fct_orders", {"orders": "count(order_id)"}),
        "movement_count": Chart("fct_movements", {"movements": "count(movement_id)"}),
        "on_time_pct": Chart("mart_order_sla", {
            "sla_pct": f"coalesce(round(100.0D * {_ON_TIME_SQL} / nullif(count_if(sla_status != 'pending'), 0), 1), 0D)",
        }),
        "open_orders": Chart("mart_order_sla", {"open_orders": "count_if(sla_status = 'pending')"}),
        "moves_last_30_days": Chart(
            "fct_movements", {"movements": "count(movement_id)"}, grain="P1D", time_column="movement_date", limit=500,
            where=f"movement_date >= {day} - interval '30' day and movement_date < {day}",
        ),
        "moves_today_by_hour": Chart(
            "fct_movements", {"movements": "count(movement_id)"}, grain="PT1H", time_column="movement_date", limit=500,
            where=f"movement_date >= {day} and movement_date < {day} + interval '1' day",
        ),
        "orders_by_status": Chart("mart_order_sla", {"orders": "count(order_id)"}, ("sla_status",), limit=10),
        "month_company": Chart(
            "mart_order_sla",
            {"orders": "count(order_id)", "total_value": _money("round(sum({}), 2)"),
             "sla_pct": f"coalesce(round(100.0D * {_ON_TIME_SQL} / nullif(count(*), 0), 1), 0D)"},
            ("issued_month", "company_id"), limit=24,
        ),
        "document_types": Chart(
            "fct_orders",
            {"orders": "count(order_id)", "mean_value": _money("round(avg({}), 2)"),
             "total_value": _money("round(sum({}), 2)")},
            ("document_type", "company_id"), limit=20,
        ),
        "operators_by_warehouse": Chart(
            "mart_operator_productivity",
            {"movements": "sum(movement_count)", "qty_per_move": _mean("avg_qty_per_move"),
             "complexity": _mean("complexity_index")},
            ("operator_user", "warehouse_id"), limit=20,
        ),
        "operator_ranking": Chart(
            "mart_operator_productivity",
            {"movements": "sum(movement_count)", "qty_per_move": _mean("avg_qty_per_move"),
             "max_outbound": "max(outbound_count)"},
            ("operator_user",), limit=15,
        ),
        "stockout_by_product": Chart(
            "mart_stockout_risk",
            {"current_stock": "avg(current_stock)", "daily_consumption": _mean("avg_daily_consumption"),
             "days_to_stockout": _mean("days_to_stockout")},
            ("product_id", "warehouse_id", "risk_level"), limit=20, desc=False,
        ),
        "items_by_risk": Chart("mart_stockout_risk", {"items": "count(inventory_id)"}, ("risk_level",), limit=10),
        "inventory_health": Chart(
            "mart_inventory_health",
            {"min_stock": "avg(min_stock_qty)", "coverage_days": _mean("coverage_days"),
             "utilization": _mean("stock_utilization_rate")},
            ("product_id", "warehouse_id", "stockout_risk"), limit=20, desc=False,
        ),
        "picking_by_shift": Chart(
            "mart_picking_performance",
            {"picks": "sum(picks_count)", "picks_per_hour": _mean("picks_per_hour"),
             "total_qty": "sum(total_qty_picked)", "skus_per_shift": _mean("distinct_skus_picked")},
            ("shift", "operator_user", "warehouse_id"), limit=20,
        ),
    }


def run_chart(df: DataFrame, chart: Chart) -> DataFrame:
    return chart_query(
        df, chart.groupby, chart.metrics, chart.where, chart.grain, chart.time_column, chart.limit, chart.desc
    )


# ---- serving summaries

def summary_orders(orders: DataFrame, movements: DataFrame) -> DataFrame:
    """Orders and revenue; units are the outbound ones, since the order fact has no quantity. Each side is one row."""
    units = movements.agg(F.coalesce(F.sum(F.when(F.col("qty_delta") < 0, -F.col("qty_delta"))), F.lit(0))).scalar()
    return orders.agg(
        F.count("*").alias("orders"), F.coalesce(money_sum("total_value"), F.lit(0.0)).alias("revenue"),
    ).select("orders", units.alias("units"), "revenue")


def summary_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count_distinct("product_id").alias("skus"),
        F.coalesce(F.sum("min_stock_qty"), F.lit(0)).alias("on_hand"),
    )


def summary_movements(movements: DataFrame) -> DataFrame:
    return movements.agg(
        F.count("*").alias("movements"), F.coalesce(F.sum(F.abs("qty_delta")), F.lit(0)).alias("units_moved"),
    )


# ---- revenue

def revenue_by_day(orders: DataFrame) -> DataFrame:
    """Documents and revenue per issue day. Documents without date form a group of their own, shown last."""
    return (
        orders.groupBy(F.to_date("issued_at").alias("day"))
        .agg(F.count("*").alias("documents"), F.coalesce(money_sum("total_value"), F.lit(0.0)).alias("revenue"))
        .orderBy(F.asc_nulls_last("day"))
    )


def newest_revenue_days(orders: DataFrame, limit: int = 10) -> DataFrame:
    return revenue_by_day(orders).orderBy(F.desc_nulls_first("day")).limit(limit)


def revenue_of_day(orders: DataFrame, day: date | datetime) -> DataFrame:
    start = datetime(day.year, day.month, day.day)
    return (
        orders.where((F.col("issued_at") >= moment(start)) & (F.col("issued_at") < moment(start + timedelta(days=1))))
        .agg(F.count("*").alias("documents"), F.coalesce(money_sum("total_value"), F.lit(0.0)).alias("revenue"))
    )


def _exact(c: Column) -> Column:
    return F.sum(c.cast("decimal(28,6)")).cast("double")


def item_revenue(items: DataFrame, headers: DataFrame, day: date | datetime) -> DataFrame:
    """Quantity times unit price over the items of the orders registered on one day."""
    start = datetime(day.year, day.month, day.day)
    of_day = headers.where(
        (F.col("dtcadastro") >= moment(start)) & (F.col("dtcadastro") < moment(start + timedelta(days=1)))
    ).select("idpedido")
    value = lenient_double("nrqtd") * lenient_double("vlproduto")
    return items.join(of_day, "idpedido").agg(
        F.count("*").alias("items"), F.coalesce(_exact(value), F.lit(0.0)).alias("revenue"),
    )


def _estimated(items: DataFrame) -> DataFrame:
    quantity, unit, net = (lenient_double(c) for c in ("nrqtd", "vlproduto", "valortotalliquido"))
    value = F.when(net > 0, net).when((quantity > 0) & (unit > 0), quantity * unit).otherwise(0.0)
    return items.withColumn("_quantity", quantity).withColumn("_value", value)


def estimated_total(items: DataFrame) -> DataFrame:
    return _estimated(items).agg(
        F.count("*").alias("items"), F.coalesce(_exact(F.col("_value")), F.lit(0.0)).alias("revenue"),
    )


def estimated_by_product(items: DataFrame, limit: int | None = 10) -> DataFrame:
    """Estimated revenue per product, largest first. Items without product share one group.

    Amounts are summed per product and description first: with text only in the keys that step hashes its rows, and
    the step that picks a description sees few of them.
    """
    key = F.coalesce(F.nullif("cdproduto", F.lit("")), F.lit("SEM_PRODUTO"))
    described = (
        _estimated(items).groupBy(key.alias("product_key"), "cdproduto", "dsproduto")
        .agg(F.expr("sum(cast(_quantity as decimal(28,6))) as _q"), F.expr("sum(cast(_value as decimal(28,6))) as _v"))
    )
    out = (
        described.groupBy("product_key")
        .agg(F.min("cdproduto").alias("cdproduto"), F.min("dsproduto").alias("dsproduto"),
             F.expr("round(cast(sum(_q) as double), 2) as quantity"),
             F.expr("round(cast(sum(_v) as double), 2) as revenue"))
        .orderBy(F.desc("revenue"), "product_key")
    )
    return out.limit(limit) if limit else out


def estimated_by_order(items: DataFrame, limit: int | None = 10) -> DataFrame:
    number = F.nullif("nrpedido", F.lit(""))
    ident = F.nullif(F.coalesce(F.col("idpedido").cast("string"), F.lit("None")), F.lit(""))
    out = (
        _estimated(items).groupBy(F.coalesce(number, ident, F.lit("SEM_PEDIDO")).alias("order_key"))
        .agg(F.count("*").alias("items"), F.round(_exact(F.col("_value")), 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "order_key")
    )
    return out.limit(limit) if limit else out


def orders_per_day(headers: DataFrame, limit: int = 15) -> DataFrame:
    return (
        headers.where("dtcadastro is not null").groupBy(F.to_date("dtcadastro").alias("day"))
        .agg(F.count("*").alias("orders")).orderBy(F.desc("day")).limit(limit)
    )
