"""Lost and new clients between two periods.

A client's membership in both periods and its figures come from one aggregate per client, so the order table is read
once and neither distinct lists nor anti-joins are needed. A NULL client never equals itself: it counts as lost and as
new, is left out where the report joins back on the client, and stays in the new-client report.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from stockyard.functions.exprs import MONEY, moment, money_sum, percent, ratio

Period = tuple[date, date]


def _within(period: Period) -> Column:
    return (F.col("issued_at") >= moment(period[0])) & (F.col("issued_at") < moment(period[1]))


def _activity(sla: DataFrame, a: Period, b: Period, *extra: Column) -> DataFrame:
    return sla.where(_within(a) | _within(b)).groupBy("depositor_id").agg(
        F.count_if(_within(a)).alias("_in_a"), F.count_if(_within(b)).alias("_in_b"), *extra
    )


def _lost() -> Column:
    return (F.col("_in_a") > 0) & ((F.col("_in_b") == 0) | F.col("depositor_id").isNull())


def _new() -> Column:
    return (F.col("_in_b") > 0) & ((F.col("_in_a") == 0) | F.col("depositor_id").isNull())


def lost_clients(sla: DataFrame, a: Period, b: Period) -> DataFrame:
    def in_a(c: Column | str) -> Column:
        return F.when(_within(a), c)

    amount = in_a(F.col("total_value").cast(MONEY))
    clients = _activity(
        sla, a, b,
        F.to_date(F.min(in_a(F.col("issued_at")))).alias("first_order"),
        F.to_date(F.max(in_a(F.col("issued_at")))).alias("last_order"),
        F.round(ratio(F.sum(amount), F.count(amount)), 2).alias("mean_ticket"),
        F.sum(amount).cast("double").alias("total_value"),
        F.count_if(_within(a) & (F.col("sla_status") == "late")).alias("late_orders"),
    )
    return (
        clients.where(_lost() & F.col("depositor_id").isNotNull())
        .select(
            "depositor_id", F.col("_in_a").alias("orders"), "first_order", "last_order", "mean_ticket",
            "total_value", "late_orders", percent(F.col("late_orders"), F.col("_in_a"), 1).alias("late_pct"),
        )
        .orderBy(F.desc_nulls_first("total_value"), "depositor_id")
    )


def churn_summary(sla: DataFrame, a: Period, b: Period) -> DataFrame:
    active = F.count_if(F.col("_in_a") > 0)
    lost = F.count_if(_lost())
    return _activity(sla, a, b).agg(
        active.alias("active_before"), F.count_if(F.col("_in_b") > 0).alias("active_after"),
        lost.alias("lost_clients"), F.count_if(_new()).alias("new_clients"),
        percent(lost, active, 1).alias("churn_pct"),
    )


def lost_sla(sla: DataFrame, a: Period, b: Period) -> DataFrame:
    """Share of late or at-risk orders among the clients that left."""
    bad = F.count_if(_within(a) & F.col("sla_status").isin("late", "at_risk")).alias("problem_orders")
    return (
        _activity(sla, a, b, bad).where(_lost() & F.col("depositor_id").isNotNull())
        .select("depositor_id", F.col("_in_a").alias("orders"), "problem_orders",
                percent(F.col("problem_orders"), F.col("_in_a"), 1).alias("problem_pct"))
        .orderBy(F.desc("problem_pct"), "depositor_id")
    )


def new_clients(sla: DataFrame, a: Period, b: Period) -> DataFrame:
    clients = _activity(
        sla, a, b,
        F.to_date(F.min(F.when(_within(b), F.col("issued_at")))).alias("first_order"),
        money_sum(F.when(_within(b), F.col("total_value"))).alias("total_value"),
    )
    return (
        clients.where(_new())
        .select("depositor_id", F.col("_in_b").alias("orders"), "first_order", "total_value")
        .orderBy(F.desc_nulls_first("total_value"), "depositor_id")
    )
