"""Edges of the mart rules."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockyard.operators import marts

T0 = datetime(2024, 3, 5, 10, 0, 0)
ORDERS = (
    "order_id string, document_number string, document_type string, company_id string, depositor_id string, "
    "issued_at timestamp_ntz, delivered_at timestamp_ntz, total_value double"
)
MOVES = (
    "movement_id string, product_id string, warehouse_id string, depositor_id string, qty_delta int, "
    "movement_date timestamp_ntz, movement_status string, operator_user string"
)
STOCK = (
    "inventory_id string, product_id string, warehouse_id string, company_id string, product_class string, "
    "ideal_stock_qty int, min_stock_qty int, max_stock_qty int, safety_stock_qty int, reorder_point int, "
    "avg_consumption double"
)


def order(i, delivered=None, depositor="D", issued=T0, value=10.0, company="C"):
    return (str(i), str(i), "NF", company, depositor, issued, delivered, value)


def move(i, at, delta=-1, operator="op", warehouse="W", product="p", status="1", depositor="D"):
    return (str(i), product, warehouse, depositor, delta, at, status, operator)


def stock(i, least, used, ideal=100, safety=5, reorder=10):
    return (str(i), f"p{i}", "W", "C", "A", ideal, least, 200, safety, reorder, used)


def by_id(df, key="order_id"):
    return {row[key]: row for row in df.collect()}


def test_sla_bounds_are_inclusive(spark):
    hours = {"24": 24, "24+": 24, "48": 48, "48+": 48, "72": 72, "72+": 72}
    rows = [
        order(k, T0 + timedelta(hours=h, seconds=1 if k.endswith("+") else 0)) for k, h in hours.items()
    ]
    got = by_id(marts.order_sla(spark.createDataFrame(rows, ORDERS), spark.createDataFrame([], MOVES)))
    assert {k: r.sla_status for k, r in got.items()} == {
        "24": "on_time_express", "24+": "on_time", "48": "on_time", "48+": "at_risk", "72": "at_risk", "72+": "late",
    }
    assert got["24"].cycle_time_hours == 24.0 and got["24"].sla_met


def test_proxy_is_the_first_outbound_movement_after_issue(spark):
    orders = [
        order("a"), order("b"), order("null dep", depositor=None), order("other", depositor="E"),
        order("undated", issued=None), order("delivered", T0 + timedelta(hours=1)),
    ]
    moves = [
        move(1, T0, status="8"),  # at the issue time: not after it
        move(2, T0 + timedelta(seconds=30), status="1"),  # not outbound
        move(3, T0 + timedelta(hours=30), status="8"),
        move(4, T0 + timedelta(hours=29), status="8"),
        move(5, T0 + timedelta(hours=1), status="8", depositor=None),
        move(6, None, status="8"),
    ]
    got = by_id(marts.order_sla(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(moves, MOVES)))
    assert set(got) == {"a", "b", "null dep", "other", "delivered"}
    assert got["a"].delivered_at_proxy == got["b"].delivered_at_proxy == T0 + timedelta(hours=29)
    assert got["a"].sla_status == "on_time"
    assert got["null dep"].sla_status == got["other"].sla_status == "pending"
    assert got["null dep"].cycle_time_hours is None and not got["null dep"].sla_met
    assert got["delivered"].resolved_delivered_at == T0 + timedelta(hours=1)
    assert got["delivered"].delivered_at_proxy == T0 + timedelta(hours=29)


@pytest.mark.parametrize(
    "least, used, cover, health, risk",
    [
        (0, 0.0, None, "critical", "stockout"),
        (5, 0.0, None, "healthy", "low"),
        (5, None, None, "healthy", "low"),
        (0, None, None, "healthy", "stockout"),
        (5, -1.0, None, "critical", "low"),
        (0, 1.0, 0.0, "critical", "stockout"),
        (3, 1.0, 3.0, "critical", "critical"),
        (304, 100.0, 3.0, "high", "critical"),  # 3.04 days: one mart rounds first
        (7, 1.0, 7.0, "high", "high"),
        (14, 1.0, 14.0, "medium", "medium"),
        (15, 1.0, 15.0, "healthy", "low"),
    ],
)
def test_stock_levels(spark, least, used, cover, health, risk):
    df = spark.createDataFrame([stock(1, least, used)], STOCK)
    h = marts.inventory_health(df).first()
    r = marts.stockout_risk(df, date(2024, 3, 5)).first()
    assert (h.coverage_days, h.stockout_risk) == (cover, health)
    assert (r.days_to_stockout, r.risk_level, r.snapshot_date) == (cover, risk, date(2024, 3, 5))


def test_stock_flags_and_ideal(spark):
    rows = [stock(1, 5, 1.0), stock(2, 6, 1.0, ideal=0), stock(3, 11, 1.0, ideal=None, safety=None, reorder=None)]
    got = by_id(marts.inventory_health(spark.createDataFrame(rows, STOCK)), "inventory_id")
    assert (got["1"].below_safety_stock, got["1"].below_reorder_point, got["1"].stock_utilization_rate) == (
        True, True, 0.05,
    )
    assert (got["2"].below_safety_stock, got["2"].below_reorder_point, got["2"].stock_utilization_rate) == (
        False, True, None,
    )
    assert (got["3"].below_safety_stock, got["3"].below_reorder_point, got["3"].stock_utilization_rate) == (
        False, False, None,
    )


def test_operator_rank_has_gaps_and_counts_null_warehouse_as_a_group(spark):
    day = datetime(2024, 3, 5)
    counts = {("a", "W"): 3, ("b", "W"): 3, ("c", "W"): 1, ("a", None): 2, ("b", None): 1}
    rows, n = [], 0
    for (who, where), times in counts.items():
        for _ in range(times):
            rows.append(move(n, day + timedelta(minutes=n), operator=who, warehouse=where, delta=-2 if n % 2 else 4))
            n += 1
    rows += [move(90, day, operator=None), move(91, None)]
    got = marts.operator_productivity(spark.createDataFrame(rows, MOVES)).collect()
    assert {(r.operator_user, r.warehouse_id): r.daily_ranking for r in got} == {
        ("a", "W"): 1, ("b", "W"): 1, ("c", "W"): 3, ("a", None): 1, ("b", None): 2,
    }
    a = next(r for r in got if (r.operator_user, r.warehouse_id) == ("a", "W"))
    assert (a.movement_count, a.total_qty_handled, a.outbound_count, a.inbound_count) == (3, 10, 1, 2)
    assert a.complexity_index == round((1.5 + 2) / 3, 3) and a.avg_qty_per_move == 3.33


def test_shifts_and_rate(spark):
    day = datetime(2024, 3, 5)
    hours = {5: "night", 6: "morning", 13: "morning", 14: "afternoon", 21: "afternoon", 22: "night"}
    rows = [move(h, day + timedelta(hours=h)) for h in hours] + [move(50, day + timedelta(hours=7), delta=3)]
    got = {r["shift"]: r for r in marts.picking_performance(spark.createDataFrame(rows, MOVES)).collect()}
    assert {s: r.picks_count for s, r in got.items()} == {"night": 2, "morning": 2, "afternoon": 2}
    assert got["morning"].active_hours == 7.0 and got["morning"].picks_per_hour == 0.29
    assert got["night"].active_hours == 17.0
    one = marts.picking_performance(spark.createDataFrame([move(1, day)], MOVES)).first()
    assert one.active_hours == 0.0 and one.picks_per_hour is None


GEO = "entity_type string, entity_id string, localidade string, uf string, estado string, regiao string, latitude double, longitude double"


def test_geo_performance_shares_and_precedence(spark):
    orders = [
        order(1, T0 + timedelta(hours=48)), order(2, T0 + timedelta(hours=48, seconds=1)), order(3),
        order(4, depositor="E", company="none"), order(5, depositor="F", company=None),
    ]
    geo = [
        ("company", "C", "Town", None, "S", "R", 1.0, 2.0), ("warehouse", "D", "Yard", "UF", "S2", "R2", 3.0, 4.0),
        ("warehouse", "E", "Dock", "UE", "S3", "R3", 5.0, 6.0),
    ]
    df = spark.createDataFrame(orders, ORDERS)
    got = by_id(marts.geo_performance(df, spark.createDataFrame(geo, GEO)), "depositor_id")
    d = got["D"]
    assert (d.order_count, d.delivered_count, d.sla_compliance_pct, d.late_delivery_pct) == (3, 2, 33.33, 33.33)
    assert (d.cidade, d.uf) == ("Town", "UF")  # column by column
    assert (got["E"].cidade, got["F"].cidade) == ("Dock", None)
    assert got["E"].avg_cycle_time_hours is None
    bare = marts.geo_performance(df)
    assert bare.where("cidade is not null").isEmpty() and bare.count() == 3


def test_geo_inventory(spark):
    rows = [stock(1, 5, 1.0), stock(2, 6, 0.0), stock(3, 50, None)]
    r = marts.geo_inventory(spark.createDataFrame(rows, STOCK)).first()
    assert (r.product_count, r.total_current_stock, r.avg_coverage_days) == (3, 61, 5.0)
    assert (r.stockout_count, r.below_reorder_count, r.stock_health_pct, r.cidade) == (1, 2, 66.67, None)


def test_weather_impact(spark):
    df = spark.createDataFrame([order(1, T0 + timedelta(hours=50)), order(2, company="X")], ORDERS)
    geo = spark.createDataFrame([("company", "C", "T", "UF", "S", "R", 1.0, 2.0)], GEO)
    weather = spark.createDataFrame(
        [("UF", T0.date(), "Neblina", 20.0, 1.0, 3.0)],
        "location_uf string, weather_date date, weather_condition string, avg_temperature_c double, "
        "precipitation_mm double, wind_speed_kmh double",
    )
    got = by_id(marts.weather_impact(df, geo, weather), "company_id")
    assert (got["C"].delayed_order_count, got["C"].delay_rate_pct, got["C"].weather_condition) == (1, 100.0, "Neblina")
    assert got["X"].weather_condition is None and got["X"].delay_rate_pct == 0.0
    assert marts.weather_impact(df).where("weather_condition is not null").isEmpty()


def test_slices_equal_the_whole(spark):
    days = [datetime(2024, 3, d, 8) for d in (1, 1, 2, 3, 3)]
    df = spark.createDataFrame([move(i, t, product=f"p{i}") for i, t in enumerate(days)], MOVES)
    whole = marts.operator_productivity(df).collect()
    first = marts.operator_productivity(df.where(F.col("movement_date") < "2024-03-02")).collect()
    rest = marts.operator_productivity(df, since=datetime(2024, 3, 1)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, first + rest))
