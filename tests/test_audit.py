"""Audits, churn, gates and reports on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockyard.operators import audit, churn, dedup, enrich, quality, reports, staging

SLA = "depositor_id string, issued_at timestamp_ntz, total_value double, sla_status string, order_id string"
A, B = (date(2024, 1, 1), date(2024, 4, 1)), (date(2024, 4, 1), date(2024, 5, 1))


@pytest.fixture(scope="module")
def sla(spark):
    rows = [
        ("left", datetime(2024, 1, 5), 10.0, "late"), ("left", datetime(2024, 3, 31, 23), 5.0, "on_time"),
        ("stays", datetime(2024, 2, 1), 1.0, "late"), ("stays", datetime(2024, 4, 1), 1.0, "late"),
        ("new", datetime(2024, 4, 30, 23), 2.5, "pending"), ("too late", datetime(2024, 5, 1), 9.0, "late"),
        (None, datetime(2024, 2, 1), 3.0, "late"), (None, datetime(2024, 4, 2), 4.0, "late"),
    ]
    return spark.createDataFrame([(*r, str(i)) for i, r in enumerate(rows)], SLA)


def test_churn(sla):
    lost = churn.lost_clients(sla, A, B).collect()
    assert [(r.depositor_id, r.orders, r.mean_ticket, r.total_value, r.late_orders, r.late_pct) for r in lost] == [
        ("left", 2, 7.5, 15.0, 1, 50.0)
    ]
    assert (lost[0].first_order, lost[0].last_order) == (date(2024, 1, 5), date(2024, 3, 31))
    s = churn.churn_summary(sla, A, B).first()
    assert (s.active_before, s.active_after, s.lost_clients, s.new_clients, s.churn_pct) == (3, 3, 2, 2, 66.7)
    assert [r.depositor_id for r in churn.lost_sla(sla, A, B).collect()] == ["left"]
    new = churn.new_clients(sla, A, B).collect()
    assert {(r.depositor_id, r.orders, r.total_value) for r in new} == {("new", 1, 2.5), (None, 1, 4.0)}


def test_churn_of_nothing(sla):
    s = churn.churn_summary(sla.where("false"), A, B).first()
    assert (s.active_before, s.churn_pct) == (0, None)


def test_orphans_need_an_earlier_order_of_the_same_depositor(spark):
    t = datetime(2024, 1, 10)
    orders = spark.createDataFrame([("D", t), ("D", t + timedelta(1)), (None, t)], "depositor_id string, issued_at timestamp_ntz")
    rows = [("same time", "D", t), ("before", "D", t - timedelta(1)), ("unknown", "X", t), ("null dep", None, t),
            ("undated", "D", None)]
    moves = spark.createDataFrame(
        [(i, d, "p", at, "8") for i, d, at in rows] + [("other status", "X", "p", t, "1")],
        "movement_id string, depositor_id string, product_id string, movement_date timestamp_ntz, movement_status string",
    )
    got = {r.movement_id for r in audit.orphans(moves, orders).collect()}
    assert got == {"before", "unknown", "null dep", "undated"}
    classes = {r.orphan_class: r.total for r in audit.orphan_class(moves, orders).collect()}
    assert classes == {audit.BEFORE_EXTRACTION: 1, audit.WITHIN_PERIOD: 3}


def test_gaps_at_both_ends_of_the_window(spark):
    as_of = date(2024, 4, 1)
    days = [as_of - timedelta(n) for n in range(1, 91)]
    orders = [(datetime(d.year, d.month, d.day, 23),) for d in days if d not in (days[0], days[-1])]
    moves = [(datetime(d.year, d.month, d.day),) for d in days if d != days[5]] + [(datetime(2024, 4, 1),)]
    got = audit.gaps(
        spark.createDataFrame(orders, "dataemissao timestamp_ntz"),
        spark.createDataFrame(moves, "datamovimento timestamp_ntz"), as_of,
    ).collect()
    assert [tuple(r) for r in got] == [
        (days[0], audit.NO_DATA, audit.HAS_DATA), (days[5], audit.HAS_DATA, audit.NO_DATA),
        (days[-1], audit.NO_DATA, audit.HAS_DATA),
    ]


def test_freshness_of_fresh_stale_and_empty_tables(spark):
    now = datetime(2024, 1, 2)
    table = lambda *hours: spark.createDataFrame([(now - timedelta(hours=h),) for h in hours], "_cdc_loaded_at timestamp_ntz")
    got = {r.table_name: (r.status, r.age_hours) for r in audit.freshness(
        {"fresh": table(26, 90), "stale": table(26.5), "empty": table()}, now
    ).collect()}
    assert got == {"fresh": ("OK", 26.0), "stale": ("STALE", 26.5), "empty": ("WARN", None)}


def test_pending_alarm(spark):
    rows = [(datetime(2024, 1, d), "pending") for d in (1, 2, 3, 4, 6, 7)] + [(datetime(2024, 1, 7), "late")]
    df = spark.createDataFrame(rows, "issued_at timestamp_ntz, sla_status string")
    got = audit.pending_alarm(df, 0.95, 3).collect()
    assert [tuple(r) for r in got] == [(date(2024, 1, 1), date(2024, 1, 4), 4)]


def test_dedup(spark):
    rows = [("a", 1, datetime(2024, 1, 1)), ("a", 2, None), ("a", 3, datetime(2024, 1, 2)), (None, 4, None), (None, 5, None)]
    df = spark.createDataFrame(rows, "k string, v int, at timestamp_ntz")
    assert {(r.k, r.v) for r in dedup.dedup_latest(df, ["k"], "at").collect()} == {("a", 3), (None, 4)}
    assert {(r.k, r.v) for r in dedup.dedup_any(df, ["k"]).collect()} == {("a", 1), (None, 4)}


def test_a_repeated_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("if(id < 99, 'hot', 'cold') as k", "id as v")
    plan = dedup.dedup_any(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan[plan.index("Exchange hashpartitioning") :]
    newest = dedup.dedup_latest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert newest.count("WindowGroupLimit") == 2


def test_bad_values(spark):
    bronze = spark.createDataFrame(
        [("1", "p", "w", "d", "x", "2", None, "8", "u", "n")],
        ", ".join(f"{c} string" for c in (
            "sequenciamovimento", "codigoproduto", "codigoestabelecimento", "codigodepositante", "quantidadeanterior",
            "quantidadeatual", "datamovimento", "estadomovimento", "usuario", "observacao",
        )),
    )
    with pytest.raises(Exception):
        staging.stg_movements(bronze).collect()
    row = staging.stg_movements(bronze, lenient=True).first()
    assert (row.qty_before, row.qty_after, row.qty_delta) == (None, 2, None)


def test_checks_and_gates(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), (None, None)], "k string, v string")
    assert quality.check_not_null(df, "k").count() == 2
    assert [tuple(r) for r in quality.check_unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.check_accepted_values(df, "v", ["x"]).collect()] == [("y", 1)]
    parent = spark.createDataFrame([("x",), (None,)], "id string")
    assert [r.v for r in quality.check_relationship(df, "v", parent, "id").collect()] == ["y"]
    gate = quality.row_gate({"t": df, "u": df.where("false")}, {"t": 4, "u": 1})
    assert [r.status for r in gate.collect()] == ["OK", "FAIL"]
    with pytest.raises(quality.QualityError, match="u"):
        quality.enforce(gate)
    with pytest.raises(quality.QualityError, match="'null_count': 2"):
        quality.enforce(quality.null_gate({"t": df}, [("t", "k")]))
    quality.enforce(quality.row_gate({"t": df}, {"t": 1}))
    quality.store_failures(quality.check_not_null(df, "k"), str(tmp_path / "failures"))
    assert spark.read.parquet(str(tmp_path / "failures")).count() == 2


def test_declared_tests_are_counted():
    not_null = sum(len(n) for n, _, _ in quality.TESTS.values())
    unique = sum(len(u) for _, u, _ in quality.TESTS.values())
    accepted = sum(len(a) for _, _, a in quality.TESTS.values())
    assert (not_null, unique, accepted) == (28, 9, 4)


def test_model_results_find_failures(spark):
    rows = [("1", "late"), ("1", "odd"), (None, None), ("2", "late")]
    df = spark.createDataFrame(rows, "order_id string, sla_status string")
    got = {(r.test, r.column_name): r.failures for r in quality.model_results("mart_order_sla", df).collect()}
    assert got == {("not_null", "order_id"): 1, ("not_null", "sla_status"): 1, ("accepted_values", "sla_status"): 1,
                   ("unique", "order_id"): 1}


ITEMS = "idpedido long, nrpedido string, cdproduto string, dsproduto string, nrqtd string, vlproduto string, valortotalliquido string"


def test_estimated_revenue(spark):
    rows = [
        (1, "P1", "a", "apple", " 2 ", "3.5", None),  # quantity times unit
        (1, "P1", "a", "apple", "9", "9", "4"),  # the net total wins
        (2, "", "", "none", "2", "x", "-1"),  # nothing usable
        (None, None, None, None, "1", "1", ""),
    ]
    df = spark.createDataFrame(rows, ITEMS)
    assert tuple(reports.estimated_total(df).first()) == (4, 12.0)
    products = {r.product_key: (r.quantity, r.revenue) for r in reports.estimated_by_product(df).collect()}
    assert products == {"a": (11.0, 11.0), "SEM_PRODUTO": (3.0, 1.0)}
    orders = {r.order_key: (r["items"], r.revenue) for r in reports.estimated_by_order(df).collect()}
    assert orders == {"P1": (2, 11.0), "2": (1, 0.0), "None": (1, 1.0)}


def test_estimated_revenue_of_text_that_is_no_finite_number(spark):
    rows = [(1, "P1", "a", "apple", "nan", "3.5", None), (1, "P1", "a", "apple", "2", "NaN", "inf"), (1, "P1", "a", "apple", "3", "2", "Infinity")]
    df = spark.createDataFrame(rows, ITEMS)
    assert tuple(reports.estimated_total(df).first()) == (3, 6.0)
    assert [(r.quantity, r.revenue) for r in reports.estimated_by_product(df).collect()] == [(5.0, 6.0)]
    assert [r.revenue for r in reports.estimated_by_order(df).collect()] == [6.0]


def test_revenue_by_day_keeps_undated_documents_last(spark):
    df = spark.createDataFrame(
        [(None, 1.5), (None, 2.0), (datetime(2024, 1, 1, 9), None)], "issued_at timestamp_ntz, total_value double"
    )
    assert [tuple(r) for r in reports.revenue_by_day(df).collect()] == [(date(2024, 1, 1), 1, 0.0), (None, 2, 3.5)]


def test_chart_query(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9), (None, 4)], "g string, v int")
    got = reports.chart_query(df, ["g"], {"n": "sum(v)"}, where="v > 1", limit=2).collect()
    assert [tuple(r) for r in got] == [("b", 9), (None, 4)]
    assert reports.chart_query(df, [], {"n": "count(*)"}).first().n == 4


def test_weather_arrays_of_unequal_length(spark):
    text = (
        '{"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_mean": [1.5], "weather_code": [3, 42, 61], '
        '"precipitation_sum": [null, 2.0]}}'
    )
    df = spark.createDataFrame([("SP", text), ("RJ", "{}"), ("MG", None)], "location_uf string, response string")
    rows = enrich.explode_weather(df).collect()
    assert [(r.weather_date.day, r.avg_temperature_c, r.precipitation_mm, r.weather_code, r.weather_condition) for r in rows] == [
        (1, 1.5, None, 3, "Nublado"), (2, None, 2.0, 42, "Código 42"),
    ]


def test_weather_window():
    assert enrich.weather_window(date(2024, 3, 1), 30) == (date(2024, 1, 31), date(2024, 2, 29))


def test_volume_anomaly(spark):
    """Quiet weeks, one day without rows, one with far too many, and a first weekday that nothing is known about."""
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(70)]
    odd = {days[42]: 0, days[50]: 90}
    rows = [(d,) for d in days for _ in range(odd.get(d, 20 + d.day % 3))] + [(None,)] * 5
    got = {r.day: r for r in quality.volume_anomaly(spark.createDataFrame(rows, "at date"), "at").collect()}
    assert sorted(got) == days and got[days[42]].row_count == 0
    assert {d: got[d].status for d in odd} == {days[42]: "LOW", days[50]: "HIGH"}
    assert {got[d].status for d in days[:28]} == {"NEW"} and got[days[0]].expected is None
    assert {got[d].status for d in days[28:] if d not in odd} == {"OK"}
    assert quality.volume_anomaly(spark.createDataFrame([], "at date"), "at").isEmpty()


def test_sketches_of_days_give_months(spark, tmp_path):
    """Daily sketches, stored load by load, answer for months within three per cent; a day that comes again counts once."""
    from stockyard.sources import tables

    df = spark.range(60_000).selectExpr("date_add(date'2024-01-01', cast(id % 60 as int)) as at", "id % 7919 as k", "id as u")
    path = str(tmp_path / "sketches")
    load = lambda where: audit.daily_sketches(df.where(where), "at", ["k", "u"])
    tables.merge_partitions(spark, load("at < '2024-02-01'"), path, ["day"], "day")
    tables.merge_partitions(spark, load("at >= '2024-01-30'"), path, ["day"], "day")
    stored = tables.read(spark, path)
    assert stored.count() == 60
    near = {r.month: r for r in audit.distinct_from_sketches(stored, ["k", "u"]).collect()}
    exact = df.groupBy(F.to_date(F.date_trunc("month", "at")).alias("month")).agg(F.count_distinct("k").alias("k"), F.count_distinct("u").alias("u"))
    for r in exact.collect():
        assert abs(near[r.month].k - r.k) <= 0.03 * r.k and abs(near[r.month].u - r.u) <= 0.03 * r.u
