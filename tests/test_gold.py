"""The stored layers end to end: full build, increment, full refresh."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockyard.operators import quality, reports
from stockyard.plans import gold
from stockyard.sources import binding, tables

CUT, NOW = datetime(2000, 1, 1), datetime(2001, 8, 1)


def recent(orders):
    return orders.where(F.col("dataemissao") >= F.lit(datetime(1999, 6, 1)).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def stored(spark, root, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    bronze = f"{base}/bronze"
    orders = recent(binding.orders(spark, root))
    moves = binding.outbound(spark, root).unionByName(binding.movements(spark, root))
    tables.overwrite(orders.where(F.col("dataemissao") < F.lit(CUT).cast("timestamp_ntz")), f"{bronze}/orders_documento")
    tables.overwrite(moves, f"{bronze}/movements_entrada_saida")
    tables.overwrite(binding.inventory(spark, root), f"{bronze}/inventory_produtoestoque")
    warehouse = gold.Warehouse(spark, bronze, f"{base}/gold", NOW)
    first = gold.build_gold(warehouse, "run-1")
    gold.record_metrics(first, f"{base}/metrics")
    return warehouse, base, orders, first


def counts(warehouse):
    return {m.name: warehouse.gold(m.name).count() for m in gold.FACTS + gold.MARTS}


def test_build_increment_and_refresh(spark, root, stored):
    warehouse, base, orders, first = stored
    assert {r.state for r in first.collect()} == {"success"}
    assert warehouse.gold("mart_geo_performance").where("cidade is not null").isEmpty()
    early = counts(warehouse)

    late = orders.where(F.col("dataemissao") >= F.lit(CUT).cast("timestamp_ntz"))
    tables.append(late, f"{warehouse.bronze_root}/orders_documento")
    tables.append(late, f"{warehouse.bronze_root}/orders_documento")  # repeated rows are one in silver
    tables.overwrite(binding.geo_reference(spark, root), f"{warehouse.bronze_root}/geo_reference")
    tables.overwrite(binding.weather_daily(spark, root), f"{warehouse.bronze_root}/weather_daily")
    second = gold.build_gold(warehouse, "run-2", threads=2)
    assert {r.state for r in second.collect()} == {"success"}
    grown = counts(warehouse)
    assert grown["fct_orders"] == grown["mart_order_sla"] == orders.count() > early["fct_orders"]
    assert grown["mart_picking_performance"] == early["mart_picking_performance"]
    places = warehouse.gold("mart_geo_performance").groupBy(F.col("issued_month") >= F.lit(CUT).cast("timestamp_ntz")).agg(
        F.count("cidade").alias("n")
    )
    assert {r[0]: r.n > 0 for r in places.collect()} == {False: False, True: True}  # stored months stay as they were

    gold.build_gold(warehouse, "run-3", full_refresh=True)
    assert counts(warehouse) == grown
    assert warehouse.gold("mart_geo_performance").where("cidade is null").isEmpty()


def test_metrics_feed_the_job_panels(spark, stored):
    _, base, _, _ = stored
    runs = tables.read(spark, f"{base}/metrics")
    now = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(minutes=1)
    top = reports.task_durations(runs, now).collect()
    assert len(top) == 12 and {r.succeeded for r in top} == {1}
    assert reports.run_counts(runs, now).first().failed == 0


def month_files(base, table):
    folder = Path(base) / "gold" / table / "v00000001"
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in folder.iterdir() if p.is_dir() and p.name.startswith("part_key=")}


def test_a_load_touches_its_months_only(spark, root, tmp_path):
    """New, changed and re-dated orders of one night; all other months keep their files."""
    base = str(tmp_path)
    orders = recent(binding.orders(spark, root))
    tables.overwrite(orders, f"{base}/bronze/orders_documento")
    tables.overwrite(binding.outbound(spark, root), f"{base}/bronze/movements_entrada_saida")
    tables.overwrite(binding.inventory(spark, root), f"{base}/bronze/inventory_produtoestoque")
    warehouse = gold.Warehouse(spark, f"{base}/bronze", f"{base}/gold", NOW)
    gold.build_gold(warehouse, "run-1")
    before, facts = month_files(base, "fct_orders"), {r.order_id: r for r in warehouse.gold("fct_orders").collect()}
    moves = month_files(base, "fct_movements")
    inside = lambda y, m: sorted(k for k, r in facts.items() if (r.issued_at.year, r.issued_at.month) == (y, m))
    changed, moved = inside(2000, 3)[0], inside(2001, 5)[0]
    at = F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")
    night = orders.where(F.col("sequenciaintegracao").cast("string").isin(changed, moved)).withColumns({
        "valortotaldocumento": F.lit(1).cast(orders.schema["valortotaldocumento"].dataType), "_cdc_loaded_at": at,
        "dataemissao": F.when(F.col("sequenciaintegracao").cast("string") == moved, F.lit("1999-07-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("dataemissao")),
    })
    tables.append(night, f"{base}/bronze/orders_documento", "night")
    assert {r.state for r in gold.build_gold(warehouse, "run-2").collect()} == {"success"}  # also of marts without rows
    after = month_files(base, "fct_orders")
    assert {k for k in after if after[k] != before.get(k)} == {"part_key=p2000-03", "part_key=p2001-05", "part_key=p1999-07"}
    assert moves == month_files(base, "fct_movements")
    now = {r.order_id: r for r in warehouse.gold("fct_orders").collect()}
    assert now.keys() == facts.keys() and {k for k in now if now[k] != facts[k]} == {changed, moved}
    assert now[moved].issued_at == datetime(1999, 7, 1) and now[changed].total_value == 1
    gold.build_gold(warehouse, "run-3", full_refresh=True)
    assert {r.order_id: r for r in warehouse.gold("fct_orders").collect()} == now


def test_tests_are_counted_at_the_write(spark, root, stored):
    """What a build notes about its rows is what the tests say about the stored tables."""
    warehouse, _, _, _ = stored
    metrics = gold.build_gold(warehouse, "run-t", full_refresh=True)
    noted = gold.test_results(warehouse, "run-t")
    key = ["model", "test", "column_name", "failures"]
    names = [m.name for m in gold.FACTS + gold.MARTS]
    again = quality.test_results({n: warehouse.gold(n) for n in names})
    assert sorted(map(tuple, noted.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))
    assert {r.table_name: r.row_count for r in gold.stored_counts(warehouse).collect()} == counts(warehouse)
    tables_ = {n: warehouse.gold(n) for n in names}
    for mine, plain in ((gold.null_gate(warehouse, "run-t"), quality.null_gate(tables_)), (gold.row_gate(metrics), quality.row_gate(tables_))):
        assert sorted(map(tuple, mine.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
        quality.enforce(mine)


def test_a_failed_fact_stops_its_marts(spark, stored, monkeypatch):
    warehouse, _, _, _ = stored
    before = tables.versions(spark, warehouse.gold_path("mart_order_sla"))
    broken = gold.Model("fct_orders", ("order_id",), lambda w, _: w.gold("missing"))
    monkeypatch.setattr(gold, "FACTS", [broken, *gold.FACTS[1:]])
    states = {r.task: r.state for r in gold.build_gold(warehouse, "r").collect()}
    assert {k for k, v in states.items() if v == "failed"} == {"fct_orders"}
    assert {k for k, v in states.items() if v == "skipped"} == {"mart_order_sla", "mart_geo_performance", "mart_weather_impact"}
    assert tables.versions(spark, warehouse.gold_path("mart_order_sla")) == before


def test_nothing_is_published_over_rows(spark, stored, tmp_path):
    """Neither without bronze, nor from bronze without rows."""
    warehouse, base, _, _ = stored
    rows = counts(warehouse)
    nowhere = gold.Warehouse(spark, str(tmp_path / "mistyped"), f"{base}/gold", NOW)
    states = {r.task: r.state for r in gold.build_gold(nowhere, "r", full_refresh=True).collect()}
    assert {states[m.name] for m in gold.FACTS} == {"failed"} and set(states.values()) == {"failed", "skipped"}
    empty = gold.Warehouse(spark, str(tmp_path / "empty"), f"{base}/gold", NOW)
    for name in ("orders_documento", "movements_entrada_saida", "inventory_produtoestoque"):
        tables.overwrite(warehouse.bronze(name).limit(0), f"{empty.bronze_root}/{name}")
    states = {r.task: r.state for r in gold.build_gold(empty, "r", full_refresh=True).collect()}
    assert {states[m.name] for m in gold.FACTS} == {"failed"}
    assert counts(warehouse) == rows
