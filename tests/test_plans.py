"""Plans over stored facts: what reaches the scan, and what needs no shuffle."""

import re
from datetime import date, datetime

from stockyard.operators import facts, marts, reports, staging
from stockyard.sources import binding


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_filters_and_columns_reach_the_scan(spark, root, tmp_path):
    path = str(tmp_path / "orders")
    facts.fct_orders(staging.stg_orders(binding.orders(spark, root))).write.parquet(path)
    plan = plan_of(marts.geo_performance(spark.read.parquet(path), since=datetime(2000, 1, 1)))
    assert "GreaterThan(issued_at,2000-01-01" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {
        "company_id", "depositor_id", "issued_at", "delivered_at", "total_value",
    }


def test_inventory_marts_are_one_stage(spark, root, tmp_path):
    path = str(tmp_path / "inventory")
    facts.fct_inventory_snapshot(staging.stg_inventory(binding.inventory(spark, root))).write.parquet(path)
    stored = spark.read.parquet(path)
    for df in (marts.inventory_health(stored), marts.stockout_risk(stored, date(2024, 1, 1))):
        assert "Exchange" not in plan_of(df)


def test_asof_windows_by_key_and_hour(spark):
    df = spark.range(100).selectExpr("if(id < 99, 'hot', 'cold') as k", "timestamp_ntz'2024-01-01' as at", "id")
    from stockyard.operators.asof import first_after

    plan = plan_of(first_after(df, df.selectExpr("k", "at as seen"), "k", "at", "seen", "next"))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    # both sides are combined to distinct instants before they are shuffled
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate.*\n.*Union", re.sub(r"\(\d+\)", "", plan))


def test_sizing():
    from stockyard.session import sizing

    assert sizing(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert sizing(10**13)["spark.sql.shuffle.partitions"] == "74506"
    assert sizing(10**15)["spark.sql.shuffle.partitions"] == "7450581"


def test_a_count_reads_the_key_only(spark, root):
    plan = plan_of(reports.movement_count(facts.fct_movements(staging.stg_movements(binding.movements(spark, root)))))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["event_id:bigint"]


def test_submitted_settings_win(spark):
    from stockyard.session import build_session, explicit

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert build_session().conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
        assert "spark.sql.session.timeZone" in explicit(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_inventory_goes_to_more_tasks_as_it_grows(spark, root, monkeypatch):
    """The share of one task is bounded, and one key still meets in one task before it is de-duplicated."""
    from pyspark.sql import functions as F
    from stockyard.operators import staging
    from stockyard.sources import binding

    whole = sorted(map(tuple, staging.stg_inventory(binding.inventory(spark, root)).collect()))
    monkeypatch.setattr(binding, "TASK_BYTES", 4096)
    stock = staging.stg_inventory(binding.inventory(spark, root))
    shares = [r["count"] for r in stock.groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) > 20 and max(shares) < len(whole) / 10
    assert sorted(map(tuple, stock.collect())) == whole


def test_products_are_told_apart_in_more_tasks_as_stock_grows(spark, root, monkeypatch):
    from pyspark.sql import functions as F
    from stockyard.plans.layers import Layers
    from stockyard.sources import binding

    whole = sorted(map(tuple, facts.dim_products(Layers(spark, root).stg_inventory).collect()))
    monkeypatch.setattr(binding, "TASK_BYTES", 4096)
    products = Layers(spark, root).dim_products
    shares = [r["count"] for r in products.groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) > 20 and max(shares) < len(whole) / 10
    assert sorted(map(tuple, products.collect())) == whole


def test_parents_of_a_relationship_are_combined_before_the_shuffle(spark):
    from stockyard.operators.quality import check_relationship

    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c"), (4, "c")], "id int, ref string")
    parents = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "key string")
    found = check_relationship(children, "ref", parents, "key")
    assert "Aggregate" in plan_of(found) and [tuple(r) for r in found.collect()] == [(2, "b")]


def test_declarative_tests_build_silver_once(spark, root, monkeypatch):
    from stockyard.operators import quality
    from stockyard.plans import catalog
    from stockyard.plans.layers import Layers

    built = []
    for name in ("orders", "inventory", "movements"):
        whole = getattr(binding, name)
        monkeypatch.setattr(binding, name, lambda *a, name=name, whole=whole: built.append(name) or whole(*a))
    found = catalog.QUERIES["test_results"](Layers(spark, root))
    assert sorted(built) == ["inventory", "movements", "orders"]
    assert not {"l_quantity", "o_orderpriority", "props"}.intersection(re.findall(r"\w+", plan_of(found.where("model like '%inventory%'"))))
    lake = Layers(spark, root)
    plain = quality.test_results({m: getattr(lake, m) for m in quality.TESTS})
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
