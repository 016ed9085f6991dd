"""Queries over tables that loads and merges have stored: each runs its loads into a new folder and reads the result."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from stockyard.functions.exprs import moment
from stockyard.operators import marts, quality
from stockyard.plans import gold, refresh
from stockyard.plans.layers import Layers
from stockyard.schemas import GEO_REFERENCE
from stockyard.session import scratch
from stockyard.sources import binding, checkpoints, extract, tables

FIRST, SECOND = datetime(2000, 1, 1), datetime(2001, 8, 1)
ORDERS = extract.ENTITIES["orders_documento"]


def _source(lake: Layers) -> DataFrame:
    return lake.bronze("orders").drop("_cdc_loaded_at")


def overlap_load(lake: Layers) -> DataFrame:
    """A first load without watermark reaches two days back; the next starts at its watermark, whose rows come twice."""
    at, source = scratch(lake.spark, "load"), _source(lake)
    load = lambda df, run, as_of: extract.extract(lake.spark, df, ORDERS, at, f"{at}/marks", run, as_of, days=2)
    load(source.where(F.col("dataemissao") < moment(FIRST)), "r1", FIRST)
    load(source, "r2", SECOND)
    return tables.read(lake.spark, f"{at}/{ORDERS.name}").groupBy("sequenciaintegracao").agg(F.count("*").alias("times"))


def checkpoint_rules(lake: Layers) -> DataFrame:
    """The checkpoint after a load, after one with too few rows, after the replay of a window, and after a reset."""
    at, source, spark = scratch(lake.spark, "marks"), _source(lake), lake.spark
    marks, steps = f"{at}/marks", []

    def step(name: str, df: DataFrame, **how) -> None:
        extract.extract(spark, df, ORDERS, at, marks, name, SECOND, mode=extract.FULL_WINDOW, days=3650, **how)
        steps.append((name, checkpoints.last_value(spark, marks, ORDERS.name)))

    step("load", source.where(F.col("dataemissao") < moment(FIRST)))
    step("too few rows", source, min_rows=10**9)
    step("replay", source, window=(FIRST, SECOND))
    step("next load", source)
    checkpoints.reset(spark, marks, ORDERS.name)
    steps.append(("reset", checkpoints.last_value(spark, marks, ORDERS.name)))
    return spark.createDataFrame(steps, "step string, last_value timestamp_ntz")


def snapshot_load(lake: Layers) -> DataFrame:
    """A snapshot replaces the one before: the second load has half of the products."""
    at = scratch(lake.spark, "snapshot")
    part = binding.table(lake.spark, lake.root, "part").selectExpr(
        "cast(p_partkey as string) as CODIGOPRODUTO", "p_name as DESCRICAOPRODUTO", "p_type as CLASSIFICACAOPRODUTO"
    )
    for run, rows in (("r1", part), ("r2", part.where("cast(CODIGOPRODUTO as long) % 2 = 0"))):
        extract.extract(lake.spark, rows, extract.ENTITIES["products_snapshot"], at, f"{at}/marks", run, SECOND)
    return tables.read(lake.spark, f"{at}/products_snapshot").select("codigoproduto", "descricaoproduto")


def upsert_places(lake: Layers) -> DataFrame:
    """Places resolved once, and again for some entities later: each keeps the time of its last resolution."""
    at, entities = scratch(lake.spark, "geo"), lake.bronze("entities")
    for when, rows in ((FIRST, entities), (SECOND, entities.where("cast(entity_id as long) % 2 = 0"))):
        refresh.refresh_geo(rows, lake.bronze("addresses"), at, when)
    return tables.read(lake.spark, at).select("entity_type", "entity_id", "uf", "_enriched_at")


def upsert_weather(lake: Layers) -> DataFrame:
    at, responses = scratch(lake.spark, "weather"), lake.bronze("weather_responses")
    for when in (FIRST, SECOND):
        refresh.refresh_weather(responses, at, when)
    return tables.read(lake.spark, at).select("location_uf", "weather_date", "max_temperature_c", "_enriched_at")


def full_refresh(lake: Layers) -> DataFrame:
    """A stored mart, then a full refresh from other days: nothing of the first build is left."""
    at = scratch(lake.spark, "mart")
    keys = ["operator_user", "warehouse_id", "period_date"]
    moves = lake.fct_movements

    def build(rows: DataFrame, **how) -> None:
        tables.materialize(
            lake.spark, at, keys, lambda since: marts.operator_productivity(rows, since), "period_date",
            partition=tables.By("period_date"), **how,
        )

    build(moves.where(F.col("movement_date") < moment(date(2024, 1, 15))))
    build(moves.where(F.col("movement_date") >= moment(date(2024, 1, 10))), full_refresh=True)
    return tables.read(lake.spark, at)


def stored_increment(lake: Layers) -> DataFrame:
    """A mart built from the movements until an evening, and brought up to date from all: its days, merged by day."""
    at = scratch(lake.spark, "mart")
    for rows in (lake.fct_movements.where(F.col("movement_date") < moment(date(2024, 1, 21))), lake.fct_movements):
        tables.materialize(
            lake.spark, at, ["operator_user", "warehouse_id", "period_date"],
            lambda since, rows=rows: marts.operator_productivity(rows, since), "period_date", partition=tables.By("period_date"),
        )
    return tables.read(lake.spark, at)


def fact_by_loads(lake: Layers) -> DataFrame:
    """Orders that arrive in two loads, the second of which also changes and re-dates older ones."""
    root = scratch(lake.spark, "lake")
    warehouse = gold.Warehouse(lake.spark, f"{root}/bronze", f"{root}/gold", SECOND)
    orders, model = lake.bronze("orders"), gold.FACTS[0]
    early = F.col("dataemissao") < moment(FIRST)
    wrong = F.col("sequenciaintegracao").cast("long") % 100 == 0
    spoilt = orders.where(early).withColumns({
        "dataemissao": F.when(wrong, F.col("dataemissao") - F.expr("interval 40 days")).otherwise(F.col("dataemissao")),
        "dataentrega": F.when(wrong, F.lit(None)).otherwise(F.col("dataentrega")), "_cdc_loaded_at": moment(FIRST),
    })
    later = orders.where(~early | wrong).withColumn("_cdc_loaded_at", moment(SECOND))
    for run, rows in (("r1", spoilt), ("r2", later)):
        tables.append(rows, f"{warehouse.bronze_root}/{model.loads}", run)
        gold.take_loads(warehouse, model, quality.Measured(model.name), run)
    return warehouse.gold(model.name)


def optional_source(lake: Layers) -> DataFrame:
    """Stock by place without a table of places."""
    none = tables.optional_source(lake.spark, scratch(lake.spark, "nothing"), GEO_REFERENCE)
    return marts.geo_inventory(lake.fct_inventory_snapshot, none).select("warehouse_id", "company_id", "product_class", "cidade", "uf")


def stored_failures(lake: Layers) -> DataFrame:
    """The failing rows of a test, kept."""
    at = scratch(lake.spark, "failures")
    quality.store_failures(quality.check_not_null(lake.fct_orders, "delivered_at").select("order_id", "issued_at"), at)
    return lake.spark.read.parquet(at)


def stored_counts(lake: Layers) -> DataFrame:
    """Rows of stored tables, one by month and one with an append, from their footers."""
    at = scratch(lake.spark, "counts")
    tables.create(lake.fct_orders, f"{at}/fct_orders", ["order_id"], partition=tables.By("issued_at", "month"))
    moves = lake.fct_movements.select("movement_id", "movement_date")
    for day in (moves.where("movement_date < '2024-01-10'"), moves.where("movement_date >= '2024-01-10'")):
        tables.append(day, f"{at}/fct_movements")
    return tables.row_counts(lake.spark, {n: f"{at}/{n}" for n in ("fct_orders", "fct_movements")})


def bronze_by_day(lake: Layers) -> DataFrame:
    """Source rows of one day, out of envelopes stored by entity and day."""
    at = scratch(lake.spark, "envelopes")
    customer = binding.table(lake.spark, lake.root, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    for run, when, rows in (("r1", FIRST, customer), ("r2", SECOND, customer.where("c_custkey % 2 = 1"))):
        extract.write_envelope(extract.envelope(rows, "customers", "oracle_wms", "CLIENTE", run, when), at)
    day = extract.read_envelope(lake.spark, at, "customers", SECOND.date(), SECOND.date())
    return extract.unwrapped(day, customer.schema)


def appended_columns(lake: Layers) -> DataFrame:
    """Two loads of a table, the second with a column more."""
    at, orders = scratch(lake.spark, "appends"), lake.fct_orders
    early = F.col("issued_at") < moment(FIRST)
    tables.append(orders.where(early).select("order_id", "issued_at"), at, "r1")
    tables.append(orders.where(~early).select("order_id", "issued_at", "document_type"), at, "r2")
    return tables.read(lake.spark, at).select("order_id", "issued_at", "document_type")


def time_zone_rule(lake: Layers) -> DataFrame:
    """Times with a zone become UTC without one; times without stay as they are."""
    orders = binding.table(lake.spark, lake.root, "orders").selectExpr(
        "o_orderkey", "o_orderdate as plain", "to_timestamp(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') || '+02:00') as zoned"
    )
    return extract.normalise(orders)


QUERIES = {
    f.__name__: f for f in (
        overlap_load, checkpoint_rules, snapshot_load, upsert_places, upsert_weather, full_refresh, stored_increment, fact_by_loads,
        optional_source, stored_failures, stored_counts, bronze_by_day, appended_columns, time_zone_rule,
    )
}
