"""The registered queries: each takes a session and a folder of tables and returns a frame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockyard.functions.exprs import moment
from stockyard.functions.fixed import uf_of_ibge_code
from stockyard.operators import audit, churn, dedup, docs, enrich, marts, quality, reports, staging
from stockyard.operators.asof import first_after
from stockyard.plans import stored
from stockyard.plans.layers import EVENTS_AS_OF, ORDERS_AS_OF, Layers
from stockyard.session import scratch
from stockyard.sources import binding, extract, sinks, tables

BEFORE = (date(2001, 1, 1), date(2001, 4, 1))
AFTER = (date(2001, 4, 1), date(2001, 5, 1))
HALF_YEAR = datetime(2001, 2, 1)
SOME_DAY = date(2001, 6, 15)

GOLD = [
    "fct_orders", "fct_movements", "mart_order_sla", "mart_operator_productivity", "mart_picking_performance",
    "mart_stockout_risk", "mart_inventory_health",
]


def _gold(lake: Layers, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: getattr(lake, name) for name in names or GOLD}


def _proxy(lake: Layers) -> DataFrame:
    outbound = lake.outbound.where(F.col("movement_status") == marts.OUTBOUND_STATUS)
    orders = lake.fct_orders.select("order_id", "depositor_id", "issued_at")
    return first_after(orders, outbound, "depositor_id", "issued_at", "movement_date", "delivered_at_proxy").select(
        "order_id", "delivered_at_proxy"
    )


def _proxy_heavy_key(lake: Layers) -> DataFrame:
    """A third of all depositors folded into one."""
    folded = F.when(F.col("depositor_id").cast("long") % 3 == 0, "0").otherwise(F.col("depositor_id"))
    outbound = lake.outbound.where(F.col("movement_status") == marts.OUTBOUND_STATUS)
    orders = lake.fct_orders.select("order_id", "depositor_id", "issued_at").withColumn("depositor_id", folded)
    return first_after(
        orders, outbound.withColumn("depositor_id", folded), "depositor_id", "issued_at", "movement_date",
        "delivered_at_proxy",
    ).drop("depositor_id")


def _orders_left_geo(lake: Layers) -> DataFrame:
    place = lake.geo.where("entity_type = 'company'").alias("g")
    return lake.fct_orders.alias("o").join(place, F.col("g.entity_id") == F.col("o.company_id"), "left").select(
        "o.order_id", "o.company_id", F.col("g.localidade").alias("cidade"), "g.uf", "g.regiao"
    )


def _layer_summary(lake: Layers) -> DataFrame:
    return audit.layer_summary({
        "bronze.orders_documento": (lake.bronze("orders"), "dataemissao", "dataemissao"),
        "bronze.movements_entrada_saida": (lake.bronze("outbound"), "datamovimento", "datamovimento"),
        "bronze.products_snapshot": (lake.bronze("products"), None, "codigoproduto"),
        "bronze.inventory_produtoestoque": (lake.bronze("inventory"), None, "codigoproduto"),
    })


def _freshness(lake: Layers) -> DataFrame:
    return audit.freshness({
        "bronze.orders_documento": lake.bronze("orders"),
        "bronze.movements_entrada_saida": lake.bronze("movements"),
        "bronze.inventory_produtoestoque": lake.bronze("inventory"),
    }, ORDERS_AS_OF)


def _recency(lake: Layers) -> DataFrame:
    return audit.recency(
        {"fct_orders": (lake.fct_orders, "issued_at"), "fct_movements": (lake.fct_movements, "movement_date")},
        ORDERS_AS_OF,
    )


def _merge_incremental(lake: Layers) -> DataFrame:
    """Orders stored without delivery date, merged with a later load of the newer ones."""
    orders = lake.fct_orders
    stored = orders.where(F.col("issued_at") < moment(date(2000, 1, 1))).withColumn(
        "delivered_at", F.lit(None).cast("timestamp_ntz")
    )
    return tables.merged(stored, orders.where(F.col("issued_at") >= moment(date(1999, 7, 1))), ["order_id"])


def _watermark_scan(lake: Layers) -> DataFrame:
    return extract.scan(lake.bronze("orders"), "dataemissao", datetime(2001, 1, 1))


def _increment(lake: Layers) -> DataFrame:
    """The days behind those that a mart of the movements until some evening holds."""
    until = lake.fct_movements.where(F.col("movement_date") < moment(date(2024, 1, 21)))
    stored = marts.operator_productivity(until)
    return marts.operator_productivity(lake.fct_movements, tables.bound(stored, "period_date"))


def _append_new(lake: Layers) -> DataFrame:
    orders = lake.fct_orders.select("order_id", "issued_at")
    stored = orders.where(F.col("issued_at") < moment(date(2000, 1, 1)))
    return tables.without_keys(orders, stored, ["order_id"], null_safe=True)


def _normalise(lake: Layers) -> DataFrame:
    bronze = lake.bronze("orders").select(
        "sequenciaintegracao", "dataemissao", "dataentrega", F.to_date("dataemissao").alias("dia"),
        "valortotaldocumento",
    )
    return extract.normalise(bronze)


def _mask(lake: Layers) -> DataFrame:
    customer = binding.table(lake.spark, lake.root, "customer")
    return extract.mask_columns(customer.select(
        "c_custkey", F.col("c_name").alias("EMAIL"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).alias("document_number"),
    ))


def _envelope(lake: Layers) -> DataFrame:
    customer = binding.table(lake.spark, lake.root, "customer").select("c_custkey", "c_name", "c_nationkey")
    return extract.envelope(customer, "customers", "oracle_wms", "CLIENTE", "run-1", ORDERS_AS_OF)


def _evolve(lake: Layers) -> DataFrame:
    orders = lake.fct_orders
    old = orders.where(F.col("issued_at") < moment(date(2000, 1, 1))).select("order_id", "issued_at")
    new = orders.where(F.col("issued_at") >= moment(date(2000, 1, 1))).select("order_id", "issued_at", "document_type")
    old, new = tables.evolve(old, new)
    return old.unionByName(new)


def _documents(lake: Layers) -> DataFrame:
    """Documents under a path, as files of a documentation tree."""
    key = F.col("doc_id") % 4
    folder = (
        F.when(key == 0, "adr/note-").when(key == 1, "runbook/note-").when(key == 2, "system-architecture-")
        .otherwise("runbooks/note-")
    )
    return binding.table(lake.spark, lake.root, "documents").select(
        "doc_id", "text", F.concat(F.lit("docs/"), folder, F.col("doc_id").cast("string"), F.lit(".md")).alias("path")
    )


def _movement_source(lake: Layers) -> DataFrame:
    """Movements as the source has them: some without a movement date, which the history date stands in for."""
    missing = F.col("l_orderkey") % 5 == 0
    return binding.table(lake.spark, lake.root, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sequenciamovimento"),
        F.when(~missing, F.col("l_shipdate")).alias("datamovimento"), F.col("l_shipdate").alias("datahistorico"),
    )


def _movement_window(start: datetime, end: datetime | None = None) -> Callable[[Layers], DataFrame]:
    def run(lake: Layers) -> DataFrame:
        rows = extract.source_window(_movement_source(lake), extract.ENTITIES["movements_entrada_saida"], start, end)
        return rows.select("sequenciamovimento", F.coalesce("datamovimento", "datahistorico").alias("datamovimento"))

    return run


def _cosine(lake: Layers) -> DataFrame:
    vectors = binding.table(lake.spark, lake.root, "embeddings")
    query = vectors.orderBy("vec_id").select("embedding").first()[0]  # the question: one vector
    return docs.cosine_topk(vectors, query).select("vec_id", "label", F.round("score", 6).alias("score"))


def _search(lake: Layers) -> DataFrame:
    """The documents nearest to each of many questions, with their payload; each tenth vector asks."""
    documents = binding.table(lake.spark, lake.root, "documents").select("doc_id", "source", "lang")
    index = binding.table(lake.spark, lake.root, "embeddings").join(documents, F.col("vec_id") == F.col("doc_id"))
    questions = index.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    found = docs.search(index.drop("doc_id"), questions)
    return found.select("query_id", "rank", "vec_id", "source", "lang", F.round("score", 6).alias("score"))


def _index_recall(lake: Layers) -> DataFrame:
    """The same questions put to a stored index, held against the exact search."""
    path = scratch(lake.spark, "index")
    vectors = binding.table(lake.spark, lake.root, "embeddings")
    docs.build_index(vectors, path)
    asked = vectors.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    found = docs.recall(docs.search_index(lake.spark, path, asked), docs.search(vectors, asked))
    return found.select("questions", "neighbours", (F.col("recall") >= 0.9).alias("enough"))


def _chart(name: str, as_of: datetime) -> Callable[[Layers], DataFrame]:
    def run(lake: Layers) -> DataFrame:
        chart = reports.charts(as_of)[name]
        return reports.run_chart(getattr(lake, chart.table), chart)

    return run


# the chart of one day shows the last full day of the events
CHARTS = {
    f"chart_{name}": _chart(name, datetime(2024, 1, 30) if name == "moves_today_by_hour" else EVENTS_AS_OF)
    for name in reports.charts(EVENTS_AS_OF)
}

QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    "stg_orders": lambda k: k.stg_orders,
    "stg_inventory": lambda k: k.stg_inventory,
    "stg_movements": lambda k: staging.stg_movements(k.bronze("outbound")),
    "fct_orders": lambda k: k.fct_orders,
    "fct_movements": lambda k: k.fct_movements,
    "fct_inventory_snapshot": lambda k: k.fct_inventory_snapshot,
    "dim_products": lambda k: k.dim_products,
    "dedup_latest": lambda k: dedup.dedup_latest(k.outbound, ["movement_id"], "movement_date"),
    "mart_order_sla": lambda k: k.mart_order_sla,
    "mart_inventory_health": lambda k: k.mart_inventory_health,
    "mart_stockout_risk": lambda k: k.mart_stockout_risk,
    "mart_operator_productivity": lambda k: k.mart_operator_productivity,
    "mart_picking_performance": lambda k: k.mart_picking_performance,
    "mart_geo_performance": lambda k: k.mart_geo_performance,
    "mart_geo_inventory": lambda k: k.mart_geo_inventory,
    "mart_weather_impact": lambda k: k.mart_weather_impact,
    "asof_proxy": _proxy,
    "asof_proxy_heavy_key": _proxy_heavy_key,
    "orders_left_geo": _orders_left_geo,
    "layer_summary": _layer_summary,
    "ingestion_gaps": lambda k: audit.gaps(k.bronze("orders"), k.bronze("outbound"), date(2001, 10, 1)),
    "duplicate_keys": lambda k: audit.duplicate_keys(
        k.bronze("outbound"), "sequenciamovimento", "movements_entrada_saida"
    ),
    "orphan_count": lambda k: audit.orphan_count(k.outbound, k.fct_orders),
    "orphan_by_month": lambda k: audit.orphan_months(k.outbound, k.fct_orders),
    "orphan_class": lambda k: audit.orphan_class(k.outbound, k.fct_orders),
    "delivery_coverage": lambda k: audit.delivery_coverage(k.mart_order_sla),
    "sla_distribution": lambda k: audit.status_share(k.mart_order_sla, HALF_YEAR),
    "active_clients": lambda k: audit.active_clients(k.mart_order_sla, HALF_YEAR),
    "mart_counts": lambda k: audit.table_counts(_gold(k, [g for g in GOLD if g.startswith("mart_")])),
    "freshness": _freshness,
    "recency": _recency,
    "freshness_summary": lambda k: audit.freshness_summary({
        "orders_bronze": (k.bronze("orders"), "_cdc_loaded_at"),
        "movements_bronze": (k.bronze("movements"), "_cdc_loaded_at"),
        "orders_gold": (k.fct_orders, "issued_at"), "movements_gold": (k.fct_movements, "movement_date"),
        "mart_sla": (k.mart_order_sla, "issued_at"),
    }),
    "silver_metrics": lambda k: audit.silver_metrics("movements", k.bronze("outbound"), "sequenciamovimento", "run-1"),
    "gold_counts": lambda k: audit.table_counts(_gold(k, [
        "fct_orders", "fct_movements", "dim_products", "mart_order_sla", "mart_operator_productivity",
        "mart_picking_performance", "mart_stockout_risk", "mart_inventory_health", "mart_geo_performance",
    ])),
    "date_profile": lambda k: audit.date_profile(k.fct_orders, "delivered_at", "issued_at"),
    "pending_alarm": lambda k: audit.pending_alarm(k.mart_order_sla, share=0.05, days=3),
    "lost_clients": lambda k: churn.lost_clients(k.mart_order_sla, BEFORE, AFTER),
    "churn_summary": lambda k: churn.churn_summary(k.mart_order_sla, BEFORE, AFTER),
    "lost_sla": lambda k: churn.lost_sla(k.mart_order_sla, BEFORE, AFTER),
    "new_clients": lambda k: churn.new_clients(k.mart_order_sla, BEFORE, AFTER),
    "gate_rows": lambda k: quality.row_gate(_gold(k)),
    "gate_nulls": lambda k: quality.null_gate(_gold(k)),
    "test_results": lambda k: quality.test_results(_gold(k.staged(), list(quality.TESTS))),
    "test_unique": lambda k: quality.check_unique(k.outbound, "movement_id"),
    "test_not_null": lambda k: quality.check_not_null(k.fct_orders, "delivered_at").select("order_id", "issued_at"),
    "test_accepted_values": lambda k: quality.check_accepted_values(k.fct_movements, "notes", ["purchase", "view"]),
    "test_relationship": lambda k: quality.check_relationship(
        k.fct_orders.select("order_id", "depositor_id"), "depositor_id", k.fct_inventory_snapshot, "warehouse_id"
    ),
    "test_volume": lambda k: quality.volume_anomaly(k.outbound, "movement_date"),
    "distinct_products_by_month": lambda k: audit.distinct_check(k.outbound, "movement_date", "product_id"),
    "kpis": lambda k: reports.kpis(k.mart_order_sla),
    "movement_count": lambda k: reports.movement_count(k.fct_movements),
    "items_at_risk": lambda k: reports.items_at_risk(k.mart_stockout_risk),
    "on_time_pct": lambda k: reports.on_time_pct(k.mart_order_sla),
    "moves_per_day": lambda k: reports.moves_per_day(k.fct_movements, datetime(2024, 1, 10), datetime(2024, 1, 20)),
    "status_pivot": lambda k: reports.status_pivot(k.mart_order_sla),
    "month_company": lambda k: reports.month_company(k.mart_order_sla),
    "monthly_revenue": lambda k: reports.monthly_revenue(k.fct_orders, ORDERS_AS_OF),
    "document_types": lambda k: reports.document_types(k.fct_orders),
    "top_operators": lambda k: reports.top_operators(k.mart_operator_productivity),
    "backlog_ageing": lambda k: reports.backlog_ageing(k.mart_order_sla, ORDERS_AS_OF),
    "oldest_open": lambda k: reports.oldest_open(k.mart_order_sla, ORDERS_AS_OF),
    "stockout_table": lambda k: reports.stockout_table(k.mart_stockout_risk),
    "sla_by_place": lambda k: reports.sla_by_place(k.geo, k.mart_geo_performance),
    "state_rank": lambda k: reports.state_rank(k.geo, k.mart_geo_performance),
    "region_sla": lambda k: reports.region_sla(k.geo, k.mart_geo_performance),
    "rain_by_day": lambda k: reports.rain_by_day(k.weather, ORDERS_AS_OF),
    "delay_by_day": lambda k: reports.delay_by_day(k.mart_weather_impact, k.geo, ORDERS_AS_OF),
    "temperature_series": lambda k: reports.temperature_series(k.weather, ORDERS_AS_OF),
    "run_counts": lambda k: reports.run_counts(k.bronze("job_runs"), EVENTS_AS_OF),
    "run_history": lambda k: reports.run_history(k.bronze("job_runs"), EVENTS_AS_OF),
    "recent_failures": lambda k: reports.recent_failures(k.bronze("job_runs")),
    "task_durations": lambda k: reports.task_durations(k.bronze("job_runs"), EVENTS_AS_OF),
    **CHARTS,
    "summary_orders": lambda k: reports.summary_orders(k.fct_orders, k.fct_movements),
    "summary_inventory": lambda k: reports.summary_inventory(k.fct_inventory_snapshot),
    "summary_movements": lambda k: reports.summary_movements(k.fct_movements),
    "revenue_by_day": lambda k: reports.revenue_by_day(k.fct_orders),
    "newest_revenue_days": lambda k: reports.newest_revenue_days(k.fct_orders),
    "revenue_of_day": lambda k: reports.revenue_of_day(k.fct_orders, SOME_DAY),
    "item_revenue": lambda k: reports.item_revenue(k.bronze("order_items"), k.bronze("order_headers"), SOME_DAY),
    "estimated_total": lambda k: reports.estimated_total(k.bronze("order_items")),
    "estimated_by_product": lambda k: reports.estimated_by_product(k.bronze("order_items")),
    "estimated_by_order": lambda k: reports.estimated_by_order(k.bronze("order_items")),
    "revenue_file": lambda k: sinks.revenue_file(reports.revenue_by_day(k.fct_orders)),
    "product_file": lambda k: sinks.product_file(reports.estimated_by_product(k.bronze("order_items"), limit=None)),
    "order_file": lambda k: sinks.order_file(reports.estimated_by_order(k.bronze("order_items"), limit=None)),
    "orders_per_day": lambda k: reports.orders_per_day(k.bronze("order_headers")),
    "merge_incremental": _merge_incremental,
    "watermark_scan": lambda k: _watermark_scan(k).select(
        "sequenciaintegracao", "dataemissao", F.col("valortotaldocumento").cast("double").alias("valortotaldocumento")
    ),
    "watermark_scan_movements": _movement_window(datetime(2001, 6, 1)),
    "full_window_scan": _movement_window(datetime(2000, 1, 1), datetime(2000, 3, 31)),
    "new_watermark": lambda k: _watermark_scan(k).agg(F.max("dataemissao").alias("last_successful_value")).select(
        F.lit("orders_documento").alias("entity_name"), "last_successful_value"
    ),
    "high_water_increment": _increment,
    "append_new": _append_new,
    "normalise_values": _normalise,
    "mask_columns": _mask,
    "bronze_envelope": _envelope,
    "evolve_schema": _evolve,
    "geo_enrich": lambda k: enrich.geo_reference(k.bronze("entities"), k.bronze("addresses")),
    "state_of_ibge_code": lambda k: k.bronze("address_book").select(
        F.col("cep").cast("long").cast("string").alias("entity_id"), uf_of_ibge_code("ibge").alias("uf")
    ),
    "weather_explode": lambda k: enrich.explode_weather(k.bronze("weather_responses")),
    "weather_requests": lambda k: enrich.weather_requests(k.geo, ORDERS_AS_OF),
    "chunk_documents": lambda k: docs.chunk(binding.table(k.spark, k.root, "documents"), "doc_id", sep=r"\n+"),
    "index_documents": lambda k: docs.index_documents(_documents(k), "path", "text", sep=r"\n+"),
    "cosine_topk": _cosine,
    "cosine_search": _search,
    "cosine_index_recall": _index_recall,
    **stored.QUERIES,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, root, build=build: build(Layers(spark, root))) for name, build in QUERIES.items()}
