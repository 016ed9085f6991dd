"""Silver to gold facts and the product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

ORDER_FACT = [
    "order_id", "doc_seq", "document_number", "document_series", "document_type", "company_id", "depositor_id",
    "issued_at", "delivered_at", "total_value",
]
MOVEMENT_FACT = [
    "movement_id", "product_id", "warehouse_id", "depositor_id", "qty_before", "qty_after", "qty_delta",
    "movement_date", "movement_status", "operator_user", "notes",
]
INVENTORY_FACT = [
    "inventory_id", "product_id", "warehouse_id", "company_id", "ideal_stock_qty", "min_stock_qty",
    "max_stock_qty", "safety_stock_qty", "reorder_point", "avg_consumption", "product_class",
]
PRODUCT_KEY = ["product_id", "warehouse_id", "company_id", "product_class"]


def fct_orders(stg: DataFrame) -> DataFrame:
    return stg.select(*ORDER_FACT)


def fct_movements(stg: DataFrame) -> DataFrame:
    return stg.select(*MOVEMENT_FACT)


def fct_inventory_snapshot(stg: DataFrame) -> DataFrame:
    return stg.select(*INVENTORY_FACT)


def dim_products(stg_inventory: DataFrame, tasks: int | None = None) -> DataFrame:
    """The different products in stock; with ``tasks``, told apart in so many."""
    keys = stg_inventory.select(*PRODUCT_KEY).na.drop(subset=PRODUCT_KEY)
    return (keys.repartition(tasks, *PRODUCT_KEY) if tasks else keys).distinct()
