"""Bronze, silver and gold wired together over one folder of benchmark tables. Nothing runs until an action."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stockyard.operators import facts, marts, staging
from stockyard.session import scratch
from stockyard.sources import binding

ORDERS_AS_OF = datetime(2001, 8, 1)
EVENTS_AS_OF = datetime(2024, 1, 31)


class Layers:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def bronze(self, name: str) -> DataFrame:
        return getattr(binding, name)(self.spark, self.root)

    def staged(self) -> Layers:
        """The same layers over silver tables that are written once, for what reads many models in full."""
        lake = Layers(self.spark, self.root)
        for name in ("stg_orders", "stg_inventory", "stg_movements"):
            path = scratch(self.spark, name)
            getattr(self, name).write.parquet(path)
            setattr(lake, name, self.spark.read.parquet(path))
        return lake

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.bronze("orders"))

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return staging.stg_inventory(self.bronze("inventory"))

    @cached_property
    def stg_movements(self) -> DataFrame:
        return staging.stg_movements(self.bronze("movements"))

    @cached_property
    def outbound(self) -> DataFrame:
        """Typed bronze movements; the service-level mart reads them before de-duplication."""
        return staging.project_movements(self.bronze("outbound"))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(self.stg_orders)

    @cached_property
    def fct_movements(self) -> DataFrame:
        return facts.fct_movements(self.stg_movements)

    @cached_property
    def fct_inventory_snapshot(self) -> DataFrame:
        return facts.fct_inventory_snapshot(self.stg_inventory)

    @cached_property
    def dim_products(self) -> DataFrame:
        return facts.dim_products(self.stg_inventory, binding.tasks(self.spark, self.root, "lineitem"))

    @cached_property
    def geo(self) -> DataFrame:
        return self.bronze("geo_reference")

    @cached_property
    def weather(self) -> DataFrame:
        return self.bronze("weather_daily")

    @cached_property
    def mart_order_sla(self) -> DataFrame:
        return marts.order_sla(self.fct_orders, self.outbound)

    @cached_property
    def mart_inventory_health(self) -> DataFrame:
        return marts.inventory_health(self.fct_inventory_snapshot)

    @cached_property
    def mart_stockout_risk(self) -> DataFrame:
        return marts.stockout_risk(self.fct_inventory_snapshot, ORDERS_AS_OF)

    @cached_property
    def mart_operator_productivity(self) -> DataFrame:
        return marts.operator_productivity(self.fct_movements)

    @cached_property
    def mart_picking_performance(self) -> DataFrame:
        return marts.picking_performance(self.fct_movements)

    @cached_property
    def mart_geo_performance(self) -> DataFrame:
        return marts.geo_performance(self.fct_orders, self.geo)

    @cached_property
    def mart_geo_inventory(self) -> DataFrame:
        return marts.geo_inventory(self.fct_inventory_snapshot, self.geo)

    @cached_property
    def mart_weather_impact(self) -> DataFrame:
        return marts.weather_impact(self.fct_orders, self.geo, self.weather)
