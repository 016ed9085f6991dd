"""Build the gold layer out of stored bronze tables: facts first, then the marts that read them."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockyard.functions.exprs import moment
from stockyard.operators import facts, marts, quality, staging
from stockyard.operators.quality import Measured
from stockyard.schemas import JOB_METRICS
from stockyard.session import sized
from stockyard.sources import checkpoints, tables

log = logging.getLogger(__name__)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Warehouse:
    """Where the layers are stored. Silver is computed on the fly; facts and marts are tables."""

    def __init__(self, spark: SparkSession, bronze_root: str, gold_root: str, as_of: datetime):
        self.spark, self.bronze_root, self.gold_root, self.as_of = spark, bronze_root, gold_root, as_of

    def bronze(self, name: str) -> DataFrame:
        """A mandatory bronze table; it raises where there is none."""
        return tables.read(self.spark, f"{self.bronze_root}/{name}")

    def loaded(self, name: str, after: datetime | None, until: datetime | None) -> DataFrame:
        """Bronze rows of the loads in between. A row without load time counts as new each time. Appends of one load
        have one load time, so their footers keep older files unread."""
        rows = self.bronze(name)
        if after is None:
            return rows
        return rows.where(((F.col(staging.LOADED) > moment(after)) & (F.col(staging.LOADED) <= moment(until))) | F.col(staging.LOADED).isNull())

    def bronze_bytes(self) -> int:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.bronze_root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.getContentSummary(root).getLength() if fs.exists(root) else 0

    def enrichment(self, name: str) -> DataFrame | None:
        """An optional bronze table: without it the marts show NULL in its columns."""
        path = f"{self.bronze_root}/{name}"
        return tables.read(self.spark, path) if tables.exists(self.spark, path) else None

    def gold_path(self, name: str) -> str:
        return f"{self.gold_root}/{name}"

    def gold(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.gold_path(name))


@dataclass(frozen=True)
class Model:
    """A gold table. ``build`` gets the warehouse and where to start: the stored high-water mark of a mart, the rows of the
    new loads of a fact with ``loads``, else nothing."""

    name: str
    keys: tuple[str, ...]
    build: Callable[[Warehouse, datetime | DataFrame | None], DataFrame]
    high_water: str | None = None
    sort_by: str | None = None  # the date that increments filter on
    inputs: tuple[str, ...] = ()  # gold tables it reads
    by: tables.By | None = None  # its folders: a merge reads and writes those that it touches
    loads: str | None = None  # the bronze table whose new loads it takes in


FACTS = [
    Model("fct_orders", ("order_id",),
          lambda w, rows: facts.fct_orders(staging.newest_orders(rows)),
          sort_by="issued_at", by=tables.By("issued_at", "month"), loads="orders_documento"),
    Model("fct_movements", ("movement_id",),
          lambda w, rows: facts.fct_movements(staging.newest_movements(rows)),
          sort_by="movement_date", by=tables.By("movement_date", "month"), loads="movements_entrada_saida"),
    Model("fct_inventory_snapshot", ("inventory_id",),
          lambda w, _: facts.fct_inventory_snapshot(staging.stg_inventory(w.bronze("inventory_produtoestoque")))),
    Model("dim_products", tuple(facts.PRODUCT_KEY),
          lambda w, _: facts.dim_products(staging.stg_inventory(w.bronze("inventory_produtoestoque")))),
]
MARTS = [
    Model("mart_order_sla", ("order_id",),
          lambda w, since: marts.order_sla(
              w.gold("fct_orders"), staging.project_movements(w.bronze("movements_entrada_saida")), since),
          "issued_at", sort_by="issued_at", inputs=("fct_orders",), by=tables.By("issued_at", "month")),
    Model("mart_inventory_health", ("inventory_id",),
          lambda w, _: marts.inventory_health(w.gold("fct_inventory_snapshot")), inputs=("fct_inventory_snapshot",)),
    Model("mart_stockout_risk", ("inventory_id",),
          lambda w, _: marts.stockout_risk(w.gold("fct_inventory_snapshot"), w.as_of), inputs=("fct_inventory_snapshot",)),
    Model("mart_operator_productivity", ("operator_user", "warehouse_id", "period_date"),
          lambda w, since: marts.operator_productivity(w.gold("fct_movements"), since), "period_date", inputs=("fct_movements",),
          by=tables.By("period_date")),
    Model("mart_picking_performance", ("operator_user", "warehouse_id", "shift_date", "shift"),
          lambda w, since: marts.picking_performance(w.gold("fct_movements"), since), "shift_date", inputs=("fct_movements",),
          by=tables.By("shift_date")),
    Model("mart_geo_performance", ("company_id", "depositor_id", "issued_month"),
          lambda w, since: marts.geo_performance(w.gold("fct_orders"), w.enrichment("geo_reference"), since),
          "issued_month", inputs=("fct_orders",), by=tables.By("issued_month", "month")),
    Model("mart_geo_inventory", ("warehouse_id", "company_id", "product_class"),
          lambda w, _: marts.geo_inventory(w.gold("fct_inventory_snapshot"), w.enrichment("geo_reference")), inputs=("fct_inventory_snapshot",)),
    Model("mart_weather_impact", ("company_id", "depositor_id", "issued_date"),
          lambda w, since: marts.weather_impact(
              w.gold("fct_orders"), w.enrichment("geo_reference"), w.enrichment("weather_daily"), since),
          "issued_date", inputs=("fct_orders",), by=tables.By("issued_date", "month")),
]


def take_loads(
    warehouse: Warehouse, model: Model, measured: Measured, run_id: str, full_refresh: bool = False, reopen: timedelta = timedelta(0),
) -> None:
    """Merge the rows of the loads since the last build into a fact, in the months that they touch, and remember the load
    time only after that. A run that is lost in between takes the same loads again, with the same result."""
    spark, path = warehouse.spark, warehouse.gold_path(model.name)
    marks = f"{warehouse.gold_root}/_loads/{model.name}"
    fresh = full_refresh or not tables.exists(spark, path)
    last = None if fresh else checkpoints.last_value(spark, marks, model.name)
    top = warehouse.bronze(model.loads).agg(F.max(staging.LOADED)).first()[0]
    rows = warehouse.loaded(model.loads, last - reopen if last else None, top)
    new = measured.over(model.build(warehouse, rows))
    if last is None:
        tables.create(new, path, model.keys, partition=model.by, sort_by=model.sort_by, may_be_empty=False)
    else:
        tables.merge_partitions(spark, new, path, model.keys, model.by, sort_by=model.sort_by)
    if top is not None:
        mark = checkpoints.Checkpoint(
            model.name, "bronze", "timestamp", top.isoformat(), run_id, warehouse.as_of, last, top, "success"
        )
        checkpoints.save(spark, marks, mark, measured.rows())


def build_gold(
    warehouse: Warehouse, run_id: str, full_refresh: bool = False, lookback: timedelta = timedelta(0),
    threads: int = 4, reopen: timedelta = timedelta(0),
) -> DataFrame:
    """Bring every fact and mart up to date and return the run's metrics, one row per table.

    Models of one stage do not depend on each other and are submitted side by side, so that the tail of one fills with
    tasks of the next. A model that fails is reported as failed and leaves its table as it was; models that read it are
    skipped. After a success all but the two newest versions of the table are deleted. ``reopen`` goes back behind the
    newest load that a fact has taken in, for loads that were published late. The declared tests are counted while the
    rows are written, and kept for ``test_results``.
    """
    spark = warehouse.spark
    broken: set[str] = set()
    tested: list[tuple] = []

    def run(model: Model) -> tuple:
        path, began = warehouse.gold_path(model.name), _now()
        if broken.intersection(model.inputs):
            broken.add(model.name)
            return ("build_gold", model.name, "skipped", began, _now(), 1, None, None, None, run_id)
        try:
            measured = Measured(model.name)
            if model.loads:
                take_loads(warehouse, model, measured, run_id, full_refresh, reopen)
            else:
                tables.materialize(
                    spark, path, model.keys, lambda since: measured.over(model.build(warehouse, since)),
                    model.high_water, lookback, full_refresh, partition=model.by, sort_by=model.sort_by,
                )
            state, rows = "success", tables.read(spark, path).count()
            tested.extend((run_id, *result) for result in measured.results())
            tables.expire(spark, path)
        except Exception:  # noqa: BLE001 - the state is reported, the other models go on
            log.exception("%s failed", model.name)
            state, rows = "failed", None
            broken.add(model.name)
        return ("build_gold", model.name, state, began, _now(), 1, None, rows, None, run_id)

    def stage(models: Iterable[Model]) -> list[tuple]:
        with ThreadPoolExecutor(threads) as pool:
            return list(pool.map(run, models))

    with sized(spark, warehouse.bronze_bytes()):
        metrics = stage(FACTS) + stage(MARTS)
    if tested:
        tables.append(spark.createDataFrame(tested, TESTED), f"{warehouse.gold_root}/_tests", run_id)
    return spark.createDataFrame(metrics, JOB_METRICS)


def stored_counts(warehouse: Warehouse) -> DataFrame:
    """Rows of every gold table there is, from the footers of its files."""
    names = [m.name for m in FACTS + MARTS]
    paths = {n: warehouse.gold_path(n) for n in names if tables.exists(warehouse.spark, warehouse.gold_path(n))}
    return tables.row_counts(warehouse.spark, paths)


TESTED = "run_id string, model string, test string, column_name string, failures long, rows long"


def test_results(warehouse: Warehouse, run_id: str) -> DataFrame:
    """The declared tests over the rows that a run has written: model, test, column_name, failures, rows."""
    return tables.read(warehouse.spark, f"{warehouse.gold_root}/_tests").where(F.col("run_id") == run_id).drop("run_id")


test_results.__test__ = False  # not a test case


def null_gate(warehouse: Warehouse, run_id: str) -> DataFrame:
    """The null gate over the rows that a run has written; rows of earlier runs passed it when they were written."""
    stopping = F.struct("model", "column_name").isin([F.struct(F.lit(t), F.lit(c)) for t, c in quality.NEVER_NULL])
    found = test_results(warehouse, run_id).where((F.col("test") == "not_null") & stopping)
    return found.select(
        F.col("model").alias("table_name"), "column_name", F.col("failures").alias("null_count"),
        F.when(F.col("failures") == 0, "OK").otherwise("FAIL").alias("status"),
    )


def row_gate(metrics: DataFrame, least: dict[str, int] = quality.MIN_ROWS) -> DataFrame:
    """The row gate from the metrics of a run, which hold each table's row count."""
    limits = F.create_map(*[F.lit(v) for pair in least.items() for v in pair])[F.col("task")]
    enough = F.coalesce(F.col("rows_written") >= limits, F.lit(False))
    return metrics.where(F.col("task").isin(*least)).select(
        F.col("task").alias("table_name"), F.col("rows_written").alias("row_count"), limits.alias("min_rows"), F.when(enough, "OK").otherwise("FAIL").alias("status"),
    )


def record_metrics(metrics: DataFrame, path: str) -> None:
    """Keep the run's metrics for the job panels."""
    tables.append(metrics, path)
