"""Declarative column tests and gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from stockyard.operators.marts import HEALTH_LEVELS, RISK_LEVELS, SHIFTS, SLA_STATUSES

# Fixed values. Tests per model: columns that may not be NULL, columns that must be unique, columns with a closed set of values.
TESTS: dict[str, tuple[list[str], list[str], dict[str, list[str]]]] = {
    "stg_orders": (["order_id", "depositor_id", "company_id"], ["order_id"], {}),
    "stg_inventory": (["inventory_id", "product_id", "warehouse_id"], ["inventory_id"], {}),
    "stg_movements": (["movement_id", "product_id"], ["movement_id"], {}),
    "fct_orders": (["order_id"], ["order_id"], {}),
    "fct_inventory_snapshot": (["inventory_id"], ["inventory_id"], {}),
    "fct_movements": (["movement_id"], ["movement_id"], {}),
    "dim_products": (["product_id"], [], {}),
    "mart_order_sla": (["order_id", "sla_status"], ["order_id"], {"sla_status": SLA_STATUSES}),
    "mart_inventory_health": (
        ["inventory_id", "stockout_risk"], ["inventory_id"], {"stockout_risk": HEALTH_LEVELS},
    ),
    "mart_stockout_risk": (["inventory_id", "risk_level"], ["inventory_id"], {"risk_level": RISK_LEVELS}),
    "mart_operator_productivity": (["operator_user", "period_date"], [], {}),
    "mart_picking_performance": (["operator_user", "shift_date", "shift"], [], {"shift": SHIFTS}),
    "mart_geo_performance": (["company_id", "issued_month"], [], {}),
    "mart_geo_inventory": (["warehouse_id"], [], {}),
    "mart_weather_impact": (["company_id", "issued_date"], [], {}),
}

# Fixed values. Gates: least row count per gold table, and columns that stop the run when they hold a NULL.
MIN_ROWS = {
    "fct_orders": 1, "fct_movements": 1, "mart_order_sla": 1, "mart_operator_productivity": 1,
    "mart_picking_performance": 1, "mart_stockout_risk": 1, "mart_inventory_health": 1,
}
NEVER_NULL = [
    ("mart_order_sla", "sla_status"), ("mart_stockout_risk", "risk_level"),
    ("mart_inventory_health", "stockout_risk"), ("mart_operator_productivity", "operator_user"),
    ("mart_picking_performance", "shift"), ("fct_orders", "order_id"), ("fct_movements", "movement_id"),
]


class QualityError(ValueError):
    """A gate failed."""


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records")).where("n_records > 1")
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the set, with their number; NULL is not judged here."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
    )


def check_relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference has no parent; NULL references pass."""
    known = parent.select(F.col(parent_column).alias("_parent")).where("_parent is not null").distinct()
    return df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_parent"), "left_anti")


def measures(model: str) -> dict[tuple[str, str], Column]:
    """Counts of failing rows per test (name, column) of a model, for every test but uniqueness."""
    not_null, _, accepted = TESTS[model]
    counted = {("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null}
    return counted | {
        ("accepted_values", c): F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(values))
        for c, values in accepted.items()
    }


class Measured:
    """The tests of a model, counted while its rows are written, so that nothing is built or read again for them.

    Uniqueness is not among the counts: a merge looks for repeated keys in what it wrote and refuses them.
    """

    def __init__(self, model: str):
        self.model, self.counted, self.seen = model, measures(model), Observation()

    def over(self, df: DataFrame) -> DataFrame:
        """``df``, to be written once."""
        counts = [expr.alias(f"m{i}") for i, expr in enumerate(self.counted.values())]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    def rows(self) -> int:
        return self.seen.get.get("rows", 0)

    def results(self) -> list[tuple[str, str, str, int, int]]:
        """model, test, column, failing rows, rows looked at; after the write."""
        got, rows = self.seen.get, self.rows()
        found = [(self.model, *test, got.get(f"m{i}", 0), rows) for i, test in enumerate(self.counted)]
        return found + [(self.model, "unique", c, 0, rows) for c in TESTS[self.model][1]]


def model_results(model: str, df: DataFrame) -> DataFrame:
    """Failing rows of every test of one model in one pass over it: a unique key is grouped once, and the other tests
    are counted in the same aggregate."""
    unique, counted = TESTS[model][1], measures(model)
    names = {test: f"_{i}" for i, test in enumerate(counted)}
    if unique:
        key = unique[0]
        per_key = df.groupBy(key).agg(
            F.count("*").alias("_n"), *[expr.alias(names[test]) for test, expr in counted.items()]
        )
        row = per_key.agg(
            F.count_if((F.col("_n") > 1) & F.col(key).isNotNull()).alias("_u"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names.values()],
        )
        names[("unique", key)] = "_u"
    else:
        row = df.agg(*[expr.alias(names[test]) for test, expr in counted.items()])
    results = F.array(*[
        F.struct(F.lit(test).alias("test"), F.lit(column).alias("column_name"), F.col(name).alias("failures"))
        for (test, column), name in names.items()
    ])
    return row.select(F.lit(model).alias("model"), F.explode(results).alias("r")).select("model", "r.*")


def test_results(models: dict[str, DataFrame]) -> DataFrame:
    """One row per declared test of the given models."""
    return reduce(DataFrame.unionByName, [model_results(name, df) for name, df in models.items()])


test_results.__test__ = False  # not a test case


def volume_anomaly(
    df: DataFrame, at: str, weeks: int = 8, least: int = 4, factor: float = 3.5, slack: float = 0.05,
) -> DataFrame:
    """Days whose number of rows is out of line with earlier days of the same weekday, one row a day.

    A day from the first to the last one without rows counts as a day of zero rows; rows without a date are left out. A
    day is judged by the median of up to ``weeks`` earlier days of its weekday and by the median distance from it (MAD):
    ``LOW`` or ``HIGH`` when it lies further off than ``factor`` deviations, where one deviation is at least ``slack`` of
    the median and at least one row, else ``OK``; ``NEW`` while fewer than ``least`` such days have passed. Rows shrink
    to one per day first, so the windows, one per weekday, cover the calendar only.
    """
    daily = df.where(F.col(at).isNotNull()).groupBy(F.to_date(at).alias("day")).agg(F.count("*").alias("n"))
    span = daily.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    counted = span.join(daily, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("row_count"))
    earlier = Window.partitionBy(F.weekday("day")).orderBy("day").rowsBetween(-weeks, -1)

    def middle(values: Column) -> Column:
        ordered, n = F.array_sort(values), F.size(values)
        low, high = (F.element_at(ordered, F.floor(x).cast("int")) for x in ((n + 1) / 2, n / 2 + 1))
        return F.when(n > 0, (low + high) / 2)

    seen = counted.withColumn("_seen", F.collect_list("row_count").over(earlier))
    judged = seen.withColumn("expected", middle(F.col("_seen"))).withColumn(
        "spread", middle(F.transform("_seen", lambda x: F.abs(x - F.col("expected"))))
    )
    off = F.col("row_count") - F.col("expected")
    limit = factor * F.greatest(F.col("spread") * 1.4826, F.col("expected") * slack, F.lit(1.0))
    status = (
        F.when(F.size("_seen") < least, "NEW").when(off < -limit, "LOW").when(off > limit, "HIGH").otherwise("OK")
    )
    return judged.select("day", "row_count", "expected", "spread", status.alias("status"))


def store_failures(failing: DataFrame, path: str) -> None:
    failing.write.mode("overwrite").parquet(path)


def row_gate(tables: dict[str, DataFrame], least: dict[str, int] = MIN_ROWS) -> DataFrame:
    rows = [
        tables[name].agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(n).alias("min_rows"),
        )
        for name, n in least.items()
    ]
    status = F.when(F.col("row_count") >= F.col("min_rows"), "OK").otherwise("FAIL").alias("status")
    return reduce(DataFrame.unionByName, rows).select("*", status)


def null_gate(tables: dict[str, DataFrame], columns: Sequence[tuple[str, str]] = tuple(NEVER_NULL)) -> DataFrame:
    rows = [
        tables[name].agg(F.count_if(F.col(column).isNull()).alias("null_count")).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "null_count",
        )
        for name, column in columns
    ]
    status = F.when(F.col("null_count") == 0, "OK").otherwise("FAIL").alias("status")
    return reduce(DataFrame.unionByName, rows).select("*", status)


def enforce(gate: DataFrame) -> None:
    """Raise with the failing lines of a gate. A gate holds one row per checked table."""
    failed = gate.where("status = 'FAIL'").collect()
    if failed:
        raise QualityError("\n".join(str(row.asDict()) for row in failed))
