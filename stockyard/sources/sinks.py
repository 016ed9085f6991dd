"""Report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_csv(report: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header; a missing value is written as ``None``. ``one_file`` is for reports with a bounded number
    of rows, such as one per day."""
    if one_file:
        report = report.coalesce(1)
    report.write.mode("overwrite").option("header", "true").option("nullValue", "None").csv(path)


def _two_digits(c: str):
    return F.col(c).cast("decimal(28,2)").cast("string")


def revenue_file(by_day: DataFrame) -> DataFrame:
    """Columns and formats of the revenue file: one row per day, the undated documents last."""
    return by_day.select(
        F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("data"), F.col("documents").alias("documentos"),
        F.col("revenue").alias("faturamento"),
    )


def product_file(by_product: DataFrame) -> DataFrame:
    return by_product.select(
        "cdproduto", "dsproduto", _two_digits("quantity").alias("qtd_total"),
        _two_digits("revenue").alias("faturamento_total"),
    )


def order_file(by_order: DataFrame) -> DataFrame:
    return by_order.select(
        F.col("order_key").alias("pedido"), F.col("items").alias("itens"),
        _two_digits("revenue").alias("faturamento_total"),
    )
