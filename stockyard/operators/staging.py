"""Bronze to silver: rename, cast, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockyard.operators.dedup import dedup_any, dedup_latest

# silver name, bronze name, type
ORDER_COLUMNS = [
    ("order_id", "sequenciaintegracao", "string"),
    ("doc_seq", "sequenciadocumento", "string"),
    ("document_number", "numerodocumento", "string"),
    ("document_series", "seriedocumento", "string"),
    ("document_type", "tipodocumento", "string"),
    ("company_id", "codigoempresa", "string"),
    ("depositor_id", "codigodepositante", "string"),
    ("issued_at", "dataemissao", "timestamp_ntz"),
    ("delivered_at", "dataentrega", "timestamp_ntz"),
    ("total_value", "valortotaldocumento", "double"),
]
INVENTORY_COLUMNS = [
    ("inventory_id", "sequenciaestoque", "string"),
    ("product_id", "codigoproduto", "string"),
    ("warehouse_id", "codigoestabelecimento", "string"),
    ("company_id", "codigoempresa", "string"),
    ("ideal_stock_qty", "estoqueideal", "int"),
    ("min_stock_qty", "estoqueminimo", "int"),
    ("max_stock_qty", "estoquemaximo", "int"),
    ("safety_stock_qty", "estoqueseguranca", "int"),
    ("reorder_point", "pontoreposicao", "int"),
    ("avg_consumption", "consumomedio", "double"),
    ("product_class", "classeproduto", "string"),
]
MOVEMENT_COLUMNS = [
    ("movement_id", "sequenciamovimento", "string"),
    ("product_id", "codigoproduto", "string"),
    ("warehouse_id", "codigoestabelecimento", "string"),
    ("depositor_id", "codigodepositante", "string"),
    ("qty_before", "quantidadeanterior", "int"),
    ("qty_after", "quantidadeatual", "int"),
    ("movement_date", "datamovimento", "timestamp_ntz"),
    ("movement_status", "estadomovimento", "string"),
    ("operator_user", "usuario", "string"),
    ("notes", "observacao", "string"),
]


def _typed(columns: list[tuple[str, str, str]], lenient: bool) -> list[str]:
    cast = "try_cast" if lenient else "cast"
    return [f"{cast}({source} as {dtype}) as {name}" for name, source, dtype in columns]


def rename_and_cast(df: DataFrame, columns: list[tuple[str, str, str]], lenient: bool = False) -> DataFrame:
    """Typed projection. A bad value raises; ``lenient`` turns it into NULL instead."""
    return df.selectExpr(*_typed(columns, lenient))


def project_movements(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    """Typed movements with the signed quantity, not de-duplicated."""
    names = [name for name, _, _ in MOVEMENT_COLUMNS]
    cut = names.index("qty_after") + 1
    return rename_and_cast(bronze, MOVEMENT_COLUMNS, lenient).selectExpr(
        *names[:cut], "qty_after - qty_before as qty_delta", *names[cut:]
    )


def stg_orders(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    return dedup_any(rename_and_cast(bronze, ORDER_COLUMNS, lenient), ["order_id"])


def stg_inventory(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    return dedup_any(rename_and_cast(bronze, INVENTORY_COLUMNS, lenient), ["inventory_id"])


def stg_movements(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    return dedup_any(project_movements(bronze, lenient), ["movement_id"])


LOADED = "_cdc_loaded_at"


def _of_newest_load(df: DataFrame, columns: list[tuple[str, str, str]], key: str) -> DataFrame:
    """Typed rows, of each key that of its newest load."""
    typed = rename_and_cast(df, [*columns, (LOADED, LOADED, "timestamp_ntz")])
    return dedup_latest(typed, [key], LOADED).drop(LOADED)


def newest_orders(bronze: DataFrame) -> DataFrame:
    """As ``stg_orders``, with the row of the newest load per key, so that loads merged one by one give the same rows as
    all of them at once."""
    return _of_newest_load(bronze, ORDER_COLUMNS, "order_id")


def newest_movements(bronze: DataFrame) -> DataFrame:
    """As ``stg_movements``, with the row of the newest load per key."""
    return _of_newest_load(bronze, MOVEMENT_COLUMNS, "movement_id").withColumn("qty_delta", F.col("qty_after") - F.col("qty_before"))
