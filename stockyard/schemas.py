"""Explicit schemas of the bronze layer.

Timestamps carry no zone: the source stores wall-clock time, and zone-aware values are moved to UTC on load.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, TS, D = T.StringType(), T.IntegerType(), T.TimestampNTZType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


ORDERS = _schema(
    sequenciadocumento=S, numerodocumento=S, seriedocumento=S, tipodocumento=S, codigoempresa=S,
    codigodepositante=S, dataemissao=TS, dataentrega=TS, valortotaldocumento=T.DecimalType(15, 2),
    sequenciaintegracao=S, _cdc_loaded_at=TS,
)
ORDER_LINES = _schema(
    sequenciadocumento=S, sequenciaitemdetalhe=S, codigoproduto=S, quantidade=T.DecimalType(15, 4),
    _cdc_loaded_at=TS,
)
INVENTORY = _schema(
    sequenciaestoque=S, codigoproduto=S, codigoestabelecimento=S, codigoempresa=S, estoqueideal=I,
    estoqueminimo=I, estoquemaximo=I, estoqueseguranca=I, pontoreposicao=I,
    consumomedio=T.DecimalType(15, 4), classeproduto=S, _cdc_loaded_at=TS,
)
MOVEMENTS = _schema(
    sequenciamovimento=S, codigoproduto=S, codigoestabelecimento=S, codigodepositante=S,
    quantidadeanterior=I, quantidadeatual=I, datamovimento=TS, dataemissao=TS, data_ref=TS,
    estadomovimento=S, usuario=S, observacao=S, _cdc_loaded_at=TS,
)
PRODUCTS = _schema(
    codigoproduto=S, codigoestabelecimento=S, descricaoproduto=S, unidademedida=S, classeproduto=S,
    _cdc_loaded_at=TS,
)
GEO_REFERENCE = _schema(
    entity_type=S, entity_id=S, cep=S, logradouro=S, bairro=S, localidade=S, uf=S, estado=S, regiao=S,
    ibge_code=S, latitude=T.DecimalType(10, 6), longitude=T.DecimalType(11, 6), _enriched_at=TS,
)
WEATHER_DAILY = _schema(
    location_uf=S, weather_date=D, avg_temperature_c=T.DecimalType(5, 2),
    min_temperature_c=T.DecimalType(5, 2), max_temperature_c=T.DecimalType(5, 2),
    precipitation_mm=T.DecimalType(8, 2), weather_condition=S, wind_speed_kmh=T.DecimalType(6, 2),
    _enriched_at=TS,
)
CHECKPOINT = _schema(
    entity_name=S, source_system=S, checkpoint_type=S, last_successful_value=S, last_successful_run_id=S,
    last_successful_timestamp=TS, extraction_window_start=TS, extraction_window_end=TS, status=S,
)
ENVELOPE = _schema(
    entity_name=S, extraction_timestamp=TS, source_system=S, source_table=S, ingestion_run_id=S, payload=S,
)
JOB_METRICS = _schema(
    job=S, task=S, state=S, started_at=TS, ended_at=TS, attempt=I, rows_read=T.LongType(),
    rows_written=T.LongType(), rows_deduplicated=T.LongType(), run_id=S,
)

BRONZE = {
    "orders_documento": ORDERS,
    "orders_documentodetalhe": ORDER_LINES,
    "inventory_produtoestoque": INVENTORY,
    "movements_entrada_saida": MOVEMENTS,
    "products_snapshot": PRODUCTS,
    "geo_reference": GEO_REFERENCE,
    "weather_daily": WEATHER_DAILY,
}
