"""Extraction from the operational source into bronze."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from stockyard.functions.exprs import moment
from stockyard.functions.fixed import SENSITIVE_COLUMNS
from stockyard.sources import checkpoints, tables

INCREMENTAL, FULL_WINDOW = "incremental", "full_90d"


@dataclass(frozen=True)
class Entity:
    """One source table: its projection, load mode and watermark column.

    The same column is filtered on and stored as watermark; using two lets rows fall between them.
    """

    name: str
    source: str
    columns: tuple[tuple[str, str], ...]  # bronze name, source expression
    watermark: str | None = None
    snapshot: bool = False
    instead: str | None = None  # source column that stands in where the watermark's is NULL


# Source tables and the columns each bronze table takes from them.
ENTITIES = {
    e.name: e
    for e in (
        Entity(
            "orders_documento", "ORAINT.DOCUMENTO",
            tuple((c, c) for c in (
                "sequenciadocumento", "numerodocumento", "seriedocumento", "tipodocumento", "codigoempresa",
                "codigodepositante", "dataemissao", "dataentrega", "valortotaldocumento", "sequenciaintegracao",
            )),
            watermark="dataemissao",
        ),
        Entity(
            "inventory_produtoestoque", "WMAS.ESTOQUEPRODUTO",
            (
                ("sequenciaestoque", "cast(sequenciaestoque as string)"), ("codigoproduto", "codigoproduto"),
                ("codigoestabelecimento", "cast(codigoestabelecimento as string)"),
                ("codigoempresa", "codigoempresa"), ("estoqueideal", "cast(null as int)"),
                ("estoqueminimo", "cast(null as int)"), ("estoquemaximo", "quantidadeestoque"),
                ("estoqueseguranca", "cast(null as int)"), ("pontoreposicao", "cast(null as int)"),
                ("consumomedio", "cast(null as double)"), ("classeproduto", "especieestoque"),
            ),
            snapshot=True,
        ),
        Entity(
            "movements_entrada_saida", "WMAS.MOVIMENTOENTRADASAIDA",
            (
                ("sequenciamovimento", "cast(sequenciamovimento as string)"), ("codigoproduto", "codigoproduto"),
                ("codigoestabelecimento", "cast(codigoestabelecimento as string)"),
                ("codigodepositante", "codigodepositante"), ("quantidadeanterior", "quantidadeanterior"),
                ("quantidadeatual", "quantidadeatual"), ("datamovimento", "coalesce(datamovimento, datahistorico)"),
                ("estadomovimento", "cast(estadomovimento as string)"), ("usuario", "usuario"),
                ("observacao", "observacao"),
            ),
            watermark="datamovimento", instead="datahistorico",
        ),
        Entity(
            "products_snapshot", "ORAINT.PRODUTO",
            (
                ("codigoproduto", "codigoproduto"), ("codigoestabelecimento", "cast(null as string)"),
                ("descricaoproduto", "descricaoproduto"), ("unidademedida", "cast(null as string)"),
                ("classeproduto", "classificacaoproduto"),
            ),
            snapshot=True,
        ),
    )
}

# Columns of the row-limited source previews.
PREVIEWS = {
    "orders": (
        "sequenciadocumento", "numerodocumento", "seriedocumento", "tipodocumento", "codigodepositante",
        "codigoempresa", "codigoentrega", "rota", "subrota", "sequenciapedido", "dataemissao",
        "dataprevisaomovimento", "dataentrega", "datamovimento", "dataagendamento", "valortotaldocumento",
        "valortotalproduto", "valorfrete", "valordesconto",
    ),
    "inventory": (
        "codigoinventario", "sequenciaetiqueta", "codigoproduto", "tipoua", "endereco", "etiquetaendereco",
        "codigoua", "etiquetaua", "lotefabricacao", "lotegeral", "datafabricacao", "datavencimento",
        "quantidadeinventario", "quantidadeestoque", "datainicio", "datafim",
    ),
    "movements": (
        "sequenciamovimentoestoque", "numeromovimento", "codigodepositante", "codigoempresa", "codigoproduto",
        "tipodocumento", "seriedocumento", "numerodocumento", "tipouc", "quantidademovimento",
        "lotefabricacaoorigem", "lotefabricacaodestino", "datavencimentoorigem", "datavencimentodestino",
    ),
}


def preview(source: DataFrame, columns: tuple[str, ...], limit: int = 500) -> DataFrame:
    return source.select(*columns).limit(limit)


def query_rows(spark: SparkSession, sql: str, limit: int = 50) -> list[str]:
    """The first rows of an ad-hoc query as JSON text."""
    return spark.sql(sql).limit(limit).toJSON().collect()


def jdbc_options(
    url: str, table: str, user: str | None = None, password: str | None = None, driver: str | None = None,
    fetch_size: int = 2000, split_column: str | None = None, bounds: tuple | None = None, splits: int = 1,
    one_task: bool = False,
) -> dict[str, str]:
    """Options of a JDBC scan. The table is read by ``splits`` tasks at once, cut by the split column; a small one may
    be read by ``one_task``. Filters and column lists put on the frame are pushed into the generated queries."""
    if not split_column and not one_task:
        raise ValueError("name a split column, or say one_task=True for a table that one task can read")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "pushDownPredicate": "true"}
    options |= {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
    if split_column:
        low, high = bounds
        options |= {
            "partitionColumn": split_column, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(splits),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def normalise(df: DataFrame) -> DataFrame:
    """Decimals become doubles, zone-aware times become UTC without zone, dates become midnight."""

    def value(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        return c.alias(f.name)

    return df.select(*[value(f) for f in df.schema])


def mask_columns(df: DataFrame, names: list[str] = SENSITIVE_COLUMNS) -> DataFrame:
    """Sensitive columns show three asterisks where they hold a value. No load applies this by itself."""
    hidden = {n.lower() for n in names}
    return df.select(*[
        F.when(F.col(c).isNotNull(), F.lit("***")).alias(c) if c.lower() in hidden else F.col(c) for c in df.columns
    ])


def lower_bound(mode: str, last: datetime | None, as_of: datetime, days: int) -> datetime:
    """Where a load starts: the stored watermark of an incremental load, else ``days`` before now."""
    if mode == INCREMENTAL and last is not None:
        return last
    return as_of - timedelta(days=days)


def scan(source: DataFrame, watermark: str, start: datetime) -> DataFrame:
    """Rows at or after the bound. Boundary rows are read again by the next load; silver keeps one of them."""
    return source.where(F.col(watermark) >= moment(start))


def source_window(source: DataFrame, entity: Entity, start: datetime, end: datetime | None = None) -> DataFrame:
    """The source rows whose watermark lies in the window, by conditions on bare columns, which Parquet and JDBC scans
    evaluate themselves."""

    def inside(column: str) -> Column:
        after = F.col(column) >= moment(start)
        return after & (F.col(column) < moment(end)) if end else after

    kept = inside(entity.watermark)
    if entity.instead:
        kept = kept | (F.col(entity.watermark).isNull() & inside(entity.instead))
    return source.where(kept)


def project(source: DataFrame, entity: Entity) -> DataFrame:
    return lower_names(source).select(*[F.expr(sql).alias(name) for name, sql in entity.columns])


def envelope(df: DataFrame, entity: str, system: str, source_table: str, run_id: str, at: datetime) -> DataFrame:
    """The bronze record with its provenance, the raw row as JSON, and the date to partition by."""
    stamp = moment(at)
    return df.select(
        F.lit(entity).alias("entity_name"), stamp.alias("extraction_timestamp"), F.lit(system).alias("source_system"),
        F.lit(source_table).alias("source_table"), F.lit(run_id).alias("ingestion_run_id"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("payload"),
        F.to_date(stamp).alias("extraction_date"),
    )


def envelope_violations(df: DataFrame) -> DataFrame:
    """Envelope rows that break one of the six not-null rules."""
    required = ["entity_name", "extraction_timestamp", "source_system", "source_table", "ingestion_run_id", "payload"]
    return df.where(" or ".join(f"{c} is null" for c in required))


ENVELOPE_FOLDERS = ["entity_name", "extraction_date", "ingestion_run_id"]


def write_envelope(df: DataFrame, path: str) -> None:
    """Store envelope rows by entity, day and run. A run that is repeated replaces its own rows and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*ENVELOPE_FOLDERS).parquet(path)


def read_envelope(spark: SparkSession, path: str, entity: str, first: date | None = None, last: date | None = None, run_id: str | None = None) -> DataFrame:
    """Envelope rows of an entity, of some days or one run; only the folders of these are read."""
    rows = spark.read.schema(
        "extraction_timestamp timestamp_ntz, source_system string, source_table string, payload string, "
        "entity_name string, extraction_date date, ingestion_run_id string"
    ).parquet(path).where(F.col("entity_name") == entity)
    if first:
        rows = rows.where(F.col("extraction_date") >= F.lit(first))
    if last:
        rows = rows.where(F.col("extraction_date") <= F.lit(last))
    return rows.where(F.col("ingestion_run_id") == run_id) if run_id else rows


def unwrapped(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The source rows inside envelope rows, so that a layer can be built again without the source. A payload that does
    not fit the schema raises."""
    return rows.select(F.from_json("payload", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


@dataclass(frozen=True)
class LoadResult:
    entity: str
    rows: int
    watermark: datetime | None
    window_start: datetime | None
    seconds: float


def extract(
    spark: SparkSession,
    source: DataFrame,
    entity: Entity,
    bronze_root: str,
    checkpoint_path: str,
    run_id: str,
    as_of: datetime,
    mode: str = INCREMENTAL,
    days: int = 90,
    min_rows: int = 0,
    window: tuple[datetime, datetime] | None = None,
    raw_root: str | None = None,
) -> LoadResult:
    """Load one entity into bronze and move its checkpoint.

    Count and new watermark are observed while the rows are written, so the source is read once. A snapshot is
    published as a new version; other loads append. ``window`` replays a range of time and leaves the checkpoint. With
    ``raw_root`` the source's rows are stored there first, in envelopes by entity and day, and bronze is made of those.
    """
    import time

    began = time.monotonic()
    rows, start = lower_names(source), None
    if entity.watermark and not entity.snapshot:
        if window:
            start = window[0]
            rows = source_window(rows, entity, *window)
        else:
            last = checkpoints.last_value(spark, checkpoint_path, entity.name)
            start = lower_bound(mode, last, as_of, days)
            rows = source_window(rows, entity, start)
    if raw_root:
        write_envelope(envelope(rows, entity.name, "oracle_wms", entity.name, run_id, as_of), raw_root)
        day = as_of.date()
        rows = unwrapped(read_envelope(spark, raw_root, entity.name, day, day, run_id), rows.schema)
    rows = normalise(project(rows, entity)).withColumn("_cdc_loaded_at", moment(as_of))
    top = F.max(entity.watermark if entity.watermark else F.lit(None).cast("timestamp_ntz"))
    seen = Observation(f"{entity.name}-{run_id}")
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), top.alias("top"))
    path = f"{bronze_root}/{entity.name}"
    tables.overwrite(observed, path) if entity.snapshot else tables.append(observed, path, run_id)
    count, watermark = seen.get["rows"], seen.get.get("top")
    if not window:
        checkpoints.save(
            spark, checkpoint_path,
            checkpoints.Checkpoint(
                entity.name, "oracle_wms", "snapshot" if entity.snapshot else "timestamp",
                (watermark or start or as_of).isoformat(), run_id, as_of, start, as_of, "success",
            ),
            count, min_rows,
        )
    return LoadResult(entity.name, count, watermark, start, time.monotonic() - began)
