"""Benchmark tables presented as the bronze layer.

Every bronze table is derived by Spark from the given Parquet tables, so its size follows theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockyard.functions.fixed import STATES, WMO_LABELS
from stockyard.schemas import (
    GEO_REFERENCE, INVENTORY, MOVEMENTS, ORDERS, PRODUCTS, WEATHER_DAILY,
)

# Schemas of the tables, given to the reader so that opening one starts no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}.parquet")


TASK_BYTES = 4 << 20  # of an input file, about 300,000 order lines


def tasks(spark: SparkSession, root: str, name: str) -> int:
    """A number of partitions that grows with a table, so that the share of one task does not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(4, -(-size // TASK_BYTES))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _null(dtype: str = "string") -> Column:
    return F.lit(None).cast(dtype)


def _conform(df: DataFrame, schema) -> DataFrame:
    """Select the columns of a bronze schema with its types; a column the source lacks becomes NULL."""
    have = set(df.columns)
    return df.selectExpr(*[
        f"cast({f.name if f.name in have else 'null'} as {f.dataType.simpleString()}) as {f.name}" for f in schema
    ])


def _one_of(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def orders(spark: SparkSession, root: str) -> DataFrame:
    customer = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    df = table(spark, root, "orders").join(customer, F.expr("o_custkey = c_custkey")).selectExpr(
        "'1' as sequenciadocumento",
        "o_orderkey as numerodocumento",
        "'1' as seriedocumento",
        "o_orderpriority as tipodocumento",
        "c_nationkey as codigoempresa",
        "o_custkey as codigodepositante",
        "o_orderdate as dataemissao",
        "if(o_orderstatus = 'F', o_orderdate + make_dt_interval(0, cast(o_orderkey % 97 as int)), null) as dataentrega",
        "o_totalprice as valortotaldocumento",
        "o_orderkey as sequenciaintegracao",
        "o_orderdate + interval '1' hour as _cdc_loaded_at",
    )
    return _conform(df, ORDERS)


def movements(spark: SparkSession, root: str) -> DataFrame:
    """Operator movements, one per event."""
    leaves = "event_type in ('purchase', 'click', 'error')"
    df = table(spark, root, "events").selectExpr(
        "event_id as sequenciamovimento",
        "get_json_object(props, '$.k') as codigoproduto",
        "user_id % 7 as codigoestabelecimento",
        f"if({leaves}, ceil(value), 0) as quantidadeanterior",
        f"if({leaves}, 0, ceil(value)) as quantidadeatual",
        "ts as datamovimento",
        "'1' as estadomovimento",
        "user_id as usuario",
        "event_type as observacao",
        "ts as _cdc_loaded_at",
    )
    return _conform(df, MOVEMENTS)


def outbound(spark: SparkSession, root: str) -> DataFrame:
    """Depositor movements, one per order line; keys repeat, so this table also shows de-duplication."""
    owner = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    df = table(spark, root, "lineitem").join(owner, F.expr("l_orderkey = o_orderkey")).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) as sequenciamovimento",
        "l_partkey as codigoproduto",
        "l_suppkey as codigoestabelecimento",
        "o_custkey as codigodepositante",
        "if(l_linestatus = 'F', l_quantity, 0) as quantidadeanterior",
        "if(l_linestatus = 'F', 0, l_quantity) as quantidadeatual",
        "l_shipdate as datamovimento",
        "if(l_linestatus = 'F', '8', '1') as estadomovimento",
        "l_returnflag as observacao",
        "l_shipdate as _cdc_loaded_at",
    )
    return _conform(df, MOVEMENTS)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Stock per product and warehouse. Nearly every order line has a pair of its own, so lines are not combined before
    the shuffle, and both shuffles go to a number of partitions that grows with the lines: adaptive merging goes by
    compressed bytes, of which a row here has few."""
    parts = tasks(spark, root, "lineitem")
    part = table(spark, root, "part").select("p_partkey", "p_type")
    df = (
        table(spark, root, "lineitem")
        .repartition(parts, "l_partkey", "l_suppkey")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.expr("sum(cast(l_quantity as bigint)) as ideal"), F.min("l_quantity").alias("least"),
            F.count("*").alias("n"), F.max("l_shipdate").alias("_cdc_loaded_at"),
        )
        .join(part, F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "concat_ws('-', l_partkey, l_suppkey) as sequenciaestoque",
            "l_partkey as codigoproduto",
            "l_suppkey as codigoestabelecimento",
            "l_suppkey % 5 as codigoempresa",
            "ideal as estoqueideal",
            "least as estoqueminimo",
            "ideal * 2 as estoquemaximo",
            "floor(ideal * 0.15D) as estoqueseguranca",
            "floor(ideal * 0.25D) as pontoreposicao",
            "if(l_partkey % 11 = 0, 0D, floor(ideal * 10000D / (n * (l_partkey % 25 + 1))) / 10000D) as consumomedio",
            "p_type as classeproduto",
            "_cdc_loaded_at",
        )
    )
    return _conform(df, INVENTORY).repartition(parts, "sequenciaestoque")


def products(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "part").select(
        _text("p_partkey").alias("codigoproduto"),
        F.col("p_name").alias("descricaoproduto"),
        F.col("p_type").alias("classeproduto"),
        F.make_timestamp_ntz(*[F.lit(v) for v in (2001, 8, 1, 0, 0, 0)]).alias("_cdc_loaded_at"),
    )
    return _conform(df, PRODUCTS)


def _uf(nation: str) -> Column:
    return _one_of([s[0] for s in STATES], F.col(nation))


def geo_reference(spark: SparkSession, root: str) -> DataFrame:
    """One row per company (nation) and per warehouse (supplier)."""
    region = table(spark, root, "region")
    nation = table(spark, root, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    supplier = table(spark, root, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))

    def rows(df: DataFrame, kind: str, key: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("entity_type"), _text(key).alias("entity_id"), F.col("n_name").alias("localidade"),
            _uf("n_nationkey").alias("uf"), F.col("n_name").alias("estado"), F.col("r_name").alias("regiao"),
            (F.col("n_nationkey") * 1.5 - 20).alias("latitude"), (F.col("n_nationkey") * 2.0 - 60).alias("longitude"),
        )

    both = rows(nation, "company", "n_nationkey").unionByName(rows(supplier, "warehouse", "s_suppkey"))
    return _conform(both, GEO_REFERENCE)


def _weather_by_day(spark: SparkSession, root: str) -> DataFrame:
    """Weather figures per state and day, made from whole-number sums so that they do not depend on row order."""
    supplier = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    n = F.col("_n")
    cents = {c: F.round(F.col(c) * 100).cast("long") for c in ("l_discount", "l_tax")}
    codes = [*WMO_LABELS, 100]
    return (
        table(spark, root, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", F.to_date("l_shipdate").alias("weather_date"))
        .agg(
            F.count("*").alias("_n"),
            F.sum(cents["l_discount"]).alias("_warm"),
            F.min(cents["l_discount"]).alias("min_temperature_c"),
            F.max(cents["l_discount"]).alias("max_temperature_c"),
            F.sum(cents["l_tax"]).alias("_rain"),
            F.sum(F.col("l_quantity").cast("long")).alias("_wind"),
        )
        .select(
            _uf("s_nationkey").alias("location_uf"),
            "weather_date",
            F.round(F.col("_warm") / n, 2).alias("avg_temperature_c"),
            F.col("min_temperature_c").cast("double").alias("min_temperature_c"),
            F.col("max_temperature_c").cast("double").alias("max_temperature_c"),
            F.round(F.col("_rain") / n, 2).alias("precipitation_mm"),
            F.round(F.col("_wind") / n, 2).alias("wind_speed_kmh"),
            _one_of(codes, n % len(codes)).alias("weather_code"),
        )
    )


def weather_responses(spark: SparkSession, root: str) -> DataFrame:
    """The same figures as a weather service sends them: one JSON document of parallel arrays per state and month.
    A document holds at most 31 days."""
    fields = {
        "time": F.date_format("weather_date", "yyyy-MM-dd"),
        "temperature_2m_mean": F.col("avg_temperature_c"),
        "temperature_2m_min": F.col("min_temperature_c"),
        "temperature_2m_max": F.col("max_temperature_c"),
        "precipitation_sum": F.col("precipitation_mm"),
        "wind_speed_10m_max": F.col("wind_speed_kmh"),
        "weather_code": F.col("weather_code"),
    }
    day = F.struct(*[value.alias(name) for name, value in fields.items()])
    return (
        _weather_by_day(spark, root)
        .groupBy("location_uf", F.trunc("weather_date", "month").alias("month"))
        .agg(F.sort_array(F.collect_list(day)).alias("days"))
        .select(
            "location_uf",
            F.to_json(F.struct(F.struct(*[F.col(f"days.{f}").alias(f) for f in fields]).alias("daily")))
            .alias("response"),
        )
    )


def weather_daily(spark: SparkSession, root: str) -> DataFrame:
    from stockyard.functions.fixed import wmo_label

    df = _weather_by_day(spark, root).withColumn("weather_condition", wmo_label("weather_code"))
    return _conform(df, WEATHER_DAILY)


def order_items(spark: SparkSession, root: str) -> DataFrame:
    """Order items with numbers as text, as the order tables deliver them. Some lack a net total, some a product."""
    part = table(spark, root, "part").select("p_partkey", "p_name")
    line, key = F.col("l_linenumber"), F.col("l_orderkey")
    # whole cents, so that the text does not hang on the last bit of a product
    cents = F.round(F.col("l_extendedprice") * 100).cast("long") * (100 - F.round(F.col("l_discount") * 100).cast("long"))
    net = F.floor(cents / 100.0) / 100.0
    return (
        table(spark, root, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            key.alias("idpedido"),
            F.when(key % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("P"), _text(key))).alias("nrpedido"),
            F.when(line == 7, _null()).otherwise(_text("l_partkey")).alias("cdproduto"),
            F.when(line == 7, _null()).otherwise(F.col("p_name")).alias("dsproduto"),
            F.concat(F.lit(" "), _text(F.col("l_quantity").cast("int"))).alias("nrqtd"),
            F.when(line == 6, "n/d").otherwise(_text(F.col("l_partkey") % 1000 + 1)).alias("vlproduto"),
            F.when(line % 3 == 0, _text(net.cast("decimal(15,2)"))).alias("valortotalliquido"),
        )
    )


def order_headers(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("idpedido"), F.col("o_orderdate").alias("dtcadastro"),
    )


def entities(spark: SparkSession, root: str) -> DataFrame:
    """Warehouses with a formatted postal code; every thirteenth code is too short."""
    digits = F.lpad(_text("s_suppkey"), 8, "0")
    good = F.concat(F.substring(digits, 1, 5), F.lit("-"), F.substring(digits, 6, 3))
    return table(spark, root, "supplier").select(
        F.lit("warehouse").alias("entity_type"),
        _text("s_suppkey").alias("entity_id"),
        F.when(F.col("s_suppkey") % 13 == 12, F.substring(good, 1, 7)).otherwise(good).alias("cep"),
    )


def addresses(spark: SparkSession, root: str) -> DataFrame:
    """The address book with holes: one code in ten is not known."""
    return address_book(spark, root).where(F.col("cep").cast("long") % 10 != 9)


def address_book(spark: SparkSession, root: str) -> DataFrame:
    """Address book by postal code; every seventh entry has a state code that does not exist."""
    nation = table(spark, root, "nation").select("n_nationkey", "n_name")
    key = F.col("s_suppkey")
    code = _one_of([s[6] for s in STATES], F.col("n_nationkey"))
    return (
        table(spark, root, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.lpad(_text(key), 8, "0").alias("cep"),
            F.when(key % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("Rua "), _text(key))).alias("logradouro"),
            F.lit("Centro").alias("bairro"),
            F.col("n_name").alias("localidade"),
            F.when(key % 7 == 6, F.lit("XX")).otherwise(_uf("n_nationkey")).alias("uf"),
            F.concat(code, F.lit("00000")).alias("ibge"),
        )
    )


def job_runs(spark: SparkSession, root: str) -> DataFrame:
    """Run records of our own jobs, one per event."""
    key = F.col("event_id")
    end = F.col("ts") + F.make_dt_interval(secs=(key % 300).cast("int"))
    return table(spark, root, "events").select(
        F.col("event_type").alias("job"),
        F.concat(F.lit("task_"), _text(F.col("user_id") % 10)).alias("task"),
        F.when(key % 9 == 0, "failed").when(key % 97 == 1, "running").when(key % 50 == 2, "up_for_retry")
        .otherwise("success").alias("state"),
        F.lit("scheduled").alias("run_type"),
        F.col("ts").alias("started_at"),
        F.when(key % 97 != 1, end).alias("ended_at"),
        (key % 3 + 1).cast("int").alias("attempt"),
        _text(key).alias("run_id"),
    )
