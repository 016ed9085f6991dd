"""Geographic and weather enrichment. The looked-up services are replaced by input tables of their answers."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from stockyard.functions.exprs import cep_digits
from stockyard.functions.fixed import states, wmo_label

WEATHER_RESPONSE = (
    "daily struct<time: array<string>, temperature_2m_mean: array<double>, temperature_2m_min: array<double>, "
    "temperature_2m_max: array<double>, precipitation_sum: array<double>, wind_speed_10m_max: array<double>, "
    "weather_code: array<int>>"
)


def _filled(column: str):
    return F.nullif(F.col(column), F.lit(""))


def geo_reference(entities: DataFrame, addresses: DataFrame) -> DataFrame:
    """Entity, postal code, address, state, region and centroid. Codes that are malformed or unknown are left out;
    an unknown state keeps its address without state name and coordinates."""
    # 27 rows, fixed
    state = F.broadcast(states(entities.sparkSession).withColumnRenamed("uf", "_uf"))
    book = addresses.select(
        cep_digits("cep").alias("_cep"), F.col("cep").alias("_given"), "logradouro", "bairro", "localidade", "uf", "ibge",
    ).where("_cep is not null")
    return (
        entities.withColumn("_key", cep_digits("cep")).where("_key is not null")
        .join(book, F.col("_key") == F.col("_cep"))
        .join(state, F.upper("uf") == F.col("_uf"), "left")
        .select(
            "entity_type", "entity_id", F.coalesce("_given", "cep").alias("cep"),
            *[_filled(c).alias(c) for c in ("logradouro", "bairro", "localidade", "uf")],
            "estado", "regiao", _filled("ibge").alias("ibge_code"),
            F.col("lat").cast("decimal(10,6)").alias("latitude"), F.col("lon").cast("decimal(11,6)").alias("longitude"),
        )
    )


def explode_weather(responses: DataFrame, response: str = "response") -> DataFrame:
    """One row per state and day out of JSON documents of parallel arrays.

    The dates decide how many rows there are: a shorter array ends in NULLs, and the surplus of a longer one is cut.
    """
    fields = [
        ("temperature_2m_mean", "avg_temperature_c"), ("temperature_2m_min", "min_temperature_c"),
        ("temperature_2m_max", "max_temperature_c"), ("precipitation_sum", "precipitation_mm"),
        ("wind_speed_10m_max", "wind_speed_kmh"), ("weather_code", "weather_code"),
    ]
    daily = F.from_json(response, WEATHER_RESPONSE)["daily"]
    zipped = F.arrays_zip(F.col("_d.time"), *[F.coalesce(f"_d.{f}", F.array()).alias(f) for f, _ in fields])
    return (
        responses.select("location_uf", daily.alias("_d")).where("_d.time is not null")
        .select("location_uf", F.explode(F.slice(zipped, F.lit(1), F.size("_d.time"))).alias("_r"))
        .select(
            "location_uf", F.to_date("_r.time").alias("weather_date"),
            *[F.col(f"_r.{f}").alias(name) for f, name in fields],
        )
        .withColumn("weather_condition", wmo_label("weather_code"))
    )


def weather_window(as_of: date | datetime, days: int = 30) -> tuple[date, date]:
    """First and last day to ask for: it ends the day before ``as_of`` and is ``days`` long."""
    end = (as_of.date() if isinstance(as_of, datetime) else as_of) - timedelta(days=1)
    return end - timedelta(days=days - 1), end


def weather_requests(geo: DataFrame, as_of: date | datetime, days: int = 30) -> DataFrame:
    """The states present in the reference table, each with its window and centroid."""
    start, end = weather_window(as_of, days)
    centroid = F.broadcast(states(geo.sparkSession).select(F.col("uf").alias("location_uf"), "lat", "lon"))
    return (
        geo.where("uf is not null").select(F.col("uf").alias("location_uf")).distinct()
        .join(centroid, "location_uf")
        .select("location_uf", "lat", "lon", F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    )


def stamped(df: DataFrame, at: datetime) -> DataFrame:
    """Add the enrichment time before an upsert."""
    return df.withColumn("_enriched_at", F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
