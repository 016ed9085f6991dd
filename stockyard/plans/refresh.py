"""Stored enrichment tables and the document index."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from stockyard.operators import docs, enrich
from stockyard.operators.dedup import dedup_latest
from stockyard.sources import tables


def refresh_geo(entities: DataFrame, addresses: DataFrame, path: str, at: datetime) -> int:
    """Resolve the entities and upsert their places."""
    rows = enrich.stamped(enrich.geo_reference(entities, addresses), at)
    return tables.merge_by_key(entities.sparkSession, rows, path, ["entity_type", "entity_id"])


def refresh_weather(responses: DataFrame, path: str, at: datetime) -> int:
    """Unfold the responses and upsert their days."""
    rows = enrich.stamped(enrich.explode_weather(responses).drop("weather_code"), at)
    return tables.merge_by_key(responses.sparkSession, rows, path, ["location_uf", "weather_date"])


def reindex_documents(documents: DataFrame, path: str, path_column: str, text_column: str, **options) -> int:
    """Replace the whole index, so that chunks of deleted documents disappear."""
    return tables.overwrite(docs.index_documents(documents, path_column, text_column, **options), path)


def reindex_vectors(chunks: DataFrame, vectors: DataFrame, path: str, vector_column: str = "embedding", **options) -> int:
    """Replace the search index: the payload of ``index_documents`` with a vector for each ``point_id``. Chunks without
    one are not found by a search, so they are left out."""
    rows = chunks.join(vectors.select("point_id", vector_column), "point_id")
    return docs.build_index(rows, path, "point_id", vector_column, **options)


def repair_bronze(spark, path: str, keys: list[str], newest_by: str = "_cdc_loaded_at") -> int:
    """Publish a version of a bronze table that keeps the newest row per key."""
    return tables.overwrite(dedup_latest(tables.read(spark, path), keys, newest_by), path)
