"""Load checkpoints: one small row per entity, replaced only after a load has succeeded."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockyard.schemas import CHECKPOINT
from stockyard.sources import tables


@dataclass(frozen=True)
class Checkpoint:
    entity_name: str
    source_system: str
    checkpoint_type: str  # timestamp, id or snapshot
    last_successful_value: str | None
    last_successful_run_id: str
    last_successful_timestamp: datetime
    extraction_window_start: datetime | None
    extraction_window_end: datetime | None
    status: str  # success, failed or partial


def load(spark: SparkSession, path: str) -> DataFrame:
    return tables.optional_source(spark, path, CHECKPOINT)


def last_value(spark: SparkSession, path: str, entity: str) -> datetime | None:
    """The stored watermark of one entity, NULL before its first load."""
    row = load(spark, path).where(F.col("entity_name") == entity).select("last_successful_value").first()
    return datetime.fromisoformat(row[0]) if row and row[0] else None


def save(spark: SparkSession, path: str, checkpoint: Checkpoint, rows: int, min_rows: int = 0) -> bool:
    """Store a checkpoint if its load succeeded with at least ``min_rows`` rows; otherwise keep the last good one."""
    if checkpoint.status != "success" or rows < min_rows:
        return False
    new = spark.createDataFrame([tuple(asdict(checkpoint).values())], CHECKPOINT)
    tables.merge_by_key(spark, new, path, ["entity_name"])
    return True


def reset(spark: SparkSession, path: str, entity: str) -> None:
    """Forget an entity, so that its next load starts from the default window."""
    kept = load(spark, path).where(F.col("entity_name") != entity)
    tables.overwrite(kept, path)
