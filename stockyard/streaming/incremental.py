"""Incremental file load as a stream that stops when it has caught up.

The load is a batch job, so there are no windows or stateful operators here; the stream's checkpoint plays the part
of the watermark file when the source delivers files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from stockyard.functions.exprs import moment
from stockyard.sources import tables
from stockyard.sources.extract import normalise


def new_files(spark: SparkSession, folder: str, schema: T.StructType, per_batch: int = 1000) -> DataFrame:
    """Files of a landing folder that no earlier run has read."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).option("recursiveFileLookup", "true")
        .parquet(folder)
    )


def load_available(
    spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str, at, per_batch: int = 1000,
) -> StreamingQuery:
    """Append everything that has arrived to a bronze table, then stop. A file is loaded exactly once, also when the
    run is broken off and started again: a batch that comes again replaces what it appended before. Batches are named by
    the id in the stream's checkpoint, so several streams may load into one table."""
    rows = normalise(new_files(spark, folder, schema, per_batch)).withColumn("_cdc_loaded_at", moment(at))

    def load(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        tables.append(batch, target, f"{stream}-{number}")

    return rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
