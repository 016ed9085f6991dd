"""What the operators share: written tables that cut lineage, splits by id, and text columns as byte arrays."""

from __future__ import annotations

import importlib.util
import io
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import stockyard

SLICE_BYTES = 1 << 20
TEXT_ROWS = 1000  # whole texts that go to a worker at once, where thousands would take much of an executor's memory


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, the context's own, or a new one for local runs.

    On a cluster one of the two must be set: executors do not see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="stockyard-shared-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` as a table written to the shared folder and read back, so that lost executors cost no recomputation.

    With ``rows``, batches sent to Python workers for it have so many rows at most, as is right for whole texts.
    Tables that a lazy result still reads stay; an application's folder can be deleted when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with few_rows_a_batch(spark, rows) if rows else nullcontext():
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    spark, at = df.sparkSession, getattr(df, "_written_at", None)
    if at:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores before it if a column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def shipped(spark: SparkSession) -> SparkSession:
    """The session, with this package sent to its Python workers if they do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_has_stockyard", False):
        return spark

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("stockyard") is not None])], ["there"])

    if not spark.range(0, 1, 1, 1).mapInArrow(look, "there boolean").first()[0]:
        package = Path(stockyard.__file__).parent
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, f"stockyard/{file.relative_to(package)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/{context.applicationId}/stockyard.zip")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(content.getvalue())
        out.close()
        context.addPyFile(path.toString())
    context._has_stockyard = True
    return spark


def id_remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the split into rows that may be learnt from and held-out rows."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % divisor


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots))


def perhaps_among(rows: DataFrame, key: str, keys: DataFrame, most_slots: int = 1 << 28) -> DataFrame:
    """The rows whose ``key`` may be among ``keys`` (one column), to make a join with these smaller before its shuffle.

    Keys mark slots of a bitmap by their hash, eight or more slots a key, so that about an eighth of the other rows stay.
    The bitmap is broadcast; its size is bounded by ``most_slots`` (32 MB), beyond which it fills up and more rows stay.
    No row that the join needs is lost.
    """
    (column,) = keys.columns
    slots = min(most_slots, 1 << (8 * max(keys.count(), 4096) - 1).bit_length())
    slot = _slot(F.col(column), slots)
    bitmap = keys.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    slot = _slot(F.col(key), slots)
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_place": place}).join(F.broadcast(bitmap), "_bucket")
    return marked.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_place % 8 as int))")) != 0).select(*rows.columns)


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in column ``text`` have about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)] if len(part) else [0]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def mapped(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: int | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` with a function of one batch; with ``text``, batches are cut by the bytes of that column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit) if text is not None else [batch]:
                if part.num_rows and (out := each(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def filtered(docs: DataFrame, text: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts ``keep`` marks."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                if part.num_rows:
                    yield part.filter(pa.array(keep(part.column(at))))

    return docs.mapInArrow(run, docs.schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and where each text begins, with the end; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
