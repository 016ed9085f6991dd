"""Tables as folders of Parquet versions, and key merge.

A write goes to a new version folder, which counts once Spark has put its ``_SUCCESS`` marker there; an append goes to a
folder of its own beside the version it belongs to, named by its run, so that a repeated run replaces it. Readers see
the old or the new table, never a part of one, also when executors or the driver are lost midway. A merge into a table
stored by day or month is Spark's dynamic partition overwrite: merged partitions are written in full beside the table
and swapped in when the job commits, so a job that is lost leaves the table as it was, and nothing of it is read later.
Only the swap itself is not one step for all partitions; where that matters, keep the table in a catalog with row-level
operations, which ``merge_into`` uses.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


# Folder column of a partitioned table: the text of the partitioning date, which itself stays in the files with its
# own type. The letter in front keeps it from being read back as a date or number.
PART = "part_key"


@dataclass(frozen=True)
class By:
    """How a table is split into folders: by the days or months of a date column, so their number has a bound."""

    column: str
    grain: str = "day"

    def key(self, df: DataFrame) -> Column:
        kind = df.schema[self.column].dataType
        if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise TypeError(f"{self.column} is no date or time")
        form = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}[self.grain]
        return F.concat(F.lit("p"), F.coalesce(F.date_format(self.column, form), F.lit("-")))


def by(partition: By | str | None) -> By | None:
    return By(partition) if isinstance(partition, str) else partition


def _with_part(df: DataFrame, partition: By | None, sort_by: str | None = None) -> DataFrame:
    """The folder column, and the rows of a folder brought together: a file or a few per folder, however many tasks
    there were. Adaptive execution splits the heavy folders."""
    if partition is None:
        return _sorted(df, sort_by)
    dealt = df.withColumn(PART, partition.key(df)).hint("rebalance", F.col(PART))
    return dealt.sortWithinPartitions(PART, sort_by) if sort_by else dealt


class MergeError(ValueError):
    """The rows to merge hold a key twice."""


class EmptyRefreshError(ValueError):
    """A full refresh would replace a table that has rows by one that has none."""


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder, hadoop


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table, oldest first."""
    fs, folder, hadoop = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    numbers = [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]
    return sorted(n for n in numbers if fs.exists(hadoop.Path(f"{path}/v{n:08d}/_SUCCESS")))


def _version_path(path: str, n: int) -> str:
    return f"{path}/v{n:08d}"


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The current version with its appends. Columns that only some of them have are NULL in the others."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(path)
    version, appended = _version_path(path, found[-1]), _appended(spark, path, found[-1])
    if not appended:
        return spark.read.parquet(version)
    return spark.read.schema(_union_schema(spark, [version, *appended])).parquet(version, *appended)


def _union_schema(spark: SparkSession, folders: Sequence[str]) -> T.StructType:
    """The columns of all folders, from one file each, in the order in which they came; a changed type is refused."""
    fs, _, hadoop = _folder(spark, folders[0])
    files = []
    for folder in folders:
        names = sorted(x.getPath().toString() for x in fs.listStatus(hadoop.Path(folder)) if x.getPath().getName().startswith("part-"))
        files += names[:1]
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except SparkRuntimeException as refused:
        raise TypeError(f"column type changed in {folders[0]}") from refused


def _appended(spark: SparkSession, path: str, n: int, complete: bool = True) -> list[str]:
    """Folders of the appends to a version."""
    fs, folder, hadoop = _folder(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
    own = [f"{path}/{x}" for x in names if x.startswith(f"v{n:08d}+")]
    return [x for x in own if not complete or fs.exists(hadoop.Path(f"{x}/_SUCCESS"))]


def read(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path).drop(PART)


def optional_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty relation of the same type where it does not exist."""
    return read(spark, path) if exists(spark, path) else spark.createDataFrame([], schema)


def optional_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The same for a catalog table."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def _sorted(df: DataFrame, sort_by: str | None) -> DataFrame:
    """Order the rows of each file, so that a range filter on the column skips row groups. Nothing is shuffled."""
    return df.sortWithinPartitions(sort_by) if sort_by else df


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: str | None = None) -> int:
    """Write the next version of a table. Old versions stay until ``expire``."""
    df = _sorted(df, sort_by)
    spark = df.sparkSession
    found = versions(spark, path)
    n = found[-1] + 1 if found else 1
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(_version_path(path, n))
    return n


def append(df: DataFrame, path: str, run_id: str | None = None) -> int:
    """Add rows to the current version; a table that does not exist yet is created.

    The rows become visible together. A run that is repeated under its ``run_id`` replaces what it appended before;
    rows that arrive twice otherwise are left to the silver layer, which keeps one per key. Columns may be added; a
    column whose type has changed is refused.
    """
    spark = df.sparkSession
    found = versions(spark, path)
    if found:
        evolve(_stored(spark, path), df)
    n = found[-1] if found else overwrite(spark.createDataFrame([], df.schema), path)
    name = re.sub(r"[^\w.-]", "-", run_id) if run_id else uuid.uuid4().hex
    df.write.mode("overwrite").parquet(f"{_version_path(path, n)}+{name}")
    return n


def append_new(df: DataFrame, path: str, keys: Sequence[str], run_id: str | None = None) -> int:
    """Append only the rows whose key is not stored yet."""
    spark = df.sparkSession
    if exists(spark, path):
        df = without_keys(df, read(spark, path), keys, null_safe=True)
    return append(df, path, run_id)


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions."""
    fs, _, hadoop = _folder(spark, path)
    old = versions(spark, path)[:-keep]
    for n in old:
        for folder in [_version_path(path, n), *_appended(spark, path, n, complete=False)]:
            fs.delete(hadoop.Path(folder), True)
    return old


def evolve(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of their columns; columns may be added, and a changed type is refused."""
    before = {f.name: f.dataType for f in old.schema}
    changed = [f.name for f in new.schema if f.name in before and f.dataType != before[f.name]]
    if changed:
        raise TypeError(f"column type changed: {', '.join(changed)}")
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema if f.name not in before]
    gone = [F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema if f.name not in new.columns]
    wide = old.select("*", *added)
    return wide, new.select("*", *gone).select(*wide.columns)


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """The rows of ``df`` whose key does not occur in ``other``."""
    return _with_keys(df, other, keys, null_safe, "left_anti")


def _with_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool, how: str) -> DataFrame:
    taken = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = [df[k].eqNullSafe(taken[f"_k_{k}"]) if null_safe else df[k] == taken[f"_k_{k}"] for k in keys]
    return df.join(taken, reduce(lambda a, b: a & b, same), how)


def merged(existing: DataFrame, new: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """The stored rows whose key is not among the new ones, and the new ones. Nothing is ever deleted.

    With ``null_safe=False`` a key holding a NULL matches nothing, so such rows pile up, as in a SQL merge.
    """
    existing, new = evolve(existing, new)
    return without_keys(existing, new, keys, null_safe).unionByName(new)


def _refuse_duplicates(new: DataFrame, keys: Sequence[str], null_safe: bool) -> None:
    keyed = new if null_safe else new.na.drop(subset=list(keys))
    twice = keyed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").first()
    if twice is not None:
        raise MergeError(f"key appears more than once: {twice.asDict()}")


@contextmanager
def _staged(new: DataFrame, path: str):
    """The rows to merge, computed once and written beside the table, so that the key check and the merge read them
    back instead of computing them again."""
    spark = new.sparkSession
    folder = f"{path}/_new-{uuid.uuid4().hex}"
    new.write.parquet(folder)
    try:
        yield spark.read.schema(new.schema).parquet(folder)
    finally:
        fs, _, hadoop = _folder(spark, path)
        fs.delete(hadoop.Path(folder), True)


def create(
    df: DataFrame, path: str, keys: Sequence[str], null_safe: bool = True, partition: By | str | None = None,
    sort_by: str | None = None, may_be_empty: bool = True,
) -> int:
    """Write the next version, look for repeated keys in what was written, and only then publish it.

    With ``may_be_empty=False`` an empty result is not published over rows.
    """
    spark = df.sparkSession
    found = versions(spark, path)
    n = found[-1] + 1 if found else 1
    target = _version_path(path, n)
    writer = _with_part(df, by(partition), sort_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition:
        writer = writer.partitionBy(PART)
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
    fs, _, hadoop = _folder(spark, path)
    if partition and not any(x.isDirectory() for x in fs.listStatus(hadoop.Path(target))):
        spark.createDataFrame([], df.schema).write.parquet(f"{target}/{PART}=p-")  # an empty table keeps its columns
    after = spark.read.schema(df.schema).parquet(target)
    _refuse_duplicates(after, keys, null_safe)
    if not may_be_empty and found and after.isEmpty() and not read(spark, path).isEmpty():
        raise EmptyRefreshError(path)
    fs.create(hadoop.Path(f"{target}/_SUCCESS")).close()
    return n


def merge_by_key(
    spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str], null_safe: bool = True,
    sort_by: str | None = None,
) -> int:
    """Update the rows whose key exists, insert the others, and publish the result as the next version."""
    if not exists(spark, path):
        return create(new, path, keys, null_safe, sort_by=sort_by)
    with _staged(new, path) as rows:
        _refuse_duplicates(rows, keys, null_safe)
        return overwrite(merged(read(spark, path), rows, keys, null_safe), path, sort_by=sort_by)


def merge_partitions(
    spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str], partition: By | str, null_safe: bool = True,
    sort_by: str | None = None,
) -> int:
    """Key merge that reads and rewrites only the days or months it touches: those of the new rows and, where the date
    is not part of the key, those in which their keys are stored, so that a row may move.

    Keys are looked up by a semi-join that reads the key columns alone. The driver sees the names of the touched folders,
    never rows. A table that gets a new column is written anew.
    """
    partition = by(partition)
    if not exists(spark, path):
        return create(new, path, keys, null_safe, partition, sort_by)
    n = versions(spark, path)[-1]
    version = _version_path(path, n)
    stored = spark.read.parquet(version)
    with _staged(new, path) as rows:
        _refuse_duplicates(rows, keys, null_safe)
        if set(rows.columns) - set(stored.columns):
            return create(merged(stored.drop(PART), rows, keys, null_safe), path, keys, null_safe, partition, sort_by)
        touched = {row[0] for row in rows.select(partition.key(rows)).distinct().collect()}
        if partition.column not in keys:
            held = _with_keys(stored.select(PART, *keys), rows, keys, null_safe, "left_semi")
            touched |= {row[0] for row in held.select(PART).distinct().collect()}
        if not touched:
            return n
        after = merged(stored.where(F.col(PART).isin(*touched)).drop(PART), rows, keys, null_safe)
        seen = Observation()
        filled = _with_part(after, partition, sort_by).observe(seen, F.collect_set(PART).alias("filled"))
        filled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(version)
    fs, _, hadoop = _folder(spark, version)
    for left in touched - set(seen.get["filled"]):  # all their rows have moved
        fs.delete(hadoop.Path(f"{version}/{PART}={left}"), True)
    return n


def merge_into(new: DataFrame, table: str, keys: Sequence[str], null_safe: bool = True) -> None:
    """Key merge by the catalog's own row-level operation, for tables in a format that has one."""
    op = "<=>" if null_safe else "="
    on = " and ".join(f"{table}.{k} {op} source.{k}" for k in keys)
    new.alias("source").mergeInto(table, F.expr(on)).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def high_water(spark: SparkSession, path: str, column: str, lookback: timedelta = timedelta(0)):
    """Highest stored value of a column less ``lookback``. An absent or empty table has no bound."""
    if not exists(spark, path):
        return None
    top = read(spark, path).agg(F.max(column)).first()[0]
    return None if top is None else top - lookback


def bound(stored: DataFrame, column: str) -> Column:
    """Highest stored value of a time column as a scalar subquery: a filter that gets its bound when the query runs, at
    the scan too. An empty table has no bound."""
    return F.coalesce(stored.agg(F.max(column)).scalar(), F.lit("0001-01-01").cast("timestamp_ntz"))


def row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table_name, row_count of stored tables, from the footers of their files; no column is read.

    Only the newer Parquet reader hands aggregates down to footers, so it is switched on for these counts.
    """
    wanted = {
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.sources.useV1SourceList": ",".join(
            x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"
        ),
    }
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        counts = [
            _stored(spark, path).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, path in paths.items()
        ]
        rows = reduce(DataFrame.unionByName, counts).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.createDataFrame(rows, "table_name string, row_count long").orderBy("table_name")


def materialize(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    build: Callable[[date | datetime | None], DataFrame],
    high_water_column: str | None = None,
    lookback: timedelta = timedelta(0),
    full_refresh: bool = False,
    null_safe: bool = True,
    partition: By | str | None = None,
    sort_by: str | None = None,
) -> int:
    """Build a gold table and merge it by key.

    ``build`` receives the stored high-water mark, or ``None`` for everything, and applies it to its inputs. The mark
    is strict, so a day or month that was stored once is not opened again unless ``lookback`` reaches back over it.
    With a ``partition`` column the merge touches only the partitions that receive rows.
    """
    if full_refresh:
        return create(build(None), path, keys, null_safe, partition, sort_by, may_be_empty=False)
    since = high_water(spark, path, high_water_column, lookback) if high_water_column else None
    if partition:
        return merge_partitions(spark, build(since), path, keys, partition, null_safe, sort_by)
    return merge_by_key(spark, build(since), path, keys, null_safe, sort_by)
