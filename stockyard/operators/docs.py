"""Document chunking and vector search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from stockyard.functions.exprs import ratio
from stockyard.sources import tables

CHUNK_SIZE, CHUNK_OVERLAP, MIN_CHUNK = 800, 100, 50
BLANK_LINE = r"\n{2,}"
# The characters counted as white space at the ends of a text.
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "               　"
)


def _strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACE))


def split_chunks(
    text: Column, sep: str = BLANK_LINE, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
    min_len: int = MIN_CHUNK,
) -> Column:
    """Fold the paragraphs of one text into overlapping chunks.

    A chunk is closed when the next paragraph would take it past ``size``; the next one opens with the last
    ``overlap`` characters. A single paragraph longer than ``size`` stays whole. Chunks of ``min_len`` or fewer
    characters are dropped.
    """
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, paragraph: Column) -> Column:
        current = acc["open"]
        full = (F.length(current) + F.length(paragraph) + 2 > size) & (current != "")
        done = F.when(full, F.array_append(acc["done"], _strip(current))).otherwise(acc["done"])
        opened = F.when(
            full, F.concat(F.right(current, F.lit(overlap)), F.lit("\n\n"), paragraph)
        ).otherwise(_strip(F.concat(current, F.lit("\n\n"), paragraph)))
        return F.struct(done.alias("done"), opened.alias("open"))

    def finish(acc: Column) -> Column:
        every = F.when(acc["open"] != "", F.array_append(acc["done"], _strip(acc["open"]))).otherwise(acc["done"])
        return F.filter(every, lambda chunk: F.length(chunk) > min_len)

    return F.aggregate(F.split(_strip(text), sep), start, step, finish)


def chunk(docs: DataFrame, id_column: str, text_column: str = "text", **options) -> DataFrame:
    """One row per chunk, numbered from 0 inside its document. A document is a row of work of its own, so the chunks
    spread with the documents and nothing is shuffled."""
    chunks = split_chunks(F.col(text_column), **options)
    return docs.select(id_column, F.posexplode(chunks).alias("chunk_no", "content"))


def document_type(path: Column) -> Column:
    folders = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(folders, -1), r"(?<=.)\.[^.]*$", "")
    return (
        F.when(F.array_contains(folders, "adr"), "adr")
        .when(F.array_contains(folders, "runbook"), "runbook")
        .when(F.contains(stem, F.lit("architecture")), "architecture")
        .otherwise("doc")
    )


def title(path: Column, text: Column) -> Column:
    """First top-level heading, else the file name with every run of letters capitalised."""
    heading = F.regexp_extract(text, r"(?mdU)^#\s+(.+)", 1)
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    words = F.regexp_extract_all(F.replace(stem, F.lit("-"), F.lit(" ")), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    cased = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))), ""
    )
    return F.when(heading != "", _strip(heading)).otherwise(cased)


def index_documents(docs: DataFrame, path_column: str, text_column: str, **options) -> DataFrame:
    """Search payload of a full re-index: a point id made of source and chunk number, type, title, content and source."""
    path, text = F.col(path_column), F.col(text_column)
    return (
        docs.where(_strip(text) != "")
        .select(
            document_type(path).alias("doc_type"), title(path, text).alias("title"), path.alias("source"),
            F.posexplode(split_chunks(text, **options)).alias("chunk_no", "content"),
        )
        .select(F.md5(F.concat_ws("#", "source", "chunk_no")).alias("point_id"), "doc_type", "title", "content", "source", "chunk_no")
    )


def cosine_to(query: Sequence[float]):
    """A column function giving the cosine of each vector to ``query``, in double precision.

    Vectors arrive as Arrow batches and are scored as one matrix product. A vector that is NULL, has another length
    or no magnitude has no score.
    """
    target = np.asarray(query, dtype="float64")
    target = target / np.linalg.norm(target)

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), len(target)), False)
        matrix = vectors.filter(fits).flatten().to_numpy(zero_copy_only=False).astype("float64")
        matrix = matrix.reshape(-1, len(target))
        scores = np.full(len(vectors), np.nan)
        with np.errstate(invalid="ignore", divide="ignore"):
            scores[np.asarray(fits)] = (matrix @ target) / np.linalg.norm(matrix, axis=1)
        return pa.array(scores, mask=~np.isfinite(scores))

    return score


def cosine_topk(
    vectors: DataFrame, query: Sequence[float], k: int = 5, vector_column: str = "embedding",
    id_column: str = "vec_id",
) -> DataFrame:
    """The ``k`` vectors nearest to one query, best first, with all their columns as payload.

    Every task keeps its own best ``k`` and only those meet, so the scan is the whole cost.
    """
    return (
        vectors.withColumn("score", cosine_to(query)(vector_column)).where("score is not null")
        .orderBy(F.desc("score"), id_column).limit(k)
    )


QUERY_BLOCK = 4096
INDEX_SHARD = 8192
ASKED, SCORED = 256, 4096  # questions and index vectors that a task scores at once
SLACK = 1e-9  # more than rounding moves a product of two vectors of magnitude 1


def ranking() -> tuple[Callable, Callable]:
    """``nearest`` and ``places``, as inner functions: they travel with a task, so workers need not have this package."""

    def products(targets: np.ndarray, matrix: np.ndarray, row: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Inner products of pairs, each summed alike wherever it stands, so that equal vectors have equal scores."""
        out = np.empty(len(row))
        for at in range(0, len(row), INDEX_SHARD):
            some = slice(at, at + INDEX_SHARD)
            out[some] = (targets[row[some]] * matrix[own[some]]).sum(1)
        return out

    def nearest(targets: np.ndarray, matrix: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of ``targets`` the ``k`` rows of ``matrix`` with the largest inner product, ties to the lesser ``order``:
        row of the target, row of the matrix, score.

        Of equal rows the first ``k`` take part. A matrix product finds the rows that reach the ``k``-th best so far,
        and only these are ranked.
        """
        kept = np.arange(len(matrix))
        if len(matrix) > k:
            _, alike = np.unique(np.ascontiguousarray(matrix).view(f"V{matrix.shape[1] * 8}").ravel(), return_inverse=True)
            by = np.lexsort((order, alike))
            kept = np.sort(by[np.arange(len(by)) - np.searchsorted(alike[by], alike[by]) < k])
            matrix, order = matrix[kept], order[kept]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for first in range(0, len(targets), ASKED):
            some = targets[first : first + ASKED]
            row, own, score = found[0]
            floor = np.full(len(some), -np.inf)
            for at in range(0, len(matrix), SCORED):
                scores = some @ matrix[at : at + SCORED].T
                if not at and scores.shape[1] > k:
                    floor = np.partition(scores, -k, axis=1)[:, -k] - SLACK
                more, there = np.nonzero(scores >= floor[:, None])
                there += at
                row, own = np.append(row, more), np.append(own, there)
                score = np.append(score, products(some, matrix, more, there))
                best = np.lexsort((order[own], -score, row))
                row, own, score = row[best], own[best], score[best]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, own, score = row[keep], own[keep], score[keep]
                counts = np.bincount(row, minlength=len(some))
                full = counts == k
                floor[full] = score[np.cumsum(counts)[full] - 1] - SLACK
            found.append((row + first, kept[own], score))
        return tuple(np.concatenate(x) for x in zip(*found))

    def places(ids: pa.ChunkedArray) -> np.ndarray:
        """The place of each id among the sorted ones."""
        out = np.empty(len(ids), np.int64)
        out[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        return out

    return nearest, places


def search(
    index: DataFrame, queries: DataFrame, k: int = 5, vector_column: str = "embedding", id_column: str = "vec_id",
    query_id: str = "query_id", block: int = QUERY_BLOCK, shard: int = INDEX_SHARD,
) -> DataFrame:
    """For each of ``queries`` (``query_id``, ``vector_column``) the ``k`` rows of ``index`` nearest by cosine, with rank,
    score and their other columns as payload. Ties go to the smaller id.

    Questions are dealt to blocks of about ``block`` vectors and the index to shards of about ``shard``; each block
    meets each shard in one group of a shuffle, so what a task holds is bounded and no vector passes the driver, which
    sees only the two counts. A group gives its best ``k`` per question, so pairs never leave it, and only the winners
    meet their payload. Vectors that are NULL or without magnitude take no part, nor do rows without an id.
    """
    vectors = index.select(F.col(id_column).cast("long").alias("_id"), F.col(vector_column).alias("_v")).where("_id is not null and _v is not null")
    asked = queries.select(F.col(query_id).cast("long").alias("_id"), F.col(vector_column).alias("_v")).where("_id is not null and _v is not null")
    if vectors.schema["_v"].dataType != asked.schema["_v"].dataType:
        vectors, asked = (d.withColumn("_v", F.col("_v").cast("array<double>")) for d in (vectors, asked))
    blocks, shards = max(1, -(-asked.count() // block)), max(1, -(-vectors.count() // shard))

    def dealt(rows: DataFrame, question: bool, own: str, n: int, other: str, every: int) -> DataFrame:
        return rows.select(
            "_id", "_v", F.lit(question).alias("_question"), F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(every - 1))).alias(other),
        )

    schema = f"{query_id} long, _id long, score double"
    nearest, places = ranking()

    def unit(rows: pa.Table, length: int) -> tuple[pa.ChunkedArray, np.ndarray]:
        """Ids and vectors of magnitude 1 of the rows with vectors of this length."""
        rows = rows.filter(pc.equal(pc.list_value_length(rows["_v"]), length))
        matrix = pc.list_flatten(rows["_v"]).to_numpy().astype("float64").reshape(-1, length)
        norm = np.linalg.norm(matrix, axis=1)
        good = np.isfinite(norm) & (norm > 0)
        return rows["_id"].filter(pa.array(good)), matrix[good] / norm[good, None]

    def best(group: pa.Table) -> pa.Table:
        question = group["_question"]
        mine, others = group.filter(question), group.filter(pc.invert(question))
        out = [pa.table({query_id: pa.array([], pa.int64()), "_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})]
        for length in pc.unique(pc.list_value_length(mine["_v"])).to_pylist():
            if not length:
                continue
            (ids, targets), (own, matrix) = unit(mine, length), unit(others, length)
            row, found, score = nearest(targets, matrix, places(own), k)
            out.append(pa.table({query_id: ids.take(pa.array(row)), "_id": own.take(pa.array(found)), "score": score}))
        return pa.concat_tables(out)

    together = dealt(asked, True, "_block", blocks, "_shard", shards).unionByName(dealt(vectors, False, "_shard", shards, "_block", blocks))
    found = together.groupBy("_block", "_shard").applyInArrow(best, schema)
    ranks = Window.partitionBy(query_id).orderBy(F.desc("score"), "_id")
    winners = found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return winners.join(index.drop(vector_column), F.col("_id") == F.col(id_column)).drop("_id")


BUCKET_LENGTH, TABLES = 0.6, 4
# A constant further component of every vector: its random weight shifts the buckets of each hash table by another amount,
# else all tables would cut at zero. Distances stay as they are.
SHIFT = 100.0


def _directed(df: DataFrame, vector_column: str) -> DataFrame:
    """``df`` with ``unit``, the vector with magnitude 1 in doubles, in place of the vector; rows whose vector is NULL,
    empty, not finite or without magnitude are dropped."""
    rest = df.drop(vector_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(b.num_columns - 1)
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
            norm, some = np.zeros(len(lengths)), lengths > 0
            with np.errstate(over="ignore"):
                if some.any():
                    norm[some] = np.sqrt(np.add.reduceat(values * values, (np.cumsum(lengths) - lengths)[some]))
            good = np.isfinite(norm) & (norm > 0)
            of = np.repeat(good, lengths)
            offsets = np.append(0, np.cumsum(lengths[good])).astype(np.int32)
            unit = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[of] / np.repeat(norm, lengths)[of]))
            columns = b.filter(pa.array(good)).columns[:-1]
            yield pa.RecordBatch.from_arrays([*columns, unit], [*b.schema.names[:-1], "unit"])

    schema = StructType([*rest.schema.fields, StructField("unit", ArrayType(DoubleType()))])
    return df.select(*rest.columns, F.col(vector_column).cast("array<double>").alias("unit")).mapInArrow(run, schema)


def _features() -> Column:
    return array_to_vector(F.array_append("unit", F.lit(SHIFT)))


def _hashed(model: BucketedRandomProjectionLSHModel, df: DataFrame) -> DataFrame:
    """Bucket numbers of the column ``unit``, one per hash table, as ``buckets``."""
    hashed = model.transform(df.withColumn("_features", _features()))
    buckets = F.transform("_hashes", lambda h: vector_to_array(h)[0].cast("long"))
    return hashed.withColumn("buckets", buckets).drop("_features", "_hashes")


def build_index(
    vectors: DataFrame, path: str, id_column: str = "vec_id", vector_column: str = "embedding",
    bucket_length: float = BUCKET_LENGTH, hash_tables: int = TABLES, seed: int = 7, keep: int = 2,
) -> int:
    """Replace the stored index: every vector with its payload, its direction and its bucket in each hash table.

    The hashes are random projections of the directions, cut into buckets of ``bucket_length``; they are saved beside the
    version, so a search uses those that the index was built with. Equal directions are numbered by id (``copy``), so
    that a search for k neighbours takes k of them at most. Rows without id or direction are not indexed; all vectors
    have one length.
    """
    spark = vectors.sparkSession
    found = tables.versions(spark, path)
    n = found[-1] + 1 if found else 1
    rows = _directed(vectors.where(F.col(id_column).isNotNull()), vector_column)
    lsh = BucketedRandomProjectionLSH(
        inputCol="_features", outputCol="_hashes", bucketLength=bucket_length, numHashTables=hash_tables, seed=seed,
    )
    model = lsh.fit(rows.select(_features().alias("_features")))
    model.write().overwrite().save(f"{path}/_hashes-{n}")
    copies = Window.partitionBy("unit").orderBy(id_column)
    tables.overwrite(_hashed(model, rows).withColumn("copy", F.row_number().over(copies)), path)
    tables.expire(spark, path, keep)
    return n


def search_index(
    spark: SparkSession, path: str, questions: DataFrame, k: int = 5, id_column: str = "vec_id",
    vector_column: str = "embedding", query_id: str = "query_id", block: int = QUERY_BLOCK, shard: int = INDEX_SHARD,
) -> DataFrame:
    """As ``search``, among the vectors that share a bucket with the question in one of the hash tables.

    Questions and index meet by bucket, in blocks of about ``block`` questions and shards of about ``shard`` vectors, so
    what a task holds is bounded however full a bucket is. A group scores its candidates exactly and gives its best
    ``k`` per question, so pairs never leave it. What lies in other buckets is not found: wider buckets or more tables
    find more and score more.
    """
    n = tables.versions(spark, path)[-1]
    model = BucketedRandomProjectionLSHModel.load(f"{path}/_hashes-{n}")
    index = tables.read(spark, path)
    asked = questions.select(F.col(query_id).cast("long").alias("_id"), F.col(vector_column).alias("_v")).where("_id is not null")
    asked = _hashed(model, _directed(asked, "_v"))
    there = index.where(F.col("copy") <= k).withColumnRenamed(id_column, "_id")
    bucket = ["_table", "_bucket"]

    def spread(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*columns, F.posexplode("buckets").alias(*bucket))

    def parts(df: DataFrame, size: int, name: str) -> DataFrame:
        return spread(df).groupBy(*bucket).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    counts = parts(asked, block, "_blocks").join(parts(there, shard, "_shards"), bucket)

    def dealt(rows: DataFrame, ids: list[Column], own: str, n: str, other: str, every: str) -> DataFrame:
        return spread(rows, "_id", "unit").join(counts, bucket).select(
            *ids, "unit", *bucket, F.pmod(F.xxhash64("_id"), F.col(n)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(every) - 1)).alias(other),
        )

    kind = index.schema[id_column].dataType
    nearest, places = ranking()
    together = dealt(
        asked, [F.col("_id").alias("_asked"), F.lit(None).cast(kind).alias("_there")], "_block", "_blocks", "_shard", "_shards"
    ).unionByName(dealt(
        there, [F.lit(None).cast("long").alias("_asked"), F.col("_id").alias("_there")], "_shard", "_shards", "_block", "_blocks"
    ))

    def best(group: pa.Table) -> pa.Table:
        question = pc.is_valid(group["_asked"])
        mine, others = group.filter(question), group.filter(pc.invert(question))
        targets, matrix = (pc.list_flatten(x["unit"]).to_numpy().reshape(len(x), -1) if len(x) else None for x in (mine, others))
        if targets is None or matrix is None:
            return pa.table({query_id: mine["_asked"][:0], id_column: others["_there"][:0], "score": pa.array([], pa.float64())})
        row, own, score = nearest(targets, matrix, places(others["_there"]), k)
        return pa.table({query_id: mine["_asked"].take(pa.array(row)), id_column: others["_there"].take(pa.array(own)), "score": score})

    schema = f"{query_id} long, {id_column} {kind.simpleString()}, score double"
    found = together.groupBy(*bucket, "_block", "_shard").applyInArrow(best, schema)
    scored = found.groupBy(query_id, id_column).agg(F.max("score").alias("score"))
    ranks = Window.partitionBy(query_id).orderBy(F.desc("score"), id_column)
    winners = scored.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return winners.join(index.drop("unit", "buckets", "copy"), id_column)


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id", id_column: str = "vec_id") -> DataFrame:
    """questions, neighbours and the share of the exact neighbours that were found."""
    hit = exact.select(query_id, id_column).join(found.select(query_id, id_column, F.lit(1).alias("_hit")), [query_id, id_column], "left")
    return hit.agg(
        F.count_distinct(query_id).alias("questions"), F.count("*").alias("neighbours"),
        ratio(F.count("_hit"), F.count("*")).alias("recall"),
    )
