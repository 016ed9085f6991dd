"""Document fingerprints: MinHash over word shingles, compared by signature bands and confirmed on full sets.

A text's shingles (five words, see ``words``) go through ``HASHES`` universal hash permutations in numpy; the low byte
of each minimum makes the fingerprint. The share of equal bytes, less what chance gives, estimates the Jaccard
similarity of two texts.

``edited`` puts every document beside the next one in descending order of ids with a single shuffle of the texts: ids
are cut into ranges, a range is sorted in one task, and its last document gets the first of the range below as an extra
row. Ranges are as wide as it takes for about ``RANGE_ROWS`` ids, measured between each two of ``KNOTS`` quantiles, so
that ids may be dense in one place and sparse in another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stockyard.llm.common import mapped, written
from stockyard.llm.components import components
from stockyard.llm.near_duplicates import confirmed, full_sets, linked_in_blocks
from stockyard.llm.words import Permutations, mix, shingle_sets

SHINGLE = 5
HASHES = 128
BAND = 4
RANGE_ROWS = 2_000
KNOTS = 64
PERCENT = 75
_TURNS = Permutations(HASHES, seed=41)


def signatures(texts: pa.Array) -> np.ndarray:
    """(texts, HASHES) bytes; a text without words has all zeros, which no other text is likely to have."""
    sets = shingle_sets(texts, SHINGLE)
    out = np.zeros((len(sets), HASHES), np.uint8)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        out[full] = mix(_TURNS.least([sets[i] for i in full])).astype(np.uint8)
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of signatures, from 0 to 1."""
    return np.maximum(0.0, ((x == y).mean(1) - 1 / 256) / (1 - 1 / 256))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, signature of every row of ``docs``; null text counts as empty."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [len(s) for s in shingle_sets(b.column(1), SHINGLE)]
        rows = [r.tobytes() for r in signatures(b.column(1))]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "n_shingles", "signature"])

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return mapped(columns, each, "doc_id long, n_shingles long, signature binary", text=1)


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, band: int = BAND) -> DataFrame:
    """a, b: documents that agree on a whole band of the fingerprint and whose sets share ``percent`` of their union.

    Equal sets are one class, joined by its smallest id; a band's members are held against its smallest class, so a
    band of many copies makes as many pairs as it has members. Members that this star leaves outside the component of
    its centre are held against the centre's other members in blocks, so that the pairs given have the components of
    all pairs. They are not all pairs: inside a component some are left out. Texts without words and rows without an
    id have no pair; rows repeated under one id are one document.
    """
    prints = written(_named(docs, doc_id, text), "prints")
    classes = written(prints.groupBy("s1", "s2").agg(F.min("node").alias("node"), F.max("n").alias("n"), F.max("signature").alias("signature")), "classes")
    copies = prints.withColumnRenamed("node", "b").join(classes, ["s1", "s2"]).where("b <> node").selectExpr("node as a", "b")
    bands = F.explode(F.expr(f"transform(sequence(0, {HASHES // band - 1}), i -> struct(i, substring(signature, i * {band} + 1, {band}) as bytes))"))
    keys = classes.select("node", "n", bands.alias("key"))
    centre = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count("node").alias("members")).where("members > 1").select("key", "pivot")
    placed = written(keys.join(centre, "key").where("node <> pivot").select("key", "pivot", "node", "n"), "placed")
    stars = placed.selectExpr("pivot as a", "node as b").distinct()
    sets = written(full_sets(docs, stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), doc_id, text), "sets")
    links = written(confirmed(stars, sets, percent).unionByName(copies).distinct(), "links")

    # members of one band in different components have only been compared with the centre
    found = written(components(links), "components")
    here = placed.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = here.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    left = here.join(apart, "key").select("pivot", "node", "n", "component").distinct()
    left = written(left.join(found.selectExpr("node as pivot", "component as main"), "pivot", "left"), "apart")
    return links.unionByName(linked_in_blocks(left, sets, percent)).distinct()


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node, n, the set's 128-bit name (s1, s2) and signature of the rows that have an id and words."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column(1), SHINGLE)
        names = np.array([[mix(s).sum(), mix(s ^ np.uint64(0x5DEECE66D)).sum()] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]),
             pa.array([r.tobytes() for r in signatures(b.column(1))], pa.binary())],
            ["node", "n", "s1", "s2", "signature"],
        )

    columns = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text")).where("node is not null")
    return mapped(columns, each, "node long, n long, s1 long, s2 long, signature binary", text=1).where("n > 0")


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document has the
    next smaller id; after the smallest comes the largest. The edited text has the last third of the code points,
    rounded down, replaced by the first as many of the next one, or all. A null text counts as empty; a document alone
    is its own next. Rows repeated under one id follow each other in the order of their texts. Rows without an id come
    last, as one more id below all others. Other columns are ignored; an empty table gives no rows.
    """
    low = -(1 << 63)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "id", F.coalesce("doc_id", F.lit(low))
    )
    range_of, count = _range_of(rows, range_rows)
    rows = rows.withColumn("range", range_of)
    # the first document of each range, for the range above it
    first = written(rows.groupBy("range").agg(F.max(F.struct("id", "text")).alias("f")).select("range", "f.id", "f.text"), "first")
    above = first.select("range").withColumn("to", F.lag("range").over(Window.orderBy(F.desc("range"))))
    lowest = first.agg(F.min("range")).first()[0]
    if lowest is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    edge = first.join(above, "range").select(
        F.lit(None).cast("long").alias("doc_id"), "text", "id", F.coalesce("to", F.lit(lowest)).alias("range"), F.lit(1).alias("edge")
    )
    order = ["range", "edge", F.desc("id"), F.desc("text")]
    dealt = rows.withColumn("edge", F.lit(0)).unionByName(edge).repartition(max(1, count // (2 * range_rows)), "range").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256).select(["doc_id", "text", "edge"])
                if held is not None:
                    b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
                held = b.slice(b.num_rows - 1)
                if b.num_rows > 1:
                    yield beside(b)

    def beside(b: pa.RecordBatch) -> pa.RecordBatch:
        """Every row but the last beside the row that follows; edges have no result of their own."""
        texts = b.column(1).to_pylist()
        own = np.flatnonzero(b.column(2).to_numpy()[:-1] == 0)
        changed = [texts[i][: len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][: len(texts[i]) // 3] for i in own]
        prints, other = signatures(b.column(1)), signatures(pa.array(changed, pa.string()))
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(own)), pa.array([len(texts[i]) for i in own], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
             pa.array([prints[i].tobytes().hex() for i in own], pa.string()), pa.array([r.tobytes().hex() for r in other], pa.string()),
             pa.array(likeness(prints[own], other)), pa.array(likeness(prints[own], prints[own + 1]))],
            SCHEMA_NAMES,
        )

    return dealt.mapInArrow(run, SCHEMA)


def _range_of(rows: DataFrame, range_rows: int) -> tuple[Column, int]:
    """A number per range of ids that rises with ``id``, rows without an id being a range below all others; the count."""
    share = ",".join(str(i / KNOTS) for i in range(KNOTS + 1))
    count, knots = rows.where("doc_id is not null").agg(F.count("*"), F.expr(f"percentile_approx(id, array({share}), 10000)")).first()
    if not count:
        return F.lit(-1).cast("long"), 0
    knots = sorted(set(knots))
    width = [max(1, -(-(b - a + 1) * range_rows * KNOTS // count)) for a, b in zip(knots, [*knots[1:], knots[-1]])]
    at = " + ".join(f"if(id >= {k}L, 1, 0)" for k in knots[1:]) or "0"
    picked = lambda values: f"element_at(array({','.join(f'{v}L' for v in values)}), {at} + 1)"
    inside = f"greatest(0L, id - {picked(knots)}) div {picked(width)}"
    return F.expr(f"if(doc_id is null, -1L, cast({at} as long) * 1048576L * 1048576L + ({inside}))"), count


SCHEMA_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
