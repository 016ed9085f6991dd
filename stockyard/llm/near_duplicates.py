"""Near-duplicate documents: MinHash signatures compared by a multi-index Hamming join, confirmed on full sets.

A document's set holds the hashes of its 5-word shingles. Its signature has ``HASHES`` minima, cut to 16 bits each; at
a similarity of 0.75 two signatures differ in a quarter of their values. The join finds every pair of signatures that
differ in at most ``RADIUS`` = 31 of 64 values, over four standard deviations beyond that: of 16 chunks of 4 values,
one has at most one wrong value (pigeonhole), so the two documents agree on some chunk with some value left out. All
16 * 4 such keys of a document are listed; a key holds the three other values themselves, no hash of them.

Groups of copies do not make pairs among themselves:

* Equal sets are one class, named by its smallest id, before anything is joined.
* A key's members are compared with one pivot, the one that shares most keys with others, in a star. Members of one
  component need no comparison among themselves. Those that a star leaves outside the pivot's component are queries
  against the pivot's other members, in blocks of bounded size that give out links only, so no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockyard.llm.common import dropped, free_name, mapped, written
from stockyard.llm.components import components
from stockyard.llm.words import Permutations, mix, shingle_sets

SHINGLE = 5
HASHES, CHUNK = 64, 4
CHUNKS = HASHES // CHUNK
RADIUS = 2 * CHUNKS - 1
PERCENT = 75
BLOCK = 512


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit name (s1, s2), and its signature (null for an empty set)."""
    turns = Permutations(HASHES)

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column(1), SHINGLE)
        full = [i for i, s in enumerate(sets) if len(s)]
        signature: list[bytes | None] = [None] * len(sets)
        if full:
            low = mix(turns.least([sets[i] for i in full])).astype(np.uint16)
            for i, row in zip(full, low):
                signature[i] = row.tobytes()
        names = np.array([[mix(s).sum(), mix(s ^ np.uint64(0x5DEECE66D)).sum()] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(signature, pa.binary())],
            ["doc_id", "n_shingles", "s1", "s2", "signature"],
        )

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return mapped(columns, each, "doc_id long, n_shingles long, s1 long, s2 long, signature binary", text=1)


def full_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``node`` and its shingle set for the documents listed in ``nodes``."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column(1), SHINGLE)
        offsets = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
        values = pa.array(np.concatenate(sets).view(np.int64))
        return pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, values)], ["node", "items"])

    columns = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    return mapped(columns.join(nodes, "node", "left_semi"), each, "node long, items array<long>", text=1)


def chunk_keys(classes: DataFrame) -> DataFrame:
    """key, node, n: for each chunk of the signature and each value left out, the place and the other values."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        values = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint16).reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
        keys = np.empty((len(values), CHUNKS, CHUNK), np.uint64)
        for out in range(CHUNK):
            a, c, d = (values[:, :, j] for j in range(CHUNK) if j != out)
            keys[:, :, out] = a << np.uint64(32) | c << np.uint64(16) | d
        keys |= np.arange(HASHES, dtype=np.uint64).reshape(CHUNKS, CHUNK) << np.uint64(48)
        take = pa.array(np.repeat(np.arange(len(values)), HASHES))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel().view(np.int64)), b.column(0).take(take), b.column(1).take(take)], ["key", "node", "n"]
        )

    return mapped(classes.selectExpr("node", "cast(n as int) as n", "signature"), each, "key long, node long, n int")


def within_radius(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ``RADIUS`` values."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, HASHES) for i in (2, 3))
        return b.select(["a", "b"]).filter(pa.array((x != y).sum(1) <= RADIUS))

    both = (
        pairs.join(signatures.selectExpr("node as b", "signature as y"), "b")
        .join(signatures.selectExpr("node as a", "signature as x"), "a").select("a", "b", "x", "y")
    )
    return mapped(both, each, "a long, b long").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full sets have at least ``percent`` of their union in common."""
    both = (
        pairs.join(sets.selectExpr("node as b", "items as y"), "b").join(sets.selectExpr("node as a", "items as x"), "a")
        .select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("same"))
    )
    return both.where(f"100 * same >= {percent} * (nx + ny - same)").select("a", "b").distinct()


def _similar_size(x: str, y: str, percent: int) -> str:
    """Sets of very different sizes cannot reach the similarity."""
    return f"100L * least({x}, {y}) >= {percent}L * greatest({x}, {y})"


def linked(docs: DataFrame, prints: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``node``, ``component`` for the classes of equal sets that are linked with another; ``prints`` from ``fingerprints``."""
    classes = written(
        prints.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.max("signature").alias("signature")), "classes",
    )
    keys = chunk_keys(classes)
    shared = keys.groupBy("key").agg(F.count("node").alias("size")).where("size > 1")
    members = written(keys.join(shared, "key").select("key", "node", "n", "size"), "members")
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = written(members.join(degree, "node").select("key", "node", "n", "degree"), "ranked")
    dropped(members)
    signatures = classes.select("node", "signature")
    sets = written(full_sets(docs, ranked.select("node").distinct(), doc_id, text), "sets")

    def check(pairs: DataFrame) -> DataFrame:
        return confirmed(within_radius(pairs, signatures), sets, percent)

    # a star around one pivot in every key
    best = ranked.groupBy("key").agg(F.max(F.struct("degree", -F.col("node"), "n")).alias("p"))
    pivots = written(best.select("key", (-F.col("p.col2")).alias("pivot"), F.col("p.n").alias("np")), "pivots")
    placed = ranked.join(pivots, "key").where("node <> pivot")
    pairs = placed.where(_similar_size("n", "np", percent)).selectExpr("pivot as a", "node as b").distinct()
    links = written(confirmed(within_radius(pairs, signatures), sets, percent), "links")
    found = written(components(links), "components")

    # members of one key that are in different components have only been compared with the pivot
    here = placed.select("key", "pivot", "node", "n").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = here.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    left = here.join(apart, "key").select("pivot", "node", "n", "component").distinct()
    left = written(left.join(found.selectExpr("node as pivot", "component as main"), "pivot", "left"), "apart")
    more = written(linked_in_blocks(left, sets, percent), "links")
    if more.isEmpty():
        return found
    return components(links.unionByName(more))


def linked_in_blocks(left: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) among the rows (pivot, node, n, component, main) of one pivot.

    The queries are the nodes outside the pivot's own component ``main``; each is held against all nodes of the
    pivot's group that are in another component. Queries and nodes are dealt to blocks of about ``block`` sets, and a
    task holds one block of each: a large group takes more tasks, not larger ones. Only links leave a task.
    """
    outside = F.col("main").isNull() | (F.col("component") != F.col("main"))
    sizes = left.groupBy("pivot").agg(F.count("node").alias("nodes"), F.count_if(outside).alias("queries")).where("nodes > 1 and queries > 0")
    dealt = (
        left.withColumn("query", outside).join(sizes, "pivot")
        .withColumn("nb", F.expr(f"cast(ceil(nodes / {block}) as int)")).withColumn("qb", F.expr(f"cast(ceil(queries / {block}) as int)"))
        .withColumn("h", F.xxhash64("node"))
    )
    rest = ["pivot", "node", "component"]
    queries = dealt.where("query").select(*rest, F.lit(True).alias("query"), F.expr("cast(pmod(h, qb) as int)").alias("q"), F.explode(F.expr("sequence(0, nb - 1)")).alias("b"))
    others = dealt.select(*rest, F.lit(False).alias("query"), F.explode(F.expr("sequence(0, qb - 1)")).alias("q"), F.expr("cast(pmod(h, nb) as int)").alias("b"))

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        query = group["query"].to_numpy()
        node, component = group["node"].to_numpy(), group["component"].to_numpy()
        lists = group["items"].combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(node)), lengths)
        values, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        y, x = np.flatnonzero(query), np.flatnonzero(~query)
        same = np.zeros((len(y), len(x)), np.float32)
        place = np.zeros(len(node), np.int64)
        place[y], place[x] = np.arange(len(y)), np.arange(len(x))
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, len(values), 4096):  # sums of products of 0/1 matrices, some columns at a time
            part = slice(*np.searchsorted(column, [first, first + 4096]))
            r, c = row[part], column[part] - first
            left_side, right_side = np.zeros((len(y), 4096), np.float32), np.zeros((len(x), 4096), np.float32)
            left_side[place[r[query[r]]], c[query[r]]] = 1
            right_side[place[r[~query[r]]], c[~query[r]]] = 1
            same += left_side @ right_side.T
        union = lengths[y][:, None] + lengths[x][None, :] - same
        i, j = np.nonzero((100 * same >= percent * union) & (component[y][:, None] != component[x][None, :]))
        return pa.table({"a": node[y[i]], "b": node[x[j]]})

    rows = queries.unionByName(others).join(sets, "node")
    return rows.groupBy("pivot", "q", "b").applyInArrow(compare, "a long, b long").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked if their sets share ``percent`` of their union; ``component_id`` is the smallest id that
    links lead to, and the document of that id is kept. A text with fewer than five words has one shingle, its whole
    sequence; without words, or null, its set is empty and it is linked with nothing. Rows repeated under one id are
    one document, linked if one of its texts is. A row without an id stands alone and is kept, with a null component.
    Other columns are ignored; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, doc_id, text), "fingerprints")
    found = linked(docs, prints, doc_id, text, percent)
    known = prints.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    sets = F.struct("s1", "s2")
    several = known.groupBy("doc_id").agg(F.min(sets).alias("low"), F.max(sets).alias("high")).where("low <> high").select("doc_id")
    if not several.isEmpty():  # the texts of one id are one document, so their classes belong together
        own = known.join(several, "doc_id").select("doc_id", "s1", "s2").distinct().join(classes, ["s1", "s2"])
        least = own.groupBy("doc_id").agg(F.min("node").alias("least"))
        same = own.join(least, "doc_id").selectExpr("least as a", "node as b")
        found = components(found.selectExpr("component as a", "node as b").unionByName(same))
    named = classes.join(found, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    return (
        prints.select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
        .selectExpr("doc_id", "n_shingles", "if(doc_id is null, null, coalesce(if(n_shingles > 0, component, null), doc_id)) as component_id")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``groups`` keeps; of rows repeated under one id, the first by all columns."""
    told = written(groups(docs, doc_id, text).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("kept").alias("n")), "kept")
    name = free_name(docs, "kept_id")
    key = F.col(doc_id).cast("long")

    def of(ids: DataFrame) -> DataFrame:
        return docs.join(ids.select(F.col("doc_id").alias(name)), key == F.col(name), "left_semi")

    out = of(told.where("n = 1")).unionByName(docs.where(key.isNull()))
    if told.where("n > 1").isEmpty():
        return out
    number = free_name(docs, "number")
    first = Window.partitionBy(doc_id).orderBy(*[c for c in docs.columns if c != doc_id])
    repeated = of(told.where("n > 1")).withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).drop(number)
    return out.unionByName(repeated)
