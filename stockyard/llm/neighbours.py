"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Fitting. On at most ``SAMPLE`` vectors, chosen by a hash of the vector, each tree splits a node by the plane between
two random centres, at the median. A leaf keeps at least ``LEAF`` sampled vectors, so a tree has at most
``SAMPLE / LEAF`` leaves and the forest's size has a bound whatever the table's size.

Index. Every vector goes through every tree once; equal vectors are one entry with their smallest ids. Entries are dealt
to shards of about ``SHARD`` by a hash, each sent once with the leaves it lies in, so a task's matrix stays small.

Search. A query's margin in a node is its distance from the plane, negative on the far side. All trees share one
priority queue keyed by the least margin on the way down; leaves are popped from it until they hold ``share`` times
as many entries as the index. A child never precedes its parent, so popping is the same as taking leaves in
descending order of that least margin. A query goes to the shards with its popped leaves as bits; the entries in any of
them are its candidates, and each is scored once, however many trees offer it. What can still be among the best goes on,
with all that tie, and the final order is by exact double-precision scores. Vectors of different lengths have no product,
so those of each length have a forest of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockyard.llm.common import written

SAMPLE = 65_536
LEAF = 128
TREES = 8
SHARE = 2.0  # entries popped, counted per tree, as a share of the index
SHARD = 32_768
QUERIES = 128  # that a task scores at once
ROUNDING = 1e-10  # of the product of the norms: more than a matrix product can be off


class Forest:
    """Planes of ``trees`` complete binary trees of one depth: ``normals`` (trees, nodes, dim) and ``cuts`` (trees, nodes)."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 7):
        self.depth = max(0, int(math.log2(max(1, len(sample)) / leaf)))
        nodes = 2**self.depth - 1
        self.normals = np.zeros((trees, nodes, sample.shape[1]))
        self.cuts = np.zeros((trees, nodes))
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            parts = [np.arange(len(sample))]
            for node in range(nodes):
                own = sample[parts[node]]
                normal = self._normal(own, rng)
                along = own @ normal
                cut = float(np.median(along)) if len(own) else 0.0
                self.normals[t, node], self.cuts[t, node] = normal, cut
                parts += [parts[node][along <= cut], parts[node][along > cut]]

    @staticmethod
    def _normal(own: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Direction between two centres, refined on a few of the node's vectors; random where they coincide."""
        if len(own) > 1:
            some = own[rng.choice(len(own), min(len(own), 256), replace=False)]
            a, b = some[0], some[1]
            for _ in range(4):
                near_a = some @ (a - b) > (a @ a - b @ b) / 2
                if near_a.all() or not near_a.any():
                    break
                a, b = some[near_a].mean(0), some[~near_a].mean(0)
            length = np.linalg.norm(a - b)
            if length > 0:
                return (a - b) / length
        normal = rng.normal(size=own.shape[1])
        return normal / np.linalg.norm(normal)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each vector in each tree."""
        out = np.zeros((len(x), len(self.normals)), np.int64)
        for t, (normals, cuts) in enumerate(zip(self.normals, self.cuts)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, normals[node]) > cuts[node])
            out[:, t] = node - (2**self.depth - 1)
        return out

    def least_margins(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees * leaves): least margin on the way to each leaf."""
        out = []
        for normals, cuts in zip(self.normals, self.cuts):
            margins = x @ normals.T - cuts
            least = np.full((len(x), 1), np.inf)
            for d in range(self.depth):
                here = margins[:, 2**d - 1 : 2 ** (d + 1) - 1]
                least = np.stack([np.minimum(least, -here), np.minimum(least, here)], 2).reshape(len(x), -1)
            out.append(least)
        return np.concatenate(out, 1)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part: not null, not zero, all components finite."""
    v = F.col("v")
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull() & plain & F.exists(v, lambda x: x != 0.0))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    leaf: int = LEAF,
    share: float = SHARE,
    sample: int = SAMPLE,
    shard: int = SHARD,
) -> DataFrame:
    """The ``k`` nearest of ``vectors`` for each of ``queries``: query_id, rank from 1, vec_id, score.

    Both frames have the columns ``vec_id`` and ``vector``; a candidate with the query's own id is left out. Vectors
    that are null, zero, or hold a null or non-finite component, or have no id, take no part on either side; a query finds
    vectors of its own length. Rows repeated under one id count once. Fewer than ``k`` candidates give fewer rows, an
    empty table none. Ties go to the smaller id. Other columns are ignored.
    """
    spark = vectors.sparkSession
    # one entry per distinct vector: its k + 1 smallest ids answer every query, also one that is itself among them
    ids = F.array_sort(F.collect_set("id"))
    base = usable(vectors, vec_id, vector).select("id", "v", F.xxhash64("v").alias("h"))
    ranked = base.distinct().withColumn("_n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("_n") <= k + 1)
    entries = written(
        ranked.groupBy("v").agg(ids.alias("ids")).select(F.col("ids")[0].alias("entry"), "v", "ids", F.xxhash64("v").alias("h")),
        "entries",
    )
    asked = usable(queries, vec_id, vector).dropDuplicates(["id"])
    lengths = [r[0] for r in entries.select(F.size("v")).distinct().collect()]
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    near = reduce(DataFrame.unionByName, [
        _near(entries.where(F.size("v") == n), asked.where(F.size("v") == n), k, trees, leaf, share, sample, shard) for n in lengths
    ])
    # exact scores: products summed from the first component to the last
    exact = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = (
        near.join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
        .join(entries.select("entry", "v", "ids"), "entry").where(F.size("q") == F.size("v"))
        .select("query_id", exact.alias("score"), F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
    )
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _near(entries: DataFrame, asked: DataFrame, k: int, trees: int, leaf: int, share: float, sample: int, shard: int) -> DataFrame:
    """query_id and entry of all that may be among the ``k`` nearest, for vectors of one length."""
    spark = entries.sparkSession
    count = entries.count()
    fraction = min(1.0, sample / count)
    chosen = entries if fraction == 1.0 else entries.where(F.pmod("h", F.lit(1 << 30)) < int(fraction * (1 << 30)))
    forest = Forest(_matrix(chosen.select("v").toArrow().column("v").combine_chunks()), trees, leaf)
    held = spark.sparkContext.broadcast(forest)
    per_tree = 2**forest.depth

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaves = held.value.leaves(_matrix(b.column("v"))) + np.arange(trees) * per_tree
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, _lists(leaves.ravel(), np.full(b.num_rows, trees), pa.int32())], ["entry", "v", "h", "leaves"]
                )

    placed = written(entries.select("entry", "v", "h").mapInArrow(route, "entry long, v array<double>, h long, leaves array<int>"), "leaves")
    # at most trees * SAMPLE / LEAF rows
    sizes = np.zeros(trees * per_tree, np.int64)
    for r in placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    budget = share * count

    def pop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the leaves that they pop, a bit for each."""
        for whole in batches:
            for at in range(0, whole.num_rows, 2 * QUERIES):
                b = whole.slice(at, 2 * QUERIES)
                queue = np.argsort(-held.value.least_margins(_matrix(b.column("v"))), axis=1, kind="stable")
                before = np.cumsum(sizes[queue], axis=1) - sizes[queue]
                popped = np.zeros(queue.shape, bool)
                np.put_along_axis(popped, queue, before < budget, 1)
                bits = np.packbits(popped, axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([row.tobytes() for row in bits], pa.binary())], ["id", "v", "popped"])

    shards = max(1, -(-count // shard))
    kind = ["shard", "kind", "id", "v", "leaves", "popped"]
    stored = placed.select(
        F.pmod("h", F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), F.col("entry").alias("id"), "v", "leaves",
        F.lit(None).cast("binary").alias("popped"),
    )
    probes = asked.select("id", "v").mapInArrow(pop, "id long, v array<double>, popped binary").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "id", "v",
        F.lit(None).cast("array<int>").alias("leaves"), "popped",
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shard, entries before queries; per query the best of a shard's candidates go on."""
        here, held_rows, index = None, [], None
        for whole in batches:
            at_shard, kinds = whole.column("shard").to_numpy(), whole.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(at_shard) != 0) | (np.diff(kinds) != 0)) + 1
            for a, z in zip([0, *cuts], [*cuts, len(kinds)]):
                b = whole.slice(a, z - a)
                if at_shard[a] != here:
                    here, held_rows, index = at_shard[a], [], None
                if kinds[a] == 0:
                    held_rows.append((b.column("id").to_numpy(), _matrix(b.column("v")), _matrix(b.column("leaves")).astype(np.int64)))
                elif held_rows:
                    if index is None:
                        index = tuple(np.concatenate(c) for c in zip(*held_rows))
                        held_rows = [index]
                    for at in range(0, b.num_rows, QUERIES):
                        yield best(b.slice(at, QUERIES), *index)

    def best(b: pa.RecordBatch, entry: np.ndarray, x: np.ndarray, leaves: np.ndarray) -> pa.RecordBatch:
        q, asks = _matrix(b.column("v")), b.column("id").to_numpy()
        popped = np.unpackbits(np.frombuffer(b"".join(b.column("popped").to_pylist()), np.uint8).reshape(len(q), -1), axis=1).astype(bool)
        candidate = np.zeros((len(q), len(x)), bool)
        for tree in leaves.T:
            candidate |= popped[:, tree]
        scores = np.where(candidate, q @ x.T, -np.inf)
        slack = ROUNDING * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        last = -np.inf if len(x) <= k + 1 else np.partition(scores, len(x) - k - 1, axis=1)[:, len(x) - k - 1] - slack
        row, col = np.nonzero((scores.T >= last).T & candidate)
        return pa.RecordBatch.from_arrays(
            [pa.array(asks[row]), pa.array(entry[col]), pa.array(scores[row, col]), pa.array(slack[row])], ["query_id", "entry", "score", "slack"]
        )

    dealt = stored.select(kind).unionByName(probes.select(kind)).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    hits = dealt.mapInArrow(scan, "query_id long, entry long, score double, slack double")
    # all that are not below the last of the best by more than rounding
    own = Window.partitionBy("query_id")
    placed_ = hits.withColumn("_n", F.row_number().over(own.orderBy(F.desc("score"), "entry")))
    last = F.max(F.when(F.col("_n") == k + 1, F.col("score"))).over(own)
    return placed_.withColumn("_last", last).where("_last is null or score >= _last - 2 * slack").select("query_id", "entry")
