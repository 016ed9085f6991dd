"""Hard-negative mining by threshold joins over inverted indexes in blocks of dimensions.

Every vector becomes integers, so scores are exact. Rows go to shards and anchors to blocks of bounded size by a hash of
their ids; each block meets each shard once, in a group of a shuffle, and only the best of a shard leave it.

In a group the shard's rows have an index: per block of dimensions a posting list of the rows that have a value there
worth indexing. A row's last dimensions are left out as soon as the norm of that suffix, times the longest anchor, is
below every anchor's first threshold: alone they cannot lift a pair to it. Rows stand in order of how much of them is
indexed, so a posting list is the beginning of the row order and partial scores of all anchors are added list by list. A
partial score and the product of the two remaining norms bound the pair from above. Only pairs whose bound reaches the
anchor's threshold are scored in full; then the threshold is lowered, for the anchors whose windows are not full yet,
until they are or the window's end is reached. Whatever is not scored lies below the threshold, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from stockyard.llm.common import written

SCALE = 256
LARGEST = 1 << 26  # components beyond are left out: their scores would not fit 64 bits
SHARD = BLOCK = 8192
DIMS = 8  # of a posting list
ANCHORS = 256  # that a task scores at once
FIRST, LOWER = 0.5, 0.75  # the first threshold as a share of the largest possible score, and the factor of each next one
PAIRS = 1 << 16  # scored in full at once


class Index:
    """Posting lists of the rows ``x``, without the dimensions whose suffix norm stays below ``needed`` per unit of an anchor."""

    def __init__(self, x: np.ndarray, needed: float):
        self.x = x
        squares = (x.astype(np.float64) ** 2)[:, ::-1].cumsum(1)[:, ::-1]
        self.after = np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], 1)[:, ::DIMS] if x.shape[1] % DIMS == 0
                             else np.concatenate([squares[:, ::DIMS], np.zeros((len(x), 1))], 1))
        cut = (self.after >= needed).sum(1).clip(max=self.after.shape[1] - 1) if needed > 0 else np.full(len(x), self.after.shape[1] - 1)
        self.order = np.argsort(-cut, kind="stable")
        self.cut = cut[self.order]
        self.rest = self.after[self.order, self.cut]
        lengths = [int(np.searchsorted(-self.cut, -j, "left")) for j in range(self.after.shape[1] - 1)]
        self.lists = [x[self.order[:n], j * DIMS : (j + 1) * DIMS].astype(np.float64) for j, n in enumerate(lengths)]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(anchors, rows in the order of ``order``): partial score plus the product of the remaining norms."""
        out = np.zeros((len(q), len(self.order)))
        for j, rows in enumerate(self.lists):
            out[:, : len(rows)] += q[:, j * DIMS : (j + 1) * DIMS].astype(np.float64) @ rows.T
        squares = (q.astype(np.float64) ** 2)[:, ::-1].cumsum(1)[:, ::-1]
        after = np.sqrt(np.concatenate([squares, np.zeros((len(q), DIMS))], 1)[:, ::DIMS])[:, : self.after.shape[1]]
        rest = after[:, self.cut] * self.rest
        return out + rest * (1 + 1e-9) + np.abs(out) * 1e-12 + 1e-6  # beyond any rounding


def joined(q: np.ndarray, x: np.ndarray, allowed: np.ndarray, first: np.ndarray, last: np.ndarray, full: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, row, score) among the ``allowed`` ones, with all that score at least an anchor's final threshold.

    Thresholds fall from ``first`` to ``last``; ``full(anchor, score, threshold)`` tells from all pairs so far which anchors have enough.
    """
    length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    usable = length > 0
    index = Index(x, float((first[usable] / length[usable]).min()) if usable.any() else 0.0)
    whole = index.x[index.order]
    bounds = np.where(allowed[:, index.order], index.bounds(q), -np.inf)
    threshold, before, open_ = first.astype(np.float64), np.full(len(q), np.inf), np.ones(len(q), bool)
    found = [np.zeros(0, np.int64)] * 3
    while open_.any():
        here = np.flatnonzero(open_)
        part = bounds[here]
        row, col = np.nonzero((part >= threshold[here, None]) & (part < before[here, None]))
        row = here[row]
        score = np.empty(len(row), np.int64)
        for at in range(0, len(row), PAIRS):
            a, b = row[at : at + PAIRS], col[at : at + PAIRS]
            score[at : at + PAIRS] = (q[a] * whole[b]).sum(1)
        found = [np.append(f, n) for f, n in zip(found, (row, index.order[col], score))]
        open_ &= ~full(found[0], found[2], threshold) & (threshold > last)
        before = np.where(open_, threshold, before)
        lower = np.where(threshold > 0, threshold * LOWER, last)
        threshold = np.where(open_, np.maximum(np.where(lower < 0.1 * first, last, lower), last), threshold)
    return tuple(found)


def _ranked(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each row, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, row))
    row = row[order]
    return order[np.arange(len(row)) - np.searchsorted(row, row) < k]


def _ints(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """id, label, v of the rows that take part; of rows under one id the least by (label, v)."""
    v = F.col(vector)
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    rows = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & plain).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("v"),
    )
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _matrix(lists: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy().astype(np.int64).reshape(len(lists), length)


def _met(anchors: DataFrame, rows: DataFrame, blocks: int, shards: int, each: Callable[[pa.Table, pa.Table, int], list[pa.Table]], schema: str) -> DataFrame:
    """``each(anchors, rows, length)`` for every block of anchors, shard of rows and length of vectors."""
    def dealt(df: DataFrame, asks: bool, own: str, n: int, other: str, every: int) -> DataFrame:
        return df.select(
            "*", F.lit(asks).alias("_asks"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(every - 1))).alias(other),
        )

    none = pa.schema([(f.split()[0], pa.int64()) for f in schema.split(", ")]).empty_table()

    def group(table: pa.Table) -> pa.Table:
        table = table.append_column("_length", pc.list_value_length(table["v"]))
        out = [none]
        asks = table.filter(table["_asks"])
        for length in pc.unique(asks["_length"]).to_pylist():
            same = pc.equal(table["_length"], length)
            out += each(table.filter(pc.and_(same, table["_asks"])), table.filter(pc.and_(same, pc.invert(table["_asks"]))), length)
        return pa.concat_tables(out)

    extra = [F.lit(None).cast(t).alias(n) for n, t in anchors.dtypes if n not in rows.columns]
    both = dealt(anchors, True, "_block", blocks, "_shard", shards).unionByName(dealt(rows.select("*", *extra), False, "_shard", shards, "_block", blocks))
    return both.groupBy("_block", "_shard").applyInArrow(group, schema)


def _table(schema: str, *columns: np.ndarray) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in schema.split(", ")])


def mine(
    vectors: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.

    A component x counts as floor(256 x). Anchors are the rows that meet ``is_anchor``, a condition on ``id``. An anchor's
    positives are its first ``positives`` other rows of the same label; for each of them the first ``negatives`` rows of
    other labels with ``low`` to ``high`` hundredths of the positive's score are given. Higher inner products come first,
    ties by smaller id. A positive below zero has an empty window and gives no row, nor does one without a row in it.

    Rows with a null id, label or vector, or a component that is null, not finite or of 2^18 and more, take no part. Rows
    under one id are one row, the least by label and vector. Vectors of different lengths have no score. Other columns
    are ignored.
    """
    rows = written(_ints(vectors, vec_id, vector, label), "vectors")
    anchors = rows.where(is_anchor)
    shards, blocks = max(1, -(-rows.count() // shard)), max(1, -(-anchors.count() // block))

    schema = "anchor_id long, id long, score long"

    def positive(asks: pa.Table, own: pa.Table, length: int) -> list[pa.Table]:
        q, x = _matrix(asks["v"], length), _matrix(own["v"], length)
        q_id, x_id, q_label, x_label = (t[c].to_numpy() for c in ("id", "label") for t in (asks, own))
        out = []
        for value in np.unique(q_label):
            mine_, theirs = np.flatnonzero(q_label == value), np.flatnonzero(x_label == value)
            if not len(theirs):
                continue
            longest = np.sqrt((x[theirs].astype(np.float64) ** 2).sum(1).max())
            for at in range(0, len(mine_), ANCHORS):
                a = mine_[at : at + ANCHORS]
                first = FIRST * longest * np.sqrt((q[a].astype(np.float64) ** 2).sum(1))

                def full(row: np.ndarray, score: np.ndarray, threshold: np.ndarray) -> np.ndarray:
                    return np.bincount(row[score >= threshold[row]], minlength=len(a)) >= positives

                row, col, score = joined(q[a], x[theirs], q_id[a][:, None] != x_id[theirs][None, :], first, np.zeros(len(a)), full)
                keep = np.flatnonzero(score >= 0)
                keep = keep[_ranked(row[keep], x_id[theirs[col[keep]]], score[keep], positives)]
                out.append(_table(schema, q_id[a[row[keep]]], x_id[theirs[col[keep]]], score[keep]))
        return out

    per_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = (
        _met(anchors, rows, blocks, shards, positive, schema)
        .withColumn("place", F.row_number().over(per_anchor)).where(F.col("place") <= positives)
        .groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
        .select("id", F.transform("p", lambda p: p["id"]).alias("pos_id"), F.transform("p", lambda p: p["score"]).alias("pos_score"))
    )
    asked = written(anchors.join(near, "id"), "positives")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def negative(asks: pa.Table, own: pa.Table, length: int) -> list[pa.Table]:
        q, x = _matrix(asks["v"], length), _matrix(own["v"], length)
        q_id, x_id, q_label, x_label = (t[c].to_numpy() for c in ("id", "label") for t in (asks, own))
        count = pc.list_value_length(asks["pos_id"]).to_numpy()
        pos_id, pos_score = (np.zeros((len(q), positives), np.int64) for _ in range(2))
        there = np.arange(positives) < count[:, None]
        pos_id[there], pos_score[there] = (pc.list_flatten(asks[c]).to_numpy() for c in ("pos_id", "pos_score"))
        lo, hi = -(-low * pos_score // 100), high * pos_score // 100
        out = []
        for at in range(0, len(q), ANCHORS):
            a = np.arange(at, min(at + ANCHORS, len(q)))
            ends = np.where(there[a], lo[a], np.iinfo(np.int64).max).min(1)
            starts = np.where(there[a], hi[a], np.iinfo(np.int64).max).min(1)

            def full(row: np.ndarray, score: np.ndarray, threshold: np.ndarray) -> np.ndarray:
                done = np.ones(len(a), bool)
                for w in range(positives):
                    fits = (score >= np.maximum(threshold, lo[a, w])[row]) & (score <= hi[a, w][row])
                    done &= ~there[a, w] | (threshold <= lo[a, w]) | (np.bincount(row[fits], minlength=len(a)) >= negatives)
                return done

            row, col, score = joined(q[a], x, q_label[a][:, None] != x_label[None, :], starts, ends, full)
            for w in range(positives):
                fits = np.flatnonzero(there[a, w][row] & (score >= lo[a, w][row]) & (score <= hi[a, w][row]))
                fits = fits[_ranked(row[fits], x_id[col[fits]], score[fits], negatives)]
                r = a[row[fits]]
                out.append(_table(schema, q_id[r], pos_id[r, w], pos_score[r, w], x_id[col[fits]], score[fits]))
        return out

    per_pair = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        _met(asked, rows, blocks, shards, negative, schema)
        .withColumn("rank", F.row_number().over(per_pair)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
