"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the largest permitted length are cut into pieces of it. The pieces are dealt to shards of bounded
size; within a shard they are placed from the longest to the shortest, each into the open bin it fills best. Where none
has room a bin is opened whose size is the cheapest per token it can be expected to hold: the piece itself and as much
of the gap as the pieces still to come can fill. In the end every bin is cut down to the smallest permitted length
that holds its contents.

The cost of a sequence of n tokens is ``n + n * n / ATTENTION + START``: work per token, attention, and a fixed part.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import mapped, written
from stockyard.llm.words import Words

SIZES = (512, 1024, 2048, 4096, 8192)
ATTENTION, START = 65_536, 16
SHARD_PIECES, SHARD_TOKENS = 16_384, 1 << 23


def cost(size: int) -> float:
    return size + size * size / ATTENTION + START


def place(lengths: list[int], sizes: tuple[int, ...] = SIZES) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each length, given in descending order, and the final size of each bin."""
    rising = np.array(lengths[::-1], np.int64)
    volume = np.concatenate([[0], np.cumsum(rising)])
    room: list[tuple[int, int]] = []  # (tokens left, bin), in order
    held: list[int] = []
    bins, offsets = [], []
    for i, n in enumerate(lengths):
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            to_come = len(lengths) - i - 1
            best = None
            for size in sizes:
                if size >= n:
                    gap = size - n
                    fill = min(gap, int(volume[min(to_come, int(np.searchsorted(rising, gap, side="right")))]))
                    price = cost(size) / (n + fill)
                    if best is None or price < best[0]:
                        best = (price, size)
            left, b = best[1], len(held)
            held.append(0)
        bins.append(b)
        offsets.append(held[b])
        held[b] += n
        if left > n:
            insort(room, (left - n, b))
    return bins, offsets, [next(s for s in sizes if s >= n) for n in held]


def word_counts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(Words(b.column(1)).first))], ["doc_id", "tokens"])

    return mapped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), each, "doc_id long, tokens long", text=1)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokens: str | None = None, sizes: tuple[int, ...] = SIZES,
    shard_pieces: int = SHARD_PIECES, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Where each piece of each document goes: doc_id, piece, start, n_tokens, sequence, capacity, position.

    A document's tokens are its words, or as many as its column ``tokens`` says. ``start`` is the piece's first token
    in the document, ``position`` its first in the sequence. A document without tokens (null, empty, a null or
    non-positive count) has one row, piece 0 of 0 tokens, with a null sequence. Each row of ``docs`` is packed, also one
    whose id is null or repeated. The sizes must be ascending. Other columns are ignored; an empty table gives no rows.
    """
    most = sizes[-1]
    counted = word_counts(docs, doc_id, text) if tokens is None else docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(0)).alias("tokens")
    )
    counted = written(counted, "lengths")
    pieces = (
        counted.withColumn("row", F.monotonically_increasing_id())  # of a written table, so that a repeated task finds the same
        .withColumn("piece", F.explode(F.expr(f"sequence(0, greatest(0, (tokens - 1) div {most}))")))
        .withColumn("start", F.col("piece") * most).withColumn("n_tokens", F.expr(f"cast(least(tokens - start, {most}) as int)"))
        .select("doc_id", F.col("piece").cast("int").alias("piece"), F.col("start").cast("long").alias("start"), "n_tokens", "row")
    )
    total, tokens_in_all = pieces.where("n_tokens > 0").agg(F.count("*"), F.sum("n_tokens")).first()
    shards = max(1, -(-total // shard_pieces), -(-(tokens_in_all or 0) // shard_tokens))

    def each(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        bins, offsets, held = place(group["n_tokens"].to_pylist(), sizes)
        shard = group["shard"][0].as_py()
        return pa.table({
            "doc_id": group["doc_id"], "piece": group["piece"], "start": group["start"], "n_tokens": group["n_tokens"],
            "sequence": pa.array(np.array(bins, np.int64) + (shard << 32)), "capacity": pa.array([held[b] for b in bins], pa.int32()),
            "position": pa.array(offsets, pa.int32()),
        })

    schema = "doc_id long, piece int, start long, n_tokens int, sequence long, capacity int, position int"
    packed = (
        pieces.where("n_tokens > 0").withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
        .groupBy("shard").applyInArrow(each, schema)
    )
    nothing = pieces.where("n_tokens = 0").selectExpr(
        "doc_id", "piece", "start", "n_tokens", "cast(null as long) as sequence", "cast(null as int) as capacity", "cast(null as int) as position"
    )
    return packed.unionByName(nothing)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence of ``pack``: its length, contents and the pieces in their order.

    Documents without words (null or blank text) are in no sequence: their rows of ``pack`` end here.
    """
    piece = F.struct("position", "doc_id", "start", "n_tokens")
    return (
        placed.where("sequence is not null").groupBy("sequence")
        .agg(F.first("capacity").alias("capacity"), F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(piece)).alias("pieces"))
        .select(
            "sequence", "capacity", "n_tokens", F.col("pieces.doc_id").alias("doc_ids"), F.col("pieces.start").alias("starts"),
            F.col("pieces.n_tokens").alias("lengths"), F.col("pieces.position").alias("positions"),
        )
    )
