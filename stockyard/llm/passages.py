"""Passages that repeat across documents, from a sparse suffix array.

1. *Sparse suffixes.* A text is a sequence of words. Each window of ``LENGTH`` = 50 words selects the least hash of its
   ``SEED`` = 10-word runs (a minimiser); only the suffixes at these places are kept, about one for twenty words. Equal
   windows select the same place, so a repeated passage of 50 words has a kept suffix in every copy. Of a text's suffixes
   with the same ten words the first stands for all: a word pair repeated a thousand times is one row.
2. *Sort and compare neighbours.* The suffixes are sorted by their leading words (as hashes, so the order of words is
   that of their hashes) over range partitions that may cut through equal ones, as document and place complete the
   order. A suffix stays if its ten words equal those of the one before or after it, or if it stands at the edge of a
   partition.
3. *Extend left and right.* A kept suffix speaks for the windows that selected it: up to 40 words to its left, and the
   50 words from the last of them on. Equal extents are one class, whose first document owns it; all windows of an
   extent owned by another document repeat. A text has one row per class, with all its places. What is left, one
   document's row per class, is compared window by window, again by the first owner. Owners are found by sorting: extents, then windows, stand by name and document
   over range partitions, and the first document of a name is carried along them, from one partition to the next. So a
   passage that a third of all documents share is no hot group, and nothing is joined by name.

A window repeats if an earlier document, by id, has it too; a document's own repetitions are left alone. Results are
exact up to collisions of 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from stockyard.llm.common import SLICE_BYTES, TEXT_ROWS, dropped, free_name, mapped, slices, written
from stockyard.llm.words import Words, mix, runs, stream

LENGTH, SEED = 50, 10
SPAN = LENGTH - SEED + 1
PART_BYTES = SLICE_BYTES >> 2  # words take some fifty bytes for each of text
EXTENT_ROWS = 1000  # extents that go to a worker at once; each makes a row for every one of its up to 41 windows
_BASE = np.uint64(0x9E3779B97F4A7C15)


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the kept suffixes of one text, and the first and last window that selected each."""
    if len(words) < LENGTH:
        return (np.zeros(0, np.int64),) * 3
    seeds = runs(words, SEED)
    chosen = np.lib.stride_tricks.sliding_window_view(seeds, SPAN).argmin(1) + np.arange(len(words) - LENGTH + 1)
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    return chosen[first], first, np.append(first[1:], len(chosen)) - 1


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts rows of equal keys together, as they stood, and where groups begin in it.

    Only the first key is sorted. A group whose first key is another's too may come in parts; groups never mix.
    """
    order = np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text")).where(
        "doc_id is not null and text is not null"
    )


def suffixes(texts: DataFrame) -> DataFrame:
    """head, tail, doc_id, copy, place: the kept suffixes; ``head`` holds two words, ``tail`` the hash of all ten.

    A text has one row for those of the same ten words, with the first place.
    """

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(b.column(2))
        parts = [minimisers(words.hash[a:z])[0] for a, z in zip(words.first[:-1], words.first[1:])]
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        place = np.concatenate(parts)
        at = place + words.first[row]
        half = words.hash >> np.uint64(32)
        head = half[at] << np.uint64(32) | half[at + 1] if len(at) else np.zeros(0, np.uint64)
        tail = runs(words.hash, SEED)[at] if len(at) else np.zeros(0, np.uint64)
        order, edge = grouped(tail, head, row)
        once = order[edge]
        head, tail, take = head[once], tail[once], pa.array(row[once])
        return pa.RecordBatch.from_arrays(
            [pa.array(head.view(np.int64)), pa.array(tail.view(np.int64)), b.column(0).take(take), b.column(1).take(take), pa.array(place[once].astype(np.int32))],
            ["head", "tail", "doc_id", "copy", "place"],
        )

    return mapped(texts, each, "head long, tail long, doc_id long, copy long, place int", text=2, limit=PART_BYTES)


def with_equal_neighbour(suffix: DataFrame) -> DataFrame:
    """doc_id, copy, place of the suffixes that a neighbour in the sorted order equals, or that have none on one side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        before = None
        for b in batches:
            if not b.num_rows:
                continue
            table = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            keys = np.stack([table.column(0).to_numpy(), table.column(1).to_numpy()], 1)
            same = (keys[1:] == keys[:-1]).all(1)
            keep = np.append(before is None or before == tuple(keys[0]), same)
            keep[:-1] |= same
            # the last row waits for the one after it
            yield table.slice(0, len(keys) - 1).filter(pa.array(keep[:-1])).select(["doc_id", "copy", "place"])
            held = table.slice(len(keys) - 1)
            before = tuple(keys[-2]) if len(keys) > 1 else before
        if held is not None:
            yield held.select(["doc_id", "copy", "place"])

    order = ["head", "tail", "doc_id", "copy", "place"]
    return suffix.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "doc_id long, copy long, place int")


class RangeHash:
    """128-bit names of any ranges of a text's words, from prefix sums of a polynomial."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.power = np.cumprod(np.full(n + 1, _BASE, np.uint64)) * np.uint64(1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.back = np.cumprod(np.full(n + 1, inverse, np.uint64))
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words ^ s) * self.power[:n])]) for s in stream(31, 2)]

    def name(self, begin: np.ndarray, end: np.ndarray, side: int) -> np.ndarray:
        return mix((self.sums[side][end] - self.sums[side][begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def extents(texts: DataFrame, places: DataFrame) -> DataFrame:
    """c1, c2 (name of the extent's words), doc_id, copy, begin, last, again, and the 8-byte names of its windows on end.

    A text has one row per name. ``begin`` and ``last`` are of its first place; ``again`` says how far behind each place
    begins, the first (0) included.
    """
    listed = places.groupBy("doc_id", "copy").agg(F.collect_set("place").alias("places"))

    def each(b: pa.RecordBatch) -> pa.RecordBatch | None:
        words = Words(b.column(2))
        lists = b.column(3)
        wanted, edge = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        rows, begins, lasts, names, again, times, windows = [], [], [], [[], []], [], [], []
        for i, (a, z) in enumerate(zip(words.first[:-1], words.first[1:])):
            place, first, last = minimisers(words.hash[a:z])
            tails = runs(words.hash[a:z], SEED)[place]
            keep = np.isin(tails, tails[np.isin(place, wanted[edge[i] : edge[i + 1]])])
            first, last = first[keep], last[keep]
            if not len(first):
                continue
            ranges = RangeHash(words.hash[a:z])
            named = [ranges.name(first, last + LENGTH, side) for side in (0, 1)]
            order, group = grouped(*named)
            once, counts = order[group], np.diff(np.append(group, len(order)))
            again.append(first[order] - np.repeat(first[once], counts))
            times.append(counts)
            first, last = first[once], last[once]
            rows.append(np.full(len(first), i))
            begins.append(first)
            lasts.append(last)
            for side in (0, 1):
                names[side].append(named[side][once])
            at = np.arange(len(words.hash[a:z]) - LENGTH + 1)
            each_window = (ranges.name(at, at + LENGTH, 0) ^ (ranges.name(at, at + LENGTH, 1) << np.uint64(1))).view(np.int64)
            windows += [each_window[f : e + 1].tobytes() for f, e in zip(first, last)]
        if not rows:
            return None
        take = pa.array(np.concatenate(rows))
        places_of = pa.ListArray.from_arrays(np.append(0, np.cumsum(np.concatenate(times))).astype(np.int32), np.concatenate(again).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(np.concatenate(n).view(np.int64)) for n in names), b.column(0).take(take), b.column(1).take(take),
             pa.array(np.concatenate(begins).astype(np.int32)), pa.array(np.concatenate(lasts).astype(np.int32)), places_of, pa.array(windows, pa.binary())],
            ["c1", "c2", "doc_id", "copy", "begin", "last", "again", "windows"],
        )

    rows = texts.join(listed, ["doc_id", "copy"]).select("doc_id", "copy", "text", "places")
    schema = "c1 long, c2 long, doc_id long, copy long, begin int, last int, again array<int>, windows binary"
    return mapped(rows, each, schema, text=2, limit=PART_BYTES)


def window_names(owned: DataFrame) -> DataFrame:
    """name, doc_id, copy, at, again: one row per window of each extent, at its first place."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        names = b.column(4).to_pylist()
        counts = [len(n) // 8 for n in names]
        take = pa.array(np.repeat(np.arange(len(names)), counts))
        begin = b.column(2).to_numpy()
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(begin, counts)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(b"".join(names), np.int64)), b.column(0).take(take), b.column(1).take(take), pa.array(at.astype(np.int32)), b.column(3).take(take)],
            ["name", "doc_id", "copy", "at", "again"],
        )

    return mapped(owned.select("doc_id", "copy", "begin", "again", "windows"), each, "name long, doc_id long, copy long, at int, again array<int>")


def after_first(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` sorted by ``key`` (longs) and doc_id over range partitions, and whether an earlier document has their key.

    The first document of a key is carried along the sorted rows, so one key may fill any number of partitions. New
    columns: ``repeats``, as far as the partition shows it; ``open``, for rows of the first document of a partition's
    first key, which the partitions before it may yet make repeats; ``part``; and ``edge``, in one more row per
    partition, with its first key and document, last key, and the first document of that. ``settled`` reads these.
    """
    order = [*key, *(c for c in ("doc_id", "copy", "begin", "at") if c in rows.columns)]
    names, doc = rows.columns, rows.columns.index("doc_id")
    at = [names.index(c) for c in key]
    schema = StructType(rows.schema.fields + StructType.fromDDL("repeats boolean, open boolean, part int, edge array<bigint>").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = owner = None  # the first row's key and document, the last row's key, and its first document
        types = {}
        for b in batches:
            if not b.num_rows:
                continue
            types = {f.name: f.type for f in b.schema}
            keys = np.stack([b.column(i).to_numpy() for i in at], 1)
            docs = b.column(doc).to_numpy()
            new = np.append(last != tuple(keys[0].tolist()), (keys[1:] != keys[:-1]).any(1))
            begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            owners = np.where(begin < 0, 0 if owner is None else owner, docs[begin])
            if first is None:
                first = [*keys[0].tolist(), int(docs[0])]
            of_first = (keys == first[:-1]).all(1) & (docs == first[-1])
            last, owner = tuple(keys[-1].tolist()), int(owners[-1])
            n = b.num_rows
            more = [pa.array(docs != owners), pa.array(of_first), pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*names, "repeats", "open", "part", "edge"])
        if first is not None:
            row = [pa.nulls(1, types[c]) for c in names] + [pa.nulls(1, pa.bool_()), pa.nulls(1, pa.bool_()), pa.array([part], pa.int32())]
            yield pa.RecordBatch.from_arrays([*row, pa.array([[*first, *last, owner]], pa.list_(pa.int64()))], [*names, "repeats", "open", "part", "edge"])

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def settled(marked: DataFrame) -> DataFrame:
    """A written table of ``after_first`` with ``repeats`` final; one row per partition passes through the driver."""
    edges = marked.where("edge is not null").select("edge", "part").collect()
    late, key, owner = [], None, None
    for edge, part in sorted((list(e), p) for e, p in edges):
        k = (len(edge) - 2) // 2
        first, doc, last, own = edge[:k], edge[k], edge[k + 1 : -1], edge[-1]
        if first == key and owner < doc:
            late.append(part)
        if last != key:
            key, owner = last, own
    whole = marked.where("edge is null")
    return whole.withColumn("repeats", F.col("repeats") | (F.col("open") & F.col("part").isin(late))).drop("open", "part", "edge")


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, copy, spans: per document the places (begin, end), in words, of passages that an earlier one has.

    ``copy`` is the hash of the text, so that rows repeated under one id are told apart. Spans may touch or overlap.
    """
    texts = _texts(docs, doc_id, text)
    suffix = written(suffixes(texts), "suffixes", TEXT_ROWS)
    found = written(extents(texts, with_equal_neighbour(suffix)), "extents", TEXT_ROWS)
    dropped(suffix)
    told = settled(written(after_first(found, ["c1", "c2"]).withColumn("windows", F.expr("case when not repeats then windows end")), "told", EXTENT_ROWS))
    dropped(found)
    windows = after_first(window_names(told.where("not repeats")), ["name"])
    later = settled(written(windows.where("repeats or open or edge is not null"), "later-windows", EXTENT_ROWS)).where("repeats")
    partly = later.selectExpr("doc_id", "copy", f"transform(again, d -> struct(at + d as begin, at + d + {LENGTH} as end)) as spans")
    wholly = told.where("repeats").selectExpr("doc_id", "copy", f"transform(again, d -> struct(begin + d as begin, last + d + {LENGTH} as end)) as spans")
    return wholly.unionByName(partly).groupBy("doc_id", "copy").agg(F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"))


def joined_spans(spans: DataFrame) -> DataFrame:
    """The sorted ``spans`` of each row (doc_id, copy) joined where they touch."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in b.column(2).to_pylist():
            done: list[dict] = []
            for s in row:
                if done and s["begin"] <= done[-1]["end"]:
                    done[-1]["end"] = max(done[-1]["end"], s["end"])
                else:
                    done.append(s)
            out.append(done)
        return b.set_column(2, "spans", pa.array(out, b.column(2).type))

    return mapped(spans.select("doc_id", "copy", "spans"), each, "doc_id long, copy long, spans array<struct<begin:int,end:int>>")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_repeated, passages (``begin-end`` in words, comma between) for every row of ``docs``.

    Words are runs of other than ASCII white space, A-Z in lower case. A text that is null or has fewer than 50 words
    repeats nothing. A row without an id is not compared. Rows repeated under one id are one document: they do not
    repeat each other. Other columns are ignored; an empty table gives no rows.
    """

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(Words(b.column(2)).first))], ["doc_id", "copy", "n_words"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))
    counted = mapped(rows, each, "doc_id long, copy long, n_words long", text=2)
    spans = joined_spans(repeated(docs, doc_id, text))
    return counted.join(spans, ["doc_id", "copy"], "left").select(
        "doc_id", "n_words", F.expr("coalesce(aggregate(spans, 0L, (n, s) -> n + s.end - s.begin), 0L)").alias("n_repeated"),
        F.expr("coalesce(array_join(transform(spans, s -> concat(s.begin, '-', s.end)), ','), '')").alias("passages"),
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and rows dropped of which nothing is left.

    A passage goes with the white space behind it. All other rows and columns stay as they are, but for ``n_chars``,
    where there is one, which follows the text.
    """
    id_name, copy_name, spans_name = (free_name(docs, n) for n in ("span_id", "span_copy", "spans"))
    spans = repeated(docs, doc_id, text).select(F.col("doc_id").alias(id_name), F.col("copy").alias(copy_name), F.col("spans").alias(spans_name))
    rows = docs.withColumn(copy_name, F.xxhash64(text)).withColumn(id_name, F.col(doc_id).cast("long"))
    joined = rows.join(spans, [id_name, copy_name], "left").drop(id_name, copy_name)
    place = joined.columns.index(text)
    names = joined.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, place):
                yield b.set_column(place, names[place], cut(b.column(place), b.column(len(names) - 1)))

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        marked = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
        out = texts.to_pylist()
        words = Words(texts.take(pa.array(marked)))
        for k, i in enumerate(marked):
            a, z = words.first[k], words.first[k + 1]
            begin, base = words.start[a:z] - words.offsets[k], words.offsets[k]
            data = words.raw[base : words.offsets[k + 1]].tobytes()
            edge = np.append(begin, len(data))
            kept, at = [], 0
            for s in spans[i].as_py():
                kept.append(data[at : max(at, edge[s["begin"]])])
                at = max(at, int(edge[s["end"]]))
            kept.append(data[at:])
            out[i] = b"".join(kept).decode()
        return pa.array(out, pa.string())

    kept = joined.mapInArrow(run, joined.schema).where(F.col(spans_name).isNull() | (F.trim(text) != "")).drop(spans_name)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.coalesce(F.length(text).cast(kept.schema["n_chars"].dataType), F.col("n_chars")))
    return kept.select(*docs.columns)
