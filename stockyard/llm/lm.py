"""Language-model scoring: interpolated modified Kneser-Ney over words, counted in Spark, read from mapped arrays.

Counting. Words are 64-bit hashes. Each task counts its n-grams, packs them into sorted blocks, one per bucket, and Spark
moves the blocks. A bucket holds all n-grams of its contexts; n-grams whose last context word is hot, that is more than a
quarter of a bucket's share of all tokens, are dealt by the whole n-gram instead, and their contexts' totals are summed
afterwards. What a bucket holds is therefore bounded, whatever share of the text one word has. A bucket counts its
n-grams, writes their arrays, and sends the n-grams without their first word on, counted once per different first word:
these continuation counts are what the next lower order is made of. All orders are counted in one chain of shuffles.

Storage. An order has, by bucket, a sorted array of n-gram hashes with their counts and one of context hashes with their
totals; words have one of hashes, counts and continuation counts. They are files in the shared folder. Workers map them
(from a store that cannot be mapped, a local copy that has no name any more) and look a batch's keys up in sorted order,
so a worker's memory does not grow with the model.

Probability of w behind h, for counts c of the order, discounts D of the modified kind and h' without its first word:
(max(c(hw) - D(c), 0) + (D1 N1(h) + D2 N2(h) + D3 N3+(h)) p(w|h')) / c(h); behind an unknown h it is p(w|h'), and below
the words stands the uniform share 1 / (V + 1), where V is the number of different tokens.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import id_remainder, mapped, shared_dir, slices, written
from stockyard.llm.words import Words, mix, stream

ORDER = 2
BUCKET = 6_000_000  # tokens of the corpus per bucket
HELD = 3_000_000  # n-grams a task counts before it sends them
BATCH_BYTES = 2 << 20
END, BEGIN, TIMES = stream(31, 3)
TIMES |= np.uint64(1)
MANY = 255  # counts from here on stand in an array of their own
CODEC = pa.Codec("zstd", 1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens on end, each text closed by END, and where each text begins."""
    words = Words(column)
    texts = np.arange(len(column))
    out = np.full(len(words.hash) + len(column), END)
    out[np.arange(len(words.hash)) + words.doc] = words.hash
    return out, words.first[:-1] + texts


def grams(token: np.ndarray, begins: np.ndarray, order: int) -> list[np.ndarray]:
    """The words of the n-gram that ends at each token, first word first; before a text stands BEGIN."""
    place = np.arange(len(token)) - np.repeat(begins, np.diff(np.append(begins, len(token))))
    return [np.where(place >= k, np.roll(token, k), BEGIN) for k in range(order - 1, -1, -1)]


def combined(columns: list[np.ndarray]) -> np.ndarray:
    key = columns[0]
    for c in columns[1:]:
        key = mix(key * TIMES + c)
    return key


def _range(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    if not len(few):
        return np.zeros(len(values), bool)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


def bucket_of(columns: list[np.ndarray], buckets: int, hot: np.ndarray) -> np.ndarray:
    if len(columns) == 1:
        return _range(columns[0], buckets)
    return _range(np.where(_among(columns[-2], hot), combined(columns), combined(columns[:-1])), buckets)


def summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows in order, and the sum of ``n`` of each."""
    if not len(n):
        return columns, n
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    at = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)))
    return [c[at] for c in columns], np.add.reduceat(n[order], at)


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers, the first as differences, their bytes by place; equal or small numbers take little."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in [first, *columns[1:]])
    return len(columns[0]).to_bytes(8, "little") + CODEC.compress(planes, asbytes=True)


def unpacked(block: bytes, width: int) -> list[np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    planes = np.frombuffer(CODEC.decompress(block[8:], 8 * n * width), np.uint8).reshape(width, 8, n)
    out = [np.ascontiguousarray(p.T).view("<u8")[:, 0] for p in planes]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


ROWS = "bucket int, kind string, block binary"


def _rows(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    bucket, kind, block = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.string()), pa.array(block, pa.binary())], ["bucket", "kind", "block"])


def _blocks(columns: list[np.ndarray], n: np.ndarray, buckets: int, hot: np.ndarray, kind: str = "grams") -> list[tuple[int, str, bytes]]:
    """Sorted rows as one block per bucket."""
    own = bucket_of(columns, buckets, hot)
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(buckets + 1))
    return [
        (b, kind, packed([c[order[i:j]] for c in [*columns, n]])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j
    ]


class Store:
    """Arrays in files of a folder that all workers see, one file per name and bucket."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, name: str, bucket: int, arrays: list[np.ndarray]) -> None:
        """A file appears whole, and again the same if its task is run again."""
        fs, folder = pafs.FileSystem.from_uri(self.folder)
        part = f"{folder}/{name}-{bucket}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as out:
            out.write(np.array([len(a) for a in arrays] + [0] * (8 - len(arrays)), "<i8").tobytes())
            for a in arrays:
                out.write(a.tobytes() + bytes(-a.nbytes % 8))
        fs.move(part, f"{folder}/{name}-{bucket}")

    def read(self, name: str, bucket: int, kinds: tuple[str, ...]) -> list[np.ndarray] | None:
        return _mapped(f"{self.folder}/{name}-{bucket}", kinds)


@lru_cache(256)
def _mapped(uri: str, kinds: tuple[str, ...]) -> list[np.ndarray] | None:
    """The arrays of a file, mapped; nothing where there is no such file."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    if isinstance(fs, pafs.LocalFileSystem):
        data = np.memmap(path, np.uint8, "r")
    else:
        with tempfile.TemporaryFile() as copy, fs.open_input_stream(path) as source:
            while some := source.read(1 << 24):
                copy.write(some)
            copy.flush()
            data = np.memmap(copy, np.uint8, "r")
    out, at = [], 64
    for n, kind in zip(data[:64].view("<i8"), kinds):
        size = int(n) * np.dtype(kind).itemsize
        out.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return out


GRAMS = ("<u8", "u1", "<u8", "<u8")  # hashes, counts up to MANY; hashes and counts of those with more
CONTEXTS = ("<u8", "<u8", "<u4", "<u4", "<u4")  # hashes, total, n-grams of count 1, 2, more
WORDS = ("<u8", "<u8", "<u8")  # hashes, counts, continuation counts


def _gram_arrays(key: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    many = n >= MANY
    return [key, np.minimum(n, MANY).astype("u1"), key[many], n[many]]


def _sums(total: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Per run of counts: their sum, and how many are 1, 2, more."""
    return [np.add.reduceat(x.astype(np.uint64), at) for x in (total, total == 1, total == 2, total > 2)]


def _stats(order: int, n: np.ndarray) -> tuple[int, str, bytes]:
    """order, how many counts are 1, 2, 3, 4, more than 2, and their sum."""
    return 0, "stats", np.array([order, *[(n == k).sum() for k in (1, 2, 3, 4)], (n > 2).sum(), n.sum()], "<i8").tobytes()


def _bucket(table: pa.Table, order: int, store: Store, buckets: int, hot: np.ndarray) -> list[tuple[int, str, bytes]]:
    """Count a bucket's n-grams, write its arrays, and give what the next order needs. Other rows are passed on."""
    rows = list(zip(table["bucket"].to_pylist(), table["kind"].to_pylist(), table["block"].to_pylist()))
    out = [r for r in rows if r[1] in ("stats", "hot")]
    if order == 1:
        return out + _words(rows, store)
    parts = [unpacked(block, order + 1) for _, kind, block in rows if kind == "grams"]
    if not parts:
        return out
    *columns, n = (np.concatenate(c) for c in zip(*parts))
    del parts, rows
    columns, n = summed(columns, n)
    at = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)))
    context = combined([c[at] for c in columns[:-1]])
    sums = _sums(n, at)
    spread = _among(columns[-2][at], hot)
    if spread.any():
        partial = [c[spread] for c in [np.full(len(at), order, np.uint64), context, *sums]]
        out.append((0, "hot", packed(partial)))
    whole = np.flatnonzero(~spread)
    whole = whole[np.argsort(context[whole])]
    bucket = int(bucket_of([c[:1] for c in columns], buckets, hot)[0])
    store.write(f"contexts{order}", bucket, [c[whole].astype(kind) for c, kind in zip([context, *sums], CONTEXTS)])
    store.write(f"grams{order}", bucket, _gram_arrays(combined(columns), n))
    out.append(_stats(order, n))
    lower, n = summed(columns[1:], np.ones(len(n), np.uint64))
    return out + _blocks(lower, n, buckets, hot)


def _words(rows: list, store: Store) -> list[tuple[int, str, bytes]]:
    kept = [(bucket, kind, unpacked(block, 2)) for bucket, kind, block in rows if kind in ("grams", "words")]
    if not kept:
        return []
    key = [np.concatenate([k for _, kind, (k, _) in kept if kind == "words"])]
    n = np.concatenate([n for _, kind, (_, n) in kept if kind == "words"])
    (key,), n = summed(key, n)
    known, before = summed([np.concatenate([k for _, kind, (k, _) in kept if kind == "grams"])], np.concatenate([n for _, kind, (_, n) in kept if kind == "grams"]))
    continued = np.zeros(len(key), np.uint64)
    continued[np.searchsorted(key, known[0])] = before
    store.write("words", kept[0][0], [key, n, continued])
    return [_stats(1, continued)]


@dataclass
class Model:
    """A fitted model: small numbers, and where its arrays lie."""

    store: Store
    order: int
    buckets: int
    hot: np.ndarray  # hashes of the hot words, four a bucket at most
    tokens: int
    kinds: int
    discounts: dict[int, np.ndarray] = field(default_factory=dict)  # per order: for counts 0, 1, 2, more
    rest: float = 1.0  # share of the uniform distribution
    continued: int = 0

    def _lookup(self, name: str, kinds: tuple[str, ...], bucket: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        """Columns behind the keys, zero where there is none."""
        out = [np.zeros(len(key), np.uint64) for _ in kinds[1:]]
        order = np.lexsort((key, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        for i, j in zip(cuts, cuts[1:]):
            here = order[i:j]
            arrays = self.store.read(name, int(bucket[here[0]]), kinds)
            if arrays is None or not len(arrays[0]):
                continue
            at = np.minimum(np.searchsorted(arrays[0], key[here]), len(arrays[0]) - 1)
            hit = arrays[0][at] == key[here]
            for column, values in zip(out, arrays[1:]):
                if len(values) == len(arrays[0]):
                    column[here[hit]] = values[at[hit]]
            if kinds == GRAMS and len(arrays[2]):
                more = here[out[0][here] == MANY]
                out[0][more] = arrays[3][np.searchsorted(arrays[2], key[more])]
        return out

    def _cut(self, order: int, n: np.ndarray) -> np.ndarray:
        n = n.astype(np.float64)
        return np.maximum(n - self.discounts[order][np.minimum(n, 3).astype(int)], 0)

    def judge(self, token: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token its count in the corpus and its probability."""
        word, back = np.unique(token, return_inverse=True)
        count, before = self._lookup("words", WORDS, _range(word, self.buckets), word)
        p = self.rest / (self.kinds + 1) + self._cut(1, before) / max(self.continued, 1)
        p, count = p[back], count[back]
        if not self.tokens:
            return count, p
        for o in range(2, self.order + 1):
            columns = grams(token, begins, o)
            context, back = np.unique(combined(columns[:-1]), return_inverse=True)
            at = _range(context, self.buckets)
            total, *kinds = (a + b for a, b in zip(self._lookup(f"contexts{o}", CONTEXTS, at, context), self._lookup(f"hot{o}", CONTEXTS, at, context)))
            left = sum(d * k for d, k in zip(self.discounts[o][1:], kinds))[back]
            total = total[back].astype(np.float64)
            key, first, back = np.unique(combined(columns), return_index=True, return_inverse=True)
            n = self._lookup(f"grams{o}", GRAMS, bucket_of([c[first] for c in columns], self.buckets, self.hot), key)[0][back]
            p = np.where(total > 0, (self._cut(o, n) + left * p) / np.maximum(total, 1), p)
        return count, p


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What counts of 0, 1, 2 and more lose; half the count where the counts of counts do not tell."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    out = [0.0]
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and y else 0.0
        out.append(d if 0 < d <= k else k / 2)
    return np.array(out)


def _counted(each, order: int):
    """Rows of ``each(columns, n)`` for the n-grams of the texts in the first column, counted over ``HELD`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for b in slices(whole, 0, BATCH_BYTES):
                columns = grams(*tokens(b.column(0)), order)
                held.append(summed(columns, np.ones(len(columns[0]), np.uint64)))
                size += len(held[-1][1])
                if size > HELD:
                    yield each(*summed([np.concatenate(c) for c in zip(*(h[0] for h in held))], np.concatenate([h[1] for h in held])))
                    held, size = [], 0
        if held:
            yield each(*summed([np.concatenate(c) for c in zip(*(h[0] for h in held))], np.concatenate([h[1] for h in held])))

    return run


def fit(texts: DataFrame, order: int = ORDER, bucket: int = BUCKET) -> Model:
    """A model of the column ``text`` of ``texts``; null counts as empty, and every text has an end token."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = texts.sparkSession
    texts = texts.select("text")

    def words(columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[0].view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    counted = texts.mapInArrow(_counted(words, 1), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = written(counted, "words")
    size, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    buckets = max(1, -(-size // bucket))
    store = Store(f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/lm-{uuid.uuid4().hex}")
    if not size:
        return Model(store, order, buckets, np.zeros(0, np.uint64), 0, 0, {o: np.zeros(4) for o in range(1, order + 1)})
    path = spark._jvm.org.apache.hadoop.fs.Path(store.folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    hot = vocabulary.where(F.col("n") > size / (4 * buckets)).select("word").toArrow()["word"].to_numpy()
    hot = np.sort(hot.astype(np.int64).view(np.uint64))

    def as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                (word,), n = summed([b.column(0).to_numpy().view(np.uint64)], b.column(1).to_numpy().astype(np.uint64))
                yield _rows(_blocks([word], n, buckets, hot, "words"))

    def level(o: int):
        return lambda table: pa.Table.from_batches([_rows(_bucket(table, o, store, buckets, hot))])

    chain = texts.mapInArrow(_counted(lambda columns, n: _rows(_blocks(columns, n, buckets, hot)), order), ROWS)
    for o in range(order, 0, -1):
        if o == 1:
            chain = chain.unionByName(vocabulary.mapInArrow(as_blocks, ROWS))
        chain = chain.groupBy("bucket").applyInArrow(level(o), ROWS)
    told = written(chain, "orders")

    def hot_rows(b: pa.RecordBatch) -> pa.RecordBatch:
        columns = [np.concatenate(c).view(np.int64) for c in zip(*(unpacked(x, 6) for x in b.column(0).to_pylist()))]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["order", "key", "total", "one", "two", "more"])

    def keep(table: pa.Table) -> pa.Table:
        at, o = table["bucket"][0].as_py(), table["order"][0].as_py()
        columns = [table[c].to_numpy().view(np.uint64) for c in ("key", "total", "one", "two", "more")]
        order_ = np.argsort(columns[0])
        store.write(f"hot{o}", at, [c[order_].astype(kind) for c, kind in zip(columns, CONTEXTS)])
        return pa.table({"rows": pa.array([len(order_)], pa.int64())})

    if len(hot):
        partial = mapped(told.where("kind = 'hot'").select("block"), hot_rows, "order long, key long, total long, one long, two long, more long")
        sums = partial.groupBy("order", "key").agg(*[F.sum(c).alias(c) for c in ("total", "one", "two", "more")])
        # the bucket of a hash: its upper half as a number from 0 to 1
        at = (F.shiftrightunsigned("key", 32) * F.lit(buckets) / F.lit(2**32)).cast("int")
        sums.withColumn("bucket", at).groupBy("order", "bucket").applyInArrow(keep, "rows long").write.format("noop").mode("overwrite").save()

    model = Model(store, order, buckets, hot, size, kinds)
    sums = np.zeros((order + 1, 6), np.int64)

    def stats_rows(b: pa.RecordBatch) -> pa.RecordBatch:
        columns = np.stack([np.frombuffer(x, "<i8") for x in b.column(0).to_pylist()]).T
        return pa.RecordBatch.from_arrays([*map(pa.array, columns)], [f"x{i}" for i in range(7)])

    told_stats = mapped(told.where("kind = 'stats'").select("block"), stats_rows, ", ".join(f"x{i} long" for i in range(7)))
    for row in told_stats.groupBy("x0").agg(*[F.sum(f"x{i}") for i in range(1, 7)]).collect():
        sums[row[0]] = row[1:]
    for o in range(1, order + 1):
        model.discounts[o] = discounts(*sums[o, :4].tolist())
    one, two, _, _, more, model.continued = sums[1].tolist()
    model.rest = float(model.discounts[1][1:] @ [one, two, more]) / model.continued
    return model


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", may_learn: str = "_rest <> 1", order: int = ORDER, bucket: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row of ``docs``.

    The model learns from rows whose id remainder (crc32 modulo 5, column ``_rest``) meets ``may_learn``; held out are those
    with remainder 1 and those without an id, which are not learnt from. Tokens are the words, A-Z in lower case, and one
    end. ``score`` is the sum of the tokens' log10 probabilities; ``base_score`` that of single words with one half added to
    every count and a kind of token for all unknown ones. A null text is empty and has its end only; repeated ids are rows
    of their own. Where nothing is learnt, every probability is 1. Other columns are ignored.
    """
    rest = id_remainder(doc_id, 5)
    model = fit(docs.withColumn("_rest", rest).where(may_learn).select(F.col(text).alias("text")), order, bucket)
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_tokens", "n_known", "base_score", "score"]

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        m = held.value
        token, begins = tokens(b.column(1))
        count, p = m.judge(token, begins)
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.kinds + 1)))
        size = np.diff(np.append(begins, len(token)))
        sums = [np.add.reduceat(x, begins) for x in (np.ones(len(token), np.int64), (count > 0).astype(np.int64), base, np.log10(p))]
        return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, sums)], ["doc_id", *names])

    found = mapped(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), each,
        "doc_id long, n_tokens long, n_known long, base_score double, score double", text=1, limit=BATCH_BYTES,
    )
    return found.select(
        "doc_id", F.coalesce(id_remainder("doc_id", 5) == 1, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
