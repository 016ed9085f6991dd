"""Toxicity: two Kneser-Ney models of words, one per class, compared by length-normalised log-likelihood.

The models run over the letters of a word with its boundaries (bytes of lower-case text, in 126 classes). Orders 4, 6
and 8 have counts of their class; they back off to one distribution for both classes, the order-3 continuation counts of
all documents, so that an expression which is rare in a class is judged by what the corpus makes of it. Each n-gram
has counts of its own: seven bits a letter make its key, 56 bits at most, and the model grows with the number of
different n-grams in the labelled texts.

A text's evidence is the log-likelihood ratio per letter of the whole text, the largest one of a passage of
``PASSAGE`` words, the largest of a single word, and what its words' ratios exceed ``MARGIN`` by, per word: an ordinary
word has a ratio a little below zero, and a few toxic ones would vanish in the mean of a long text. Their weights are a
logistic fit on labelled rows that the counts have not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import filtered, id_remainder, mapped, perhaps_among, slices, text_bytes
from stockyard.llm.fitting import logistic
from stockyard.llm.words import mix, stream

ORDERS = (4, 6, 8)
DISCOUNT = 0.75
PASSAGE = 32
MARGIN = 2.0
LEAST_WORDS = 16
LEAST_LETTERS = 100  # a shorter text or passage is not taken for more evidence than this many letters allow
EVIDENCE = ("whole", "passage", "word", "excess")
CALIBRATION_ROWS = 6_000
BATCH_BYTES = 1 << 19
HELD_GRAMS = 1 << 20  # a task counts about this many different n-grams before it sends them on

_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[0x80:0xC0] = np.arange(27, 91)
_CODE[0xC2:0xE0] = np.arange(91, 121)
_CODE[0xE0:0xF0] = 121 + np.arange(16) % 4
_CODE[0xF0:0xF5] = 125
LETTERS = 128
_LETTER, _PLACE = stream(41, LETTERS), stream(42, 256) | np.uint64(1)


class Letters:
    """All words of a batch on end, one separator (0) between them: codes, distance from the word's start, owners."""

    def __init__(self, column: pa.Array):
        raw, offsets = text_bytes(column)
        codes = _CODE[raw]
        if len(raw) > 1:  # capitals of the Latin-1 letters, and their small forms
            second = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0x9F)) + 1
            codes[second] = _CODE[raw[second] + 0x20]
        at = offsets[:-1]
        codes = np.insert(codes, at, 0)
        doc = np.repeat(np.arange(len(column)), np.diff(offsets) + 1)
        keep = codes > 0
        keep[1:] |= codes[:-1] > 0
        keep[:1] = True
        self._place(np.append(codes[keep], 0).astype(np.int64))
        owner = np.append(doc[keep], len(column))[: max(len(self.codes), 1)]
        self.word_doc = owner[self.begins] if len(self.begins) else np.zeros(0, np.int64)
        self.rows = len(column)

    def _place(self, codes: np.ndarray) -> None:
        self.codes = codes[:-1] if len(codes) > 1 and codes[-2] == 0 else codes
        n = len(self.codes)
        zeros = np.flatnonzero(self.codes == 0)
        self.ends = zeros[1:]  # each word ends at a separator and begins behind the one before
        self.begins = zeros[:-1] + 1
        self.length = self.ends - self.begins + 1
        self.dist = np.arange(n) - np.repeat(zeros, np.diff(np.append(zeros, n)))
        self.dist[self.ends] = self.length

    def different(self) -> tuple[Letters, np.ndarray]:
        """The different words, without owners, and which of them each word is; words are told apart by 64-bit hashes."""
        most = int(self.length.max())
        place = _PLACE if most < len(_PLACE) else stream(42, most + 1) | np.uint64(1)
        value = _LETTER[self.codes[1:]] * place[self.dist[1:]]
        _, first, which = np.unique(mix(np.add.reduceat(value, self.begins - 1)), return_index=True, return_inverse=True)
        length = self.length[first]
        end = np.cumsum(length)
        at = np.repeat(self.begins[first] - (end - length), length) + np.arange(end[-1])
        own = object.__new__(Letters)
        own._place(np.concatenate([np.zeros(1, np.int64), self.codes[at]]))
        return own, which

    def keys(self, order: int) -> np.ndarray:
        """The last ``order`` codes at each place as one number; places too close to the text's start are wrong."""
        key = self.codes.copy()
        for j in range(1, order):
            key[j:] |= self.codes[:-j] << (7 * j)
        return key

    def triples(self) -> np.ndarray:
        key = self.keys(3)
        return np.where(self.dist < 2, key & 127, key)


def grams(letters: Letters, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Places with a full n-gram of this order, and the n-grams; one's context is all but its last seven bits."""
    at = np.flatnonzero(letters.dist >= order - 1)
    return at, letters.keys(order)[at]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sum of ``n`` for each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[new], np.add.reduceat(n, new) if len(new) else n


def class_counts(labelled: DataFrame) -> DataFrame:
    """order, bucket, toxic, plain: how often each n-gram (its letters' codes as one number) occurs in the texts
    (text, label) of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for whole in batches:
            for b in slices(whole, 0, BATCH_BYTES):
                label = b.column(1).to_numpy(zero_copy_only=False)
                letters = Letters(b.column(0))
                word = np.repeat(label[letters.word_doc], letters.length)
                side = np.zeros(len(letters.codes), np.int64)
                side[1 : 1 + len(word)] = word
                for i, o in enumerate(ORDERS):
                    at, key = grams(letters, o)
                    new, n = np.unique((key | i << 56) << 1 | side[at], return_counts=True)
                    keys, counts = np.append(keys, new), np.append(counts, n)
                keys, counts = _summed(keys, counts)
                if len(keys) > HELD_GRAMS:
                    yield rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        yield rows(keys, counts)

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        toxic = keys & 1
        return pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(n * toxic), pa.array(n * (1 - toxic))], ["gram", "toxic", "plain"])

    parts = labelled.select("text", "label").mapInArrow(run, "gram long, toxic long, plain long")
    summed = parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    order = F.element_at(F.array(*map(F.lit, ORDERS)), (F.shiftright("gram", 56) + 1).cast("int"))
    return summed.select(order.alias("order"), F.expr(f"gram & {(1 << 56) - 1}L").alias("bucket"), "toxic", "plain")


def continuations(docs: DataFrame) -> DataFrame:
    """triple, before: in how many distinct contexts of one more letter each triple of letters occurs, in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for whole in batches:
            for b in slices(whole, 0, BATCH_BYTES):
                letters = Letters(b.column(0))
                before = np.zeros(len(letters.codes), np.int64)
                before[3:] = letters.codes[:-3]
                before[letters.dist < 3] = 0
                seen = np.union1d(seen, np.unique((before << 21 | letters.triples())[1:]))
        yield pa.RecordBatch.from_arrays([pa.array(seen)], ["gram"])

    return (
        docs.select("text").mapInArrow(run, "gram long").distinct()
        .groupBy((F.col("gram") % (1 << 21)).cast("int").alias("triple")).agg(F.count("*").alias("before"))
    )


class Places:
    """Finds whole keys among ``keys``, which are all different, through a table as long as there are keys."""

    def __init__(self, keys: np.ndarray):
        own = mix(keys.view(np.uint64))  # a bijection: equal values are equal keys
        self.order = np.argsort(own)
        self.own = own[self.order]
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.own, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int64)
        self.first = np.append(self.first, len(keys))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where in ``order`` each key stands, -1 for a key that is not there."""
        own = mix(keys.view(np.uint64))
        part = (own >> self.shift).astype(np.int64)
        at, end = self.first[part], self.first[part + 1]
        out = np.full(len(keys), -1, np.int64)
        live = np.flatnonzero(at < end)
        at = at[live]
        while len(live):
            here, want = self.own[at], own[live]
            hit = here == want
            out[live[hit]] = at[hit]
            on = (here < want) & (at + 1 < end[live])
            live, at = live[on], at[on] + 1
        return out


class Model:
    """Of both classes the discounted probability of each n-gram and the backoff weight of each context.

    The last column of either is what an n-gram or a context has that the labelled texts do not.
    """

    def __init__(self, counts: pa.Table, shared: pa.Table):
        base = np.zeros(LETTERS**3)
        base[shared["triple"].to_numpy()] = shared["before"].to_numpy()
        triples = base.reshape(LETTERS, LETTERS, LETTERS)
        pairs = (triples > 0).sum(0).astype(float)
        single = (pairs > 0).sum(0).astype(float)
        p = (single + 1) / (single.sum() + LETTERS)
        p = self._interpolate(pairs, p[None, :])
        self.base = self._interpolate(triples, p[None, :, :]).astype(np.float32).ravel()
        self.grams, self.contexts, self.alpha, self.weight = {}, {}, {}, {}
        order = counts["order"].to_numpy()
        for o in ORDERS:
            here = np.flatnonzero(order == o)
            key = counts["bucket"].to_numpy()[here]
            here = here[np.argsort(key)]
            key.sort()
            new = np.append(True, key[1:] >> 7 != key[:-1] >> 7)[: len(key)]  # n-grams of one context follow each other
            cut, context = np.flatnonzero(new), np.cumsum(new) - 1
            grams, contexts = Places(key), Places(key[cut] >> 7)
            alpha, weight = np.zeros((2, len(key) + 1), np.float32), np.ones((2, len(cut) + 1), np.float32)
            for side, name in enumerate(("plain", "toxic")):
                n = counts[name].to_numpy()[here].astype(np.float64)
                total = np.bincount(context, n, len(cut))
                kinds = np.bincount(context[n > 0], minlength=len(cut))
                alpha[side, :-1] = (np.maximum(n - DISCOUNT, 0) / np.maximum(total[context], 1))[grams.order]
                weight[side, :-1] = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1)[contexts.order]
            grams.order = contexts.order = None
            self.grams[o], self.contexts[o], self.alpha[o], self.weight[o] = grams, contexts, alpha, weight

    def __getstate__(self) -> dict:
        """The base packed, in half precision: the model goes to every executor."""
        return vars(self) | {"base": zlib.compress(self.base.astype(np.float16).tobytes(), 1)}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        least = np.float32(6e-8)  # half precision knows no smaller number, and a probability is never zero
        self.base = np.maximum(np.frombuffer(zlib.decompress(state["base"]), np.float16).astype(np.float32), least)

    @staticmethod
    def _interpolate(n: np.ndarray, lower: np.ndarray) -> np.ndarray:
        total, kinds = n.sum(-1, keepdims=True), (n > 0).sum(-1, keepdims=True)
        known = np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1) + DISCOUNT * kinds / np.maximum(total, 1) * lower
        return np.where(total > 0, known, np.broadcast_to(lower, n.shape))

    def word_ratios(self, letters: Letters) -> np.ndarray:
        """Log-likelihood under the toxic model less that under the plain one, per word; it hangs on the word alone, so
        that each different word of a batch is looked up once."""
        if not len(letters.begins):
            return np.zeros(0)
        letters, which = letters.different()
        p = np.stack([self.base[letters.triples()]] * 2)
        for o in ORDERS:
            at, key = grams(letters, o)
            gram, context = self.grams[o].find(key), self.contexts[o].find(key >> 7)
            for side in (0, 1):
                p[side, at] = self.alpha[o][side, gram] + self.weight[o][side, context] * p[side, at]
        ratio = np.log(p[1]) - np.log(p[0])
        return np.add.reduceat(ratio[1:], letters.begins - 1)[which]

    def evidence(self, column: pa.Array) -> np.ndarray:
        """(texts, 4): ratio per letter of the text, largest of a passage, largest of a word, excess per word (its root)."""
        letters = Letters(column)
        ratios = self.word_ratios(letters)
        out = np.zeros((letters.rows, 4))
        if not len(ratios):
            return out
        doc = letters.word_doc
        total = np.bincount(doc, ratios, letters.rows)
        size = np.bincount(doc, letters.length, letters.rows)
        out[:, 0] = total / np.maximum(size, LEAST_LETTERS)
        first = np.searchsorted(doc, np.arange(letters.rows))
        new = (np.arange(len(doc)) - first[doc]) % PASSAGE == 0
        cut = np.flatnonzero(new)
        passage = np.add.reduceat(ratios, cut) / np.maximum(np.add.reduceat(letters.length, cut), LEAST_LETTERS)
        out[:, 1] = -np.inf
        np.maximum.at(out[:, 1], doc[cut], passage)
        out[:, 2] = -np.inf
        np.maximum.at(out[:, 2], doc, ratios)
        excess = np.bincount(doc, np.maximum(ratios - MARGIN, 0), letters.rows)
        out[:, 3] = np.sqrt(excess / np.maximum(np.bincount(doc, minlength=letters.rows), LEAST_WORDS))
        out[~np.isfinite(out)] = 0
        return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, may_learn: str) -> tuple[Model, np.ndarray]:
    """The model and the weights of its evidence, from labelled rows that meet ``may_learn`` over the column _rest.

    Of these rows, those with an id remainder of 4 (of 5) calibrate, the others are counted. Without labelled rows of
    both classes all evidence is zero and every score is one half or less.
    """
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), id_remainder(doc_id, 5).alias("_rest")).where("text is not null")
    told = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("label"))
    keys = labels.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("_key"))
    few = perhaps_among(texts.where(may_learn), "_id", keys)
    labelled = few.hint("merge").join(told, "_id")  # the labels grow with the documents
    counts = class_counts(labelled.where("_rest <> 4")).toArrow()
    model = Model(counts, continuations(docs.select(F.col(text).alias("text"))).toArrow())
    del counts
    pa.default_memory_pool().release_unused()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, held.value.evidence(b.column(0)).T), b.column(1)], [*EVIDENCE, "label"])

    rows = labelled.where("_rest = 4")
    most = rows.count()
    if most > CALIBRATION_ROWS:
        rows = rows.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * CALIBRATION_ROWS / most))
    known = mapped(rows.select("text", "label"), each, ", ".join(f"{c} double" for c in EVIDENCE) + ", label int", text=0).toArrow()
    held.destroy()
    x = np.stack([known[c].to_numpy() for c in EVIDENCE], 1)
    return model, logistic(x, known["label"].to_numpy())


def judged(model: Model, weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    x = model.evidence(texts)
    return 1 / (1 + np.exp(-np.clip(x @ weights[1:] + weights[0], -50, 50)))


def accepted(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", may_learn: str = "_rest <> 0",
) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below one half; see ``scores``."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text, label, may_learn))
    return filtered(docs, text, lambda texts: judged(*held.value, texts) < 0.5)


def scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", may_learn: str = "_rest <> 0",
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted, for every row of ``docs``.

    Labels are learnt from rows whose id remainder (crc32 modulo 5) is not 0. A text that is null, empty or without
    letters has no evidence and gets the score of that. Repeated ids get a row each; a document labelled twice counts
    as toxic if one label says so. An id that is null is scored and counts as held out. Other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text, label, may_learn))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(judged(*held.value, b.column(1)))], ["doc_id", "score"])

    found = mapped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), each, "doc_id long, score double", text=1)
    return found.select(
        "doc_id", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
