"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words, all of them. A passage's features (shares of kinds of bytes,
lengths and repetition of words, hashed pairs of bytes) go through a trained encoder; gated attention
``w . (tanh(V h) * sigmoid(U h))`` weighs the passages, and the weighted mean of their codes is scored. Encoder,
attention and score are learnt together from labels of whole documents, by gradient descent on a bounded sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import filtered, id_remainder, mapped
from stockyard.llm.words import Words, mix

PASSAGE = 64
SAMPLE_ROWS = 8_000  # labelled documents that are learnt from, at most about this many
PAIRS = 32
CODE, GATE = 24, 12
EPOCHS, BAGS, RATE = 25, 64, 0.01
SLICE_BYTES = 1 << 18

# kinds of bytes: lower, upper, digit, space, line end, then marks of their own, other ASCII marks, beyond ASCII
_MARKS = b".,!?|&*#%$@:;<>{}=\"'()-/"
_KIND = np.full(256, 5 + len(_MARKS), np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[32] = 0, 1, 2, 3
_KIND[9:14] = 4
_KIND[list(_MARKS)] = np.arange(5, 5 + len(_MARKS))
_KIND[128:] = 6 + len(_MARKS)
KINDS = 7 + len(_MARKS)
FEATURES = KINDS + PAIRS + 8


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features (passages, FEATURES) of every passage of a batch, and the text each belongs to.

    A text without words has one passage of zeros.
    """
    words = Words(column)
    raw, offsets = words.raw, words.offsets
    n_words = np.diff(words.first)
    counts = np.maximum(1, -(-n_words // PASSAGE))
    owner = np.repeat(np.arange(len(counts)), counts)
    first_passage = np.cumsum(counts) - counts
    place = np.arange(len(owner)) - first_passage[owner]
    n = len(owner)
    # bytes from a passage's first word to the next passage, within the text
    word_at = np.minimum(words.first[owner] + place * PASSAGE, max(len(words.start) - 1, 0))
    begin = np.where(place == 0, offsets[owner], words.start[word_at] if len(words.start) else 0)
    of_byte = np.repeat(np.arange(n), np.diff(np.append(begin, len(raw))))
    size = np.bincount(of_byte, minlength=n)
    out = np.zeros((n, FEATURES), np.float32)
    kinds = np.bincount(of_byte * KINDS + _KIND[raw], minlength=n * KINDS).reshape(n, KINDS)
    out[:, :KINDS] = np.sqrt(kinds / np.maximum(size, 1)[:, None])
    if len(raw) > 1:
        pair = mix(raw[:-1].astype(np.uint64) << np.uint64(8) | raw[1:])
        hashed = np.bincount(of_byte[:-1] * PAIRS + (pair % np.uint64(PAIRS)).astype(np.int64), minlength=n * PAIRS).reshape(n, PAIRS)
        out[:, KINDS : KINDS + PAIRS] = np.sqrt(hashed / np.maximum(size, 1)[:, None])
    if len(words.start):
        of_word = first_passage[words.doc] + (np.arange(len(words.doc)) - words.first[words.doc]) // PASSAGE
        held = np.maximum(np.bincount(of_word, minlength=n), 1)
        length = (words.end - words.start).astype(float)
        mean = np.bincount(of_word, length, n) / held
        again = np.append(False, (words.hash[1:] == words.hash[:-1]) & (of_word[1:] == of_word[:-1]))
        capital = (raw[words.start] >= 65) & (raw[words.start] <= 90)
        closed = _KIND[raw[words.end - 1]] >= 5
        marked = closed & (raw[words.end - 1] < 128) & ~np.isin(raw[words.end - 1], np.frombuffer(b".,", np.uint8))
        distinct = _distinct(of_word, words.hash)
        extra = [
            np.log1p(np.bincount(of_word, minlength=n)), mean, np.sqrt(np.maximum(np.bincount(of_word, length**2, n) / held - mean**2, 0)),
            np.bincount(distinct, minlength=n) / held, np.bincount(of_word, again, n) / held, np.bincount(of_word, capital, n) / held,
            np.bincount(of_word, marked, n) / held, np.bincount(of_word, closed, n) / held,
        ]
        out[:, KINDS + PAIRS :] = np.stack(extra, 1)
    return out, owner


def _distinct(of_word: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The passage of every distinct word of a passage."""
    key = mix(hashes + mix(of_word.astype(np.uint64)))
    _, at = np.unique(key, return_index=True)
    return of_word[at]


class Net:
    """Encoder, gated attention and score; ``bag`` gives each row's bag, in order from 0."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        shape = {"we": (len(mean), CODE), "be": (CODE,), "v": (CODE, GATE), "u": (CODE, GATE), "w": (GATE,), "c": (CODE,), "b": (1,)}
        self.p = {k: rng.normal(size=s) / np.sqrt(s[0]) if len(s) > 1 or k == "w" else np.zeros(s) for k, s in shape.items()}
        self.p["c"] = rng.normal(size=CODE) / np.sqrt(CODE)

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict:
        p = self.p
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(z @ p["we"] + p["be"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = np.clip((t * g) @ p["w"], -20, 20)
        a = np.exp(e)
        a /= np.bincount(bag, a, bags)[bag]
        first = np.searchsorted(bag, np.arange(bags))
        pooled = np.add.reduceat(a[:, None] * h, first, axis=0)
        logit = pooled @ p["c"] + p["b"][0]
        return {"z": z, "h": h, "t": t, "g": g, "a": a, "pooled": pooled, "y": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict:
        p, n = self.p, len(y)
        s = self.forward(x, bag, n)
        d = (s["y"] - y) / n
        out = {"c": s["pooled"].T @ d, "b": np.array([d.sum()])}
        dm = np.outer(d, p["c"])[bag]
        dh = s["a"][:, None] * dm
        da = (dm * s["h"]).sum(1)
        de = s["a"] * (da - np.bincount(bag, s["a"] * da, n)[bag])
        out["w"] = (s["t"] * s["g"]).T @ de
        dtg = np.outer(de, p["w"])
        dt, dg = dtg * s["g"] * (1 - s["t"] ** 2), dtg * s["t"] * s["g"] * (1 - s["g"])
        out["v"], out["u"] = s["h"].T @ dt, s["h"].T @ dg
        dz = (dh + dt @ p["v"].T + dg @ p["u"].T) * (1 - s["h"] ** 2)
        out["we"], out["be"] = s["z"].T @ dz, dz.sum(0)
        return out


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, seed: int = 5) -> Net:
    """Adam on batches of bags; rows of one bag stand together."""
    mean = x.mean(0, dtype=np.float64)
    net = Net(mean, np.sqrt(np.maximum(np.square(x).mean(0, dtype=np.float64) - mean**2, 0)) + 1e-3)
    rng = np.random.default_rng(seed)
    first = np.searchsorted(bag, np.arange(len(y) + 1))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, len(y), BAGS):
            some = order[at : at + BAGS]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            own = np.repeat(np.arange(len(some)), first[some + 1] - first[some])
            step += 1
            for k, g in net.gradients(x[rows], own, y[some]).items():
                g = g + 1e-4 * net.p[k]
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, may_learn: str, sample: int = SAMPLE_ROWS) -> Net | float:
    """A trained net, or the one score there is to give where the labelled rows are of one class or there are none."""
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), id_remainder(doc_id, 3).alias("_rest")).where("_id is not null")
    told = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("label"))
    known = told.withColumn("_rest", id_remainder("_id", 3)).where(may_learn)
    most = known.count()
    if most > sample:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * sample / most))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        x, owner = passages(b.column(0))
        lengths = np.bincount(owner, minlength=b.num_rows)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths * FEATURES)]).astype(np.int32))
        return pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["id", "label", "x"])

    rows = texts.drop("_rest").join(known.drop("_rest"), "_id").select("text", "_id", "label")
    got = mapped(rows, each, "id long, label int, x array<float>", text=0).toArrow().sort_by("id").combine_chunks()
    y = got["label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    lists = got["x"].combine_chunks()
    x = lists.flatten().to_numpy().reshape(-1, FEATURES)
    bag = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()) // FEATURES)
    net = train(x, bag, y)
    del got, lists, x
    pa.default_memory_pool().release_unused()
    return net


def judged(net: Net | float, texts: pa.Array) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(texts), net)
    x, owner = passages(texts)
    return net.forward(x, owner, len(texts))["y"]


def accepted(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", may_learn: str = "_rest <> 1",
) -> DataFrame:
    """The rows of ``docs``, with all columns, that score one half or more; see ``scores``."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text, label, may_learn))
    return filtered(docs, text, lambda texts: judged(held.value, texts) >= 0.5)


def scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", may_learn: str = "_rest <> 1",
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted, for every row of ``docs``.

    Labels are learnt from rows whose id remainder (crc32 modulo 3) is not 1. A text that is null, empty or without
    words is one passage of zeros and gets the score of that. Repeated ids get a row each; a document labelled twice
    counts as good if no label says otherwise. A null id is scored and counts as held out. Where all labels are alike
    that label is the score, without labels one half. Other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text, label, may_learn))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(judged(held.value, b.column(1)))], ["doc_id", "score"])

    found = mapped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), each, "doc_id long, score double", text=1)
    return found.select(
        "doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
