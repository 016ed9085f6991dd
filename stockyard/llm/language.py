"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds labelled text of at most ``LEARN_LETTERS`` letters. A text is parsed
greedily into the longest phrases that occur in a language's text; a foreign text needs more phrases. The language
with the fewest phrases per letter wins, ties going to the first in alphabetical order.

Every letter of the learnt texts is a kind of its own; letters that no learnt text has share one. All automata stand in
one table of transitions (state, letter), and many windows of texts walk it side by side, one letter a step. Windows of ``WINDOW`` letters cover a text from end to end; each begins a phrase of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockyard.llm.common import id_remainder, mapped

LEARN_LETTERS = 40_000  # per language, at most
LEARN_TEXTS = 200  # per language, at most
PASSAGE = LEARN_LETTERS // 4  # of one text, at most
WINDOW = 512
KINDS = 62  # of the most frequent letters' kinds, and of gaps, transitions stand in a full table; of others in a sparse one
SHARPNESS = 30.0


class Automaton:
    """Suffix automaton of a sequence of small numbers; only its transitions are kept."""

    def __init__(self, codes: np.ndarray):
        link, length, step = [-1], [0], [{}]
        last = 0
        for c in codes.tolist():
            state = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and c not in step[at]:
                step[at][c] = state
                at = link[at]
            if at >= 0:
                to = step[at][c]
                if length[to] == length[at] + 1:
                    link[state] = to
                else:  # a copy for the shorter contexts
                    copy = len(step)
                    step.append(dict(step[to]))
                    link.append(link[to])
                    length.append(length[at] + 1)
                    while at >= 0 and step[at].get(c) == to:
                        step[at][c] = copy
                        at = link[at]
                    link[to] = link[state] = copy
            last = state
        self.step = step

    def table(self, kinds: int) -> tuple[np.ndarray, np.ndarray]:
        """Transitions by state and kind below ``kinds``, and rows (state, kind, to) for the other kinds."""
        out = np.zeros((len(self.step), kinds), np.int32)  # 0, the start, is where no phrase goes on
        rest = []
        for state, moves in enumerate(self.step):
            for c, to in moves.items():
                if c < kinds:
                    out[state, c] = to
                else:
                    rest.append((state, c, to))
        return out, np.array(rest, np.int64).reshape(-1, 3)


def points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, and where each begins, with the end."""
    texts = [t.lower() for t in column.fill_null("").to_pylist()]
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


class Alphabet:
    """Kinds of code points: 0 a gap, 1 any other letter, from 2 the letters told apart, in the order given."""

    def __init__(self, letters: np.ndarray):
        order = np.argsort(letters)
        self.size = 2 + len(letters)
        self.known = letters[order]
        self.number = (2 + order).astype(np.min_scalar_type(self.size))
        self.low = np.zeros(0x3000, self.number.dtype)
        self.low[[c for c in range(0x3000) if chr(c).isalpha()]] = 1
        here = self.known < 0x3000
        self.low[self.known[here]] = self.number[here]

    def kinds(self, flat: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(flat, 0x2FFF)]
        high = np.flatnonzero(flat >= 0x3000)
        if len(high):
            values, back = np.unique(flat[high], return_inverse=True)
            kind = np.array([chr(c).isalpha() for c in values], self.low.dtype)
            at = np.minimum(np.searchsorted(self.known, values), max(len(self.known) - 1, 0))
            if len(self.known):
                kind = np.where(self.known[at] == values, self.number[at], kind)
            out[high] = kind[back]
        return out

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kinds with one gap before each word, and the new offsets; texts without letters become empty."""
        kinds = self.kinds(flat)
        letter = kinds > 0
        first = letter.copy()
        if len(letter):
            first[1:] &= ~letter[:-1]
            inner = offsets[:-1][offsets[:-1] < len(letter)]
            first[inner] = letter[inner]
        at = np.flatnonzero(letter)
        starts = np.flatnonzero(first)
        out = np.insert(kinds[at], np.searchsorted(at, starts), 0)
        return out, np.searchsorted(at, offsets) + np.searchsorted(starts, offsets)


class Model:
    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        flats = {k: points(pa.array(v, pa.string())) for k, v in texts.items()}
        every = np.concatenate([f for f, _ in flats.values()]) if flats else np.zeros(0, np.uint32)
        letters, n = np.unique(every, return_counts=True)
        known = np.array([chr(c).isalpha() for c in letters], bool)
        letters, n = letters[known], n[known]
        self.alphabet = Alphabet(letters[np.lexsort((letters, -n))])
        tables, rare = [], [np.zeros((0, 3), np.int64)]
        self.start = []
        for k in self.languages:
            codes, _ = self.alphabet.encode(*flats[k])
            table, rest = Automaton(codes).table(KINDS)
            base = sum(len(t) for t in tables)
            rare.append(rest + [base, 0, base])
            self.start.append(base)
            tables.append(np.where(table > 0, table + base, 0).astype(np.int32))
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.start = np.array(self.start, np.int64)
        rest = np.concatenate(rare)
        keys = rest[:, 0] * self.alphabet.size + rest[:, 1]
        order = np.argsort(keys)
        self.rare = np.append(keys[order], np.iinfo(np.int64).max)
        self.rare_to = np.append(rest[order, 2], 0).astype(np.int32)

    def moves(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Where each language's states (languages, windows) go with the windows' next letters; 0 is nowhere."""
        to = self.table[state * KINDS + np.minimum(code, KINDS - 1)]
        rare = np.flatnonzero(code >= KINDS)
        if len(rare):
            key = np.broadcast_to(state, to.shape)[:, rare] * self.alphabet.size + code[rare]
            at = np.searchsorted(self.rare, key)
            to[:, rare] = np.where(self.rare[at] == key, self.rare_to[at], 0)
        return to

    def phrases(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, languages): phrases that each text is parsed into."""
        sizes = np.diff(offsets)
        windows = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(sizes)), windows)
        begin = offsets[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW
        length = np.minimum(WINDOW, offsets[owner + 1] - begin)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        root = self.start[:, None]
        state = np.broadcast_to(root, (len(root), len(owner))).copy()
        count = np.ones((len(root), len(owner)), np.int32)
        alive = np.searchsorted(-length, -np.arange(WINDOW), side="left")
        for t in range(int(length[0]) if len(length) else 0):
            m = alive[t]
            code = codes[begin[:m] + t].astype(np.int64)
            to = self.moves(state[:, :m], code)
            ended = to == 0
            if t:
                count[:, :m] += ended | (state[:, :m] == root)
            # a new phrase begins with this letter; a letter that the language never has is a phrase of its own, and
            # leaves the start behind it
            again = self.moves(root, code)
            state[:, :m] = np.where(ended, np.where(again == 0, root, again), to)
        out = np.zeros((len(sizes), len(root)))
        for i in range(len(root)):
            out[:, i] = np.bincount(owner, count[i], len(sizes))
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without letters, or where nothing could be learnt."""
        codes, offsets = self.alphabet.encode(*points(column))
        sizes = np.diff(offsets)
        if not self.languages:
            return ["und"] * len(sizes), np.zeros(len(sizes))
        rate = self.phrases(codes, offsets) / np.maximum(sizes, 1)[:, None]
        best = rate.argmin(1)
        weight = np.exp(-SHARPNESS * (rate - rate.min(1, keepdims=True)))
        score = np.where(sizes > 0, 1 / weight.sum(1), 0.0)
        return [self.languages[b] if n else "und" for b, n in zip(best, sizes)], score


def fit(docs: DataFrame, doc_id: str, text: str, lang: str, may_learn: str) -> Model:
    """Automata of the first ``LEARN_TEXTS`` texts of each language in the order of a hash, up to the limit; of a text longer
    than ``PASSAGE`` its beginning, so that no language is left out for the length of its texts."""
    own = Window.partitionBy("lang").orderBy("h", "id", "text")
    some = (
        docs.select(F.col(doc_id).alias("id"), F.substring(text, 1, PASSAGE).alias("text"), F.col(lang).alias("lang"), id_remainder(doc_id, 3).alias("_rest"))
        .where("lang is not null and text is not null").where(may_learn)
        .withColumn("h", F.xxhash64("id"))
        .withColumn("n", F.row_number().over(own)).where(F.col("n") <= LEARN_TEXTS).select("lang", "n", "text")
    )
    texts: dict[str, list[str]] = {}
    room: dict[str, int] = {}
    for row in sorted(some.collect(), key=lambda r: (r.lang, r.n)):
        left = room.get(row.lang, LEARN_LETTERS)
        if len(row.text) <= left:
            texts.setdefault(row.lang, []).append(row.text)
            room[row.lang] = left - len(row.text)
    return Model(texts)


def predictions(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", may_learn: str = "_rest <> 1",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1), for every row of ``docs``.

    Learnt from rows whose id remainder (crc32 modulo 3) is not 1 and whose ``lang`` is not null; of a text its
    first ``PASSAGE`` characters are learnt from at most, and a language whose rows have no text is not learnt. A null text, or one without a
    letter, is ``und`` with score 0. Repeated ids get a row each; a null id counts as held out. Other columns are
    ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, doc_id, text, lang, may_learn))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found, score = held.value.predict(b.column(1))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = mapped(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), each, "doc_id long, lang_pred string, score double", text=1)
    return found.select("doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")
