"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each partition.

Encoding. A text is split by a pattern; its matches ("words") are encoded each by itself. In a task, new words become
rows (word, position, token), at first one per byte. In each round of a recursive query the rows of neighbouring tokens
join the merge table, and it contracts each word's leftmost pair of least rank, until no word has a pair left. Decoding joins ids with the
vocabulary and aggregates their bytes in order.

Words repeat, so each worker keeps the last ones with their ids and decoded bytes, in two generations of bounded size.
Single spaces end a word wherever no other white space stands before them, so texts are cut there and whole cuts
looked up; the pattern only runs on cuts that are new.

Long words go a round at a time through a table instead of the recursive query, whose rounds all stay in memory. A
round contracts all occurrences of the least pair from the left, unless its token could form a pair of lower rank.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import mapped

KEPT_WORDS, KEPT_CUTS = 250_000, 150_000
LONG = 64
BATCH_WORDS = 60_000
SLICE_BYTES = 1 << 23  # texts are taken together, as a query costs less for many words
MEMORY = "400MB"

ENCODE = """
with recursive steps(word, step, toks) as (
    select word, 0, list(tok order by pos) from start group by word
    union all (
        with pairs as (
            select word, unnest(range(1, len(toks))) as pos, unnest(toks[:-2]) as l, unnest(toks[2:]) as r from steps where len(toks) > 1
        ),
        least as (
            select word, min(merged::bigint * 4294967296 + pos) as least from pairs p join merges m on m.l = p.l and m.r = p.r group by word
        )
        select s.word, s.step + 1, list_concat(
            list_append(s.toks[: (least & 4294967295) - 1], (least >> 32)::int), s.toks[(least & 4294967295) + 2 :])
        from steps s join least on s.word = least.word
    )
)
select word, arg_max(toks, step) as toks from steps group by word
"""

ROUND = """
create or replace temp table after as
with numbered as (select word, pos, tok, row_number() over (partition by word order by pos) as n from long),
pairs as (select *, lead(tok) over w as following from numbered window w as (partition by word order by pos)),
ranked as (select p.*, m.merged, m.lower from pairs p left join merges m on m.l = p.tok and m.r = p.following),
least as (select word, min(merged) as merged, min(n) filter (lower) as first from (
    select *, merged = min(merged) over (partition by word) as is_least from ranked where merged is not null) where is_least group by word),
hits as (select r.word, r.n, r.n - row_number() over (partition by r.word order by r.n) as run
         from ranked r join least b on b.word = r.word and b.merged = r.merged and (b.first is null or b.first = r.n)),
taken as (select word, n from (select *, row_number() over (partition by word, run order by n) as k from hits) where k % 2 = 1)
select r.word, r.pos, coalesce(case when t.n is not null then r.merged end, r.tok) as tok
from ranked r left join taken t on t.word = r.word and t.n = r.n left join taken b on b.word = r.word and b.n = r.n - 1
where b.n is null
"""

LISTED = "select word, list(tok order by pos) as toks from {} group by word"

PARTS = """
create or replace temp table parts as
select word, pos, hex from (select word, unnest(range(len(toks))) as pos, unnest(toks) as tok from found) join vocabulary using (tok)
"""

TOLD = """
with told as (select word, string_agg(hex, '' order by pos) as hex from parts group by word)
select word, len(toks) as n, array_to_string(toks, ',') as ids, hex from found join told using (word)
"""


class Generations:
    """A map of the last entries: when the young half is full it becomes the old half, and that one is forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def joined(parts: list[tuple[str, int, bytes]]) -> tuple[str, int, bytes]:
    """Parts of a text as one: ids with commas between, their number, decoded bytes."""
    if not parts:
        return "", 0, b""
    ids, counts, data = zip(*parts)
    return ",".join(ids), sum(counts), b"".join(data)


class Codec:
    """A vocabulary in DuckDB tables; ``ranks`` maps token bytes to ids, lower ids merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb

        self.pattern = regex.compile(pattern)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        lower = {part for l, r, m in zip(left, right, merged) for part in (l, r) if m <= part}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        table = pa.table({
            "l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "merged": pa.array(merged, pa.int32()),
            "lower": pa.array([m in lower for m in merged]),
        })
        self._load("merges", table)
        self._load("vocabulary", pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.words = Generations(KEPT_WORDS)
        self.cuts = Generations(KEPT_CUTS)

    def _load(self, name: str, table: pa.Table) -> None:
        self.con.register("given", table)
        self.con.execute(f"create or replace temp table {name} as select * from given")
        self.con.unregister("given")

    def _rows(self, words: list[bytes], numbers: list[int]) -> pa.Table:
        sizes = np.array([len(w) for w in words], np.int64)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pa.table({
            "word": pa.array(np.repeat(np.array(numbers, np.int32), sizes)), "pos": pa.array(place.astype(np.int32)),
            "tok": pa.array(self.bytes[np.frombuffer(b"".join(words), np.uint8)]),
        })

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, tuple[str, int, bytes]]]:
        """Each word with its ids (decimal, comma between), their number, and the bytes they decode to."""
        data = [w.encode() for w in words]
        short = [i for i, w in enumerate(data) if len(w) <= LONG]
        long = [i for i, w in enumerate(data) if len(w) > LONG]
        for at in range(0, len(short), BATCH_WORDS):
            some = short[at : at + BATCH_WORDS]
            self._load("start", self._rows([data[i] for i in some], some))
            self.con.execute(f"create or replace temp table found as {ENCODE}")
            yield from self._told(words)
        for i in long:
            self._load("long", self._rows([data[i]], [i]))
            size = None
            while size != (size := self.con.execute("select count(*) from long").fetchall()[0][0]):
                self.con.execute(ROUND)
                self.con.execute("create or replace temp table long as select * from after")
            self.con.execute(f"create or replace temp table found as {LISTED.format('long')}")
            yield from self._told(words)

    def _told(self, words: list[str]) -> Iterator[tuple[str, tuple[str, int, bytes]]]:
        self.con.execute(PARTS)
        for word, n, ids, text in self.con.execute(TOLD).fetchall():
            yield words[word], (ids, n, bytes.fromhex(text))

    def encode_cuts(self, cuts: set[str]) -> dict[str, tuple[str, int, bytes]]:
        out, new = {}, {}
        get, find = self.cuts.get, self.pattern.findall
        for cut in cuts:
            found = get(cut)
            if found is not None:
                out[cut] = found
            else:
                new[cut] = find(cut)
        wanted = set(chain.from_iterable(new.values()))
        known = {w: found for w in wanted if (found := self.words.get(w)) is not None}
        wanted.difference_update(known)
        for w, found in self.encode_words(list(wanted)):
            known[w] = found
            self.words.put(w, found)
        for cut, words in new.items():
            if len(words) == 1:
                out[cut] = known[words[0]]
            else:
                out[cut] = joined([known[w] for w in words])
                self.cuts.put(cut, out[cut])
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[str, int, bytes]]]:
        """Per text its cuts in order, each with ids, their number and decoded bytes."""
        cut = [_cuts(t) for t in texts]
        known = self.encode_cuts(set().union(*cut)) if cut else {}
        return [list(map(known.__getitem__, own)) for own in cut]

    def decode(self, ids: pa.Array) -> list[bytes]:
        """The bytes of each list of ids; unknown ids are skipped."""
        self._load("found", pa.table({"word": np.arange(len(ids), dtype=np.int32), "toks": ids.cast(pa.list_(pa.int32()))}))
        out = [b""] * len(ids)
        self.con.execute(PARTS)
        for word, _, _, text in self.con.execute(TOLD).fetchall():
            out[word] = bytes.fromhex(text)
        return out


_RUN_THEN_SPACE = re.compile(r"\s ")


def _cuts(text: str) -> list[str]:
    """The text in parts that begin with its single spaces; one part where other white space meets a space."""
    if _RUN_THEN_SPACE.search(text):
        return [text]
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + r for r in rest]


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a vocabulary; the file is installed on every machine."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids: the tokens of every whole text; none for a null or empty one. Other columns are ignored."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        parts = codec(path, pattern).encode(b.column(1).fill_null("").to_pylist())
        ids = [[int(i) for p in own for i in p[0].split(",")] for own in parts]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return mapped(columns, each, "doc_id long, ids array<int>", text=1, limit=SLICE_BYTES)


def decoded(tokens: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, data: the bytes that the ids stand for; none for a null or empty list."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = b.column(1)
        lists = pa.array(lists.to_pylist(), lists.type) if lists.null_count or lists.offset else lists
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(codec(path, pattern).decode(lists), pa.binary())], ["doc_id", "data"])

    columns = tokens.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return mapped(columns, each, "doc_id long, data binary")


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs``.

    The hashes are of the decimal ids with commas between, and of the bytes that the ids decode to. A null text counts
    as empty. Ids may be null or repeated; other columns are ignored; an empty table gives no rows.
    """

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = codec(path, pattern).encode(b.column(1).fill_null("").to_pylist())
        sizes, ids, data = [], [], []
        for own in rows:
            listed, n, text = joined(own)
            sizes.append(n)
            ids.append(hashlib.sha256(listed.encode()).hexdigest())
            data.append(hashlib.sha256(text).hexdigest())
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(ids), pa.array(data)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return mapped(columns, each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", text=1, limit=SLICE_BYTES)
