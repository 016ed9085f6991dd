"""Conversation structure repair: cheapest edits by an automaton that all conversations share from their ends.

Rows become symbols. A row's role initial (``s``, ``u``, ``a``, else ``o``) and its first fault make one letter: small
for a sound row, capital for a truncated one, ``x`` for a blank or repeated one, which has to go. A conversation's letters
are its signature, and equal signatures are one.

Automaton. Signatures are sorted by their letters from the end over range partitions, so those that end alike follow each
other, and a stack holds one node for each suffix that is open. A suffix gets its node once, however many conversations
end in it (once more where a partition begins). A node knows for each of the four grammar states what the rest costs and
with which edit the best audit goes on; the audit itself is read off along the nodes, so it is never copied into them.

Edits. The text moves once: the audit of a conversation is sorted in front of its rows, and the edits are applied as the
rows pass, so no conversation has to fit in memory. What grows with a conversation in one row is its signature and its
audit, a letter for a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stockyard.llm.common import slices, written

SPACE = " \t\n\x0b\x0c\r"
STOPS = [".", "!", "?"]
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5  # costs; keeping is free, and a truncated row that stays costs CUT more
LEGAL = {"su", "ua", "au"}

# Grammar states: 0 nothing yet, 1 after the system row, 2 after a user's, 3 after an assistant's; the end may follow 0 or 3.
NEXT = (2, 2, 3, 2)  # the state behind the one role that may be inserted, or given to a row, in each state
ROLE = {2: "user", 3: "assistant"}
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
Node = tuple[tuple[int, ...], tuple[str, ...]]  # per state: cost to go, first edit of the best audit
END: Node = ((0, 2 * INSERT, INSERT, 0), ("", "I", "I", ""))


def preceded(symbol: str, after: Node) -> Node:
    """The node of a row with this symbol in front of ``after``. Of equal costs the edit that is first in ASCII stays."""
    costs, edits = [], []
    for state in range(4):
        ways = [(DELETE + after[0][state], "D")]
        if symbol != "x":
            extra = CUT if symbol.isupper() else 0
            ways.append((REROLE + extra + after[0][NEXT[state]], "R"))
            if symbol.lower() in KEPT[state]:
                ways.append((extra + after[0][KEPT[state][symbol.lower()]], "K"))
        cost, edit = min(ways)
        costs.append(cost)
        edits.append(edit)
    plain = list(zip(costs, edits))
    # one or two inserts before the row; inserts cost, so they never go round
    once = [min(plain[s], (INSERT + plain[NEXT[s]][0], "I")) for s in range(4)]
    best = [min(once[s], (INSERT + once[NEXT[s]][0], "I")) for s in range(4)]
    return tuple(c for c, _ in best), tuple(e for _, e in best)


def _moved(state: int, edit: str, symbol: str) -> int:
    if edit == "K":
        return KEPT[state][symbol.lower()]
    return state if edit == "D" else NEXT[state]


def walk(signatures: Iterator[str]) -> Iterator[tuple[int, str]]:
    """Cost and best audit of each signature; they come written from their end, best in sorted order."""
    nodes, before = [END], ""
    for back in signatures:
        same = 0
        for a, b in zip(back, before):
            if a != b:
                break
            same += 1
        del nodes[same + 1 :]
        for symbol in back[same:]:
            nodes.append(preceded(symbol, nodes[-1]))
        before = back
        state, left, audit = 0, len(back), []
        while edit := nodes[left][1][state]:
            audit.append(edit)
            state = _moved(state, edit, back[left - 1] if left else "")
            left -= edit != "I"
        yield nodes[-1][0][0], "".join(audit)


def _plain(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """The rows under fixed names; a null role or text is one space. ``place`` orders the rows of one turn."""
    said = F.coalesce(F.col(text), F.lit(" "))
    return conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), said.alias("text"), F.unhex(F.sha2(said, 256)).alias("place"),
        (F.col(present) if present else F.lit(True)).alias("present"),
    )


def _order(*first: str) -> list[Column]:
    return [*map(F.col, first), F.asc_nulls_first("turn"), F.col("role"), F.col("place")]


def signatures(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal (longs), signature.

    Only digests of the texts are moved. Equal rows of a conversation are found by role and digest.
    """
    initial = F.left("role", F.lit(1))
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = _plain(conversations, conv_id, turn, role, text, present).select(
        "conv_id", "turn", "role", "place", "present",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(STOPS), "t").otherwise("k").alias("fault"),
    )
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "place", "present").orderBy(F.asc_nulls_first("turn"))) > 1
    marked = rows.withColumn("fault", F.when((F.col("fault") != "b") & again, "d").otherwise(F.col("fault")))
    dealt = marked.repartition("conv_id").sortWithinPartitions(*_order("conv_id"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for conv, turn, there, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(_summary(now))
                    now = [conv, None, None, 0, {"b": 0, "d": 0, "t": 0, "k": 0}, 0, "", []]
                if not there:
                    continue
                if turn is not None and turn != now[2]:
                    now[1] = turn if now[1] is None else now[1]
                    now[2], now[3] = turn, now[3] + 1
                now[4][fault] += 1
                now[5] += bool(now[6]) and now[6] + initial not in LEGAL
                now[6] = initial
                now[7].append("x" if fault in "bd" else initial.upper() if fault == "t" else initial)
            if out:
                yield _batch(out, SIGNATURE)
        if now is not None:
            yield _batch([_summary(now)], SIGNATURE)

    return dealt.select("conv_id", "turn", "present", "initial", "fault").mapInArrow(told, _ddl(SIGNATURE))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
SIGNATURE = {"conv_id": "long", **dict.fromkeys(COUNTS, "long"), "signature": "string"}
ANSWER = {"back": "string", "cost": "long", "audit": "string"}
REPAIRED = {"conv_id": "long", "place": "long", "edit": "string", "role": "string", "text": "string"}
DIGEST = {"conv_id": "long", **dict.fromkeys([*COUNTS, "cost"], "long"), "audit": "string", "repaired_sha256": "string"}
ARROW = {"long": pa.int64(), "string": pa.string()}


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in fields.items())


def _batch(rows: list[tuple], fields: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, t in zip(zip(*rows), fields.values())], list(fields))


def _summary(now: list) -> tuple:
    conv, low, high, kinds, faults, illegal, _, letters = now
    gaps = 0 if low is None else min(high - low + 1 - kinds, 2**63 - 1)
    return conv, gaps, faults["b"], faults["d"], faults["t"], illegal, "".join(letters)


def audits(conversations: DataFrame, **columns) -> DataFrame:
    """What ``signatures`` gives, with cost and audit: the cheapest edits' initials, of equal ones the least in ASCII.

    Keep is free, Rerole (to user or assistant) costs 1, Delete 2, Insert 5 and a truncated row that stays 5; blank and
    repeated rows must be deleted. What is left has the role initials ``(s?(ua)+)?``.
    """
    told = written(signatures(conversations, **columns).withColumn("back", F.reverse("signature")), "signatures")

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: list[str] = []

        def each() -> Iterator[str]:
            for batch in batches:
                for back in batch.column(0).to_pylist():
                    sent.append(back)
                    yield back

        out, held = [], 0
        for cost, audit in walk(each()):
            out.append((sent.pop(), cost, audit))
            held += len(audit)
            if held > 1 << 20 or len(out) == 10_000:
                yield _batch(out, ANSWER)
                out, held = [], 0
        if out:
            yield _batch(out, ANSWER)

    kinds = told.select("back").distinct()
    answers = kinds.repartitionByRange("back").sortWithinPartitions("back").mapInArrow(answered, _ddl(ANSWER))
    return told.join(answers, "back").select("conv_id", *COUNTS, "signature", "cost", "audit")


def _with_heads(conversations: DataFrame, columns: dict) -> DataFrame:
    """Each conversation's audit, and behind it its rows in order."""
    names = {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text", "present": None} | columns
    rows = _plain(conversations, **names).where("present").drop("present")
    heads = audits(conversations, **columns).drop("signature")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("place", "binary"))]
    empty = [F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in [*COUNTS, "cost", "audit"]]
    both = heads.select("*", *none, F.lit(0).alias("kind")).unionByName(rows.select("*", *empty, F.lit(1).alias("kind")))
    dealt = both.repartition("conv_id").sortWithinPartitions(*_order("conv_id", "kind"))
    return dealt.select("text", "conv_id", "role", "kind", *COUNTS, "cost", "audit")


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of heads (None, conv_id, counts, cost, audit) and repaired rows (edit, conv_id, role, text), in order."""
    conv, audit, at, state = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            at, state = at + 1, NEXT[state]
            yield "I", conv, ROLE[state], ""

    for whole in batches:
        for batch in slices(whole, 0):
            out: list[tuple] = []
            for text, own, role, kind, *head in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    out += inserted()
                    conv, audit, at, state = own, head[-1], 0, 0
                    out.append((None, conv, *head))
                    continue
                out += inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = KEPT[state][role[:1]]
                    out.append((edit, conv, role, text))
                elif edit == "R":
                    state = NEXT[state]
                    out.append((edit, conv, ROLE[state], text))
            yield out
    yield [*inserted()]


def repaired(conversations: DataFrame, **columns) -> DataFrame:
    """The rows after the cheapest edits: conv_id, place from 0, edit (K, R or I), role, text.

    ``conv_id``, ``turn``, ``role``, ``text`` name the columns, ``present`` a boolean one: where it is false, a row only
    makes its conversation known. Rows go by turn, nulls first; rows of one turn by role and then by the SHA-256 of their
    text, so equal rows stand side by side. Null roles and texts are one space; a null conv_id is a conversation like any
    other. A conversation of which nothing stays has no row here. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for part in _mended(batches):
            out = []
            for edit, conv, *rest in part:
                if edit is None:
                    place = 0
                else:
                    out.append((conv, place, edit, *rest))
                    place += 1
            if out:
                yield _batch(out, REPAIRED)

    return _with_heads(conversations, columns).mapInArrow(run, _ddl(REPAIRED))


def digests(conversations: DataFrame, **columns) -> DataFrame:
    """Per conversation its counts, cost, audit and the SHA-256 of its repaired rows, ``role:text`` joined by newlines.

    Columns and order as in ``repaired``. A conversation without rows has zeros, an empty audit and the digest of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, rows = None, hashlib.sha256(), 0
        for part in _mended(batches):
            out = []
            for edit, *rest in part:
                if edit is None:
                    if head is not None:
                        out.append((*head, sha.hexdigest()))
                    head, sha, rows = rest, hashlib.sha256(), 0
                else:
                    _, role, text = rest
                    sha.update(f"{chr(10) if rows else ''}{role}:{text}".encode())
                    rows += 1
            if out:
                yield _batch(out, DIGEST)
        if head is not None:
            yield _batch([(*head, sha.hexdigest())], DIGEST)

    return _with_heads(conversations, columns).mapInArrow(run, _ddl(DIGEST))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows spoilt by a checksum of ``conv_id:turn`` modulo 20: 0 drops a row (``present`` is false), 1 empties its text,
    2 takes its stops, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, "".join(STOPS), "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"), F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
