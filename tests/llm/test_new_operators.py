"""Conversation repair, hard negatives and the language model against brute force, and on odd input."""

import hashlib
import heapq
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import pytest

from stockyard.llm import conversations, html, lm, near_duplicates, negatives, neighbours, queries
from tests.oracle import compare, connect

TURNS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>, label int"
SPACE = " \t\n\x0b\x0c\r"


def fault_of(role, text, seen):
    said = text.rstrip(SPACE)
    return "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None


def cheapest(rows):
    """Cost, audit and repaired rows by a search over all edits in order of (cost, audit), and the rows' faults."""
    seen, faults = set(), []
    for role, text in rows:
        faults.append(fault_of(role, text, seen))
        seen.add((role, text))
    grows = lambda roles: re.fullmatch("s?(ua)*u?", roles)
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, out = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out, faults
        if (i, roles[-1:]) in done:
            continue
        done.add((i, roles[-1:]))
        for new in ("user", "assistant"):
            if grows(roles + new[0]):
                heapq.heappush(queue, (cost + 5, audit + "I", i, roles + new[0], (*out, new + ":")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, roles, out))
            if faults[i] in ("blank", "duplicate"):
                continue
            extra = 5 if faults[i] else 0
            if role[:1] and grows(roles + role[:1]):
                heapq.heappush(queue, (cost + extra, audit + "K", i + 1, roles + role[0], (*out, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if grows(roles + new[0]):
                    heapq.heappush(queue, (cost + extra + 1, audit + "R", i + 1, roles + new[0], (*out, f"{new}:{text}")))


def spoilt(rows):
    """The damage of the query, plainly: conversations with their rows in order."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, [])
        key, (role, text) = ":".join(" " if v is None else str(v) for v in (conv, turn)), (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            found[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return found


def repaired(rows):
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit, out, faults = cheapest([r[1:] for r in rows])
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_conversations_are_repaired_at_least_cost(spark, root):
    r = random.Random(1)
    text = lambda: r.choice([None, "", "  ", "Hi.", "Hi", "Yes!", "a b.\n", "??", "ok \t", "end.\xa0", "é" * 5000 + "."])
    role = lambda: r.choice(["system", "user", "assistant", "tool", None, "", "user2", "sys"])
    odd = [(r.choice([None, *range(150)]), r.choice([None, *range(9)]), role(), text()) for _ in range(1200)]
    long_one = [(7777, i, r.choice(["user", "assistant"]), f"{i}{r.choice('.a')}") for i in range(3000)]
    given = [tuple(x) for x in queries._table(spark, root, "conversations").select("conv_id", "turn", "role", "text").collect()]
    for rows in (odd, long_one, given, []):
        df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as place", "2 as kind", "'x' as audit")
        got = {x[0]: tuple(x)[1:] for x in conversations.digests(conversations.damaged(df), present="present").collect()}
        assert got == {conv: repaired(own) for conv, own in spoilt(rows).items()}


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "So?"), (2, 0, "user", " ")], TURNS)
    kept = conversations.repaired(df).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in kept] == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "So?")]


def test_every_suffix_has_one_node(monkeypatch):
    made = []
    plain = conversations.preceded
    monkeypatch.setattr(conversations, "preceded", lambda symbol, after: made.append(symbol) or plain(symbol, after))
    backs = sorted(["ausuauau"[i:] + "aus"[:j] for i in range(8) for j in range(4)])
    assert len(list(conversations.walk(iter(backs)))) == len(backs)
    assert len(made) == len({b[:n] for b in backs for n in range(1, len(b) + 1)})


def mined(rows, every=50):
    own = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        own[i] = min(own[i], row) if i in own else row
    out = []
    for a, (label, v) in own.items():
        if a % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in own.items() if i != a and len(w) == len(v))
            for low, p, _ in [s for s in scored if s[2] == label][:5]:
                fits = [s for s in scored if s[2] != label and -50 * low <= -100 * s[0] <= -95 * low][:3]
                out += [(a, p, n + 1, s[1], -low, -s[0]) for n, s in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "ties", "copies", "odd", "negative", "empty"])
def test_hard_negatives(spark, kind):
    r = random.Random(2)
    vector = {
        "random": lambda: [r.gauss(0, 0.12) for _ in range(64)], "ties": lambda: [r.choice([-1.0, 0.0, 1.0]) for _ in range(5)],
        "copies": lambda: [0.5] * 9 if r.random() < 0.6 else [r.gauss(0, 1) for _ in range(9)],
        "odd": lambda: r.choice([None, [], [float("nan")], [0.0, 0.0], [1.0, None], [r.gauss(0, 1) for _ in range(r.choice([2, 3, 8, 16, 17]))]]),
        "negative": lambda: [r.choice([-1.0, 0.5])] * 3, "empty": None,
    }[kind]
    rows = [(r.choice([None, *range(300)]) if kind == "odd" else i, vector(), r.choice([None, 1, 2, 3])) for i in range(600 if vector else 0)]
    df = spark.createDataFrame(rows, VECTORS)
    exact = mined([tuple(x) for x in df.collect()])  # components as they are stored
    found = negatives.mine(df.selectExpr("*", "1 as v", "2 as rank"), "id % 50 = 0", shard=150, block=4)
    assert sorted(map(tuple, found.collect())) == exact


def test_hard_negatives_of_the_table(spark, root):
    assert compare(queries.op12_hard_negatives(spark, root), connect(root), queries.HARD_NEGATIVES) is None


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) + ["</s>"]


def plain_model(texts, order):
    """The probability of a word behind others, by the definition, and the counts of words."""
    train = [tokens(t) for t in texts]
    raw = Counter(w for t in train for w in t)
    counts = {order: Counter(tuple(p[k - order + 1 : k + 1]) for t in train for p in [["<s>"] * (order - 1) + t] for k in range(order - 1, len(p)))}
    for o in range(order - 1, 0, -1):
        counts[o] = Counter(g[1:] for g in counts[o + 1])
    cut, behind = {}, {o: defaultdict(list) for o in counts}
    for o, own in counts.items():
        cut[o] = [0, *lm.discounts(*[sum(v == k for v in own.values()) for k in (1, 2, 3, 4)])[1:]]
        for g, v in own.items():
            behind[o][g[:-1]].append(v)

    def p(gram):
        if not gram:
            return 1 / (len(raw) + 1)
        lower, o = p(gram[1:]), len(gram)
        known = behind[o].get(gram[:-1])
        if not known:
            return lower
        n = counts[o][gram]
        return (max(n - cut[o][min(n, 3)], 0) + sum(cut[o][min(v, 3)] for v in known) * lower) / sum(known)

    return p, raw


@pytest.mark.parametrize("order, bucket", [(2, 500), (3, 700), (2, 10**6)])
def test_language_model(spark, order, bucket):
    r = random.Random(3)
    vocabulary = ["the"] * 8 + [f"w{i}" for i in range(60)] + ["É", "日本", "A", "b"]
    text = lambda: r.choice([None, "", " \n"]) if r.random() < 0.05 else " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 60)))
    rows = [(r.choice([None, *range(400)]), text()) for _ in range(300)]
    p, raw = plain_model([t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1], order)
    n, kinds = sum(raw.values()), len(raw)
    assert math.isclose(sum(p((*["the"] * (order - 1), w)) for w in [*raw, "?"]), 1)
    expected = []
    for i, t in rows:
        own = tokens(t)
        padded = ["<s>"] * (order - 1) + own
        score = sum(math.log10(p(tuple(padded[k - order + 1 : k + 1]))) for k in range(order - 1, len(padded)))
        base = sum(math.log10((raw[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in own)
        expected.append((i, len(own), sum(raw[w] > 0 for w in own), n, base, score))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as word", "2 as bucket")
    got = [(x.doc_id, x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in lm.scores(df, order=order, bucket=bucket).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1], round(x[4], 6))
    for a, b in zip(sorted(expected, key=key), sorted(got, key=key), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def test_language_model_without_texts_to_learn_from(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(100)], "doc_id long, text string")
    none = lm.scores(df, may_learn="false").collect()
    assert len(none) == 100 and {(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in none} == {(3, 0, 0, 0.0)}
    assert lm.scores(df.limit(0)).collect() == []


def test_nearest_of_many_ties_and_of_several_lengths(spark):
    rows = [(i, [1.0, float(i % 97), 0.0]) for i in range(400)] + [(1000 + i, [1.0 + i] * 5) for i in range(3)] + [(1020, [2.0] * 5), (1040, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1020, [2.0] * 5), (1040, [1.0])], df.schema)
    found = {}
    for r in neighbours.search(df, asked).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {0: [*range(1, 21)], 1020: [1002, 1001, 1000]}


def test_texts_of_one_id_link_what_is_like_either(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, b), (5, a), (5, b), (9, a), (11, c), (11, None), (12, "")]
    got = near_duplicates.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got.collect()) == [
        (3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False), (11, 11, True), (11, 11, True), (12, 12, True),
    ]


@pytest.fixture(scope="module")
def field(spark, root):
    return html.fit(queries._table(spark, root, "pages"), "page_id", "html")


LONG = "Long paragraph of text that goes on and on, with commas. And sentences."


@pytest.mark.parametrize("page, text", [
    (f"<nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}</p><ul><li>Item one</li><li>Item two</li></ul></article><footer>c</footer>", f"T\n{LONG}\nItem one\nItem two"),
    (f'<div class="content"><p>{LONG}</p><ol><li>First</li><li>Second</li></ol></div><div class="discussion"><p>I liked this.</p></div>', f"{LONG}\nFirst\nSecond"),
    (f'<article><header><h1>A title</h1><p class="byline">By A. Nyone</p></header><p>{LONG}</p></article>', f"A title\n{LONG}"),
    ("plain text &amp; no tags", "plain text & no tags"),
])
def test_main_text_of_small_pages(field, page, text):
    assert field.main_text(page if "plain" in page else f"<html><body>{page}</body></html>") == text


def test_deep_pages_take_memory_in_proportion(field):
    def peak(depth):
        tracemalloc.start()
        assert len(html.blocks("".join(f'<div class="c{chr(97 + i % 26)}">x ' for i in range(depth)))) == depth
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    peak(100)
    assert peak(20_000) < 3 * peak(10_000) < 60_000_000
    assert field.main_text("<div>" * 50_000 + "<p>x") in ("", "x")
