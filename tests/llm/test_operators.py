"""Each operator against a plain version: brute force, an exact round trip, or held-out labels."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from stockyard.llm import bpe, fingerprint, html, language, near_duplicates, neighbours, packing, passages, quality, toxicity
from stockyard.llm.common import perhaps_among, written
from stockyard.llm.components import components
from stockyard.llm.words import Words, shingle_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS)


def vocabulary_text(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def test_words_and_shingles():
    texts = [None, "", "  ", "One\ttwo  one", "ÀB c\x0bd e", "a b c d e F", "a B C d e f"]
    words = Words(pa.array(texts))
    for i, t in enumerate(texts):
        own = [words.raw[a:z].tobytes().decode() for a, z in zip(words.start[words.first[i] : words.first[i + 1]], words.end[words.first[i] :])]
        assert [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in own] == words_of(t)
    sets = shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [0, 0, 0, 1, 1, 2, 2] and (sets[5] == sets[6]).all()


# --- passages


def brute_repeats(rows):
    """Words covered by 50-word windows that a smaller id has too."""
    seen = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            seen[key] = min(i, seen.get(key, i))
    out = {}
    for i, t in rows:
        w = words_of(t)
        covered = {j for k in range(len(w) - 49) if seen[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        out[i] = (len(w), len(covered))
    return out


def passage_rows():
    rng = random.Random(5)
    shared = [vocabulary_text(rng, n) for n in (50, 51, 49, 120, 64)]
    rows = [(i, " ".join([vocabulary_text(rng, rng.randrange(120)), shared[rng.randrange(5)], vocabulary_text(rng, rng.randrange(120))])) for i in range(40)]
    rows += [(100, "a " * 300), (101, "b " * 200 + "a " * 90), (102, rows[3][1]), (103, rows[3][1].upper()), (104, ""), (105, "x y " * 60)]
    rows += [(106, vocabulary_text(rng, 3000)), (107, rows[-1][1])]
    return rows


def test_repeated_passages(spark):
    rows = passage_rows()
    got = {r.doc_id: (r.n_words, r.n_repeated) for r in passages.report(table(spark, rows)).collect()}
    assert got == brute_repeats(rows)


def test_cut_passages(spark):
    rows = passage_rows()
    counts = brute_repeats(rows)
    got = {r.doc_id: r.text for r in passages.without_repeats(table(spark, rows)).collect()}
    for i, t in rows:
        n, repeated = counts[i]
        if repeated == n > 0:
            assert i not in got
        elif not repeated:
            assert got[i] == t
        else:
            assert len(words_of(got[i])) == n - repeated


def test_a_text_has_one_row_for_what_it_repeats(spark):
    """A word pair repeated in many texts, and a passage that texts hold several times, in equal and in other surroundings."""
    rng = random.Random(9)
    own = [vocabulary_text(rng, 70, 4000) for _ in range(8)]
    passage, gap, other = (vocabulary_text(rng, n, 4000) for n in (75, 12, 9))
    rows = [(i, f"{own[i]} " + "is on " * (300 + i)) for i in range(6)]
    rows += [(10, f"{own[6]} {passage} {own[7]}"), (11, f"{passage} {gap} " * 5 + f"{passage} {other} " * 3), (12, f"{gap} {passage} " * 4)]
    rows += [(13, f"{own[6]} " * 3 + f"{other} {passage} {own[7]}"), (14, "only here " * 200), (15, rows[7][1])]
    texts = passages._texts(table(spark, rows), "doc_id", "text")
    suffix = written(passages.suffixes(texts), "suffixes")
    assert suffix.groupBy("doc_id", "head", "tail").count().where("count > 1").count() == 0
    found = written(passages.extents(texts, passages.with_equal_neighbour(suffix)), "extents")
    assert found.groupBy("doc_id", "c1", "c2").count().where("count > 1").count() == 0
    places = {r.doc_id: (r.rows, r.places) for r in found.where("doc_id < 6").groupBy("doc_id").agg(F.expr("count(*) as rows"), F.expr("sum(size(again)) as places")).collect()}
    assert len(places) == 6 and all(n <= 30 < 250 <= k for n, k in places.values())
    got = {r.doc_id: (r.n_words, r.n_repeated) for r in passages.report(table(spark, rows)).collect()}
    assert got == brute_repeats(rows)
    assert got[11][1] > 8 * 50 and got[14][1] == 0


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_first_documents_across_partitions(spark, partitions):
    """Keys that fill several partitions, documents that have a key often, and repeated rows."""
    rng = random.Random(partitions)
    rows = [(1, k, rng.randrange(4), rng.randrange(3), i) for i in range(900) for k in [rng.choice([0, 0, 0, 0, 7, 8, rng.randrange(50)])]]
    rows += [(-2, 5, 9, 0, i) for i in range(300)] + [(1, 0, 2, 0, i) for i in range(300)] + [(-1, 5, d, 0, 0) for d in range(300)] * 2
    least = {}
    for a, b, d, *_ in rows:
        least[a, b] = min(least.get((a, b), d), d)
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        frame = spark.createDataFrame(rows, "c1 long, c2 long, doc_id long, copy long, begin int")
        marked = written(passages.after_first(frame, ["c1", "c2"]), "marked")
        assert marked.where("edge is not null").count() in range(max(1, partitions - 2), partitions + 1)
        got = sorted(tuple(r) for r in passages.settled(marked).collect())
        assert passages.settled(written(passages.after_first(frame.limit(0), ["c1", "c2"]), "none")).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted((*r, r[2] != least[r[0], r[1]]) for r in rows)


# --- tokens


def test_bpe_equals_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})
    rng = random.Random(3)
    texts = [None, "", "a", "a   b  c ", "x \n", " \n y\n ", "it's 'd  x", "a" * 3000, "ab" * 300, " " * 500, "日本語 テスト" * 9, "&" * 200, "👍🏽 é", "<|endoftext|>"]
    texts += ["".join(rng.choice("ab 'sé\n\t.,1x  \xa0") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(150))]
    docs = table(spark, list(enumerate(texts)))
    want = {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}
    for r in bpe.digests(docs, VOCABULARY, public_tokenizers.PATTERN).collect():
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    encoded = bpe.encoded(docs, VOCABULARY, public_tokenizers.PATTERN)
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    assert {r.doc_id: bytes(r.data).decode() for r in bpe.decoded(encoded, VOCABULARY, public_tokenizers.PATTERN).collect()} == {
        i: t or "" for i, t in enumerate(texts)
    }


# --- near duplicates


def brute_groups(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def near_rows():
    """A large group of near copies whose centre has no small id, chains of copies of copies, copies, short texts."""
    rng = random.Random(11)
    centre = vocabulary_text(rng, 120, 5000)
    rows = [(1000 - i, edited(rng, centre, rng.randrange(1, 9))) for i in range(70)] + [(999_999, centre)]
    for c in range(4):
        text = vocabulary_text(rng, 90, 5000)
        for i in range(8):
            rows.append((2000 + 10 * c + i, text))
            text = edited(rng, text, 2)
    rows += [(3000 + i, t) for i, t in enumerate(["", " ", "a", "A", "a b", "a  b", "a b c d e", "a b c d e f", "a b c d", None])]
    rows += [(4000 + i, rows[5][1]) for i in range(20)] + [(5000 + i, vocabulary_text(rng, rng.randrange(200))) for i in range(30)]
    return rows


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates.linked_in_blocks, "__defaults__", (block,))
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.groups(table(spark, rows)).collect()}
    assert got == brute_groups(rows)
    kept = {r.doc_id for r in near_duplicates.one_of_each(table(spark, rows)).collect()}
    assert kept == {i for i, v in got.items() if v[2]}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(None, 3), (5, 5)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in parent}


# --- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[100:160] = x[100]  # many equal vectors
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000, None, 0), (2020, [0.0] * 16, 0), (2040, [float("nan")] * 16, 0), (2060, [1.0] * 15 + [None], 0), (2080, [float("inf")] * 16, 0)]
    df = vectors(spark, rows + rows[:3])
    got = neighbours.search(df, df.where("vec_id % 20 = 0"), k=20, leaf=32, shard=300).collect()
    exact = x.astype(float) @ x.astype(float).T
    hits = 0
    for q in range(0, 900, 20):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and q not in {r.vec_id for r in own}
        assert all(r.score == pytest.approx(exact[q, r.vec_id], abs=1e-12) for r in own)
        assert [(r.score, -r.vec_id) for r in own] == sorted(((r.score, -r.vec_id) for r in own), reverse=True)
        best = sorted((i for i in range(900) if i != q), key=lambda i: (-round(exact[q, i], 9), i))[:20]
        hits += len(set(best) & {r.vec_id for r in own})
    assert hits >= 0.9 * 20 * 45 and {r.query_id for r in got} == set(range(0, 900, 20))


def test_few_vectors(spark):
    df = vectors(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)])
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.search(df, df.where("vec_id % 20 = 0")).collect()]
    assert sorted(got) == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]


# --- pages


def test_blocks():
    page = (
        "<p>a &lt;b&gt; <!-- x > y --> c<br>d<table><tr><td>1<td>2</table> <p title=\"x>y\">q&nbsp;&amp;amp;</p> 3 < 4 "
        "<script>var t='</p>';</script><style>p{}</style><ul><li>i<li><b>j</ul>k<br/>l"
    )
    assert [b.text for b in html.blocks(page)] == ["a <b> c d", "1", "2", "q &amp;", "3 < 4", "i", "j", "k l"]
    assert html.blocks("") == [] and html.blocks("<div></div><p> </p>") == []


@pytest.mark.parametrize("page, texts", [
    ('<p>a <svg width="1"/> b<p>c <math/> d<p>e', ["a b", "c d", "e"]),
    ("<p>a<svg><title/><path d='1'/></svg> b<p>c<svg><title>t</title><script>x</script></svg> d", ["a b", "c d"]),
    *((f"<p>a<{t}> b</p><p>c", ["a b", "c"]) for t in ("object", "canvas", "noscript", "template", "select", "svg", "math")),
    ("<p>a<noscript> b</p><p>c<noscript>d</noscript> e", ["a b", "c e"]),
    ("<p>a<template>b<template>c</template>d</template> e", ["a e"]),
    ("<p>a<math><mi>x</mi></math> <object>y</object> <canvas>z</canvas> <svg><text>u</text></svg>", ["ax y z u"]),
    ("<p>a<script>b<p>c", ["a"]), ("<p>a<title>b<p>c", ["a"]),
])
def test_blocks_keep_what_stands_behind_embedded_elements(page, texts):
    assert [b.text for b in html.blocks(page)] == texts


def test_field_marginals_and_viterbi():
    """Against all labellings of a short sequence."""
    rng = np.random.default_rng(1)
    field = html.Field()
    field.pair = rng.normal(size=(2, 2))
    one = rng.normal(size=6)

    def score(y):
        return sum(one[i] for i in range(6) if y[i]) + sum(field.pair[a, b] for a, b in zip(y, y[1:]))

    every = [[k >> i & 1 for i in range(6)] for k in range(64)]
    weight = np.exp([score(y) for y in every])
    p, joint = field._marginals(one)
    assert np.allclose(p, (weight[:, None] * np.array(every)).sum(0) / weight.sum())
    assert joint.sum() == pytest.approx(5)
    assert field.viterbi(one) == every[int(weight.argmax())]


def test_main_text(spark, root):
    """On pages of the table, and on layouts that the field has not seen."""
    pages = spark.read.parquet(f"{root}/pages.parquet")
    rows = pages.collect()
    got = {r.page_id: r.text for r in html.main_texts(pages).collect()}
    for r in rows:
        blocks = html.blocks(r.html)
        assert got[r.page_id] == "\n".join(b.text for b, y in zip(blocks, html.semantic_labels(blocks)) if y)
    field = html.train([r.html for r in rows[:40]])
    rng = np.random.default_rng(8)
    right = total = 0
    for r in rows[40:]:
        blocks = html.blocks(r.html)
        labels = html.semantic_labels(blocks)
        made = html.labelled_layout(html.layouts([b.text for b, y in zip(blocks, labels) if y], [b.text for b, y in zip(blocks, labels) if not y], rng))
        told = field.viterbi(field.scores(made[0]))
        right, total = right + sum(a == b for a, b in zip(told, made[1])), total + len(told)
    assert right >= 0.97 * total


# --- languages


def test_phrases_are_longest_matches():
    learnt = {"x": ["abcabd abe", "cab"], "y": ["dddd cc"]}
    model = language.Model(learnt)
    text = "abcab, dxab ddd c!cc abe" * 40
    codes, offsets = model.alphabet.encode(*language.points(pa.array([text])))
    got = model.phrases(codes, offsets)[0]
    for k, name in enumerate(model.languages):
        own = model.alphabet.encode(*language.points(pa.array(learnt[name])))[0].tobytes()
        count = 0
        for at in range(0, len(codes), language.WINDOW):
            part = codes[at : at + language.WINDOW].tobytes()
            i = 0
            while i < len(part):
                j = i + 1
                while j < len(part) and part[i : j + 1] in own:
                    j += 1
                count, i = count + 1, j
        assert got[k] == count


def test_letters_of_large_alphabets_are_told_apart():
    """Two languages in the same 3,000 signs, in other orders, beside Latin text that is more frequent."""
    rng = random.Random(3)
    signs = [chr(0x4E00 + i) for i in range(3000)]
    words = {k: ["".join(rng.sample(signs, 3)) for _ in range(2000)] for k in ("x", "y")}
    learnt = {k: ["".join(w)] for k, w in words.items()} | {"a": ["the quick brown fox jumps over the lazy dog " * 800]}
    model = language.Model(learnt)
    texts = {k: ["".join(rng.choice(words[k]) for _ in range(60)) for _ in range(20)] for k in ("x", "y")}
    for k, some in texts.items():
        assert model.predict(pa.array(some))[0] == [k] * 20
    codes, offsets = model.alphabet.encode(*language.points(pa.array(texts["x"][:1])))
    got = model.phrases(codes, offsets)[0]
    part = texts["x"][0]
    for k, name in enumerate(model.languages):
        own, count, i, t = " " + learnt[name][0], 0, 0, " " + part
        while i < len(t):
            j = i + 1
            while j < len(t) and t[i : j + 1] in own:
                j += 1
            count, i = count + 1, j
        assert got[k] == count


def test_language(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.predictions(docs).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_of_long_texts_only(spark):
    rng = random.Random(5)
    words = {k: ["".join(rng.choice(abc) for _ in range(5)) for _ in range(300)] for k, abc in (("p", "abcdefg"), ("q", "acegikm"))}

    def text(k, n):
        return " ".join(rng.choice(words[k]) for _ in range(n))

    rows = [(i, text("p" if i % 2 else "q", 40 if i % 2 else 3000), "p" if i % 2 else "q", "s", 0) for i in range(40)]
    rows += [(1000 + i, text("q", 40), None, "s", 0) for i in range(10)]
    got = {r.doc_id: r.lang_pred for r in language.predictions(spark.createDataFrame(rows, DOCS)).collect()}
    assert {got[1000 + i] for i in range(10)} == {"q"}


# --- fingerprints


def test_fingerprints(spark):
    rng = random.Random(6)
    texts = {i * 7 - 50: vocabulary_text(rng, rng.randrange(200), 9000) for i in range(60)} | {10**15: "far é 日 away", -(10**12): "", 3: None}
    df = table(spark, list(texts.items()))
    got = {r.doc_id: r for r in fingerprint.edited(df, range_rows=5).collect()}
    order = sorted(texts, reverse=True)
    assert set(got) == set(texts)
    for i, nxt in zip(order, order[1:] + order[:1]):
        t, n = texts[i] or "", texts[nxt] or ""
        m = len(t) // 3
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - m] + n[:m]).encode()).hexdigest()
        assert 0 <= got[i].near_next <= 1 and got[i].near_next == pytest.approx(
            float(fingerprint.likeness(*(np.frombuffer(bytes.fromhex(got[k].fingerprint), np.uint8)[None] for k in (i, nxt)))[0])
        )
    long = [r for i, r in got.items() if len(words_of(texts[i])) > 60]
    assert np.mean([r.near_edited for r in long]) > 0.35 > 0.05 > np.mean([r.near_next for r in long])


def test_similar_pairs(spark):
    rows = near_rows()
    want = brute_groups(rows)
    pairs = fingerprint.similar(table(spark, rows)).collect()
    sets = {i: set() for i, _ in rows}
    for i, t in rows:
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    assert all(100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a, b in pairs)
    assert {(4000, 4000 + i) for i in range(1, 20)} <= {tuple(sorted(p)) for p in pairs} | {(4000, b) for a, b in pairs if a < 4000}
    assert all(want[a][1] == want[b][1] for a, b in pairs)


def test_similar_pairs_have_all_components(spark):
    """Members of a band that are like each other, but not like its smallest ids."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(1000)]

    def changed(n):
        at = set(rng.sample(range(1000), n))
        return " ".join(f"x{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(base))

    rows = [(i, changed(10)) for i in range(14)] + [(100, " ".join(base)), (101, changed(1)), (102, changed(1)), (103, " ".join(base))]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(996)} for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 97 * len(sets[a] | sets[b])}
    assert {(100, 101), (100, 102)} <= want and all(a >= 100 for a, b in want)
    got = {tuple(sorted(p)) for p in fingerprint.similar(table(spark, rows), percent=97).collect()}
    assert got <= want
    reached = {100}
    for _ in rows:
        reached |= {x for p in got if reached & set(p) for x in p}
    assert reached == {100, 101, 102, 103}


# --- classifiers


@pytest.mark.parametrize("operator, column, held, floor", [(quality, "quality", 3, 0.95), (toxicity, "toxic", 5, 0.9)])
def test_classifiers(spark, root, operator, column, held, floor):
    data = root.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r[column] for r in labels.collect()}
    got = operator.scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % held == (1 if held == 3 else 0)) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in tested) >= floor * len(tested)
    kept = {r.doc_id for r in operator.accepted(docs, labels).select("doc_id").collect()}
    assert kept == {r.doc_id for r in got if r.predicted == (1 if column == "quality" else 0)}


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, bag, y = rng.normal(size=(9, 5)), np.array([0, 0, 0, 1, 1, 2, 2, 2, 2]), np.array([1.0, 0.0, 1.0])
    net = quality.Net(x.mean(0), x.std(0))

    def loss():
        p = net.forward(x, bag, 3)["y"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, g in net.gradients(x, bag, y).items():
        for at in [tuple(rng.integers(s) for s in g.shape) for _ in range(4)]:
            net.p[name][at] += 1e-6
            up = loss()
            net.p[name][at] -= 2e-6
            down = loss()
            net.p[name][at] += 1e-6
            assert g[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_kneser_ney_base_sums_to_one():
    rng = np.random.default_rng(0)
    triples = rng.integers(0, 1 << 21, 5000).astype(np.int32)
    counts = pa.table({"order": pa.array([4], pa.int32()), "bucket": pa.array([1]), "context": pa.array([1]), "toxic": pa.array([1]), "plain": pa.array([0])})
    model = toxicity.Model(counts, pa.table({"triple": np.unique(triples), "before": rng.integers(1, 9, len(np.unique(triples)))}))
    assert np.allclose(model.base.reshape(-1, 128).sum(1), 1, atol=1e-4)


@pytest.mark.parametrize("slots", [1 << 28, 64])
def test_prefilter_loses_no_row(spark, slots):
    rows = spark.range(20_000).selectExpr("cast(id as int) as id", "id as _other").union(spark.createDataFrame([(None, 1)], "id int, _other long"))
    keys = spark.range(0, 20_000, 7).select("id").union(spark.createDataFrame([(None,), (-5,)], "id long"))
    got = {r.id for r in perhaps_among(rows, "id", keys, slots).collect()}
    assert got >= set(range(0, 20_000, 7))
    assert len(got) < 20_000 * (1 / 7 + 1 / 6) if slots > 64 else len(got) == 20_001
    assert perhaps_among(rows, "id", keys.limit(0)).count() == 0


def test_every_ngram_has_counts_of_its_own(spark):
    """All words of three letters: more n-grams than a table of 2^19 slots keeps apart."""
    abc = "abcdefghijklmnopqrstuvwxyz"
    words = [x + y + z for x in abc for y in abc for z in abc]
    texts = [(" ".join(words), 0), (" ".join(w for w in words if w < "c") + " lengthy lengthier", 1)]
    want = {}
    for text, label in texts:
        for w in text.split():
            w = f"\0{w}\0"
            for o in toxicity.ORDERS:
                for i in range(len(w) - o + 1):
                    key = sum((ord(c) - 96 if c != "\0" else 0) << 7 * (o - 1 - j) for j, c in enumerate(w[i : i + o]))
                    want.setdefault((o, key), [0, 0])[label] += 1
    counts = toxicity.class_counts(spark.createDataFrame(texts, "text string, label int")).toArrow()
    got = {(r["order"], r["bucket"]): [r["plain"], r["toxic"]] for r in counts.to_pylist()}
    assert got == want and len(counts) == len(want)
    model = toxicity.Model(counts, pa.table({"triple": pa.array([1], pa.int32()), "before": pa.array([1])}))
    for o in toxicity.ORDERS:
        keys = np.array([k for p, k in want if p == o], np.int64)
        place = model.grams[o].find(keys)
        assert len(set(place.tolist())) == len(keys) and (place >= 0).all()
        total = {}
        for (p, k), n in want.items():
            if p == o:
                total[k >> 7] = total.get(k >> 7, 0) + n[1]
        for k, i in zip(keys.tolist(), place.tolist()):
            assert model.alpha[o][1, i] == pytest.approx(max(want[o, k][1] - toxicity.DISCOUNT, 0) / max(total[k >> 7], 1), rel=1e-6)
        assert (model.grams[o].find(np.array([(1 << 7 * o) - 1])) == -1).all()


# --- packing


def test_packing(spark):
    rng = random.Random(9)
    sizes = [0, 1, 511, 512, 513, 8192, 8193, 20_000, None, -4] + [int(rng.lognormvariate(5.5, 1.3)) for _ in range(700)]
    df = spark.createDataFrame([(i % 600, None, n) for i, n in enumerate(sizes)] + [(None, None, 77)] * 3, "doc_id long, text string, tokens int")
    got = packing.pack(df, tokens="tokens", shard_pieces=200).collect()
    want = sum(max(0, n or 0) for n in sizes) + 3 * 77
    assert sum(r.n_tokens for r in got) == want
    bins = {}
    for r in got:
        assert (r.sequence is None) == (r.n_tokens == 0) and r.n_tokens <= packing.SIZES[-1]
        if r.n_tokens:
            bins.setdefault(r.sequence, []).append(r)
    held = 0
    for rows in bins.values():
        rows.sort(key=lambda r: r.position)
        ends = np.cumsum([r.n_tokens for r in rows]).tolist()
        assert [r.position for r in rows] == [0, *ends[:-1]]
        assert {r.capacity for r in rows} == {next(s for s in packing.SIZES if s >= ends[-1])}
        held += rows[0].capacity
    assert want >= 0.97 * held
    whole = packing.sequences(packing.pack(df, tokens="tokens")).collect()
    assert sum(r.n_tokens for r in whole) == want == sum(sum(r.lengths) for r in whole)


def test_place_takes_the_fullest_bin():
    bins, offsets, held = packing.place([400, 300, 200, 100, 12], (512, 1024))
    assert held == [1024] or sum(held) <= 1536
    assert bins[-1] == 0 and offsets[0] == 0
    assert packing.place([], (512,)) == ([], [], [])
