"""Chunking and vector search against plain restatements."""

import math
import random
import re
import tracemalloc

import numpy as np
import pytest

from stockyard.operators import docs
from stockyard.plans import refresh
from stockyard.sources import tables


def expected_chunks(text, sep, size=800, overlap=100, least=50):
    out, open_ = [], ""
    for paragraph in re.split(sep, text.strip()):
        if open_ and len(open_) + len(paragraph) + 2 > size:
            out.append(open_.strip())
            open_ = f"{open_[-overlap:]}\n\n{paragraph}"
        else:
            open_ = f"{open_}\n\n{paragraph}".strip()
    if open_:
        out.append(open_.strip())
    return [c for c in out if len(c) > least]


def test_chunks(spark):
    rng = random.Random(3)

    def words(n):
        return "".join(rng.choice("abcdé 世\t") for _ in range(n))

    texts = ["", "   ", "\n\n", "x" * 50, "x" * 51, "x" * 900, "\xa0 " + "y" * 60 + "\x1c", "a" * 798 + "\n\nb" * 3]
    texts += ["\n\n".join(words(rng.randrange(400)) for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    texts += ["\n\n\n".join(words(rng.choice([10, 820])) for _ in range(10)) + "\n" for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in docs.chunk(df, "doc_id").orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.content)
        assert r.chunk_no == len(got[r.doc_id]) - 1
    assert {i: c for i, t in enumerate(texts) if (c := expected_chunks(t, r"\n{2,}"))} == got


def test_index(spark):
    body = "\n\n" + "z" * 60
    rows = [
        ("docs/adr/001-why.md", "# The  reason \nmore" + body), ("docs/runbooks/a.md", "text\n## no\n# Yes" + body),
        ("docs/runbook/fail-over_2nd.md", "plain" + body), ("docs/the-architecture.md", "#no heading" + body),
        ("docs/empty.md", " \n"),
    ]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r.source: (r.doc_type, r.title) for r in docs.index_documents(df, "path", "text").collect()}
    assert got == {
        "docs/adr/001-why.md": ("adr", "The  reason"), "docs/runbooks/a.md": ("doc", "Yes"),
        "docs/runbook/fail-over_2nd.md": ("runbook", "fail-over_2nd".replace("-", " ").title()),
        "docs/the-architecture.md": ("architecture", "The Architecture"),
    }


def test_cosine_topk(spark):
    rng = random.Random(4)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(50)] + [(50, [0.0] * 8), (51, None)]
    query = [rng.uniform(-1, 1) for _ in range(8)]
    df = spark.createDataFrame(vectors, "vec_id int, embedding array<double>")
    got = docs.cosine_topk(df, query, 5).collect()

    def score(v):
        return sum(a * b for a, b in zip(v, query)) / math.sqrt(sum(a * a for a in v) * sum(b * b for b in query))

    want = sorted(((score(v), i) for i, v in vectors[:50]), reverse=True)[:5]
    assert [r.vec_id for r in got] == [i for _, i in want]
    assert all(abs(r.score - s) < 1e-12 for r, (s, _) in zip(got, want))


def test_search_of_many_questions(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(4)], f"t{i}") for i in range(80)] + [(90, None, "n"), (91, [0.0] * 4, "z"), (92, [1.0], "s")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, title string")
    asked = df.where("vec_id < 12 or vec_id >= 90").selectExpr("vec_id as query_id", "embedding").where("vec_id <> 92")
    unit = {i: [x / math.sqrt(sum(y * y for y in v)) for x in v] for i, v, _ in rows[:80]}
    got = docs.search(df, asked, k=3, block=5).collect()
    for q in range(12):
        score = {i: sum(a * b for a, b in zip(unit[q], v)) for i, v in unit.items()}
        best = sorted(score, key=lambda i: (-round(score[i], 9), i))[:3]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [round(r.score, 9) for r in own] == [round(score[i], 9) for i in best] and all(r.title == f"t{r.vec_id}" for r in own)
    assert {r.query_id for r in got} == set(range(12))


def test_search_plans_alike_for_any_number_of_questions(spark, monkeypatch):
    """No question passes the driver, and the index is in the plan as often for one block as for many."""
    rng = random.Random(5)
    df = spark.createDataFrame([(i, [rng.random() - 0.5 for _ in range(4)], f"t{i}") for i in range(60)], "vec_id long, embedding array<double>, title string")
    asked = df.selectExpr("vec_id as query_id", "embedding")
    whole = {(r.query_id, r["rank"], r.vec_id) for r in docs.search(df, asked, k=3).collect()}
    monkeypatch.setattr(type(df), "toLocalIterator", lambda *_, **__: pytest.fail("questions came to the driver"))
    many = docs.search(df, asked, k=3, block=7, shard=11)
    assert {(r.query_id, r["rank"], r.vec_id) for r in many.collect()} == whole and len(whole) == 180
    scans = [d._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") for d in (docs.search(df, asked, block=60), many)]
    assert scans[0] == scans[1]


def test_stored_index(spark, tmp_path):
    """Vectors are stored with their payload; few enough tables lose neighbours, wide buckets find all of them."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], f"p{i}") for i in range(400)]
    rows += [(1000 + i, rows[3][1], "copy") for i in range(300)] + [(2000, None, "x"), (2001, [0.0] * 16, "x"), (None, [1.0] * 16, "x")]
    index = spark.createDataFrame(rows, "vec_id long, embedding array<double>, note string")
    asked = spark.createDataFrame([(r[0], r[1]) for r in rows[:40]], "query_id long, embedding array<double>")
    exact = docs.search(index, asked)
    path = str(tmp_path / "index")
    assert docs.build_index(index, path, bucket_length=1e6, hash_tables=1) == 1
    whole = docs.search_index(spark, path, asked)
    key = ["query_id", "rank", "vec_id", "note"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, exact.select(key).collect()))
    assert docs.build_index(index, path, bucket_length=0.1, hash_tables=2) == 2
    few = docs.search_index(spark, path, asked)
    assert 0.1 < docs.recall(few, exact).first().recall < 1
    stored = tables.read(spark, path)
    assert stored.count() == 700 and {"unit", "buckets", "note"} <= set(stored.columns)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_chunks_with_vectors(spark, tmp_path):
    chunks = docs.index_documents(spark.createDataFrame([("docs/a.md", "# T\n\n" + "word " * 40)], "path string, text string"), "path", "text")
    ids = [r.point_id for r in chunks.collect()]
    vectors = spark.createDataFrame([(i, [1.0, 0.0]) for i in ids] + [("gone", [0.0, 1.0])], "point_id string, embedding array<double>")
    refresh.reindex_vectors(chunks, vectors, str(tmp_path / "i"))
    found = docs.search_index(spark, str(tmp_path / "i"), spark.createDataFrame([(1, [2.0, 0.1])], "query_id long, embedding array<double>"), id_column="point_id")
    assert [(r.point_id, r.title) for r in found.collect()] == [(ids[0], "T")]


def test_search_of_an_index_gives_out_winners_only(spark, tmp_path):
    """However many vectors share a bucket, no pair of question and vector becomes a row; parts give the same as the whole."""
    rng = random.Random(6)
    index = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(600)] + [(600, [None] * 8), (601, [])], "vec_id long, embedding array<double>")
    asked = index.where("vec_id % 10 = 0").selectExpr("vec_id as query_id", "embedding")
    path = str(tmp_path / "index")
    docs.build_index(index, path, bucket_length=1e6, hash_tables=2)
    key = ["query_id", "rank", "vec_id"]
    want = sorted(map(tuple, docs.search(index, asked, k=3).select(key).collect()))
    assert len(want) == 180
    for options in ({}, {"block": 7, "shard": 50}):
        found = docs.search_index(spark, path, asked, k=3, **options)
        assert sorted(map(tuple, found.select(key).collect())) == want
    plan = docs.search_index(spark, path, asked, k=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "zip_with" not in plan


def test_nearest_rows_with_ties():
    nearest, _ = docs.ranking()
    rng = random.Random(7)
    matrix = np.array([[rng.choice([-1.0, 0.5, 2.0]) for _ in range(3)] for _ in range(5000)])
    targets = np.array([[rng.choice([-1.0, 0.5, 2.0]) for _ in range(3)] for _ in range(300)])
    order = np.array(rng.sample(range(5000), 5000))
    row, own, score = nearest(targets, matrix, order, 4)
    for r in range(300):
        scores = (targets[r] * matrix).sum(1)
        want = np.lexsort((order, -scores))[:4]
        assert own[row == r].tolist() == want.tolist() and score[row == r].tolist() == scores[want].tolist()
    assert all(len(x) == 0 for x in nearest(targets, matrix[:0], order[:0], 4))


def test_memory_of_a_search_task():
    """A full block against a full shard holds no score per pair, even where all of them tie."""
    nearest, _ = docs.ranking()
    for matrix in (np.random.default_rng(8).normal(size=(docs.INDEX_SHARD, 8)), np.ones((docs.INDEX_SHARD, 8))):
        targets = np.ones((docs.QUERY_BLOCK, 8))
        tracemalloc.start()
        row, own, _ = nearest(targets, matrix, np.arange(len(matrix)), 5)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(row) == len(own) == docs.QUERY_BLOCK * 5 and peak < 100e6
