"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, for every operator and stage."""

import random

import public_tokenizers
import pytest

import corpus_pipeline
from stockyard.llm import bpe, fingerprint, html, language, near_duplicates, neighbours, packing, passages, quality, toxicity

#: columns named like those the operators make themselves
CLASH = "key string, node long, component string, kept int, kept_id long, number long, spans string, span_id long, copy int, label int, h double, n int, id string, score string, row long, shard int, range int, edge int, _rest int, text2 string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
LABELS = "doc_id long, quality int, toxic int, text string, score double"
EXTRA = ("k", 1, "c", 1, 2, 3, "s", 4, 5, 6, 7.0, 8, "i", "s", 9, 10, 11, 12, 13, "t")
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def rows():
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(30_000))
    some = [" ".join(f"v{rng.randrange(500)}" for _ in range(80)) for _ in range(20)]
    texts = [(None, None), (None, some[0]), (None, some[0]), (1, None), (1, None), (2, ""), (3, " \n\t"), (4, long), (5, long), (6, "x" * 60_000), (7, "!!! 123")]
    texts += [(10 + i, t) for i, t in enumerate(some)] + [(10, some[0]), (11, "another text under one id"), (-5, some[3]), (40, some[3].upper())]
    return [(i, t, None if i is None else ["en", "fr", None][i % 3], None, None if t is None else len(t), *EXTRA) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    told = [(i, i % 2, (i + 1) % 2, "t", 0.5) for i in range(-5, 30)] + [(None, 1, 1, None, None), (3, None, None, "t", 0.5), (12, 0, 1, "t", 0.5), (12, 1, 0, "t", 0.5)]
    return spark.createDataFrame(told, LABELS)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


OPERATORS = {
    "passages": lambda d, _: passages.report(d),
    "bpe": lambda d, _: bpe.digests(d, *VOCABULARY),
    "near_duplicates": lambda d, _: near_duplicates.groups(d),
    "language": lambda d, _: language.predictions(d),
    "fingerprints": lambda d, _: fingerprint.edited(d),
    "quality": lambda d, labels: quality.scores(d, labels),
    "toxicity": lambda d, labels: toxicity.scores(d, labels),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(docs, nothing, labels, no_labels, name):
    got = OPERATORS[name](docs, labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows())
    assert OPERATORS[name](nothing, labels).collect() == []
    if name in ("quality", "toxicity"):
        assert len(OPERATORS[name](docs, no_labels).collect()) == len(rows())


def test_values(docs, labels):
    told = {(r.doc_id, r.n_shingles): r for r in near_duplicates.groups(docs).collect()}
    assert told[None, 76].component_id is None and told[None, 76].kept
    assert told[13, 76].component_id == -5 and not told[13, 76].kept and told[40, 76].component_id == -5
    assert told[1, 0].kept and told[2, 0].kept and told[5, told[4, 29996].n_shingles].component_id == 4
    assert {r.lang_pred for r in language.predictions(docs).collect() if r.doc_id in (1, 2, 3, 7)} == {"und"}
    repeats = {(r.doc_id, r.n_words): r.n_repeated for r in passages.report(docs).collect()}
    assert repeats[5, 30_000] == 30_000 and repeats[4, 30_000] == 0 and repeats[None, 80] == 0 and repeats[13, 80] == 80
    assert {r.n_tokens for r in bpe.digests(docs, *VOCABULARY).collect() if r.doc_id in (1, 2)} == {0}
    packed = packing.pack(docs).collect()
    assert sum(r.n_tokens for r in packed) == sum(len((r[1] or "").split()) for r in rows())
    assert len({r.doc_id for r in packed}) == len({r[0] for r in rows()})


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing).collect() == [] and packing.sequences(packing.pack(nothing)).collect() == []


def test_vectors(spark):
    kind = "vec_id long, embedding array<float>, id long, v string, h long, entry int"
    some = [(i, [float(i % 3), 1.0], 1, "v", 2, 3) for i in range(60)] + [(None, [1.0, 1.0], 1, "v", 2, 3), (3, None, 1, "v", 2, 3), (0, [0.0, 1.0], 1, "v", 2, 3)]
    df = spark.createDataFrame(some, kind)
    got = neighbours.search(df, df.where("vec_id % 20 = 0"), k=20).collect()
    best = [i for i in range(60) if i % 3 == 2]
    assert sorted(r.vec_id for r in got if r.query_id == 0) == list(range(1, 21))  # all tie: the smaller ids
    assert sorted(r.vec_id for r in got if r.query_id == 20) == sorted([i for i in best if i != 20] + [1])
    empty = spark.createDataFrame([], kind)
    assert neighbours.search(empty, empty).collect() == [] and neighbours.search(df, empty).collect() == []


def test_pages(spark):
    kind = "page_id long, url string, html string, text string, n_chars string, h int"
    long = "<html><body><nav>menu</nav><article>" + "<p>Many words stand here, one after another.</p>" * 5000 + "</article></body></html>"
    some = [(None, None, None, "t", "n", 1), (1, "u", "", "t", "n", 1), (1, "u", "", "t", "n", 1), (2, None, "no markup at all", "t", "n", 1), (3, "u", "<p", "t", "n", 1), (4, "u", long, "t", "n", 1), (5, "u", "<p>&#xD800; a", "t", "n", 1)]
    got = html.main_texts(spark.createDataFrame(some, kind)).collect()
    assert len(got) == len(some)
    assert {r.page_id: r.text for r in got if r.page_id in (None, 1)} == {None: "", 1: ""}
    assert html.main_texts(spark.createDataFrame([], kind)).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, nothing, labels, tmp_path, name, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = stage(spark, docs, str(tmp_path))
    if name == "packing":
        assert sum(r.n_tokens for r in got.collect()) == sum(len((r[1] or "").split()) for r in rows())
    else:
        assert got.columns == docs.columns
        kept = got.collect()
        assert {r.doc_id for r in kept} <= {r[0] for r in rows()} and all(tuple(r)[5:] == EXTRA for r in kept)
        if name == "near duplicates":
            assert sum(r.doc_id is None for r in kept) == 3 and sum(r.doc_id == 10 for r in kept) == 1 and -5 in {r.doc_id for r in kept}
        if name == "repeated passages":
            assert 5 not in {r.doc_id for r in kept} and {1, 2, 3} <= {r.doc_id for r in kept}
    stage(spark, nothing, str(tmp_path)).collect()
