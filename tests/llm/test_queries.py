"""The registered queries: against their SQL answers, and the pipeline against its stages done plainly."""

import pytest

import corpus_pipeline
from stockyard.llm import queries as llm
from stockyard.llm import packing, quality, toxicity
from tests.llm.test_operators import brute_groups, brute_repeats
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_against_sql(spark, root, name):
    assert compare(llm.queries()[name](spark, root), connect(root), llm.oracle_sql()[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 11))


def test_pipeline(spark, root):
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality.scores(docs, labels).collect() if r.predicted}
    docs = docs.where(docs.doc_id.isin(list(good)))
    clean = {r.doc_id for r in toxicity.scores(docs, labels).collect() if not r.predicted}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in clean)
    groups = brute_groups(rows)
    rows = [r for r in rows if groups[r[0]][2]]
    left = {i: n - repeated for i, (n, repeated) in brute_repeats(rows).items() if n > repeated}
    got = {}
    for r in corpus_pipeline.run(spark, root).collect():
        assert r.n_tokens == sum(r.lengths) <= r.capacity and r.capacity in packing.SIZES
        for i, n in zip(r.doc_ids, r.lengths):
            got[i] = got.get(i, 0) + n
    assert got == left
