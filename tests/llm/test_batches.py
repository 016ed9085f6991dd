"""What goes to workers at once, and what they look up once for it."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from stockyard.llm import bpe, common, passages, toxicity


def test_texts_are_written_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    def most(rows):
        return max(r.n for r in common.written(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"), "sizes", rows).collect())

    assert most(700) == 700 and most(None) == 5000 and spark.conf.get(name) == before


def test_passages_send_few_texts_at_once(spark, monkeypatch):
    asked = []
    whole = passages.written
    monkeypatch.setattr(passages, "written", lambda df, name, rows=None: asked.append((name, rows)) or whole(df, name, rows))
    text = " ".join(f"w{i}" for i in range(80))
    found = passages.repeated(spark.createDataFrame([(1, text), (2, "other " + text)], "doc_id long, text string")).collect()
    assert [(r.doc_id, len(r.spans) > 0) for r in found] == [(2, True)]
    assert dict(asked)["suffixes"] == dict(asked)["extents"] == passages.TEXT_ROWS


def test_extents_go_to_workers_in_small_batches(spark, monkeypatch):
    """Each extent makes up to 41 rows there, one per window."""
    asked = []
    whole = passages.written
    monkeypatch.setattr(passages, "written", lambda df, name, rows=None: asked.append((name, rows)) or whole(df, name, rows))
    text = " ".join(f"w{i}" for i in range(80))
    found = passages.repeated(spark.createDataFrame([(1, text), (2, "other " + text)], "doc_id long, text string")).collect()
    assert [(r.doc_id, len(r.spans) > 0) for r in found] == [(2, True)]
    assert dict(asked)["told"] == dict(asked)["later-windows"] == passages.EXTENT_ROWS


def test_toxicity_looks_each_different_word_up_once(monkeypatch):
    words = ["alpha", "beta", "w" * 300, "alpha", "\u00e9t\u00e9", "beta", "alphabet"]
    counts = pa.table({"order": [4, 6, 8], "bucket": [1 << 7 | 2, 5, 6], "toxic": [3, 1, 1], "plain": [1, 2, 4]})
    model = toxicity.Model(counts, pa.table({"triple": pa.array([1, 2], pa.int32()), "before": [1, 3]}))
    asked = []
    find = toxicity.Places.find
    monkeypatch.setattr(toxicity.Places, "find", lambda self, keys: asked.append(len(keys)) or find(self, keys))

    def ratios(texts):
        asked.clear()
        return model.word_ratios(toxicity.Letters(pa.array(texts))), sum(asked)

    once, few = ratios(words)
    again, same = ratios([" ".join(words), None, "", *words * 3])
    assert same == few and len(again) == 4 * len(words)
    assert np.array_equal(again, np.tile(once, 4))
    assert np.array_equal(once, np.concatenate([ratios([w])[0] for w in words]))
    assert len(model.word_ratios(toxicity.Letters(pa.array(["", None, "1 2"])))) == 0


def test_a_cut_of_one_word_is_that_word():
    """Most cuts are; they are not joined anew and do not take the place of cuts of several words."""
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    found = codec.encode_cuts({" plain", " two,", ""})
    assert found[" plain"] is codec.words.get(" plain") and codec.cuts.get(" plain") is None
    assert codec.cuts.get(" two,") == found[" two,"] and found[""] == ("", 0, b"")
    assert [f[2] for f in found.values()] == [c.encode() for c in found]
