"""The as-of join and the histogram rank against brute force."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from stockyard.operators.asof import first_after
from stockyard.operators.ranking import rank_desc

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("bucket", [1, 60, 3600])
@pytest.mark.parametrize("seed, span_seconds, micros", [(1, 200, False), (2, 100_000, True), (3, 5, True)])
def test_first_after(spark, seed, span_seconds, micros, bucket):
    rng = random.Random(seed)

    def when():
        if rng.random() < 0.03:
            return None
        return T0 + timedelta(
            seconds=rng.randrange(span_seconds), microseconds=rng.randrange(1_000_000) if micros else 0
        )

    # one key holds a third of the rows
    key = lambda: rng.choice([None, "hot", "hot", "hot", "a", "b", "c", "d", "e"])
    left = [(i, key(), when()) for i in range(600)]
    right = [(key(), when()) for _ in range(400)]
    got = first_after(
        spark.createDataFrame(left, "id int, k string, at timestamp_ntz"),
        spark.createDataFrame(right, "k string, seen timestamp_ntz"), "k", "at", "seen", "next",
        bucket_seconds=bucket,
    ).collect()
    assert len(got) == len(left)
    want = {}
    for i, k, t in left:
        later = [s for q, s in right if k is not None and t is not None and q == k and s is not None and s > t]
        want[i] = min(later, default=None)
    assert {r.id: r.next for r in got} == want


def test_rank_desc(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", None, "b"]), rng.randrange(6)) for i in range(200)]
    got = rank_desc(spark.createDataFrame(rows, "id int, g string, n int"), ["g"], "n", "place").collect()
    counts = Counter((g, n) for _, g, n in rows)
    want = {i: 1 + sum(c for (h, m), c in counts.items() if h == g and m > n) for i, g, n in rows}
    assert {r.id: r.place for r in got} == want
