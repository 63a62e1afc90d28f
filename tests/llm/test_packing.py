import itertools
import random

import numpy as np
import pytest

import __spark_entry__ as registry
from urlaudit.llm import packing


def padding(bounds, lengths, counts):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in zip(lengths, counts, strict=True))


def test_bounds_are_optimal():
    pick = random.Random(3)
    for _ in range(200):
        lengths = sorted(pick.sample(range(1, 60), pick.randint(1, 8)))
        counts = [pick.randint(1, 9) for _ in lengths]
        buckets = pick.randint(1, 5)
        choices = (c for r in range(1, buckets + 1) for c in itertools.combinations(lengths, r) if c[-1] == lengths[-1])
        found = packing.optimal_bounds(lengths, counts, buckets)
        assert len(found) <= buckets
        assert padding(found, lengths, counts) == min(padding(c, lengths, counts) for c in choices)


def check(rows, budget):
    seen, full = set(), {}
    for row in rows:
        fit = max(1, budget // row["padded_to"])
        assert row["n_tokens"] <= row["padded_to"] and row["padding"] == row["padded_to"] - row["n_tokens"]
        assert 0 <= row["slot"] < fit
        place = row["bucket"], row["batch"], row["slot"]
        assert place not in seen
        seen.add(place)
        full.setdefault((row["bucket"], row["batch"]), [fit, 0])[1] += 1
    for (bucket, batch), (fit, n) in full.items():
        assert n == fit or batch == max(b for k, b in full if k == bucket), "only the last batch of a bucket may have room"


@pytest.mark.parametrize("shard_rows", [3, 20_000])
def test_batches(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", shard_rows)
    pick = random.Random(4)
    lengths = [pick.choice([1, 2, 2, 2, 7, 30, 31, 500]) for _ in range(200)]
    rows = packing.pack(spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long"), buckets=4, budget=64).collect()
    assert sorted(row["n_tokens"] for row in rows) == sorted(lengths)
    check(rows, 64)
    kinds = sorted(set(lengths))
    best = min(padding(c, kinds, [lengths.count(k) for k in kinds]) for c in itertools.combinations(kinds, 4) if c[-1] == kinds[-1])
    assert sum(row["padding"] for row in rows) == best


def test_bounds_are_optimal_for_long_lengths():
    """Against the plain dynamic program over all lengths, far beyond a few hundred tokens."""
    pick = random.Random(5)
    for size, longest in ((120, 1_000), (150, 20_000), (90, 10**9)):
        lengths = sorted(pick.sample(range(1, longest), size))
        counts = [pick.choice([1, 1, 2, 50, 1000]) for _ in lengths]
        for buckets in (1, 2, 7, 16, 200):
            found = packing.optimal_bounds(lengths, counts, buckets)
            assert len(found) <= buckets and found[-1] == lengths[-1]
            assert padding(found, lengths, counts) == least_padding(lengths, counts, buckets)


def least_padding(lengths, counts, buckets):
    n, t = np.concatenate([[0], np.cumsum(counts)]).astype(object), np.concatenate([[0], np.cumsum(np.array(lengths, object) * np.array(counts, object))])
    best = [0] + [None] * len(lengths)
    least = None
    for _ in range(min(buckets, len(lengths))):
        best = [None] + [
            min((best[i] + lengths[j - 1] * (n[j] - n[i]) - (t[j] - t[i]) for i in range(j) if best[i] is not None), default=None) for j in range(1, len(lengths) + 1)
        ]
        if best[-1] is not None:
            least = best[-1] if least is None else min(least, best[-1])
    return least


def test_rows_of_one_id_and_length_are_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 100)
    rows = spark.createDataFrame([(None, 5)] * 2_000 + [(1, 9)] * 500, "doc_id long, n_tokens long")
    found = packing.pack(rows, buckets=2, budget=64).collect()
    check(found, 64)
    assert len(found) == 2_500


def test_odd_rows(odd, empty):
    rows = packing.pack(packing.lengths(odd)).collect()
    assert sorted(row["n_tokens"] for row in rows)[:4] == [1, 1, 1, 2] and len(rows) == 12
    check(rows, packing.BUDGET)
    assert packing.pack(packing.lengths(empty)).collect() == []


def test_query(spark, texts):
    rows = registry.queries()["op7_packing"](spark, "/root/testdata/sf0.001").collect()
    assert {row["doc_id"]: row["n_tokens"] for row in rows} == {doc_id: len((text or "").split()) + 1 for doc_id, text in texts}
    check(rows, packing.BUDGET)
