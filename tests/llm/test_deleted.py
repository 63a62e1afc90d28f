import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests.llm.conftest import ODD
from urlaudit.llm import deleted


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def learns(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def reference(rows, weights):
    """Counts by dictionary and the mixture with the given weights."""
    word, pair, before = Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if learns(doc_id):
            own = tokens(text)
            word.update(own)
            pair.update(zip(["<s>", *own[:-1]], own, strict=True))
            before.update(["<s>", *own[:-1]])
    n, v, out = sum(word.values()), len(word), []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((word[w] + 1) / (n + 1 * (v + 1))) for w in own)
        score = 0
        for a, b in zip(["<s>", *own[:-1]], own, strict=True):
            w = weights[min(before[a].bit_length(), deleted.LEVELS - 1)]
            score += math.log10(w[0] * (pair[a, b] / before[a] if before[a] else 0) + w[1] * word[b] / max(1, n) + w[2] / (v + 1))
        out.append((doc_id, not learns(doc_id) if doc_id is not None else False, len(own), sum(word[w] > 0 for w in own), n, base, score))
    return out


def same(found, wanted):
    key = lambda row: (row[0] is None, row[0] or 0, row[2])
    for got, want in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-9)


@pytest.fixture
def weights(monkeypatch):
    kept, learn = [], deleted.learned_weights

    def recorded(*args):
        kept.append(learn(*args))
        return kept[-1]

    monkeypatch.setattr(deleted, "learned_weights", recorded)
    return kept


@pytest.mark.parametrize("block_rows", [7, 2000])
def test_equal_to_dictionaries(documents, texts, weights, monkeypatch, block_rows):
    monkeypatch.setattr(deleted, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(deleted, "SHARD_KEYS", 5_000 if block_rows == 7 else 1_500_000)
    found = [tuple(row) for row in deleted.score(documents).collect()]
    same(found, reference(texts, weights[0]))


def test_odd_rows(odd, empty, weights):
    found = [tuple(row) for row in deleted.score(odd).collect()]
    same(found, reference(ODD, weights[0]))
    assert deleted.score(empty).count() == 0


def test_no_training_row(odd):
    rows = deleted.score(odd.where("doc_id IS NULL")).collect()
    assert [(row["n_known"], row["train_tokens"], row["score"]) for row in rows] == [(0, 0, pytest.approx(len(tokens(ODD[9][1])) * math.log10(0.4)))]


def test_expectation_maximisation_finds_the_mixture():
    pick = np.random.default_rng(3)
    p = np.array([[-1, -3], [-2, -1], [0, -4], [-4, -2]]) - 1.0
    cells = ((1 << 16) | (((p[:, 0] - deleted.LEAST) * deleted.CELLS).astype(int) << 8) | ((p[:, 1] - deleted.LEAST) * deleted.CELLS).astype(int)).astype(np.int64)
    n = pick.integers(10, 100, len(cells)).astype(float)
    weights = deleted.learned_weights(cells, n, 1e-5)
    likelihood = lambda w: (n * np.log(np.column_stack([10.0**p, np.full(len(p), 1e-5)]) @ w)).sum()
    best = max(likelihood(np.array([a, b, 1 - a - b])) for a in np.linspace(0, 1, 101) for b in np.linspace(0, 1 - a, 101) if 1 - a - b > 1e-9)
    assert likelihood(weights[1]) >= best - 0.05
    assert weights.sum(axis=1) == pytest.approx(np.ones(deleted.LEVELS))


def test_the_model_beats_the_base_on_held_out_documents(spark):
    rows = [row for row in registry.queries()["op5_lm_scores"](spark, "/root/testdata/sf0.001").collect() if row["held_out"]]
    assert rows and sum(row["score"] for row in rows) > sum(row["base_score"] for row in rows)


def test_blocks_are_bounded_whatever_the_ids(spark):
    rows = [(None, f"text {k}") for k in range(6_000)] + [(7, f"word {k}") for k in range(6_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [row["count"] for row in deleted.dealt(df, "doc_id", "text", 12).groupBy("block").count().collect()]
    assert max(sizes) < 1_700 and sum(sizes) == 12_000
    parts = {row["id"]: row["n"] for row in deleted.dealt(df, "doc_id", "text", 12).where("block % 2 = 1").groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert None not in parts and (parts == {} or 500 < parts[7] < 1_000)


def test_long_texts_make_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(deleted, "BLOCK_BYTES", 20_000)
    rows = [(k, "some words of a text " * 300) for k in range(40)] + [(None, "some words"), (None, "some words"), (40, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    many = {row["doc_id"]: row["score"] for row in deleted.score(df).where("doc_id IS NOT NULL").collect()}
    monkeypatch.setattr(deleted, "BLOCK_BYTES", 1 << 30)
    one = deleted.score(df).where("doc_id IS NOT NULL").collect()
    assert len(one) == 41 and all(row["base_score"] is not None for row in one) and len(many) == 41
