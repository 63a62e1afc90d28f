import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests.llm.conftest import ODD
from urlaudit.llm import resampling

LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute_force(docs, target, share=5, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    all_s, all_t = float(s.total()), float(t.total())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[4], r[2]))
    rank = {id(r): k for k, r in enumerate(able[: len(able) * share // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_checksums_of_runs():
    pick = random.Random(3)
    words = ["".join(pick.choices("abcz09é漢", k=pick.choice([1, 2, 5, 31, 63, 64, 65, 200, 5000]))).encode() for _ in range(300)]
    crc, size, first = resampling.words_of([b" ".join(words)])
    assert first.tolist() == [0, 300]
    for width, found in enumerate(resampling.runs(crc, size), 1):
        assert found.tolist() == [zlib.crc32(b" ".join(words[i : i + width])) for i in range(len(words) - width + 1)]


@pytest.mark.parametrize("segment, block", [(1 << 16, 1 << 20), (4, 16), (1, 1), (7, 200)])
def test_lines_and_cuts_change_no_sum(segment, block, monkeypatch):
    monkeypatch.setattr(resampling, "SEGMENT", segment)
    monkeypatch.setattr(resampling, "BLOCK", block)
    pick = random.Random(4)
    texts = ["".join(pick.choices(["a", "B", "cd", "é", " ", " ", "\n", "\n\n", "-", "longer", "0"], k=pick.randint(0, 80))) for _ in range(60)]
    gains = np.random.default_rng(1).integers(-500, 500, resampling.BUCKETS)
    counts, weights = np.zeros(resampling.BUCKETS, np.int64), np.zeros(len(texts), np.int64)
    crossing = resampling.Crossing()
    for segments, owners in resampling.segment_blocks(texts):
        lines, places = resampling.distinct(segments)
        words, times = resampling.words_of(lines), np.bincount(places)
        for found, owner in resampling.inner_runs(*words):
            counts += np.bincount(found, times[owner], resampling.BUCKETS).astype(int)
            of_line = np.bincount(owner, gains[found], len(lines))
            weights += np.bincount(owners, of_line[places], len(texts)).astype(int)
        for found, text in crossing.runs(words, places, owners):
            counts += np.bincount(found, minlength=resampling.BUCKETS)
            weights += np.bincount(text, gains[found], len(texts)).astype(int)
    expected = [[bucket(f) for f in features(text)[1]] for text in texts]
    assert counts.tolist() == np.bincount(sum(expected, []), minlength=resampling.BUCKETS).tolist()
    assert weights.tolist() == [int(gains[found].sum()) if found else 0 for found in expected]


def test_each_distinct_line_is_counted_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "one two three four\nfive six") for i in range(500)], "doc_id long, text string").coalesce(2)
    lines = docs.select("text").mapInArrow(resampling._distinct_lines, "line binary, n long").collect()
    assert len(lines) == 4 and sum(r["n"] for r in lines) == 1000
    counts = {r["bucket"]: r["n"] for r in resampling.bucket_counts(docs).collect()}
    assert counts == {b: 500 * n for b, n in Counter(map(bucket, features("one two three four\nfive six")[1])).items()}


def test_odd_rows(spark, odd, empty):
    target = odd.where("doc_id < 3")
    expected = brute_force([(i, text) for i, text in ODD], [text for i, text in ODD if i in (1, 2)], share=50, least=1)
    assert result(resampling.resample(odd, target, share=50, min_words=1)) == expected
    assert resampling.resample(empty, target).count() == 0
    no_target = [row[:3] for row in brute_force([(i, text) for i, text in ODD], [])]
    assert sorted(tuple(r) for r in resampling.resample(odd, empty).select("doc_id", "n_features", "weight").where("doc_id is not null").collect()) == sorted(
        row for row in no_target if row[0] is not None
    )


def test_ties_go_to_the_smaller_id(spark):
    same = spark.createDataFrame([(7, "a b c")] * 3 + [(5, "a b c")], "doc_id long, text string")
    ranked = resampling.resample(same, same, share=100, min_words=1)
    assert sorted(r["rank"] for r in ranked.collect()) == [1, 2, 3, 4]
    assert result(ranked) == brute_force([(7, "a b c")] * 3 + [(5, "a b c")], ["a b c"] * 4, share=100, least=1)


def test_query(spark, texts):
    target = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    found = registry.queries()["op13_importance_resampling"](spark, "/root/testdata/sf0.001")
    assert result(found) == brute_force(texts, target)
    assert found.where(F.col("rank").isNotNull()).count() > 0
