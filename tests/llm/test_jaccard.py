import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import compare
from tests.llm.conftest import ODD
from urlaudit.llm import hashing, jaccard
from urlaudit.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text):
    own = words(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def brute(rows, threshold=0.8):
    """Links and component of each row."""
    sets = [grams(text) for _, text in rows]
    links, reach = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while reach[k] != k:
            k = reach[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and (words(rows[a][1]) == words(rows[b][1]) or len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9):
                links[a] += 1
                links[b] += 1
                reach[root(a)] = root(b)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        smallest[root(k)] = min(doc_id, smallest.get(root(k), doc_id))
    return [(doc_id, links[k], smallest[root(k)]) for k, (doc_id, _) in enumerate(rows)]


def found(df):
    return [(row["doc_id"], row["n_links"], row["component_id"]) for row in df.collect()]


def test_texts_are_copied_a_block_at_a_time(monkeypatch):
    """Of a batch of long texts no more than a block is copied at once, and the rows are those of ``blocks``."""
    monkeypatch.setattr(hashing, "BLOCK", 1_000)
    texts = [b"", None, b"one", b"x" * 3_000, *[b"two words " * 30] * 20, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["row", "text"])
    found = list(hashing.read_in_blocks(batch, 1))
    assert [row for rows, _ in found for row in rows.column(0).to_pylist()] == list(range(len(texts)))
    assert [text for _, some in found for text in some] == [text or b"" for text in texts]
    assert [len(some) for _, some in found] == [end - start for start, end in hashing.blocks([t or b"" for t in texts], 1_000)]
    assert all(rows.num_rows == len(some) and (len(some) == 1 or sum(map(len, some)) <= 1_000) for rows, some in found)
    assert list(hashing.read_in_blocks(batch.slice(0, 0), 1)) == []


def test_signatures_of_blocks(spark):
    """Classes, prefixes and sketches do not depend on how rows are cut into blocks or batches."""
    docs = jaccard.numbered(spark.createDataFrame(ODD, "doc_id long, text string").coalesce(1), "row")
    every = [jaccard.signed(docs, 5, 4, 3).orderBy("row").collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        every.append(jaccard.signed(docs, 5, 4, 3).orderBy("row").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert every[0] == every[1] and len(every[0]) == len(ODD)
    assert [row["key"] is None for row in every[0]] == [not words(row["text"]) for row in docs.orderBy("row").collect()]


def test_recall_and_depth():
    assert jaccard.matched_depth(8, 24, 0.8, 0.9995) == 5
    assert jaccard.recall(5, 24, 0.8) > 0.9995 > jaccard.recall(6, 24, 0.8)
    assert jaccard.matched_depth(8, 1, 0.5, 1.0) == 1


@pytest.mark.parametrize("block", [3, 512])
def test_equal_to_brute_force(spark, monkeypatch, block):
    """Chains of near copies, copies and others; with blocks of three a group is cut many times."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "TASK_ROWS", 50 if block == 3 else 2_000)
    pick = np.random.default_rng(1)
    base = [f"w{k}" for k in pick.integers(0, 5000, 120)]
    rows = []
    for k in range(60):
        if k % 3 == 0:
            base = [*base[:-2], f"new{k}", f"more{k}"]
        text = list(base)
        if k % 5 == 1:
            text[int(pick.integers(0, 120))] = f"edit{k}"
        rows.append((k, " ".join(text)))
    rows += [(100 + k, " ".join(f"v{x}" for x in pick.integers(0, 5000, 50))) for k in range(20)]
    assert sorted(found(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))) == sorted(brute(rows))


def test_small_tables(documents, texts):
    assert sorted(found(jaccard.near_duplicates(documents))) == sorted(brute(texts))


def test_odd_rows(odd, empty):
    rows = {row["doc_id"]: row for row in jaccard.near_duplicates(odd).collect()}
    assert rows[1]["n_links"] == rows[2]["n_links"] == 1 and rows[2]["component_id"] == 1 and not rows[2]["kept"]
    assert all(rows[k]["n_links"] == 0 and rows[k]["kept"] for k in (3, 4, 5, 6, 7, 10, 11))
    assert rows[8]["n_copies"] == 2 and rows[8]["kept"]
    assert rows[None]["n_links"] == 0 and not rows[None]["kept"]
    assert jaccard.near_duplicates(odd).count() == len(ODD)
    assert jaccard.near_duplicates(empty).count() == 0


def test_rows_without_an_id_or_with_a_shared_one(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(None, a), (None, a + " more"), (None, b), (5, b + " more"), (5, c), (6, c + " more"), (7, a + " x " + b)]
    df = jaccard.numbered(spark.createDataFrame(rows, "doc_id long, text string"), "row")
    out = {row["row"]: row for row in jaccard.near_duplicates(df, row_col="row").collect()}
    text = {row["row"]: row["text"] for row in df.collect()}
    got = sorted((text[k], row["n_links"], row["component_id"]) for k, row in out.items() if row["doc_id"] != 7)
    assert got == [(a, 1, None), (a + " more", 1, None), (b, 1, 5), (b + " more", 1, 5), (c, 1, 5), (c + " more", 1, 5)]
    left = [text[k] for k, row in out.items() if row["first"]]
    assert len(left) == 4 and {b + " more", c, a + " x " + b} <= set(left) and {a, a + " more"} & set(left)


def test_common_counts_in_columns():
    pick = np.random.default_rng(2)
    sets = [np.unique(pick.integers(0, 300, n)).astype(np.uint64) for n in (0, 5, 100, 250, 250)]
    for columns in (7, 4096):
        want = [[0 if a == b and False else len(np.intersect1d(x, y)) for b, y in enumerate(sets)] for a, x in enumerate(sets)]
        got = jaccard.common_counts(sets, columns)
        assert all(got[a][b] == want[a][b] for a in range(5) for b in range(5) if a != b)


def test_word_hashes_tell_words_and_texts_apart():
    texts = [b"", b"One two", b"  two\tONE \x0b one", "ünï two".encode(), b""]
    hashes, first = hashing.word_hashes(texts)
    own = [word for text in texts for word in words(text.decode())]
    assert np.diff(first).tolist() == [0, 2, 3, 2, 0]
    for a, x in zip(hashes, own, strict=True):
        for b, y in zip(hashes, own, strict=True):
            assert (a == b) == (x == y)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(900, 800), (900, 700), (700, 700)]
    got = {row["id"]: row["component"] for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    neighbours = defaultdict(set)
    for a, b in edges:
        neighbours[a].add(b)
        neighbours[b].add(a)
    for node in neighbours:
        seen, todo = {node}, [node]
        while todo:
            new = neighbours[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[node] == min(seen)


def test_sql(spark):
    assert compare.difference(spark, compare.connect("/root/testdata/sf0.001"), "op2_ngram_jaccard", "/root/testdata/sf0.001") is None
