import math

import numpy as np
import pytest

import __spark_entry__ as registry
import compare
from urlaudit.llm import embeddings


def brute(rows, threshold=0.95):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    links, label = [0] * n, list(range(n))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(n):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if rows[a][0] is not None and rows[b][0] is not None and ok(x) and ok(y) and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if (x == y).all() or x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    label[root(a)] = root(b)
    least = {}
    for k, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[root(k)] = min(vec_id, least.get(root(k), vec_id))
    return sorted([(vec_id, links[k], least.get(root(k)), vec_id is not None and vec_id == least[root(k)]) for k, (vec_id, _) in enumerate(rows)], key=repr)


def found(df):
    return sorted([tuple(row) for row in df.collect()], key=repr)


@pytest.mark.parametrize("block", [4, 512])
def test_groups_cut_into_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "TASK_ROWS", 200 if block == 4 else 2_000)
    pick = np.random.default_rng(4)
    centre = pick.standard_normal(32)
    rows = [(k, (centre + 0.05 * pick.standard_normal(32)).tolist()) for k in range(40)]  # all alike
    rows += [(100 + k, rows[k % 3][1]) for k in range(12)]  # copies
    rows += [(200 + k, pick.standard_normal(32).tolist()) for k in range(40)]
    assert found(embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0, 0.0, 0.0])]
    rows += [(10, [1.0, 0.01]), (10, [1.0, 0.01]), (None, [1.0, 0.0]), (11, [-1.0, 0.0]), (12, [-0.0, 5.0]), (13, [0.0, 5.0]), (14, [1e300, 1e300]), (15, [1e-300, 1e-300])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, key string, n string")
    assert found(embeddings.near_duplicates(df)) == [r if r[0] not in (14, 15) else r for r in brute([(i, v if i not in (14, 15) else [1.0, 1.0]) for i, v in rows])]
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_recall_near_the_threshold(spark):
    """Pairs of cosine 0.951 in 64 dimensions, the hardest that have to be found."""
    pick = np.random.default_rng(6)
    rows = []
    for k in range(400):
        a, b = pick.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (0.951 * a + math.sqrt(1 - 0.951**2) * b).tolist())]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(row["n_links"] for row in got) / 800 > 0.98
    assert all(row["component_id"] in (row["vec_id"], row["vec_id"] - 1) for row in got)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(registry.queries()["op10_embedding_near_duplicates"](spark, folder)) == brute(rows)


def test_sql(spark):
    assert compare.difference(spark, compare.connect("/root/testdata/sf0.001"), "op10_embedding_near_duplicates", "/root/testdata/sf0.001") is None
