"""Rankings and joins against plain Python, with a third of all rows on one key."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from urlaudit.operators import skew, status


@pytest.fixture
def skewed(spark):
    rng = random.Random(7)
    keys = ["hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None]) for _ in range(3000)]
    rows = [(k, i, rng.randrange(50), rng.randrange(9)) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "g string, id long, at int, v long").repartition(6)


def expected(pdf, group):
    pdf = pdf.sort_values(["at", "id"])
    by = pdf.groupby(group, dropna=False) if group else pdf.assign(_=0).groupby("_")
    number, total = by.cumcount() + 1, by["v"].cumsum() - pdf["v"]
    before = by["at"].shift(1)
    return {
        int(i): (int(n), int(t), None if b != b else int(b))
        for i, n, t, b in zip(pdf["id"], number, total, before)
    }


@pytest.mark.parametrize("group", [["g"], []])
def test_ordered_run(skewed, group):
    found = skew.ordered_run(
        skewed,
        group,
        [F.asc("at"), F.asc("id")],
        number="nr",
        totals={"total": F.col("v")},
        previous={"before": F.col("at")},
    )
    assert found.columns == ["g", "id", "at", "v", "nr", "total", "before"]
    rows = {r.id: (r.nr, r.total, r.before) for r in found.collect()}
    assert rows == expected(skewed.toPandas(), group)


def test_a_hot_key_joins_whatever_the_key_types_are(spark):
    """An INT key that holds most rows against a BIGINT key, joined by shuffle."""
    log = spark.range(20_000).selectExpr("cast(if(id % 3 = 0, id, 7) AS int) AS url_id", "id AS check_id")
    register = spark.range(0, 30_000, 7).selectExpr("id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {r.known: r.n for r in status.with_known(log, register).groupBy("known").agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    ids = [i if i % 3 == 0 else 7 for i in range(20_000)]
    assert found == {True: sum(i % 7 == 0 for i in ids), False: sum(i % 7 != 0 for i in ids)}


def test_no_module_reaches_below_the_api():
    package = Path(skew.__file__).resolve().parents[1]
    for module in package.rglob("*.py"):
        assert not any(name in module.read_text() for name in ("._jdf", "._jsparkSession", "._jvm")), module


def test_rank_within_keeps_exactly_the_first_n(skewed):
    ranked = skew.rank_within(skewed, F.col("g"), [F.desc("v"), F.asc("at"), F.asc("id")], 5, "id").collect()
    pdf = skewed.toPandas().sort_values(["v", "at", "id"], ascending=[False, True, True])
    wanted = set(pdf.groupby("g", dropna=False).head(5)["id"])
    assert {r.id for r in ranked} == wanted and {r.order_nr for r in ranked} == {1, 2, 3, 4, 5}
