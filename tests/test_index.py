"""The response index that is kept between polls, and the tables it is made of."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tests.test_resolve import frontier_of, login_table, random_web, response, simulate, table
from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.operators import resolve
from urlaudit.sources import index as indexes
from urlaudit.sources.index import KeptIndex
from urlaudit.sources.kept import Kept

PAIRS = StructType([StructField("k", StringType()), StructField("v", StructType([StructField("version", LongType()), StructField("text", StringType())]))])


def pairs(spark, *rows):
    return spark.createDataFrame([(k, (version, text)) for k, version, text in rows], PAIRS)


def contents(df):
    return {r.k: (r.v.version, r.v.text) for r in df.collect()}


def test_a_kept_table_holds_the_newest_of_each_key(spark, tmp_path):
    kept = Kept(spark, str(tmp_path), "pairs", "k", PAIRS, buckets=4)
    assert not kept.exists()
    kept.seed(pairs(spark, ("a", 0, "x"), ("b", 0, "x"), ("c", 0, "x")))
    kept.add(pairs(spark, ("a", 2, "late"), ("d", 1, "new")), "one")
    kept.add(pairs(spark, ("a", 1, "y"), ("b", 1, "y"), ("b", 1, "y")), "two")
    kept.add(pairs(spark, ("a", 1, "y"), ("b", 1, "y")), "two")  # a second attempt
    wanted = {"a": (2, "late"), "b": (1, "y"), "c": (0, "x"), "d": (1, "new")}
    assert contents(kept.read()) == wanted
    keys = spark.createDataFrame([("a",), ("d",), ("z",)], "k string")
    assert contents(kept.lookup(keys)) == {k: wanted[k] for k in "ad"}
    assert {r.k: r.v and r.v.text for r in kept.attach(keys).collect()} == {"a": "late", "d": "new", "z": None}
    kept.fold()
    assert kept.log().count() == 0 and contents(kept.read()) == wanted and contents(kept.base()) == wanted
    kept.add(pairs(spark, ("c", 5, "z")))
    kept.fold()
    kept.fold()
    assert contents(kept.read()) == wanted | {"c": (5, "z")}
    assert not kept.fold_if_long(10)
    assert not [f for f in Path(tmp_path).glob("pairs/base-1/*.parquet") if "a" in spark.read.parquet(str(f)).columns and f.stat().st_size > 10_000]


def test_a_session_finds_a_kept_table_by_its_files(spark, tmp_path):
    Kept(spark, str(tmp_path), "pairs", "k", PAIRS, buckets=4).seed(pairs(spark, ("a", 0, "x")))
    kept = Kept(spark, str(tmp_path), "pairs", "k", PAIRS)
    spark.sql(f"DROP TABLE {kept._table(0)}")  # the files of a table with a path of its own stay
    assert contents(kept.read()) == {"a": (0, "x")}
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {kept._table(0)}").collect()}
    assert said["Num Buckets"] == "4" and said["Type"] == "EXTERNAL"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_above(plan, name):
    """Exchanges on the way from the scan of a base to the root, in the text of a plan."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and f"{name}_0" in line)
    depth, found = lines[at].index("FileScan"), 0
    for line in reversed(lines[:at]):
        begin = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if begin < depth:
            depth = begin
            found += "Exchange" in line and "Broadcast" not in line
    return found


@pytest.mark.parametrize("few, threshold", [(True, "10m"), (False, "-1")])
def test_the_base_is_not_moved(spark, tmp_path, few, threshold):
    urls, rows = random_web(11)
    conf = AuditConfig(redirect_limit=5)
    index = KeptIndex(spark, str(tmp_path), conf, buckets=4).build(table(spark, rows))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        frontier = resolve.materialize(frontier_of(spark, urls[:5]), "frontier")
        assert exchanges_above(plan_of(index.observed(frontier, few)), "nodes") == 0
        assert exchanges_above(plan_of(index.moved(frontier, 1, few)), "jumps_1") == 0
        index.update(table(spark, rows[:3]).withColumn("duration_ms", F.lit(9).cast("long")))  # with a log, what was found is grouped
        assert exchanges_above(plan_of(index.observed(frontier, few)), "nodes") == (1 if few else 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("seed, limit, few", [(21, 5, True), (22, 3, False), (23, 0, True)])
def test_updates_equal_the_simulation(spark, tmp_path, seed, limit, few):
    urls, rows = random_web(seed)
    pick = random.Random(seed)
    pick.shuffle(rows)
    conf, login = AuditConfig(redirect_limit=limit), [urls[5], urls[6]]
    gates = {"robots_rules": spark.createDataFrame([("h3.org", "disallow", "/p1", None)], schema.ROBOTS_RULES), "login_pages": login_table(spark, *login)}
    index = KeptIndex(spark, str(tmp_path), conf, buckets=4, **gates)
    parts = [rows[:100], rows[100:101], rows[101:]]
    stamped = lambda part, hour: table(spark, part).withColumn("observed_at", F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp"))
    seen = {}
    for hour, part in enumerate(parts):
        index.update(stamped(part, hour))
        seen.update({(r[0], r[1]): r for r in part})
    changed = [r for r in rows if r[2] in (301, 302, 307)][:6]  # redirects that have become plain answers
    again = [(r[0], r[1], 200, None, *r[4:]) for r in changed]
    index.update(stamped(again, 9))
    seen.update({(r[0], r[1]): r for r in again})
    index.update(stamped(again, 9))  # delivered twice
    found = resolve.resolve(frontier_of(spark, urls), None, conf, index=index, few=few, **gates).collect()
    whole = resolve.resolve(frontier_of(spark, urls), table(spark, list(seen.values())), conf, **gates).collect()
    key = lambda r: (r.category, r.url, r.method, r.redirect_count, r.route)
    assert {r.url_id: key(r) for r in found} == {r.url_id: key(r) for r in whole} and len(found) == len(urls)
    wanted = {i: simulate(u, seen, limit, login, [u for u in urls if u.startswith("http://h3.org/p1")]) for i, u in enumerate(urls)}
    assert {r.url_id: (r.category, r.url, r.method, r.redirect_count) for r in found} == wanted


def test_only_what_has_come_is_grouped_and_only_what_changes_is_doubled(spark, tmp_path):
    conf = AuditConfig(redirect_limit=7)
    chain = lambda host, n: [(f"http://{host}/{i}", "HEAD", 301, f"http://{host}/{i + 1}", {}, None, None, None, 1) for i in range(n)]
    old = [r for h in range(50) for r in chain(f"h{h}.org", 20)]
    index = KeptIndex(spark, str(tmp_path), conf, buckets=4).build(spark.createDataFrame(old, schema.RESPONSES))
    sizes = [kept.base().count() for kept in index.levels]
    assert sizes == [1000] * 3
    new = [("http://h7.org/12", "HEAD", 308, "http://h9.org/0", {}, None, None, None, 1), ("http://new.org/", "HEAD", 302, "http://h8.org/3", {}, None, None, None, 1)]
    assert index.update(spark.createDataFrame(new, schema.RESPONSES)) == 2
    # One link of a chain and one start: of level k the jumps of 2**k steps that pass through them.
    assert [kept.log().count() for kept in index.levels] == [2, 3, 5]
    assert index._nodes().log().count() == 2
    found = resolve.resolve(frontier_of(spark, ["http://h7.org/10", "http://new.org/"]), None, conf, index=index, few=True).collect()
    assert {r.original_url: (r.url, r.redirect_count) for r in found} == {"http://h7.org/10": ("http://h9.org/4", 8), "http://new.org/": ("http://h8.org/9", 8)}


def links(index):
    """The jumps of each level, without their versions."""
    return [{r.state: (r.hop.to_url, r.hop.to_method, r.hop.steps) for r in kept.read().collect() if r.hop.to_url} for kept in index.levels]


def updated(spark, path, monkeypatch, share):
    """An index after an update that adds and ends redirects, how many these were, and an index of the same responses built at once."""
    monkeypatch.setattr(indexes, "REMAKE_SHARE", share)
    _, rows = random_web(31)
    conf = AuditConfig(redirect_limit=5)
    at = lambda part, hour: table(spark, part).withColumn("observed_at", F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp"))
    first, more = at(rows[:150], 1), at([*rows[150:], *[(r[0], r[1], 200, None, *r[4:]) for r in rows[:20]]], 2)
    index = KeptIndex(spark, f"{path}/index", conf, buckets=4).build(first)
    changed = index.update(more)
    return index, changed, KeptIndex(spark, f"{path}/whole", conf, buckets=4).build(first.unionByName(more))


def test_a_large_update_makes_the_jumps_anew(spark, tmp_path, monkeypatch):
    index, changed, whole = updated(spark, tmp_path / "anew", monkeypatch, indexes.REMAKE_SHARE)
    assert [kept.log().count() for kept in (index._nodes(), *index.levels)] == [0] * (1 + len(index.levels))
    assert links(index) == links(whole)
    little, by_little, same = updated(spark, tmp_path / "little", monkeypatch, 0)
    assert all(kept.log().count() for kept in (little._nodes(), *little.levels))
    assert links(little) == links(same) == links(whole) and by_little == changed > 0


def test_jumps_made_anew_in_part_are_made_anew_by_the_next_update(spark, tmp_path, monkeypatch):
    index, _, _ = updated(spark, tmp_path, monkeypatch, 10**9)
    broken, replace = [], Kept.replace

    def breaks(kept, rows, number):
        if kept.name == "jumps_1" and not broken:
            broken.append(kept.name)
            raise OSError("no space")
        replace(kept, rows, number)

    monkeypatch.setattr(Kept, "replace", breaks)
    rows = [response(f"http://h{i % 7}.org/p{i}", "HEAD", 301, f"http://h{(i + 1) % 7}.org/p{i + 1}") for i in range(60)]
    more = table(spark, rows).withColumn("observed_at", F.lit("2024-01-02").cast("timestamp"))
    with pytest.raises(OSError):
        index.update(more)
    monkeypatch.setattr(indexes, "REMAKE_SHARE", 0)
    index = KeptIndex(spark, index.root, index.conf, buckets=4)
    index.update(more)
    levels = links(index)
    assert broken and levels[0]["HEAD http://h0.org/p0"] == ("http://h1.org/p1", "HEAD", 1)
    assert levels[2]["HEAD http://h0.org/p0"] == ("http://h4.org/p4", "HEAD", 4)
