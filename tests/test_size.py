"""What a large table would cost: no broadcast of misjudged tables, each table written once, small tables made ready once."""

from pathlib import Path

from pyspark.sql import functions as F

from tests.test_index import plan_of
from tests.test_resolve import frontier_of, login_table, response, table
from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.operators import gates, resolve
from urlaudit.plans.queries import QUERIES
from urlaudit.session import CODE_LIMIT, CODE_SETTING, SIZE_FACTOR, SIZE_SETTING, materialize, sized_in_memory
from urlaudit.sources import index as indexes
from urlaudit.sources import kept as kept_tables
from urlaudit.sources import projections as tables
from urlaudit.sources import sinks
from urlaudit.sources.index import KeptIndex
from urlaudit.streaming import jobs

CONF = AuditConfig(redirect_limit=3)
ROWS = [response("http://a.org/1", "HEAD", 301, "http://a.org/2"), response("http://a.org/2", "HEAD", 200)]


def test_a_well_compressed_table_is_not_broadcast(spark):
    urls = spark.range(20_000).select(F.lit("http://a.example.org/" + "x" * 80).alias("url"))
    keys, rows = materialize(urls, "keys"), materialize(urls, "rows")
    size = sum(Path(f.removeprefix("file:")).stat().st_size for f in keys.inputFiles())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * size))
    try:
        assert "BroadcastHashJoin" in plan_of(rows.join(keys, "url", "left_semi"))
        with sized_in_memory(spark):
            assert "BroadcastHashJoin" not in plan_of(rows.join(keys, "url", "left_semi"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_an_update_of_the_index_is_sized_in_memory(spark, tmp_path, monkeypatch):
    index = KeptIndex(spark, str(tmp_path), CONF, buckets=2).build(table(spark, ROWS[:1]))
    seen, before = [], spark.conf.get(SIZE_SETTING)
    edges = indexes.redirect_edges
    monkeypatch.setattr(indexes, "redirect_edges", lambda *given, **named: seen.append(spark.conf.get(SIZE_SETTING)) or edges(*given, **named))
    index.update(table(spark, ROWS[1:]))
    assert seen == [SIZE_FACTOR] and spark.conf.get(SIZE_SETTING) == before


def test_a_table_of_the_index_is_written_once(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(kept_tables, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    index = KeptIndex(spark, str(tmp_path), CONF, buckets=2).build(table(spark, ROWS))
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), str(tmp_path / "status"))
    assert written == []
    assert [(r.state, r.hop.to_url) for r in index.levels[1].base().collect()] == [("HEAD http://a.org/1", "http://a.org/2")]


def test_the_tables_of_the_gates_are_made_ready_once(spark, monkeypatch):
    indexed, plain = [], gates.robots_index
    monkeypatch.setattr(gates, "robots_index", lambda rules: indexed.append("_plain" in rules.columns) or plain(rules))
    rules = spark.createDataFrame([("a.org", "disallow", "/2", None)], schema.ROBOTS_RULES)
    found = resolve.resolve(
        frontier_of(spark, ["http://a.org/1", "http://a.org/2"]), table(spark, ROWS), CONF, robots_rules=rules, login_pages=login_table(spark, "http://a.org/9")
    ).collect()
    assert {r.original_url: r.category for r in found} == dict.fromkeys(["http://a.org/1", "http://a.org/2"], "Blocked_By_Robots_txt")
    assert indexed.count(False) == 1


def test_a_key_carries_a_flag_and_no_map(spark, tmp_path):
    orders = spark.range(80).selectExpr("id AS o_orderkey", "'3-MEDIUM' AS o_orderpriority", "timestamp_ntz'1998-01-01' AS o_orderdate")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["metadata_keys"](spark, str(tmp_path))
    assert "map_contains_key(persisted" not in plan_of(found)
    counts = {r.key: (r.n, r.persisted) for r in found.collect()}
    assert counts["urlId"][0] == counts["urlId"][1] == counts["header.server"][0] and counts["header.server"][1] == 0


def test_only_an_attempt_that_waited_is_said_to_wait_no_longer(spark, tmp_path):
    root = str(tmp_path)
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), root)
    frontier = frontier_of(spark, ["http://a.org/1", "http://a.org/2"])
    settle = lambda rows, name: jobs._settle(frontier, {"responses": table(spark, rows)}, CONF, root, "2024-01-01 00:00:00", name, {})
    settle(ROWS[:1] + [response("http://a.org/2", "GET", 200)], "one")
    assert {r.url_id for r in jobs.read_pending(spark, root).collect()} == {0, 1}
    for _ in range(2):  # the second time as a repeated batch
        settle(ROWS, "two")
        assert jobs.read_pending(spark, root).count() == 0
    other = str(tmp_path / "other")
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), other)
    jobs._settle(frontier, {"responses": table(spark, ROWS)}, CONF, other, "2024-01-01 00:00:00", "one", {})
    assert jobs.pending_attempts(spark, other).log().count() == 0


def test_late_responses_land_in_files_by_their_size(spark, tmp_path, monkeypatch):
    orders = spark.range(160).selectExpr("id AS o_orderkey", "'3-MEDIUM' AS o_orderpriority", "timestamp_ntz'1998-01-01' AS o_orderdate")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    counts, paths, streamed = [], [], jobs.stream_table
    files = lambda path: [str(f) for f in Path(path.removeprefix("file:")).glob("*.parquet")]
    monkeypatch.setattr(jobs, "stream_table", lambda spark, path, *given, **named: paths.append(path) or streamed(spark, path, *given, **named))
    monkeypatch.setattr(jobs, "run_available", lambda *_: counts.append((len(files(paths[-1])), spark.read.parquet(*files(paths[-1])).count())))
    monkeypatch.setattr(KeptIndex, "build", lambda index, _: index)
    monkeypatch.setattr(sinks, "seed_status", lambda *_: None)
    monkeypatch.setattr(sinks, "read_status", lambda *_: None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        QUERIES["stream_late_responses"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (register, urls), (some, first), (all_, both) = counts
    assert register > 1 and some > 1 and all_ >= some + 2 and urls == 150
    parts = tables.responses(spark, str(tmp_path)).groupBy(F.pmod(F.xxhash64("url", "method"), F.lit(4)).alias("part")).count()
    parts = {r.part: r["count"] for r in parts.collect()}
    assert (first, both) == (parts[2], parts[2] + parts[3])


def test_many_waiting_attempts_are_not_looked_up_as_few(spark, tmp_path, monkeypatch):
    root, conf = str(tmp_path / "out"), AuditConfig(redirect_limit=0)
    index = KeptIndex(spark, str(tmp_path / "index"), conf, buckets=2).build(table(spark, ROWS[:1]))
    frontier = frontier_of(spark, ["http://a.org/2", "http://a.org/3"])
    monkeypatch.setattr(jobs, "read_pending", lambda *_: frontier)
    settled = []
    monkeypatch.setattr(jobs, "_settle", lambda rows, *given: settled.append((rows.count(), given[-1]["few"])))
    table(spark, ROWS[1:]).write.parquet(str(tmp_path / "come"))
    stream = jobs.stream_table(spark, str(tmp_path / "come"), schema.RESPONSES)
    jobs.run_available(jobs.resolve_on_arrival(stream, index, conf, root), str(tmp_path / "checkpoint"))
    assert settled == [(1, False)]


def test_few_is_measured_against_the_index(spark, tmp_path):
    rows = [response(f"http://a.org/{i}", "HEAD", 200) for i in range(50)]
    index = KeptIndex(spark, str(tmp_path), CONF, buckets=2).build(table(spark, rows))
    assert index.is_few(6) and not index.is_few(7)


def test_the_decision_is_compiled_in_any_session(spark, tmp_path, monkeypatch):
    seen, before = [], spark.conf.get(CODE_SETTING)
    spark.conf.set(CODE_SETTING, "65535")  # as Spark has it
    settled, edges = resolve._settled, indexes.redirect_edges
    monkeypatch.setattr(resolve, "_settled", lambda *given: seen.append(spark.conf.get(CODE_SETTING)) or settled(*given))
    monkeypatch.setattr(indexes, "redirect_edges", lambda *given, **named: seen.append(spark.conf.get(CODE_SETTING)) or edges(*given, **named))
    try:
        index = KeptIndex(spark, str(tmp_path), CONF, buckets=2).build(table(spark, ROWS))
        resolve.resolve(frontier_of(spark, ["http://a.org/1"]), None, CONF, index=index)
        assert seen == [CODE_LIMIT] * 2 and spark.conf.get(CODE_SETTING) == "65535"
    finally:
        spark.conf.set(CODE_SETTING, before)
