import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.operators import reports, status
from urlaudit.plans import cycle
from urlaudit.session import materialize
from urlaudit.sources import readers, sinks


def rows_of(spark, *rows):
    """Status rows from (url_id, date, category)."""
    df = spark.createDataFrame(rows, "url_id long, d string, category string")
    filled = df.withColumn("checking_date", F.col("d").cast("timestamp_ntz"))
    return filled.select(
        *[F.col(f.name) if f.name in filled.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.STATUS]
    )


def contents(rows):
    return {(r.url_id, str(r.checking_date)[:10], r.category) for r in rows.collect()}


def test_late_rows_go_to_history_and_replays_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    sinks.seed_status(rows_of(spark, (1, "2024-01-05", "Ok"), (2, "2024-01-05", "Ok"), *[(k, "2024-01-05", "Ok") for k in range(10, 40)]), root, buckets=4)
    fresh = rows_of(spark, (1, "2024-01-09", "Broken"), (2, "2024-01-01", "Broken"), (3, "2024-01-01", "Ok"))
    sinks.write_status(fresh, root, "s-0")
    others = {(k, "2024-01-05", "Ok") for k in range(10, 40)}
    wanted = {(1, "2024-01-09", "Broken"), (2, "2024-01-05", "Ok"), (3, "2024-01-01", "Ok")} | others
    assert contents(sinks.read_status(spark, root)) == wanted
    history = {(1, "2024-01-05", "Ok"), (2, "2024-01-01", "Broken")}
    assert contents(sinks.read_history(spark, root)) == history
    sinks.write_status(fresh, root, "s-0")  # a second attempt
    sinks.write_status(fresh.filter("url_id <> 2"), root, "t-0")  # a new checkpoint; the same checks delivered again
    sinks.write_status(fresh, root)
    assert contents(sinks.read_status(spark, root)) == wanted and contents(sinks.read_history(spark, root)) == history
    sinks.write_status(rows_of(spark, (1, "2024-01-10", "Ok"), (None, "2024-01-10", "Ok")), root, "t-1")  # a second check of a URL
    sinks.write_status(rows_of(spark, (1, "2024-01-09", "Broken")), root, "u-0")  # the check before, once more
    assert contents(sinks.read_status(spark, root)) == wanted - {(1, "2024-01-09", "Broken")} | {(1, "2024-01-10", "Ok")}
    after = sinks.read_history(spark, root)
    assert contents(after) == history | {(1, "2024-01-09", "Broken")} and after.count() == 3
    ids = spark.createDataFrame([(1,), (3,), (77,)], "url_id long")
    assert contents(sinks.read_status_of(spark, root, ids)) == {(1, "2024-01-10", "Ok"), (3, "2024-01-01", "Ok")}
    sinks.status_table(spark, root).fold()
    assert sinks.read_status(spark, root).count() == 33 and contents(sinks.read_history(spark, root)) == contents(after)


def written(root):
    return sum(p.stat().st_size for p in Path(root).rglob("*") if p.is_file())


def test_what_a_poll_writes_does_not_depend_on_the_size_of_the_status(spark, tmp_path):
    grown = []
    for size in (300, 30_000):
        root = str(tmp_path / str(size))
        status_rows = spark.range(size).selectExpr("id AS url_id", "'2024-01-05' AS d", "concat('Ok', id) AS category")
        filled = status_rows.withColumn("checking_date", F.col("d").cast("timestamp_ntz"))
        sinks.seed_status(filled.select(*[F.col(f.name) if f.name in filled.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.STATUS]), root)
        before = written(root)
        sinks.write_status(rows_of(spark, *[(k, "2024-01-09", "Broken") for k in range(200)]), root, "poll")
        grown.append(written(root) - before)
        assert sinks.read_status(spark, root).where("category = 'Broken'").count() == 200
    assert grown[1] < 1.05 * grown[0]


def test_history_split_is_complete(spark):
    log = rows_of(spark, *[(i % 4, f"2024-01-{1 + i:02d}", "Ok") for i in range(20)])
    current, history = status.split_history(log)
    assert current.count() == 4 and history.count() == 16
    assert {str(r.checking_date)[:10] for r in current.collect()} == {f"2024-01-{d}" for d in (17, 18, 19, 20)}


def test_unknown_urls_are_set_aside(spark):
    log = rows_of(spark, (1, "2024-01-05", "Ok"), (9, "2024-01-05", "Ok"))
    url = spark.createDataFrame([(1, "u", "g", True, 1)], schema.URL)
    known, unknown = status.known_urls(log, url)
    assert [r.url_id for r in known.collect()] == [1] and [r.url_id for r in unknown.collect()] == [9]


def test_archive_keeps_urls_without_active_context(spark):
    url = spark.createDataFrame([(i, f"u{i}", "g", True, 1) for i in (1, 2, 3)], schema.URL)
    context = spark.createDataFrame([(1, 1, None, True), (1, 2, None, False), (2, 1, None, False)], schema.URL_CONTEXT)
    gone = status.archive_inactive(url, rows_of(spark, (2, "2024-01-05", "Ok")), context, "2024-02-01 00:00:00")
    assert {(r.id, r.category) for r in gone.collect()} == {(2, "Ok"), (3, None)}


def test_category_domain(spark):
    assert [r.url_id for r in status.invalid_categories(rows_of(spark, (1, "2024-01-05", "Ok"), (2, "2024-01-05", "Fine"))).collect()] == [2]


def test_latest_file_is_replaced(spark, tmp_path):
    path = str(tmp_path / "latest")
    for day in ("05", "06"):
        sinks.write_latest(rows_of(spark, *[(i, f"2024-01-{day}", "Ok") for i in range(150)]), path, seq="url_id")
    lines = [json.loads(x) for f in Path(path).glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 100 and lines[0]["url_id"] == 149 and lines[0]["checking_date"].startswith("2024-01-06")


def test_readers(spark, tmp_path):
    text = tmp_path / "list.txt"
    text.write_text("http://a\nhttp://b \nhttp://a\n", encoding="utf-8")
    assert sorted(r.url for r in readers.read_login_pages(spark, str(text)).collect()) == ["http://a", "http://b "]
    rows = [("u", "HEAD", 200, None, {"Content-Length": "1", "content-length": "2", "X": "3"}, None, None, None, 1)]
    spark.createDataFrame(rows, schema.RESPONSES).write.parquet(str(tmp_path / "responses"))
    found = readers.read_responses(spark, str(tmp_path / "responses")).first()
    assert found.headers == {"content-length": "2", "x": "3"}


def test_queue_reports(spark):
    rows = [(1, "u1", "q", True), (2, "u2", "q", False), (3, "u3", "q", False), (4, "u4", "p", False)]
    frontier = spark.createDataFrame(rows, "seq long, url string, queue_key string, in_progress boolean")
    assert {tuple(r) for r in reports.queue_summary(frontier).collect()} == {("q", 2, 1), ("p", 1, 0)}
    contents = reports.queue_contents(frontier).select("queue_key", "position", "url").collect()
    assert {tuple(r) for r in contents} == {("q", 1, "u2"), ("q", 2, "u3"), ("p", 1, "u4")}
    assert [tuple(r) for r in reports.being_fetched(frontier).collect()] == [("q", "u1")]
    assert tuple(reports.poll_summary(frontier).first()) == (4, 2)


def test_a_cycle_writes_status_history_and_latest(spark, tmp_path):
    url = spark.createDataFrame(
        [(1, "http://a.org/1", "a.org", True, 1), (2, "http://a.org/2", "a.org", True, 1), (3, "http://b.org/3", "b.org", True, 1)],
        schema.URL,
    )
    context = spark.createDataFrame([(i, 1, None, True) for i in (1, 2, 3)], schema.URL_CONTEXT)
    answers = [("http://a.org/1", "HEAD", 200), ("http://a.org/2", "HEAD", 404), ("http://a.org/2", "GET", 404)]
    responses = spark.createDataFrame([(u, m, c, None, {}, None, None, None, 3) for u, m, c in answers], schema.RESPONSES)
    tables = cycle.CycleTables(
        url=url,
        status=rows_of(spark, (1, "2024-01-01", "Broken")),
        url_context=context,
        responses=responses,
        in_flight=spark.createDataFrame([("http://b.org/3",)], "name string"),
    )
    conf = AuditConfig(queue_timeout_ms=600_000)
    summary = cycle.run_cycle(tables, conf, "2024-02-01", str(tmp_path), "2024-02-01 10:30:00")
    assert summary.pop("elapsed_ms") > 0 and summary == {"hits": 2, "queues": 1}
    found = {(r.url_id, r.category) for r in sinks.read_status(spark, str(tmp_path)).collect()}
    assert found == {(1, "Ok"), (2, "Broken")}
    assert [r.category for r in sinks.read_history(spark, str(tmp_path)).collect()] == ["Broken"]
    again = cycle.CycleTables(**{**tables.__dict__, "status": sinks.read_status(spark, str(tmp_path)), "in_flight": None})
    assert {str(r.checking_date) for r in sinks.read_status(spark, str(tmp_path)).collect()} == {"2024-02-01 10:30:00"}
    summary = cycle.run_cycle(again, conf, "2024-02-01", str(tmp_path), "2024-02-01 10:40:00")
    assert (summary["hits"], summary["queues"]) == (1, 1)
    lost = spark.read.parquet(f"{tmp_path}/unobserved/version=1").collect()
    assert [(r.url_id, r.method) for r in lost] == [(3, "HEAD")]
    # The latest checks are those of all polls, the waiting URL is in flight for an hour.
    assert sorted(r.url_id for r in sinks.read_latest(spark, str(tmp_path)).collect()) == [1, 2]
    assert len([x for f in Path(tmp_path).glob("latest_checks/*.json") for x in f.read_text().splitlines()]) == 2
    at = lambda minute: [r.name for r in cycle.in_flight(spark, str(tmp_path), dt.datetime(2024, 2, 1, 11, minute)).collect()]
    assert at(39) == ["http://b.org/3"] and at(41) == []


def test_a_cycle_writes_what_waits_too_long(spark, tmp_path):
    rows = [(k, f"http://a.org/{k}", "a.org", True, 1) for k in range(6)]
    url = spark.createDataFrame(rows, schema.URL)
    context = spark.createDataFrame([(k, 1, None, True) for k in range(6)], schema.URL_CONTEXT)
    responses = spark.createDataFrame([(u, "HEAD", 200, None, {}, None, None, None, 3) for _, u, *_ in rows], schema.RESPONSES)
    tables = cycle.CycleTables(url=url, status=rows_of(spark, (99, "2024-01-01", "Ok")), url_context=context, responses=responses)
    cycle.run_cycle(tables, AuditConfig(delay_ms=1000, queue_timeout_ms=3000), "2024-02-01", str(tmp_path))
    dropped = spark.read.parquet(f"{tmp_path}/timed_out/version=0").collect()
    assert sorted((r.url_id, r.start_offset_ms) for r in dropped) == [(4, 4000), (5, 5000)]
    assert sorted(r.url_id for r in sinks.read_status(spark, str(tmp_path)).collect()) == [0, 1, 2, 3, 99]


def test_unreadable_fields_do_not_stop_a_batch(spark):
    texts = [("1", "x", "garbage"), ("2", "99999999999", ""), ("x", "3", "2024-01-05T10:00:00"), ("", None, None)]
    df = spark.createDataFrame(texts, "u string, c string, d string")
    md = F.create_map(F.lit("urlId"), F.array("u"), F.lit("fetch.redirectCount"), F.array("c"), F.lit("fetch.checkingDate"), F.array("d"))
    rows = status.status_from_metadata(df.select(md.alias("metadata")), fallback_date="2000-01-01 00:00:00")
    good, bad = status.split_unreadable(rows)
    assert sorted((r.url_id, r.redirect_count, str(r.checking_date)[:10]) for r in good.collect()) == [(1, 0, "2000-01-01"), (2, 0, "2000-01-01")]
    assert sorted((r.redirect_count, str(r.checking_date)[:10]) for r in bad.collect()) == [(0, "2000-01-01"), (3, "2024-01-05")]


def jobs_of(spark, group, work):
    """Spark jobs that some work starts in this thread."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_summary_of_a_poll_needs_no_job_of_its_own(spark):
    rows = spark.range(100).selectExpr("concat('q', id % 7) AS queue_key", "id")
    seen, found = Observation(), []

    def observed():
        materialize(reports.observed_summary(rows, seen), "poll")
        found.append(seen.get)

    def counted():
        polled = materialize(rows, "poll")
        found.append(reports.poll_summary(polled).first().asDict())

    one, other = jobs_of(spark, "observed", observed), jobs_of(spark, "counted", counted)
    assert found == [{"hits": 100, "queues": 7}] * 2 and one < other


@pytest.mark.parametrize("minutes, idle, due", [(None, False, True), (2, True, False), (3, True, True), (3, False, False), (59, False, False), (60, False, True)])
def test_a_poll_is_due_between_two_bounds(minutes, idle, due):
    now = dt.datetime(2024, 1, 1, 12)
    last = None if minutes is None else now - dt.timedelta(minutes=minutes)
    assert cycle.poll_is_due(last, now, lambda: idle) is due


def test_a_poller_counts_a_day_once_also_after_a_restart(spark, tmp_path):
    root, urls = str(tmp_path), spark.createDataFrame([(k, f"http://h{k}.org/", f"h{k}.org", True, 1) for k in range(4)], schema.URL)
    context = spark.createDataFrame([(k, 1, None, True) for k in range(4)], schema.URL_CONTEXT)
    responses = spark.createDataFrame([(f"http://h{k}.org/", "HEAD", 200, None, {}, None, None, None, 3) for k in range(3)], schema.RESPONSES)
    empty = spark.createDataFrame([], schema.STATUS)

    def load():
        now = sinks.read_status(spark, root) if sinks.has_status(spark, root) else empty
        return cycle.CycleTables(url=urls, status=now, url_context=context, responses=responses)

    times = iter([dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 9, 2), dt.datetime(2024, 1, 1, 9, 30), dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 2, 9)])
    now = []
    clock = lambda: now.append(next(times)) or now[-1]
    start = lambda: cycle.audit_poll(load, AuditConfig(), root, lambda: now[-1].date(), clock)
    poll = start()
    summaries = [poll(0), poll(1)]
    poll = start()
    summaries += [poll(0), poll(1), poll(2)]
    # At 9:02 it is too early, at 9:30 the URL without an answer is in flight.
    assert [s and s["hits"] for s in summaries] == [4, None, None, 1, 1]
    assert sorted((str(r.day), r.unchecked) for r in cycle.read_unchecked(spark, root).collect()) == [("2024-01-01", 4), ("2024-01-02", 1)]
