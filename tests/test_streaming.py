import datetime as dt
import re
from pathlib import Path

from pyspark.sql import functions as F

from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.operators import reports, selection
from urlaudit.sources import ledger, sinks
from urlaudit.streaming import jobs, state
from urlaudit.session import materialize, scratch_path, scratch_tables


def stream_of(spark, tmp_path, *files, ddl):
    """A stream with one trigger per list of rows."""
    for rows in files:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return jobs.stream_table(spark, str(tmp_path / "in"), spark.createDataFrame([], ddl).schema, files_per_trigger=1)


def drain(spark, stream, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_available(stream.writeStream.format("parquet").option("path", out), scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


EVENTS = "name string, kind string, at string, seq long"


def at(minute):
    return f"2024-01-{1 + minute // 1440:02d} {minute // 60 % 24:02d}:{minute % 60:02d}:00"


def emitted(spark, tmp_path, *files, late="1 hour"):
    events = stream_of(spark, tmp_path, *files, ddl=EVENTS).withColumn("at", F.col("at").cast("timestamp"))
    return drain(spark, jobs.emit_not_in_flight(events, late), tmp_path)


def test_in_flight_is_released_by_done_and_by_time(spark, tmp_path):
    first = [("a", "select", at(0), 1), ("a", "select", at(30), 2), ("b", "select", at(0), 3)]
    second = [("a", "select", at(60), 4), ("b", "done", at(1), 5), ("b", "select", at(2), 6), ("a", "select", at(119), 7)]
    assert sorted(r.seq for r in emitted(spark, tmp_path, first, second).collect()) == [1, 3, 4, 6]


def test_in_flight_ends_by_its_timer(spark, tmp_path):
    # The watermark passes the hour of "a" while no event of it comes, so its state has gone when one comes, on time or late.
    first = [("a", "select", at(0), 1), ("c", "select", at(0), 2)]
    files = [first, [("b", "select", at(300), 3)], [("b", "done", at(301), 4)], [("a", "select", at(293), 5), ("c", "done", at(295), 6)], [("c", "select", at(302), 7)]]
    rows = emitted(spark, tmp_path, *files, late="10 minutes").collect()
    assert sorted(r.seq for r in rows) == [1, 2, 3, 5, 7]


def test_what_is_in_flight_is_left_out_of_the_poll(spark, tmp_path):
    files = [[("u1", "select", at(0), 1), ("u2", "select", at(50), 2), ("u3", "select", at(55), 3)], [("u3", "done", at(56), 4), ("u2", "done", at(10), 5)]]
    passed = emitted(spark, tmp_path, *files)
    done = spark.createDataFrame([r for f in files for r in f if r[1] == "done"], EVENTS).withColumn("at", F.col("at").cast("timestamp"))
    now = jobs.in_flight_now(passed, done, at(70))
    assert [r.name for r in now.collect()] == ["u2"]
    selected = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "name string")
    assert sorted(r.name for r in selection.exclude_in_flight(selected, now).collect()) == ["u1", "u3"]


def test_a_url_is_polled_once_an_hour(spark, tmp_path):
    rows = [[("u", at(0), 1), ("u", at(59), 2), ("v", at(10), 3)], [("u", at(60), 4), ("v", at(69), 5), ("u", at(119), 6)], [("u", at(120), 7), ("v", at(130), 8)]]
    polled = stream_of(spark, tmp_path, *rows, ddl="name string, at string, seq long").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted(r.seq for r in drain(spark, jobs.drop_repeated_polls(polled), tmp_path).collect()) == [1, 3, 4, 7, 8]


def test_refreshed_loads_again_when_old():
    now, loads = [0.0], []
    value = jobs.Refreshed(lambda: loads.append(1) or len(loads), 100, clock=lambda: now[0])
    assert (value.get(), value.get()) == (1, 1)
    now[0] = 99.0
    assert value.get() == 1
    now[0] = 100.0
    assert value.get() == 2


def test_polling_calls_back(spark):
    seen = []
    query = jobs.start_polling(spark, seen.append, scratch_path(spark, "checkpoint"), every="1 second")
    try:
        for _ in range(100):
            if len(seen) >= 2:
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    assert seen[:2] == [0, 1]


def test_scratch_tables_of_a_batch_are_removed(spark, tmp_path):
    with scratch_tables(spark):
        with scratch_tables(spark):
            inner = materialize(spark.range(5), "a-b")
            assert inner.count() == 5 and inner.inputFiles()
        outer = materialize(spark.range(7), "c")
        files = [Path(name.removeprefix("file:").replace("//", "")) for name in (*outer.inputFiles(),)]
        assert outer.count() == 7 and all(f.exists() for f in files)
    assert files and not any(f.exists() for f in files)
    kept = materialize(spark.range(3), "d")
    assert kept.count() == 3
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("scratch_")]


def test_attempts_carry_category_and_message(spark, tmp_path):
    ddl = "url_id long, seq long, url string, status_code int, location string, exception_class string, exception_message string, original_url string"
    rows = [
        (1, 1, "http://a.org/x", 302, "./y", None, None, "http://a.org/x"),
        (1, 2, "http://a.org/y", 302, "./z", None, None, "http://a.org/x"),
        (2, 3, "http://b.org/", None, None, "java.net.SocketTimeoutException", "Read timed out", "http://b.org/"),
        (2, 4, "http://b.org/", 404, None, None, None, "http://b.org/"),
    ]
    routed = jobs.route_observations(stream_of(spark, tmp_path, rows, ddl=ddl), AuditConfig(redirect_limit=1))
    found = {r.seq: (r.route, r.category, r.message) for r in drain(spark, routed, tmp_path).collect()}
    assert found == {
        1: ("follow", None, None),
        2: ("status", "Undetermined", "Redirects exceeded 1 redirects for http://a.org/x"),
        3: ("retry_get", None, None),
        4: ("status", "Broken", "Broken, Status code: 404"),
    }


def test_an_attempt_is_given_up_after_an_hour(spark, tmp_path):
    ddl = "url_id long, seq long, at timestamp, url string, status_code int, location string, exception_class string"
    seen = lambda url_id, seq, minute, code: (url_id, seq, dt.datetime.fromisoformat(at(minute)), f"http://h{url_id}.org/", code, None, None)
    files = [[seen(1, 1, 0, 404), seen(2, 2, 0, 404), seen(3, 3, 90, 404)], [seen(9, 4, 200, 200)], [seen(9, 5, 201, 200)], [seen(1, 6, 195, 404), seen(3, 7, 202, 404)]]
    routed = jobs.route_observations(stream_of(spark, tmp_path, *files, ddl=ddl), AuditConfig(), late="10 minutes")
    found = {r.seq: (r.method, r.route) for r in drain(spark, routed, tmp_path).collect()}
    assert found[6] == ("HEAD", "retry_get") and found[7] == ("HEAD", "retry_get")
    assert [found[k] for k in (1, 2, 3)] == [("HEAD", "retry_get")] * 3


def test_an_observation_reaches_the_state_in_four_columns_and_leaves_it_in_lists(spark, tmp_path):
    ddl = "url_id long, seq long, at timestamp, url string, status_code int, location string, exception_class string"
    routed = jobs.route_observations(jobs.stream_table(spark, str(tmp_path), spark.createDataFrame([], ddl).schema), AuditConfig())
    plan = routed._jdf.queryExecution().analyzed().toString()
    assert len(re.search(r"transformWithStateUDF\(([^)]*)\)", plan)[1].split(",")) == 4
    assert plan.index("TransformWithState") < plan.index("to_json") < plan.index("RepartitionByExpression [url_id")

    class Held:
        get, clear, update, registerTimer = lambda _: None, lambda _: None, lambda *_: None, lambda *_: None
        getValueState = lambda held, *_: held

    n = 2 * state.CHUNK + 1
    attempt, when = state.Attempt(15), dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    attempt.init(Held())
    rows = [(7, seq, when, f'{state.OK}{{"url":"u{seq}"}}') for seq in range(n, 0, -1)]
    out = list(attempt.handleInputRows((7,), iter(rows), None))
    assert [len(row.seq) for row in out] == [state.CHUNK, state.CHUNK, 1]
    assert [x for row in out for x in row.facts] == [row[3] for row in reversed(rows)] and {x for row in out for x in row.route} == {"status"}


def check_rows(spark, *rows):
    """Status rows with a number, from (check_id, url_id, date)."""
    df = spark.createDataFrame(rows, "check_id long, url_id long, d string").withColumn("checking_date", F.col("d").cast("timestamp_ntz"))
    known = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.STATUS]
    return df.select("check_id", *known)


def run(spark, tmp_path, folder, writer_of, *files, checkpoint=None):
    """Each file as a batch of a stream of its own folder, under a checkpoint."""
    path = str(tmp_path / folder)
    for rows in files:
        rows.coalesce(1).write.mode("append").parquet(path)
    stream = jobs.stream_table(spark, path, files[0].schema, files_per_trigger=1)
    jobs.run_available(writer_of(stream), str(tmp_path / (checkpoint or f"{folder}-checkpoint")))


def test_latest_goes_on_after_a_restart_and_under_a_new_checkpoint(spark, tmp_path):
    root = str(tmp_path / "out")
    write = lambda stream: jobs.keep_latest(stream, root, 3, "check_id")
    day = lambda *ids: check_rows(spark, *[(i, i, f"2024-01-{i:02d}") for i in ids])
    latest = lambda: [r.check_id for r in sinks.read_latest(spark, root, day(1).schema).orderBy(F.desc("check_id")).collect()]
    run(spark, tmp_path, "a", write, day(1), day(3), day(2))
    assert latest() == [3, 2, 1]
    run(spark, tmp_path, "a", write, day(5))
    assert latest() == [5, 3, 2]
    run(spark, tmp_path, "b", write, day(9), day(3))
    assert latest() == [9, 5, 3]
    run(spark, tmp_path, "a", write, day(4), checkpoint="new")  # reads all of its folder anew
    assert latest() == [9, 5, 4]


def test_status_is_the_same_after_a_new_checkpoint(spark, tmp_path):
    root = str(tmp_path / "out")
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), root)
    write = lambda stream: jobs.record_checks(stream, root)
    rows = lambda *days: check_rows(spark, *[(d, 1, f"2024-01-{d:02d}") for d in days]).drop("check_id")
    days = lambda df: sorted(str(r.checking_date)[8:10] for r in df.collect())
    run(spark, tmp_path, "a", write, rows(1), rows(2))
    run(spark, tmp_path, "a", write, rows(1), checkpoint="again")
    assert days(sinks.read_status(spark, root)) == ["02"] and days(sinks.read_history(spark, root)) == ["01"]


def test_throughput_counts_each_checkpoint_once(spark, tmp_path):
    root = str(tmp_path / "out")
    minute = lambda *seconds: spark.createDataFrame([(f"2024-01-01 00:00:{s:02d}",) for s in seconds], "at string").withColumn("at", F.col("at").cast("timestamp"))
    write = lambda stream: jobs.record_throughput(jobs.count_throughput(stream), root)
    run(spark, tmp_path, "a", write, minute(1, 2), minute(3))
    run(spark, tmp_path, "a", write, minute(4))
    run(spark, tmp_path, "b", write, minute(5, 6))
    assert [r.checks for r in jobs.read_throughput(spark, root).collect()] == [6]


def test_marks_are_carried_over_batches_restarts_and_checkpoints(spark, tmp_path):
    root = str(tmp_path / "out")
    batch = lambda start, n: check_rows(spark, *[(i, i, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}") for i in range(start, start + n)]).select("checking_date", "check_id")
    write = lambda stream: jobs.mark_checks(stream, root, every=10)
    run(spark, tmp_path, "a", write, batch(0, 7), batch(7, 11), batch(18, 1))
    run(spark, tmp_path, "a", write, batch(19, 25))
    run(spark, tmp_path, "b", write, batch(44, 60))
    found = {(r.mark, r.marked_at, r.elapsed_us) for r in jobs.read_marks(spark, root).collect()}
    whole = reports.throughput(batch(0, 104), 10)
    assert found == {(r.mark, r.marked_at, r.elapsed_us) for r in whole.collect()} and len(found) == 10


def test_a_batch_that_was_marked_is_not_counted_again(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = check_rows(spark, *[(i, i, f"2024-01-01 00:00:{i:02d}") for i in range(15)]).select("checking_date", "check_id")
    writer = jobs.mark_checks(jobs.stream_table(spark, str(tmp_path), rows.schema), root, every=10)
    assert writer is not None
    run(spark, tmp_path, "a", lambda stream: jobs.mark_checks(stream, root, every=10), rows)
    before = ledger.last(spark, root, "marks")
    run(spark, tmp_path, "a", lambda stream: jobs.mark_checks(stream, root, every=10), rows.limit(0))
    assert ledger.last(spark, root, "marks").value.split('"checks"')[1] == before.value.split('"checks"')[1]


def test_the_ledger_keeps_the_newest_of_each_key(spark, tmp_path):
    root = str(tmp_path)
    assert ledger.last(spark, root, "x") is None and ledger.next_number(spark, root, "x") == 0
    for number in (0, 1, 5, 6, 8):
        ledger.commit(spark, root, "x", number, f"v{number}")
        ledger.commit(spark, root, "x", number * 2, key="k")
    assert ledger.last(spark, root, "x") == ledger.Entry(8, "v8") and ledger.last(spark, root, "x", "k").number == 16
    assert len(list(Path(root).glob("ledger/x/slot=*/*.parquet"))) == 2
    calls = []
    assert not ledger.once(spark, root, "x", 8, lambda: calls.append(1)) and ledger.once(spark, root, "x", 9, lambda: calls.append(1))
    assert calls == [1]
