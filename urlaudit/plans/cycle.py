"""One audit cycle as a batch job: select, resolve, record, report; and the poller that calls it."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from urlaudit.config import AuditConfig
from urlaudit.operators import gates, politeness, reports, resolve, selection, status
from urlaudit.session import materialize, scratch_tables
from urlaudit.sources import ledger, sinks
from urlaudit.sources.index import KeptIndex

IN_FLIGHT_HOURS = 1
#: Seconds between two polls, at least and at most.
LEAST_INTERVAL, MOST_INTERVAL = 180, 3600


@dataclass
class CycleTables:
    url: DataFrame
    status: DataFrame
    url_context: DataFrame
    responses: DataFrame | None
    robots_rules: DataFrame | None = None
    login_pages: DataFrame | None = None
    host_overrides: DataFrame | None = None
    in_flight: DataFrame | None = None
    index: resolve.ResponseIndex | KeptIndex | None = None


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def run_cycle(tables: CycleTables, conf: AuditConfig, as_of, root: str, checked_at=None) -> dict:
    """Add the checks of one poll to the status, and return the poll's summary: hits, queues and milliseconds.

    The status below ``root`` begins as ``tables.status`` if there is none yet; later polls select by the status they are given, which
    is read from there. ``checked_at`` is the start of the checks, by default the time the cycle begins. The latest checks of all polls
    are kept beside the status, as a table and as a JSON file.

    URLs that wait too long in their queue and URLs without an observed response are written as tables ``timed_out`` and ``unobserved``,
    those that were selected as ``selected``. How long a request takes is not known before it is made: a URL has waited too long only if
    the delays before it alone exceed the timeout. The summary is observed in the pass that writes the poll.
    """
    spark, begun = tables.url.sparkSession, time.monotonic()
    at = checked_at or now_utc()
    if not sinks.has_status(spark, root):
        sinks.seed_status(tables.status, root)
    number = ledger.next_number(spark, root, "poll")
    selected = selection.due_all(tables.url, tables.status, tables.url_context, as_of)
    if tables.in_flight is not None:
        selected = selection.exclude_in_flight(selected, tables.in_flight)
    summary = Observation()
    polled = gates.with_queue_key(selected, conf, url="name", given="group_key")
    polled = materialize(reports.observed_summary(polled, summary), "poll")
    moment = status.as_timestamp(at)
    hour = F.date_format(moment, "yyyy-MM-dd-HH").alias("hour")
    chosen = polled.select(F.col("id").alias("url_id"), "name", moment.alias("at"), hour, F.lit(number).alias("version"))
    chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "version").parquet(f"{root}/selected")
    frontier = selection.seed_frontier(polled)
    if conf.queue_timeout_ms >= 0:
        queued = frontier.join(polled.select(F.col("id").alias("url_id"), "queue_key"), "url_id")
        paced = politeness.with_delay(queued, conf, tables.robots_rules, tables.host_overrides, given="queue_key")
        kept, dropped = resolve.drop_queue_timeouts(politeness.plan_schedule(paced, F.lit(0), "url_id"), conf)
        dropped.select(*resolve.FRONTIER, "queue_key", "start_offset_ms").write.mode("overwrite").parquet(f"{root}/timed_out/version={number}")
        frontier = kept.select(*resolve.FRONTIER)
    outcomes = resolve.resolve(
        frontier,
        tables.responses,
        conf,
        robots_rules=tables.robots_rules,
        login_pages=tables.login_pages,
        host_overrides=tables.host_overrides,
        index=tables.index,
        few=True,
    )
    final, unobserved = resolve.split_outcomes(outcomes)
    unobserved.select(*resolve.FRONTIER).write.mode("overwrite").parquet(f"{root}/unobserved/version={number}")
    fresh = materialize(status.build_status(final, at), "fresh")  # of URLs that were selected from the register
    sinks.write_status(fresh, root, f"poll-{number}")
    sinks.keep_latest(fresh, root, seq="url_id")
    sinks.write_latest(sinks.read_latest(spark, root), f"{root}/latest_checks", seq="url_id")
    ledger.commit(spark, root, "poll", number)
    return {**summary.get, "elapsed_ms": int(1000 * (time.monotonic() - begun))}


def in_flight(spark: SparkSession, root: str, now: dt.datetime) -> DataFrame:
    """Names of the URLs that a poll has selected within the hour and that have not been recorded since."""
    hours = [(now - dt.timedelta(hours=back)).strftime("%Y-%m-%d-%H") for back in range(IN_FLIGHT_HOURS + 1)]
    selected = ledger.read_if_there(spark, f"{root}/selected", "url_id LONG, name STRING, at TIMESTAMP_NTZ, hour STRING, version INT")
    if selected is None:
        return spark.createDataFrame([], "name STRING")
    since = status.as_timestamp(now - dt.timedelta(hours=IN_FLIGHT_HOURS))
    recent = selected.where(F.col("hour").isin(hours) & (F.col("at") > since)).groupBy("url_id", "name").agg(F.max("at").alias("at"))
    recent = materialize(recent, "recent")
    done = sinks.read_status_of(spark, root, recent.select("url_id").distinct()).select("url_id", "checking_date")
    waiting = recent.join(done, "url_id", "left").where(F.col("checking_date").isNull() | (F.col("checking_date") < F.col("at")))
    return waiting.select("name")


def poll_is_due(last_poll: dt.datetime | None, now: dt.datetime, idle: Callable[[], bool], least: int = LEAST_INTERVAL, most: int = MOST_INTERVAL) -> bool:
    """No sooner than the least interval, then once nothing is in flight any more, and at the latest after the greatest interval."""
    if last_poll is None:
        return True
    waited = (now - last_poll).total_seconds()
    return waited >= most or (waited >= least and idle())


def audit_poll(
    load: Callable[[], CycleTables],
    conf: AuditConfig,
    root: str,
    as_of: Callable[[], dt.date | str],
    clock: Callable[[], dt.datetime] = now_utc,
    least: int = LEAST_INTERVAL,
    most: int = MOST_INTERVAL,
) -> Callable[[int], dict | None]:
    """What a poller calls: a cycle over tables that are read anew, without the URLs that are in flight, and once a day the number of
    unchecked URLs before it. A call before the poll is due does nothing.

    ``load`` is called for each poll. The count is a table ``unchecked`` with one row for each day; that a day has been counted and when
    the last poll was stands in the ledger, so a poller that starts again goes on where the last one stopped."""

    def poll(_: int) -> dict | None:
        now = clock()
        tables, today = load(), dt.date.fromisoformat(str(as_of())[:10])
        spark = tables.url.sparkSession
        entry = ledger.last(spark, root, "polled")
        before = None if entry is None else dt.datetime.fromisoformat(entry.value)
        with scratch_tables(spark):
            known = tables.in_flight
            if known is None and sinks.has_status(spark, root):
                known = materialize(in_flight(spark, root, now), "in_flight")
            if not poll_is_due(before, now, lambda: known is None or known.isEmpty(), least, most):
                return None

            def count() -> None:
                counted = selection.count_unchecked(tables.url, tables.status, tables.url_context)
                counted.coalesce(1).write.mode("overwrite").parquet(f"{root}/unchecked/day={today}")

            ledger.once(spark, root, "unchecked", today.toordinal(), count)
            summary = run_cycle(replace(tables, in_flight=known), conf, today, root, now)
        ledger.commit(spark, root, "polled", 0 if entry is None else entry.number + 1, now.isoformat())
        return summary

    return poll


def read_unchecked(spark: SparkSession, root: str) -> DataFrame:
    """``day`` and ``unchecked``, one row for each day that was counted."""
    rows = ledger.read_if_there(spark, f"{root}/unchecked", "unchecked LONG, day DATE")
    return (spark.createDataFrame([], "unchecked LONG, day DATE") if rows is None else rows).select("day", "unchecked")
