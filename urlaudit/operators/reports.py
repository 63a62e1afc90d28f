"""Counts and lists an operator of the audit looks at."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from urlaudit.operators.skew import ordered_run
from urlaudit.operators.status import newest_first


def poll_summary(selected: DataFrame, queue_key: str = "queue_key") -> DataFrame:
    """Hits and distinct queues of one poll."""
    return selected.agg(F.count("*").alias("hits"), F.countDistinct(queue_key).alias("queues"))


def observed_summary(selected: DataFrame, seen: Observation, queue_key: str = "queue_key") -> DataFrame:
    """The poll itself; whoever writes it finds hits and distinct queues in ``seen`` without another pass.

    The queues are gathered as a set, no longer than the poll, which its selection bounds."""
    return selected.observe(seen, F.count(F.lit(1)).alias("hits"), F.size(F.collect_set(queue_key)).alias("queues"))


def poll_times(polls: DataFrame, elapsed: str, *by: str) -> DataFrame:
    """Number, mean and maximum of the query times of a poll log."""
    return polls.groupBy(*by).agg(
        F.count("*").alias("polls"), F.avg(elapsed).alias("avg_ms"), F.max(elapsed).alias("max_ms")
    )


def queue_summary(frontier: DataFrame, in_progress: str = "in_progress") -> DataFrame:
    """Per queue: URLs waiting and URLs being fetched."""
    busy = F.count_if(F.col(in_progress))
    return frontier.groupBy("queue_key").agg((F.count("*") - busy).alias("size"), busy.alias("in_progress"))


def queue_contents(frontier: DataFrame, seq: str = "seq", in_progress: str = "in_progress") -> DataFrame:
    """Every waiting URL with its position in its queue: the whole snapshot, as rows and not as lists."""
    waiting = frontier.filter(~F.col(in_progress)).select("queue_key", seq, "url")
    return ordered_run(waiting, ["queue_key"], [F.asc(seq)], number="position")


def being_fetched(frontier: DataFrame, in_progress: str = "in_progress") -> DataFrame:
    return frontier.filter(F.col(in_progress)).select("queue_key", "url")


def latest_n(checks: DataFrame, n: int = 100, seq: str | None = None) -> DataFrame:
    return checks.orderBy(*newest_first(seq)).limit(n)


def throughput(checks: DataFrame, every: int = 100, at: str = "checking_date", tie: str = "check_id") -> DataFrame:
    """Elapsed ``elapsed_us`` between every ``every``-th check; NULL for the first mark.

    Checks are numbered over ranges of their order.
    """
    return elapsed_between(marks(checks, every, at, tie), at)


def marks(checks: DataFrame, every: int = 100, at: str = "checking_date", tie: str = "check_id", before: int = 0) -> DataFrame:
    """``mark`` and date of every ``every``-th check, where ``before`` checks have been counted already."""
    numbered = ordered_run(checks.select(at, tie), [], [F.asc(at), F.asc(tie)], number="nr").withColumn("nr", F.col("nr") + before)
    return numbered.filter(F.col("nr") % every == 0).select((F.col("nr") / every).cast("long").alias("mark"), at)


def elapsed_between(marks: DataFrame, at: str = "checking_date") -> DataFrame:
    """Elapsed ``elapsed_us`` since the mark before, NULL for the first; a mark is sent to its own number and to the next."""
    both = marks.select(
        at, F.posexplode(F.array(F.col("mark"), F.col("mark") + 1)).alias("is_previous", "mark")
    )
    met = both.groupBy("mark").agg(
        F.max(F.when(F.col("is_previous") == 0, F.col(at))).alias("marked_at"),
        F.max(F.when(F.col("is_previous") == 1, F.col(at))).alias("_before"),
    )
    gap = F.timestamp_diff("MICROSECOND", F.col("_before"), F.col("marked_at"))
    return met.filter("marked_at IS NOT NULL").select("mark", "marked_at", gap.alias("elapsed_us"))
