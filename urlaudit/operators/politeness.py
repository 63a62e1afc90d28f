"""Pacing per host: delays, planned starts, turns, and an audit of what was actually done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlaudit.config import AuditConfig
from urlaudit.operators.gates import crawl_delay_too_long, effective_delay, slots, with_overrides, with_queue_key, with_robots
from urlaudit.operators.skew import ordered_run


def with_delay(
    frontier: DataFrame,
    conf: AuditConfig,
    robots_rules: DataFrame | None = None,
    host_overrides: DataFrame | None = None,
    given: str | None = None,
    **lookups: DataFrame,
) -> DataFrame:
    """Add ``queue_key``, ``queue_slots``, ``delay_ms``, ``gate`` (robots, crawl_delay or NULL) and ``effective_timeout_ms``."""
    keyed = with_queue_key(frontier, conf, given=given, **lookups)
    looked_up = with_robots(with_overrides(keyed, host_overrides, conf), robots_rules)
    with_slots = looked_up.withColumn("queue_slots", slots(F.col("queue_key"), conf))
    delay = effective_delay(F.col("robots_delay_ms"), F.col("override_delay_ms"), F.col("queue_slots"), conf)
    too_long = crawl_delay_too_long(F.col("robots_delay_ms"), F.col("override_delay_ms"), conf)
    gate = F.when(~F.col("robots_allowed"), "robots").when(too_long, "crawl_delay")
    return with_slots.withColumns({"delay_ms": delay, "gate": gate})


def plan_schedule(frontier: DataFrame, duration: Column, seq: str = "seq") -> DataFrame:
    """Add ``start_offset_ms``: each queue is served first in, first out, one item at a time.

    The next start is the end of the item before plus the delay. An item that a ``gate`` answers is not requested: it takes no time
    and costs no delay. Queues with several slots start items side by side; their waits are not known, and the offset is NULL.
    """
    asked = F.col("gate").isNull()
    cost = F.when(asked, duration.cast("long") + F.col("delay_ms").cast("long")).otherwise(F.lit(0).cast("long"))
    planned = ordered_run(frontier, ["queue_key"], [F.asc(seq)], totals={"start_offset_ms": cost})
    return planned.withColumn("start_offset_ms", F.when(F.col("queue_slots") == 1, F.col("start_offset_ms")))


def interleave(frontier: DataFrame, seq: str = "seq") -> DataFrame:
    """Round robin: one item per queue and ``turn``, in sorted order."""
    numbered = ordered_run(frontier, ["queue_key"], [F.asc(seq)], number="turn")
    return numbered.orderBy("turn", "queue_key")


def audit_gaps(checks: DataFrame, delay_ms: Column, host: str = "host", tie: str = "check_id") -> DataFrame:
    """Add ``gap_us`` to the check before on the same host (NULL for the first) and ``too_early``."""
    order = [F.asc("checking_date"), F.asc(tie)]
    paired = ordered_run(checks, [host], order, previous={"previous_date": F.col("checking_date")})
    gap = F.timestamp_diff("MICROSECOND", F.col("previous_date"), F.col("checking_date"))
    return paired.withColumn("gap_us", gap).withColumn(
        "too_early", F.coalesce(F.col("gap_us") < delay_ms * 1000, F.lit(False))
    )
