"""Choosing the URLs that are due: register, status and contexts in, an ordered poll out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.config import (
    GROUP_LIMIT,
    HANDLE_GROUP,
    HANDLE_POLL_LIMIT,
    HEAD,
    POLL_LIMIT,
    PREFIX_LIMIT,
)
from urlaudit.functions import urls
from urlaudit.operators.skew import rank_within
from urlaudit.session import materialize


def as_date(as_of: str | dt.date | Column) -> Column:
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    return F.to_date(F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()))


def is_due(checking_date: Column, as_of) -> Column:
    """Never checked, or last checked two calendar days ago or more."""
    return checking_date.isNull() | (F.datediff(as_date(as_of), checking_date) > 1)


def active_ids(url_context: DataFrame) -> DataFrame:
    """Distinct URLs with an active context; the map-side distinct takes the weight off busy URLs."""
    return url_context.filter("active").select(F.col("url_id").alias("id")).distinct()


def poll_order() -> list[Column]:
    """Highest priority first, then never checked, then oldest; ``id`` makes the order total."""
    return [F.desc("priority"), F.asc_nulls_first("checking_date"), F.asc("id")]


def due_candidates(url: DataFrame, status: DataFrame, url_context: DataFrame, as_of) -> DataFrame:
    checked = status.select(F.col("url_id").alias("id"), "checking_date")
    return (
        url.filter("valid")
        .join(active_ids(url_context), "id", "left_semi")
        .join(checked, "id", "left")
        .filter(is_due(F.col("checking_date"), as_of))
    )


def _poll(candidates: DataFrame, group: Column, per_group: int, limit: int) -> DataFrame:
    ranked = rank_within(candidates, group, poll_order(), per_group, unique="id")
    return ranked.orderBy(*poll_order()).limit(limit)


def due_urls(url, status, url_context, as_of, per_group=GROUP_LIMIT, limit=POLL_LIMIT) -> DataFrame:
    """URLs outside the handle group, a bounded number per host; a NULL group is not selected."""
    candidates = due_candidates(url, status, url_context, as_of).filter(F.col("group_key") != HANDLE_GROUP)
    return _poll(candidates, F.col("group_key"), per_group, limit)


def due_handles(url, status, url_context, as_of, per_group=PREFIX_LIMIT, limit=HANDLE_POLL_LIMIT) -> DataFrame:
    """URLs of the handle group, a bounded number per handle prefix."""
    candidates = due_candidates(url, status, url_context, as_of).filter(F.col("group_key") == HANDLE_GROUP)
    return _poll(candidates, urls.handle_prefix(F.col("name")), per_group, limit)


def due_all(url, status, url_context, as_of) -> DataFrame:
    """Both polls from one pass over the candidates; their groups are disjoint, so nothing is de-duplicated.

    One ranking keyed by branch and group cuts every group to its limit; what is left is written and each poll takes its own rows."""
    candidates = due_candidates(url, status, url_context, as_of).filter(F.col("group_key").isNotNull())
    handle = F.col("group_key") == HANDLE_GROUP
    group = F.struct(handle.alias("handle"), F.when(handle, urls.handle_prefix(F.col("name"))).otherwise(F.col("group_key")).alias("of"))
    ranked = rank_within(candidates, group, poll_order(), max(GROUP_LIMIT, PREFIX_LIMIT), unique="id")
    ranked = materialize(ranked.filter(F.col("order_nr") <= F.when(handle, PREFIX_LIMIT).otherwise(GROUP_LIMIT)), "ranked")
    polls = [ranked.filter(chosen).orderBy(*poll_order()).limit(limit) for chosen, limit in ((~handle, POLL_LIMIT), (handle, HANDLE_POLL_LIMIT))]
    return polls[0].unionByName(polls[1])


def exclude_in_flight(selected: DataFrame, in_flight: DataFrame) -> DataFrame:
    """Drop URLs, by name, that are still being checked."""
    return selected.join(in_flight.select("name").distinct(), ["name"], "left_anti")


def seed_frontier(selected: DataFrame) -> DataFrame:
    """First attempts: HEAD, no redirects yet, the register's name as both original and current URL."""
    return selected.select(
        F.col("id").alias("url_id"),
        F.col("name").alias("original_url"),
        F.col("name").alias("url"),
        F.lit(HEAD).alias("method"),
        F.lit(0).alias("redirect_count"),
    )


def drop_blank(frontier: DataFrame) -> DataFrame:
    return frontier.filter(~urls.is_blank(F.col("url")))


def split_malformed(frontier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed, malformed) rows; blank URLs are in neither."""
    kept = drop_blank(frontier)
    return kept.filter(~urls.is_malformed(F.col("url"))), kept.filter(urls.is_malformed(F.col("url")))


def never_checked(url: DataFrame, status: DataFrame, url_context: DataFrame) -> DataFrame:
    """Valid, active URLs whose id is NOT IN status.

    A NULL ``url_id`` makes NOT IN true for no row. Spark would answer that with a broadcast of the
    whole status side; here one scalar carries the NULL test and the anti join may shuffle.
    """
    nulls = status.agg(F.count_if(F.col("url_id").isNull())).scalar()
    return (
        url.filter("valid")
        .join(active_ids(url_context), "id", "left_semi")
        .join(status.select(F.col("url_id").alias("id")), "id", "left_anti")
        .filter(nulls == 0)
    )


def count_unchecked(url: DataFrame, status: DataFrame, url_context: DataFrame) -> DataFrame:
    return never_checked(url, status, url_context).agg(F.count("*").alias("unchecked"))


def select_sql(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Any SQL as a source, as long as it returns ``id`` and ``name``; ``{name}`` stands for a given table, ``:name`` for an argument."""
    selected = spark.sql(sql, args=args or {}, **tables)
    missing = {"id", "name"} - {column.lower() for column in selected.columns}
    if missing:
        raise ValueError(f"the selection must return id and name, missing: {sorted(missing)}")
    return selected.select("id", "name")
