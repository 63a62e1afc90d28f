"""Snapshots and logs the audit writes.

The status is a kept table: a batch is appended, and what is current follows from the dates. All checks are a log besides, of which the
history is the part that is not current. Both know a check by its URL and date, so a batch that is delivered again, after a failure, a
restart or under a new checkpoint, changes nothing; and what a batch writes is its own size, whatever the size of the status.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from urlaudit import schema
from urlaudit.operators.reports import latest_n
from urlaudit.sources import ledger
from urlaudit.sources.kept import Kept

REST = [name for name in schema.STATUS_COLUMNS if name not in ("url_id", "checking_date")]
LAST = StructType([schema.STATUS["checking_date"], *[schema.STATUS[name] for name in REST]])


def status_table(spark: SparkSession, root: str, buckets: int | None = None) -> Kept:
    layout = StructType([StructField("url_id", LongType()), StructField("last", LAST)])
    return Kept(spark, root, "status", "url_id", layout, buckets)


def _as_kept(rows: DataFrame) -> DataFrame:
    fields = [F.col(name).cast(schema.STATUS[name].dataType).alias(name) for name in ("checking_date", *REST)]
    return rows.select(F.col("url_id").cast("long").alias("url_id"), F.struct(*fields).alias("last"))


def _as_status(rows: DataFrame) -> DataFrame:
    return rows.select("url_id", "last.*").select(*schema.STATUS_COLUMNS)


def _log_checks(rows: DataFrame, root: str, name: str) -> DataFrame:
    """Write the rows that have an id to the log of checks; returns them as they were written."""
    path, rows = f"{root}/checks/part={name}", rows.select(*schema.STATUS_COLUMNS).where("url_id IS NOT NULL")
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def seed_status(status: DataFrame, root: str, buckets: int | None = None) -> None:
    """The status to begin with, from any status table; of several rows of a URL the newest."""
    rows = _log_checks(status, root, "seed")
    status_table(rows.sparkSession, root, buckets).seed(ledger.newest_of(_as_kept(rows), "url_id", "last"), rows.count())


def has_status(spark: SparkSession, root: str) -> bool:
    return status_table(spark, root).exists()


def read_status(spark: SparkSession, root: str) -> DataFrame:
    """The newest check of every URL."""
    return _as_status(status_table(spark, root).read())


def read_status_of(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """The newest check of the given distinct ``url_id``; the rest of the status is not moved."""
    return _as_status(status_table(spark, root).lookup(ids))


def read_checks(spark: SparkSession, root: str) -> DataFrame:
    """Every check once, whatever the number of its deliveries."""
    log = ledger.read_if_there(spark, f"{root}/checks/*", schema.STATUS)
    if log is None:
        return spark.createDataFrame([], schema.STATUS)
    once = log.groupBy("url_id", "checking_date").agg(F.max(F.struct(*REST)).alias("_rest"))
    return once.select("url_id", "checking_date", "_rest.*").select(*schema.STATUS_COLUMNS)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All superseded checks: those that are not the newest of their URL."""
    checks = read_checks(spark, root)
    newest = checks.groupBy("url_id").agg(F.max("checking_date").alias("_newest"))
    return checks.join(newest, "url_id").filter(F.col("checking_date") < F.col("_newest")).select(*schema.STATUS_COLUMNS)


def write_status(fresh: DataFrame, root: str, name: str | None = None) -> None:
    """Add checks. A late one never replaces a newer one; one that is there already is stored once. Rows without an id belong to no URL.

    ``name`` names the batch, so that a second attempt takes the place of the first."""
    spark, name = fresh.sparkSession, name or uuid.uuid4().hex
    kept = status_table(spark, root)
    if not kept.exists():
        raise ValueError(f"no status below {root}")
    kept.add(_as_kept(_log_checks(fresh, root, name)), name)
    kept.fold_if_long()


def keep_latest(checks: DataFrame, root: str, n: int = 100, seq: str | None = None) -> None:
    """Bring the snapshot of the newest ``n`` checks up to date. A check that it holds already is not added again.

    Two snapshots are kept, of which the ledger names the one in use, so a reader of it is not disturbed."""
    spark = checks.sparkSession
    before = _latest(spark, root, checks.schema)
    merged = checks if before is None else checks.unionByName(before).dropDuplicates()
    number = ledger.next_number(spark, root, "latest")
    latest_n(merged, n, seq).write.mode("overwrite").parquet(f"{root}/latest/slot={number % 2}")
    ledger.commit(spark, root, "latest", number)


def _latest(spark: SparkSession, root: str, layout: StructType) -> DataFrame | None:
    entry = ledger.last(spark, root, "latest")
    return None if entry is None else spark.read.schema(layout).parquet(f"{root}/latest/slot={entry.number % 2}")


def read_latest(spark: SparkSession, root: str, layout: StructType = schema.STATUS) -> DataFrame:
    found = _latest(spark, root, layout)
    return spark.createDataFrame([], layout) if found is None else found


def write_latest(checks: DataFrame, path: str, n: int = 100, seq: str | None = None) -> None:
    """The newest ``n`` checks as one JSON file, newest first, replaced as a whole."""
    latest_n(checks, n, seq).coalesce(1).write.mode("overwrite").json(path)
