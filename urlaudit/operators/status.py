"""Status rows: built from outcomes, upserted by URL, superseded rows kept as history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlaudit.config import CATEGORIES
from urlaudit.functions import records
from urlaudit.operators.selection import active_ids
from urlaudit.operators.skew import ordered_run
from urlaudit.schema import STATUS_COLUMNS


def as_timestamp(at) -> Column:
    return at if isinstance(at, Column) else F.lit(str(at)).cast("timestamp_ntz")


def known_urls(rows: DataFrame, url: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of registered URLs, rows whose ``url_id`` is unknown)."""
    flagged = with_known(rows, url)
    return flagged.filter("known").drop("known"), flagged.filter(~F.col("known")).drop("known")


def with_known(rows: DataFrame, url: DataFrame) -> DataFrame:
    """Add ``known``: the register has the row's ``url_id``."""
    ids = url.select(F.col("id").alias("url_id"), F.lit(True).alias("_registered"))
    joined = rows.join(ids, ["url_id"], "left")
    return joined.withColumn("known", F.coalesce("_registered", F.lit(False))).drop("_registered")


def build_status(outcomes: DataFrame, checked_at) -> DataFrame:
    """Status rows of final outcomes. ``checked_at`` is the start of the check, a value or a column."""
    final = outcomes.filter(F.col("route") == "status")
    return final.select(
        "url_id",
        "category",
        records.truncate_message(F.col("message")).alias("message"),
        as_timestamp(checked_at).alias("checking_date"),
        F.col("status_code").cast("int").alias("status_code"),
        records.truncate_content_type(F.col("content_type")).alias("content_type"),
        F.col("content_length").cast("long").alias("content_length"),
        F.col("duration_ms").try_cast("int").alias("duration"),
        F.coalesce("redirect_count", F.lit(0)).cast("int").alias("redirect_count"),
        "method",
    )


def status_from_metadata(stream: DataFrame, metadata: str = "metadata", fallback_date=None) -> DataFrame:
    """Status rows from ``map<string, array<string>>`` records, the shape checks have on a stream.

    A date that is absent or unreadable is replaced by ``fallback_date`` (default: now). Unreadable numbers are NULL; a row without a
    readable id belongs to no URL, see ``split_unreadable``.
    """
    md = F.col(metadata)

    def text(key: str) -> Column:
        return records.first_value(md, key)

    now = F.current_timestamp().cast("timestamp_ntz") if fallback_date is None else as_timestamp(fallback_date)
    return stream.select(
        text("urlId").try_cast("long").alias("url_id"),
        text("fetch.category").alias("category"),
        records.truncate_message(text("fetch.message")).alias("message"),
        F.coalesce(records.checking_date(text("fetch.checkingDate")), now).alias("checking_date"),
        records.digits_to_number(text("fetch.statusCode")).alias("status_code"),
        records.truncate_content_type(text("fetch.contentType")).alias("content_type"),
        records.digits_to_number(text("fetch.byteLength"), "bigint").alias("content_length"),
        records.digits_to_number(text("fetch.duration")).alias("duration"),
        records.redirect_count(text("fetch.redirectCount")).alias("redirect_count"),
        records.method_label(text("http.method.head")).alias("method"),
    )


def split_unreadable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an id, rows to set aside because theirs could not be read)."""
    return rows.filter(F.col("url_id").isNotNull()), rows.filter(F.col("url_id").isNull())


def outcome_metadata(outcomes: DataFrame, checked_at) -> DataFrame:
    """``(url, metadata)`` records of final outcomes: the persisted keys, absent where there is no value."""
    date = F.date_format(as_timestamp(checked_at), "yyyy-MM-dd'T'HH:mm:ss")
    values = {
        "urlId": F.col("url_id").cast("string"),
        "originalUrl": F.col("original_url"),
        "fetch.checkingDate": date,
        "fetch.statusCode": F.col("status_code").cast("string"),
        "fetch.category": F.col("category"),
        "fetch.message": F.col("message"),
        "fetch.contentType": F.col("content_type"),
        "fetch.byteLength": F.col("content_length").cast("string"),
        "fetch.duration": F.col("duration_ms").cast("string"),
        "fetch.redirectCount": F.col("redirect_count").cast("string"),
        "http.method.head": (F.col("method") == "HEAD").cast("string"),
    }
    entries = F.create_map(*[part for key, value in values.items() for part in (F.lit(key), F.array(value))])
    present = F.map_filter(entries, lambda _, v: F.get(v, F.lit(0)).isNotNull())
    return outcomes.filter(F.col("route") == "status").select("url", present.alias("metadata"))


def invalid_categories(status: DataFrame) -> DataFrame:
    """Rows whose category is outside the domain; empty for sound data."""
    return status.filter(F.col("category").isNull() | ~F.col("category").isin(*CATEGORIES))


def newest_first(seq: str | None = None) -> list[Column]:
    return [F.desc("checking_date"), *([F.desc(seq)] if seq else [])]


def latest_status(checks: DataFrame, seq: str | None = None) -> DataFrame:
    """The newest check per URL; all but one row per URL and task are dropped before the shuffle."""
    window = Window.partitionBy("url_id").orderBy(*newest_first(seq))
    return checks.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def with_recency(checks: DataFrame, seq: str | None = None) -> DataFrame:
    """Add ``recency`` per URL: 1 is current, larger is history."""
    return ordered_run(checks, ["url_id"], newest_first(seq), number="recency")


def split_history(checks: DataFrame, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(current, history) of a log of checks."""
    ranked = with_recency(checks, seq)
    return ranked.filter("recency = 1").drop("recency"), ranked.filter("recency > 1").drop("recency")


def apply_checks(status: DataFrame, fresh: DataFrame) -> DataFrame:
    """Current and fresh rows together with ``is_current``.

    A late row never replaces a newer one. A row with the date of another for the same URL is the
    same check delivered again; it is stored once, so applying a batch twice changes nothing.
    """
    both = status.select(*STATUS_COLUMNS, F.lit(0).alias("_seq")).unionByName(
        fresh.select(*STATUS_COLUMNS, F.lit(1).alias("_seq"))
    )
    rest = [F.asc_nulls_last(c) for c in STATUS_COLUMNS if c not in ("url_id", "checking_date")]
    ranked = ordered_run(
        both,
        ["url_id"],
        [*newest_first("_seq"), *rest],
        number="_recency",
        previous={"_newer": F.col("checking_date")},
    )
    once = ranked.filter(~F.col("_newer").eqNullSafe(F.col("checking_date")) | (F.col("_recency") == 1))
    return once.select(*STATUS_COLUMNS, (F.col("_recency") == 1).alias("is_current"))


def archive_inactive(url: DataFrame, status: DataFrame, url_context: DataFrame, as_of) -> DataFrame:
    """URLs without any active context, flattened with their status, as rows of the obsolete table."""
    gone = url.join(active_ids(url_context), "id", "left_anti")
    last = status.withColumnRenamed("url_id", "id")
    return gone.join(last, "id", "left").withColumn("deletion_date", as_timestamp(as_of))
