"""Field rules of a status row, and helpers for multi-valued metadata maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metadata keys that are kept with a check.
PERSISTED_KEYS = (
    "urlId",
    "originalUrl",
    "fetch.checkingDate",
    "fetch.statusCode",
    "fetch.category",
    "fetch.message",
    "fetch.contentType",
    "fetch.byteLength",
    "fetch.duration",
    "fetch.startTime",
    "fetch.redirectCount",
    "http.method.head",
)


def _shorten(text: Column, below: int, keep: int, mark: str) -> Column:
    return F.when(F.length(text) < below, text).otherwise(F.concat(F.substring(text, 1, keep), F.lit(mark)))


def truncate_message(message: Column) -> Column:
    return _shorten(message, 1024, 1017, "[...]")


def truncate_content_type(content_type: Column) -> Column:
    return _shorten(content_type, 256, 250, "...")


def digits_to_number(text: Column, to: str = "int") -> Column:
    """A number only where the whole text is digits; too large a value is NULL."""
    return F.when(text.rlike(r"^[0-9]+\z"), text.try_cast(to))


def method_label(head_flag: Column) -> Column:
    return F.when(head_flag.isNull(), "N/A").when(F.lower(head_flag) == "true", "HEAD").otherwise("GET")


def redirect_count(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def checking_date(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def first_value(metadata: Column, key: str) -> Column:
    """First of the values under ``key``; NULL where the key is absent."""
    return F.get(F.element_at(metadata, key), F.lit(0))


def set_value(metadata: Column, key: str, value: Column) -> Column:
    """Replace all values of ``key``; dropping the old entry first needs no map-merge setting."""
    return F.map_concat(remove_key(metadata, key), F.create_map(F.lit(key), F.array(value)))


def remove_key(metadata: Column, key: str) -> Column:
    return F.map_filter(metadata, lambda k, _: k != key)


def merge_prefixed(metadata: Column, headers: Column, prefix: str = "") -> Column:
    """Add header values under prefixed keys; a header wins over an equal key."""
    added = F.transform_keys(headers, lambda k, _: F.concat(F.lit(prefix), k)) if prefix else headers
    kept = F.map_filter(metadata, lambda k, _: ~F.map_contains_key(added, k))
    return F.map_concat(kept, added)


def persisted(metadata: Column) -> Column:
    return F.map_filter(metadata, lambda k, _: k.isin(*PERSISTED_KEYS))

