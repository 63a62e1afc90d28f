"""URL expressions. ``parse_url`` rejects spaces and odd hosts that crawlers meet, so patterns are used."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Schemes accepted as well-formed, schemes that can be fetched.
KNOWN_SCHEMES = "https?|ftp|file|jar|mailto"
FETCHABLE_SCHEMES = "https?"

HOST_PATTERN = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)"
PATH_PATTERN = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)"
BAD_PORT_PATTERN = rf"(?i)^(?:{KNOWN_SCHEMES})://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^\[:/?#]*):[^/?#]*[^0-9/?#]"
HANDLE_PATTERN = "hdl.handle.net/([^/]*)"

# Characters a strict URI parser refuses, and host names it accepts as server names.
ILLEGAL = r'\x00-\x20"<>\\^`{|}\x7f'
LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
SERVER_HOST = (
    rf"(?:(?:{LABEL}\.)*[A-Za-z](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.?|[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}|\[[^\]]*\])"
)
SERVER_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*://)(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)(?s:.*)$"


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def is_malformed(url: Column) -> Column:
    """No known scheme, or a port that is not a number. NULL and blank URLs are a separate case."""
    return ~url.rlike(f"(?i)^(?:{KNOWN_SCHEMES}):") | url.rlike(BAD_PORT_PATTERN)


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def is_fetchable(url: Column) -> Column:
    return url.rlike(f"(?i)^(?:{FETCHABLE_SCHEMES}):")


def host(url: Column) -> Column:
    """Host with its case kept; empty string where there is none."""
    return F.regexp_extract(url, HOST_PATTERN, 1)


def path_and_query(url: Column) -> Column:
    """The part robots rules are matched against; an empty path counts as ``/``."""
    part = F.regexp_extract(url, PATH_PATTERN, 1)
    return F.when(part.startswith("/"), part).otherwise(F.concat(F.lit("/"), part))


def correct_url(url: Column) -> Column:
    """The form that is requested and compared with rules and login pages."""
    return F.replace(url, F.lit(" "), F.lit("%20"))


def handle_prefix(name: Column) -> Column:
    return F.regexp_extract(name, HANDLE_PATTERN, 1)


def queue_key_host(url: Column) -> Column:
    return F.lower(F.when(host(url) == "", url).otherwise(host(url)))


def queue_key(url: Column, given: Column | None = None, found: Column | None = None) -> Column:
    """A non-blank given key wins; then the domain or address found by a lookup; then the host."""
    by_mode = queue_key_host(url) if found is None else F.coalesce(F.lower(found), queue_key_host(url))
    return by_mode if given is None else F.when(given.rlike(r"\S"), F.lower(given)).otherwise(by_mode)


def _without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def _directory(url: Column) -> Column:
    """Up to the last slash before the query, without it; NULL without any slash."""
    base = _without_query(url)
    return F.when(base.contains("/"), F.left(base, F.length(base) - F.length(F.substring_index(base, "/", -1)) - 1))


def _is_strict_uri(url: Column) -> Column:
    return ~url.rlike(f"[{ILLEGAL}]")


def _server(url: Column) -> Column:
    """``scheme://host`` without user and port; a host that is no server name reads ``null``."""
    server = F.regexp_replace(url, SERVER_PATTERN, "$1$2")
    return F.regexp_replace(server, f"://(?!{SERVER_HOST}$).*$", "://null")


def resolve_location(url: Column, location: Column, mode: str = "compat") -> Column:
    """Target of a redirect, NULL where it cannot be built (see ``location_error``).

    ``compat`` keeps the register's established results, including the port that is dropped for
    root-relative targets and the slash lost for bare ones. ``rfc3986`` joins by the standard.
    """
    if mode == "rfc3986":
        return _join_rfc3986(url, location)
    if mode != "compat":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        F.when(location.startswith("."), F.concat(_directory(url), F.substring(location, 2, 2**31 - 1)))
        .when(location.startswith("/"), F.when(_is_strict_uri(url), F.concat(_server(url), location)))
        .when(location.rlike("^(http|ftp).+$"), location)
        .otherwise(F.concat(_directory(url), location))
    )


def location_error(url: Column, location: Column) -> Column:
    """``struct(class, message)`` where ``resolve_location`` has no result in ``compat`` mode, else NULL."""
    legal = F.regexp_extract(url, f"^([^{ILLEGAL}]*)", 1)
    part = F.when(legal.contains("#"), "fragment").when(legal.contains("?"), "query").otherwise("path")
    message = F.concat(
        F.lit("Illegal character in "), part, F.lit(" at index "), F.length(legal).cast("string"), F.lit(": "), url
    )
    return F.when(
        location.isNull(),
        F.struct(
            F.lit("java.net.MalformedURLException").alias("class"),
            F.lit("Location Header in a redirect shouldn't be null.").alias("message"),
        ),
    ).when(
        location.startswith("/") & ~_is_strict_uri(url),
        F.struct(F.lit("java.net.URISyntaxException").alias("class"), message.alias("message")),
    ).when(
        ~location.startswith("/") & ~(location.rlike("^(http|ftp).+$") & ~location.startswith(".")) & ~_without_query(url).contains("/"),
        F.struct(
            F.lit("java.lang.StringIndexOutOfBoundsException").alias("class"),
            F.concat(F.lit("begin 0, end -1, length "), F.length(_without_query(url)).cast("string")).alias("message"),
        ),
    )


@F.pandas_udf(StringType())
def _join_rfc3986(url: pd.Series, location: pd.Series) -> pd.Series:
    return pd.Series(
        [None if u is None or t is None else urljoin(u, t) for u, t in zip(url, location)], dtype="object"
    )
