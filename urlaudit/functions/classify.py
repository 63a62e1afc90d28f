"""Categories and messages of a finished check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urlaudit.config import BROKEN, OK, RESTRICTED, UNDETERMINED, AuditConfig

# Exception classes whose URL counts as broken, subclasses spelled out because a
# table has no class hierarchy. Every other class is Undetermined.
BROKEN_EXCEPTIONS = (
    "java.net.MalformedURLException",
    "java.lang.IllegalArgumentException",
    "java.lang.NumberFormatException",
    "java.nio.charset.IllegalCharsetNameException",
    "java.nio.charset.UnsupportedCharsetException",
    "java.util.regex.PatternSyntaxException",
    "java.net.ConnectException",
    "org.apache.http.conn.HttpHostConnectException",
    "java.net.SocketTimeoutException",
    "org.apache.http.NoHttpResponseException",
    "org.apache.http.conn.ConnectTimeoutException",
    "java.net.UnknownHostException",
    "java.net.NoRouteToHostException",
    "org.apache.http.ConnectionClosedException",
)

# Messages stored with a status.
MSG_ROBOTS = "Blocked by robots.txt"
MSG_CRAWL_DELAY = "Crawl delay too long."
MSG_MALFORMED = "java.net.MalformedURLException"
MSG_TIMEOUT = "Socket timeout fetching"
MSG_UNKNOWN_HOST = "Unknown host"
MSG_PROTOCOL = ("the '", "'-protocol is not supported by the HostProtocolFactory")


def category_of_exception(cls: Column, also_broken: tuple[str, ...] = ()) -> Column:
    """``also_broken`` names further classes, such as subclasses a crawl has met."""
    return F.when(cls.isin(*BROKEN_EXCEPTIONS, *also_broken), BROKEN).when(cls.isNotNull(), UNDETERMINED)


def message_of_exception(cls: Column, cause: Column, message: Column) -> Column:
    """The cause decides before the class; a blank message falls back to the class name."""
    timed_out = (cause == "java.util.concurrent.TimeoutException") | message.contains(" timed out")
    unknown = (cause == "java.net.UnknownHostException") | (cls == "java.net.UnknownHostException")
    blank = message.isNull() | message.rlike(r"^\s*$")
    return F.when(timed_out, MSG_TIMEOUT).when(unknown, MSG_UNKNOWN_HOST).when(blank, cls).otherwise(message)


def category_of_status(code: Column, conf: AuditConfig) -> Column:
    return (
        F.when(code.isin(*conf.ok_codes), OK)
        .when(code.isin(*conf.undetermined_codes), UNDETERMINED)
        .when(code.isin(*conf.restricted_codes), RESTRICTED)
        .when(code.isNotNull(), BROKEN)
    )


def message_of_status(category: Column, code: Column) -> Column:
    label = F.when(category == RESTRICTED, "Restricted access").otherwise(category)
    return F.when(category == OK, OK).otherwise(F.concat(label, F.lit(", Status code: "), code.cast("string")))


def message_of_limit(original_url: Column, conf: AuditConfig) -> Column:
    limit = conf.redirect_limit
    return F.concat(F.lit(f"Redirects exceeded {limit} redirects for "), original_url)


def message_of_login(original_url: Column) -> Column:
    return F.concat(original_url, F.lit(" points to a login page, therefore has restricted access."))


def message_of_protocol(scheme: Column) -> Column:
    before, after = MSG_PROTOCOL
    return F.concat(F.lit(before), F.lower(scheme), F.lit(after))
