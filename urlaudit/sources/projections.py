"""The benchmark tables seen as a URL register, its observed responses and its check log.

Every projection reads a whole table; configuration-sized inputs (overrides, listed pages and
suffixes) are literals, as they would be in a settings file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.config import AuditConfig

AS_OF = "1999-01-01"
CHECKED_AT = "1999-01-01 00:00:00"
LOGIN_PAGE = "http://login.example.org/idp"

CONF = AuditConfig(redirect_limit=15)
DELAY_CONF = AuditConfig(
    redirect_limit=15,
    max_crawl_delay_ms=30_000,
    min_delay_ms=250,
    queue_threads=((r"hdl\..*", 2), (r"host1.*", 3)),
    queue_timeout_ms=60_000,
)

NAME = (
    "CASE WHEN b % 5 = 0 THEN concat('http://hdl.handle.net/', b % 200, '/', k) "
    "ELSE concat('http://host', b % 50, '.example.org/page', k) END"
)
GROUP = "CASE WHEN b % 5 = 0 THEN 'hdl.handle.net' ELSE concat('host', b % 50, '.example.org') END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_orderkey % 40 AS r", "o_orderkey div 40 AS b", "o_orderpriority", "o_orderdate"
    )


def url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "k AS id",
        f"{NAME} AS name",
        f"{GROUP} AS group_key",
        "k % 17 <> 0 AS valid",
        "6 - cast(substring(o_orderpriority, 1, 1) AS int) AS priority",
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last check of three URLs in four; only the columns the selection reads."""
    return table(spark, sf_dir, "orders").filter("o_orderkey % 4 <> 0").selectExpr(
        "o_orderkey AS url_id", "o_orderdate AS checking_date"
    )


def full_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every status column."""
    return table(spark, sf_dir, "orders").filter("o_orderkey % 4 <> 0").selectExpr(
        "o_orderkey AS url_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'Broken' ELSE 'Ok' END AS category",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'Broken, Status code: 404' ELSE 'Ok' END AS message",
        "o_orderdate AS checking_date",
        "CASE WHEN o_orderkey % 3 = 0 THEN 404 ELSE 200 END AS status_code",
        "'text/html' AS content_type",
        "o_orderkey % 700 AS content_length",
        "cast(o_orderkey % 90 AS int) AS duration",
        "0 AS redirect_count",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'GET' ELSE 'HEAD' END AS method",
    )


def url_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS url_id",
        "l_suppkey AS context_id",
        "l_shipdate AS ingestion_date",
        "l_returnflag <> 'R' AS active",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A HEAD and a GET observation per URL: chains of 18 redirects, every status class, failures."""
    below = "CASE WHEN b % 5 = 0 THEN concat('/', b % 200, '/', k + 1) ELSE concat('/page', k + 1) END"
    name_of_next = NAME.replace(", k)", ", k + 1)")
    here = "CASE WHEN b % 5 = 0 THEN concat('./', k + 1) ELSE concat('./page', k + 1) END"
    attempts = _orders(spark, sf_dir).withColumn("method", F.explode(F.array(F.lit("HEAD"), F.lit("GET"))))
    return attempts.selectExpr(
        f"{NAME} AS url",
        "method",
        """CASE WHEN r <= 17 THEN element_at(array(301, 302, 303, 307, 308), cast(r % 5 AS int) + 1)
                WHEN r = 19 THEN 304 WHEN r = 20 THEN 405 WHEN r = 21 THEN 429 WHEN r = 22 THEN 401
                WHEN r = 23 THEN 403 WHEN r = 24 THEN 404 WHEN r = 25 THEN 500
                WHEN r = 26 AND method = 'HEAD' THEN 405
                WHEN r = 27 AND method = 'HEAD' THEN NULL
                WHEN r BETWEEN 28 AND 31 THEN NULL
                WHEN r IN (32, 33) THEN 301 ELSE 200 END AS status_code""",
        f"""CASE WHEN r <= 17 AND r % 3 = 0 THEN {name_of_next}
                 WHEN r <= 17 AND r % 3 = 1 THEN {below}
                 WHEN r <= 17 THEN {here}
                 WHEN r = 33 THEN '{LOGIN_PAGE}' END AS location""",
        "map('content-length', cast(100 + k % 900 AS string), 'content-type', 'text/html') AS headers",
        """CASE WHEN r = 27 AND method = 'HEAD' THEN 'java.net.SocketTimeoutException'
                WHEN r = 28 THEN 'java.net.UnknownHostException'
                WHEN r = 29 THEN 'java.net.SocketTimeoutException'
                WHEN r = 30 THEN 'javax.net.ssl.SSLException'
                WHEN r = 31 THEN 'java.net.SocketException' END AS exception_class""",
        "CASE WHEN r = 29 AND b % 2 = 0 THEN 'java.util.concurrent.TimeoutException' END AS cause_class",
        """CASE WHEN r IN (27, 29) THEN 'Read timed out' WHEN r = 28 THEN 'no such host'
                WHEN r = 31 THEN 'Connection reset' END AS exception_message""",
        "20 + k % 500 AS duration_ms",
    )


def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = _orders(spark, sf_dir).selectExpr("b % 50 AS n").filter("n % 5 <> 0").distinct()
    rules = """CASE WHEN n % 10 = 1 THEN array(
                   named_struct('rule', 'disallow', 'path_prefix', '/page1', 'crawl_delay_ms', cast(NULL AS bigint)),
                   named_struct('rule', 'allow', 'path_prefix', '/page11', 'crawl_delay_ms', cast(NULL AS bigint)))
               WHEN n % 10 = 4 THEN array(
                   named_struct('rule', 'disallow', 'path_prefix', '', 'crawl_delay_ms', cast(NULL AS bigint)),
                   named_struct('rule', 'disallow', 'path_prefix', '/*7$', 'crawl_delay_ms', cast(NULL AS bigint)),
                   named_struct('rule', 'allow', 'path_prefix', '/page*77', 'crawl_delay_ms', cast(NULL AS bigint)))
               WHEN n = 7 THEN transform(sequence(0, 9999), i -> named_struct('rule', if(i % 3 = 0, 'disallow', 'allow'),
                   'path_prefix', concat('/page', i), 'crawl_delay_ms', cast(NULL AS bigint)))
               WHEN n % 10 IN (2, 3) THEN array(named_struct('rule', 'allow', 'path_prefix', '/',
                   'crawl_delay_ms', CASE WHEN n % 10 = 2 THEN 2000L ELSE 40000L END)) END"""
    return hosts.selectExpr("concat('host', n, '.example.org') AS host", f"inline({rules})")


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of checks, one row per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS check_id",
        "user_id AS url_id",
        "concat('h', user_id % 20) AS host",
        "ts AS checking_date",
        """CASE event_type WHEN 'view' THEN 'Ok' WHEN 'signup' THEN 'Ok' WHEN 'error' THEN 'Broken'
           WHEN 'click' THEN 'Undetermined' WHEN 'purchase' THEN 'Restricted_Access' END AS category""",
        "cast(floor(value) AS int) AS duration",
        "try_cast(get_json_object(props, '$.k') AS int) % 5 AS redirect_count",
    )


def check_records(log: DataFrame) -> DataFrame:
    """The log as complete status rows, with ``check_id`` kept."""
    return log.selectExpr(
        "url_id",
        "category",
        "category AS message",
        "checking_date",
        "cast(NULL AS int) AS status_code",
        "cast(NULL AS string) AS content_type",
        "cast(NULL AS bigint) AS content_length",
        "duration",
        "redirect_count",
        "'GET' AS method",
        "check_id",
    )


def in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url(spark, sf_dir).filter("id % 13 = 0").select("name")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every href of every page against the page's URL, in four relative forms."""
    pages = table(spark, sf_dir, "pages")
    links = pages.select(
        "page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("nr", "href")
    )
    return links.selectExpr(
        "page_id",
        "cast(nr AS int) AS nr",
        "url",
        """CASE page_id % 4 WHEN 0 THEN href WHEN 1 THEN concat('.', href) WHEN 2 THEN substring(href, 2)
           ELSE concat('https://links.example.org', href) END AS location""",
    )


def odd_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register with the names a crawler must survive: blank, malformed, spaced, unsupported."""
    return _orders(spark, sf_dir).selectExpr(
        "k AS url_id",
        """CASE k % 9 WHEN 0 THEN concat('http://Host', b % 50, '.Example.ORG:8080/p?q=', k)
           WHEN 1 THEN '  ' WHEN 2 THEN concat('htp:/broken', k) WHEN 3 THEN concat('http://h.example.org/a b', k)
           WHEN 4 THEN concat('ftp://files.example.org/', k) WHEN 5 THEN concat('http://h.example.org:x', k, '/')
           WHEN 6 THEN concat('mailto:someone', k) WHEN 7 THEN concat('https://user@in_valid.example.co.uk#', k)
           ELSE concat('http://[::1]:80/', k) END AS url""",
    )


def login_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(LOGIN_PAGE,)], "url string")


def host_overrides(spark: SparkSession) -> DataFrame:
    rows = [("hdl.handle.net", 100, None), ("host1.example.org", None, 10000)]
    return spark.createDataFrame(rows, "host string, delay_ms long, timeout_ms long")


def short_timeouts(spark: SparkSession) -> DataFrame:
    """Two hosts that are given less time than some of their answers took."""
    rows = [("hdl.handle.net", None, 300), ("host7.example.org", None, 100)]
    return spark.createDataFrame(rows, "host string, delay_ms long, timeout_ms long")


def public_suffixes(spark: SparkSession) -> DataFrame:
    """Rules of all kinds: plain ones, ``*.net`` and ``*.org`` with wildcards, ``!example.org`` as an exception."""
    rules = ["com", "org", "*.org", "!example.org", "net", "*.net", "co.uk"]
    return spark.createDataFrame([(rule,) for rule in rules], "suffix string")


def host_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of two hosts in three of the register."""
    hosts = url(spark, sf_dir).selectExpr(r"regexp_extract(name, '^http://([^/]*)', 1) AS host").distinct()
    return hosts.filter("length(host) % 3 <> 0").selectExpr("host", "concat('10.0.', length(host), '.1') AS ip")
