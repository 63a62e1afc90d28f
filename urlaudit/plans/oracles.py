"""The registered queries as SQL for DuckDB over the same tables."""

from __future__ import annotations

import re

LIMIT = 15
ROBOTS_MAX_MS = 30_000

_NAME = (
    "CASE WHEN b % 5 = 0 THEN concat('http://hdl.handle.net/', b % 200, '/', {k}) "
    "ELSE concat('http://host', b % 50, '.example.org/page', {k}) END"
)
_GROUP = "CASE WHEN b % 5 = 0 THEN 'hdl.handle.net' ELSE concat('host', b % 50, '.example.org') END"
_HOST = r"regexp_extract({u}, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)', 1)"
_DIR = "regexp_extract({u}, '(?s)^([^?]*)/', 1)"
_SERVER = (
    r"regexp_replace({u}, '^([A-Za-z][A-Za-z0-9+.-]*://)(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)(?s:.*)$', '\1\2')"
)
_LOCATION = (
    "CASE WHEN starts_with(location, '.') THEN " + _DIR.format(u="url") + " || substr(location, 2) "
    "WHEN starts_with(location, '/') THEN " + _SERVER.format(u="url") + " || location "
    "WHEN regexp_matches(location, '^(http|ftp).+$') THEN location "
    "ELSE " + _DIR.format(u="url") + " || location END"
)

# Each table of the engine as a common table expression; a query names the ones it needs, in order.
CTES = {
    "ord": "SELECT *, o_orderkey AS k, o_orderkey % 40 AS r, o_orderkey // 40 AS b FROM orders",
    "url": f"""SELECT k AS id, {_NAME.format(k='k')} AS name, {_GROUP} AS group_key, k % 17 <> 0 AS valid,
        CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INT) AS INT) AS priority FROM ord""",
    "status": "SELECT o_orderkey AS url_id, o_orderdate AS checking_date FROM orders WHERE o_orderkey % 4 <> 0",
    "full_status": """SELECT o_orderkey AS url_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Broken' ELSE 'Ok' END AS category,
        CASE WHEN o_orderkey % 3 = 0 THEN 'Broken, Status code: 404' ELSE 'Ok' END AS message,
        o_orderdate AS checking_date, CASE WHEN o_orderkey % 3 = 0 THEN 404 ELSE 200 END AS status_code,
        'text/html' AS content_type, o_orderkey % 700 AS content_length, CAST(o_orderkey % 90 AS INT) AS duration,
        0 AS redirect_count, CASE WHEN o_orderkey % 3 = 0 THEN 'GET' ELSE 'HEAD' END AS method
        FROM orders WHERE o_orderkey % 4 <> 0""",
    "url_context": "SELECT l_orderkey AS url_id, l_returnflag <> 'R' AS active FROM lineitem",
    "candidates": """SELECT u.*, s.checking_date FROM url u LEFT JOIN status s ON s.url_id = u.id
        WHERE u.valid AND u.id IN (SELECT c.url_id FROM url_context c WHERE c.active)
        AND (s.checking_date IS NULL OR date_diff('day', s.checking_date, TIMESTAMP '1999-01-01') > 1)""",
    "ranked_urls": """SELECT *, row_number() OVER (PARTITION BY group_key
        ORDER BY priority DESC, checking_date NULLS FIRST, id) AS order_nr
        FROM candidates WHERE group_key <> 'hdl.handle.net'""",
    "due_urls": """SELECT * FROM ranked_urls WHERE order_nr <= 100
        ORDER BY priority DESC, checking_date NULLS FIRST, id LIMIT 3000""",
    "prefixed": """SELECT *, regexp_extract(name, 'hdl.handle.net/([^/]*)', 1) AS handle_prefix
        FROM candidates WHERE group_key = 'hdl.handle.net'""",
    "ranked_handles": """SELECT *, row_number() OVER (PARTITION BY handle_prefix
        ORDER BY priority DESC, checking_date NULLS FIRST, id) AS order_nr FROM prefixed""",
    "due_handles": """SELECT * FROM ranked_handles WHERE order_nr <= 20
        ORDER BY priority DESC, checking_date NULLS FIRST, id LIMIT 500""",
    "due_all": "SELECT id, name, group_key FROM due_urls UNION ALL SELECT id, name, group_key FROM due_handles",
    "odd_urls": """SELECT k AS url_id, CASE k % 9 WHEN 0 THEN concat('http://Host', b % 50, '.Example.ORG:8080/p?q=', k)
        WHEN 1 THEN '  ' WHEN 2 THEN concat('htp:/broken', k) WHEN 3 THEN concat('http://h.example.org/a b', k)
        WHEN 4 THEN concat('ftp://files.example.org/', k) WHEN 5 THEN concat('http://h.example.org:x', k, '/')
        WHEN 6 THEN concat('mailto:someone', k) WHEN 7 THEN concat('https://user@in_valid.example.co.uk#', k)
        ELSE concat('http://[::1]:80/', k) END AS url FROM ord""",
    "page_links": """SELECT page_id, CAST(nr - 1 AS INT) AS nr, url,
        CASE page_id % 4 WHEN 0 THEN href WHEN 1 THEN '.' || href WHEN 2 THEN substr(href, 2)
        ELSE 'https://links.example.org' || href END AS location
        FROM (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS nr
              FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages))""",
    "responses": f"""SELECT {_NAME.format(k='k')} AS url, method,
        CASE WHEN r <= 17 THEN [301, 302, 303, 307, 308][r % 5 + 1] WHEN r = 19 THEN 304 WHEN r = 20 THEN 405
             WHEN r = 21 THEN 429 WHEN r = 22 THEN 401 WHEN r = 23 THEN 403 WHEN r = 24 THEN 404 WHEN r = 25 THEN 500
             WHEN r = 26 AND method = 'HEAD' THEN 405 WHEN r = 27 AND method = 'HEAD' THEN NULL
             WHEN r BETWEEN 28 AND 31 THEN NULL WHEN r IN (32, 33) THEN 301 ELSE 200 END AS status_code,
        CASE WHEN r <= 17 AND r % 3 = 0 THEN {_NAME.format(k='k + 1')}
             WHEN r <= 17 AND r % 3 = 1 THEN
                 CASE WHEN b % 5 = 0 THEN concat('/', b % 200, '/', k + 1) ELSE concat('/page', k + 1) END
             WHEN r <= 17 THEN CASE WHEN b % 5 = 0 THEN concat('./', k + 1) ELSE concat('./page', k + 1) END
             WHEN r = 33 THEN 'http://login.example.org/idp' END AS location,
        100 + k % 900 AS content_length, 'text/html' AS content_type, 20 + k % 500 AS duration_ms,
        CASE WHEN r = 27 AND method = 'HEAD' THEN 'java.net.SocketTimeoutException'
             WHEN r = 28 THEN 'java.net.UnknownHostException' WHEN r = 29 THEN 'java.net.SocketTimeoutException'
             WHEN r = 30 THEN 'javax.net.ssl.SSLException' WHEN r = 31 THEN 'java.net.SocketException' END
             AS exception_class,
        CASE WHEN r = 29 AND b % 2 = 0 THEN 'java.util.concurrent.TimeoutException' END AS cause_class,
        CASE WHEN r IN (27, 29) THEN 'Read timed out' WHEN r = 28 THEN 'no such host'
             WHEN r = 31 THEN 'Connection reset' END AS exception_message
        FROM ord, (VALUES ('HEAD'), ('GET')) m(method)""",
    "attempts": f"""SELECT *, coalesce(status_code IN (301, 302, 303, 307, 308), false) AS redirects,
        coalesce(status_code IN (200, 304), false) AS ok,
        CASE WHEN status_code IN (301, 302, 303, 307, 308) THEN {_LOCATION} END AS target FROM responses""",
    "ungated": "SELECT NULL AS url, NULL AS gate WHERE false",
    "rules": """SELECT concat('host', n, '.example.org') AS host, rule, prefix, delay FROM
        (SELECT DISTINCT b % 50 AS n FROM ord WHERE b % 5 <> 0) h JOIN (VALUES
            (1, 'disallow', '/page1', NULL), (1, 'allow', '/page11', NULL),
            (4, 'disallow', '', NULL), (4, 'disallow', '/*7$', NULL), (4, 'allow', '/page*77', NULL),
            (2, 'allow', '/', 2000), (3, 'allow', '/', 40000)) v(d, rule, prefix, delay) ON h.n % 10 = v.d
        UNION ALL SELECT 'host7.example.org', CASE WHEN i % 3 = 0 THEN 'disallow' ELSE 'allow' END, '/page' || i, NULL
        FROM range(10000) t(i) WHERE EXISTS (SELECT 1 FROM ord WHERE b % 50 = 7)""",
    "robots": f"""SELECT u.id, u.name, coalesce(arg_max(rule, length(prefix) * 2 + CAST(rule = 'allow' AS INT))
            FILTER (prefix <> '' AND CASE prefix WHEN '/*7$' THEN ends_with(u.name, '7')
                WHEN '/page*77' THEN regexp_matches(u.name, '/page.*77')
                ELSE starts_with(substr(u.name, length('http://' || {_HOST.format(u='u.name')}) + 1), prefix) END), 'allow')
            = 'allow' AS allowed,
        CAST(max(delay) AS BIGINT) AS delay
        FROM url u LEFT JOIN rules ON rules.host = {_HOST.format(u='u.name')} GROUP BY u.id, u.name""",
    "robots_gated": f"""SELECT name AS url, CASE WHEN NOT allowed THEN 'robots' ELSE 'crawl_delay' END AS gate
        FROM robots WHERE NOT allowed OR delay > {ROBOTS_MAX_MS}""",
    "valid_starts": "SELECT id, name FROM url WHERE valid",
    "poll_starts": "SELECT id, name FROM due_all",
    "checks": """SELECT event_id AS check_id, user_id AS url_id, concat('h', user_id % 20) AS host, ts AS checking_date,
        CASE event_type WHEN 'view' THEN 'Ok' WHEN 'signup' THEN 'Ok' WHEN 'error' THEN 'Broken'
            WHEN 'click' THEN 'Undetermined' WHEN 'purchase' THEN 'Restricted_Access' END AS category,
        CAST(floor(value) AS INT) AS duration,
        CAST(try_cast(json_extract_string(props, '$.k') AS INT) % 5 AS INT) AS redirect_count FROM events""",
    "paced": """SELECT u.id AS url_id, u.id AS seq, u.group_key AS queue_key, 20 + u.id % 500 AS duration_ms, allowed,
        r.delay AS robots_delay_ms,
        CASE WHEN u.group_key = 'hdl.handle.net' THEN CAST(100 AS BIGINT) END AS override_delay_ms,
        CAST(CASE WHEN u.group_key = 'host1.example.org' THEN 10000 ELSE 5000 END AS BIGINT) AS effective_timeout_ms,
        CASE WHEN regexp_full_match(u.group_key, 'hdl\\..*') THEN 2 WHEN regexp_full_match(u.group_key, 'host1.*') THEN 3
            ELSE 1 END AS queue_slots FROM url u JOIN robots r USING (id) WHERE u.valid""",
    "delayed": f"""SELECT *, CASE WHEN NOT allowed THEN 'robots'
        WHEN override_delay_ms IS NULL AND robots_delay_ms > {ROBOTS_MAX_MS} THEN 'crawl_delay' END AS gate, CAST(CASE WHEN queue_slots > 1 THEN 250 WHEN override_delay_ms IS NOT NULL
        THEN override_delay_ms WHEN robots_delay_ms > {ROBOTS_MAX_MS} THEN 1000 WHEN robots_delay_ms > 0
        THEN robots_delay_ms ELSE 1000 END AS BIGINT) AS delay_ms FROM paced""",
    "snapshot": "SELECT id AS seq, name AS url, group_key AS queue_key, id % 97 = 0 AS in_progress FROM url",
}

# The second of two polls, an hour and more after the first: the URLs of the first have been checked on the day itself.
_CHAIN = ["candidates", "ranked_urls", "due_urls", "prefixed", "ranked_handles", "due_handles", "due_all"]
CTES["status_again"] = """SELECT url_id, checking_date FROM status WHERE url_id NOT IN (SELECT id FROM due_all)
    UNION ALL SELECT id, TIMESTAMP '1999-01-01' FROM due_all"""
for _name in _CHAIN:
    CTES[f"{_name}_again"] = re.sub(rf"\b({'|'.join([*_CHAIN, 'status'])})\b", r"\1_again", CTES[_name])
CTES["two_polls"] = "SELECT id, name FROM due_all UNION ALL SELECT id, name FROM due_all_again"

_REGISTER = ["ord", "url", "status", "url_context", "candidates"]
_URLS = [*_REGISTER, "ranked_urls", "due_urls"]
_HANDLES = [*_REGISTER, "prefixed", "ranked_handles", "due_handles"]
_ALL = [*_URLS, "prefixed", "ranked_handles", "due_handles", "due_all"]
_PACED = ["ord", "url", "rules", "robots", "paced", "delayed"]


def sql(names: list[str], body: str, **renamed: str) -> str:
    """``body`` over the named expressions; ``renamed`` maps a name used in it to another expression."""
    parts = [f"{name} AS ({CTES[renamed.get(name, name)]})" for name in dict.fromkeys(names)]
    return f"WITH RECURSIVE {', '.join(parts)} {body}"


CTES["timed_responses"] = f"""SELECT url, method, CASE WHEN NOT late THEN status_code END AS status_code,
        CASE WHEN NOT late THEN location END AS location, content_length, content_type, duration_ms,
        CASE WHEN late THEN 'java.net.SocketTimeoutException' ELSE exception_class END AS exception_class, cause_class,
        CASE WHEN late THEN 'Read timed out' ELSE exception_message END AS exception_message
        FROM (SELECT *, exception_class IS NULL AND duration_ms > CASE {_HOST.format(u='url')}
            WHEN 'hdl.handle.net' THEN 300 WHEN 'host7.example.org' THEN 100 ELSE 5000 END AS late FROM ({CTES['responses']}))"""


def resolution(
    starts: str, select: str, gates: str = "ungated", needs: tuple[str, ...] = (), missing: str = "false", responses: str = "responses"
) -> str:
    """The whole resolution as a recursive walk, then ``select`` over its final states ``done``."""
    names = ["ord", "url", *needs, starts, "responses", "attempts", *(["rules", "robots"] if gates != "ungated" else []), gates]
    walk = f"""
    , tried AS (SELECT * FROM attempts WHERE NOT ({missing}))
    , walk(url_id, original_url, url, method, rc) AS (
        SELECT id, name, name, 'HEAD', 0 FROM {starts}
        UNION ALL
        SELECT w.url_id, w.original_url,
            CASE WHEN a.redirects AND a.target IS NOT NULL THEN a.target ELSE w.url END,
            CASE WHEN a.redirects AND a.target IS NOT NULL THEN w.method ELSE 'GET' END,
            CASE WHEN a.redirects AND a.target IS NOT NULL THEN w.rc + 1 ELSE w.rc END
        FROM walk w JOIN tried a ON a.url = w.url AND a.method = w.method
        WHERE NOT (w.url = 'http://login.example.org/idp' AND w.url <> w.original_url)
            AND w.url NOT IN (SELECT url FROM {gates})
            AND NOT (a.redirects AND w.rc + 1 > {LIMIT})
            AND ((a.redirects AND a.target IS NOT NULL) OR (w.method = 'HEAD' AND NOT a.ok)))
    , settled AS (SELECT w.*, a.* EXCLUDE (url, method),
            a.url IS NOT NULL AS observed, a.redirects AND w.rc + 1 > {LIMIT} AS over,
            CASE WHEN g.gate IS NOT NULL THEN g.gate
                 WHEN w.url = 'http://login.example.org/idp' AND w.url <> w.original_url THEN 'login' END AS gate
        FROM walk w LEFT JOIN tried a ON a.url = w.url AND a.method = w.method LEFT JOIN {gates} g ON g.url = w.url)
    , named AS (SELECT *, coalesce(exception_class,
            CASE WHEN redirects AND NOT over AND target IS NULL THEN 'java.net.MalformedURLException' END) AS cls,
        CASE WHEN status_code IN (200, 304) THEN 'Ok' WHEN status_code IN (405, 429) THEN 'Undetermined'
             WHEN status_code IN (401, 403) THEN 'Restricted_Access' ELSE 'Broken' END AS by_code
        FROM settled WHERE gate IS NOT NULL OR NOT observed OR over
            OR NOT ((redirects AND target IS NOT NULL) OR (method = 'HEAD' AND NOT ok)))
    , done AS (SELECT url_id, original_url, url, method,
        CAST(CASE WHEN gate IS NULL AND over THEN rc + 1 ELSE rc END AS INT) AS redirect_count,
        CASE WHEN gate IS NULL AND NOT observed THEN 'unobserved' ELSE 'status' END AS route,
        CASE WHEN gate IN ('robots', 'crawl_delay') THEN 'Blocked_By_Robots_txt' WHEN gate = 'login' THEN 'Restricted_Access'
             WHEN NOT observed THEN NULL WHEN over THEN 'Undetermined'
             WHEN cls IN ('java.net.MalformedURLException', 'java.net.UnknownHostException',
                          'java.net.SocketTimeoutException') THEN 'Broken'
             WHEN cls IS NOT NULL THEN 'Undetermined' ELSE by_code END AS category,
        CASE WHEN gate = 'robots' THEN 'Blocked by robots.txt' WHEN gate = 'crawl_delay' THEN 'Crawl delay too long.'
             WHEN gate = 'login' THEN original_url || ' points to a login page, therefore has restricted access.'
             WHEN NOT observed THEN NULL
             WHEN over THEN 'Redirects exceeded {LIMIT} redirects for ' || original_url
             WHEN cls IS NOT NULL AND (cause_class = 'java.util.concurrent.TimeoutException'
                 OR exception_message LIKE '% timed out%') THEN 'Socket timeout fetching'
             WHEN cls = 'java.net.UnknownHostException' THEN 'Unknown host'
             WHEN cls = 'java.net.MalformedURLException' THEN 'Location Header in a redirect shouldn''t be null.'
             WHEN cls IS NOT NULL THEN coalesce(exception_message, cls)
             WHEN by_code = 'Ok' THEN 'Ok'
             ELSE CASE WHEN by_code = 'Restricted_Access' THEN 'Restricted access' ELSE by_code END
                 || ', Status code: ' || status_code END AS message,
        CASE WHEN gate IS NULL AND cls IS NULL THEN status_code END AS status_code,
        CASE WHEN gate IS NULL AND cls IS NULL THEN content_length END AS content_length,
        CASE WHEN gate IS NULL AND cls IS NULL THEN content_type END AS content_type,
        CASE WHEN gate IS NULL AND cls IS NULL THEN duration_ms END AS duration_ms FROM named)
    """
    return sql(names, walk + select, responses=responses)


_RESOLVED = "SELECT url_id, url, method, redirect_count, category, message FROM done"
_STATUS_ROWS = """SELECT url_id, category, message, TIMESTAMP '1999-01-01' AS checking_date, status_code, content_type,
    CAST(content_length AS BIGINT) AS content_length, CAST(duration_ms AS INT) AS duration, redirect_count, method FROM done"""
_CHECKED = """SELECT url_id, category, checking_date, NULL::INT AS status_code, duration, redirect_count, 1 AS src FROM checks
    UNION ALL SELECT url_id, category, checking_date, status_code, duration, redirect_count, 0 FROM full_status"""
_ROUTED = f"""SELECT u.id AS url_id, u.name AS url, 'HEAD' AS method, 0 AS rc, a.*,
    CASE WHEN a.target IS NOT NULL THEN 'follow' WHEN NOT a.ok THEN 'retry_get' ELSE 'status' END AS route
    FROM url u JOIN attempts a ON a.url = u.name AND a.method = 'HEAD' WHERE u.valid"""
_ROUTED_CTES = ["ord", "url", "responses", "attempts"]
_KEY = f"lower(CASE WHEN {_HOST.format(u='url')} = '' THEN url ELSE {_HOST.format(u='url')} END)"
_ANY_URL = r"(SELECT url FROM pages UNION ALL SELECT url FROM odd_urls WHERE NOT regexp_matches(url, '^\s*$'))"
_HOSTS = f"(SELECT url, lower({_HOST.format(u='url')}) AS host FROM {_ANY_URL})"
_BAD = r"""(NOT regexp_matches(url, '(?i)^(?:https?|ftp|file|jar|mailto):')
    OR regexp_matches(url, '^http://h.example.org:x'))"""

ORACLES = {
    "due_urls": sql(_URLS, "SELECT id, name, group_key, priority, CAST(order_nr AS INT) AS order_nr FROM due_urls"),
    "due_handles": sql(
        _HANDLES, "SELECT id, name, handle_prefix, priority, CAST(order_nr AS INT) AS order_nr FROM due_handles"
    ),
    "due_all": sql(_ALL, "SELECT id, name, group_key FROM due_all"),
    "due_candidates": sql(
        _REGISTER, "SELECT group_key, count(*) AS due, count(checking_date) AS rechecked FROM candidates GROUP BY group_key"
    ),
    "unchecked_count": sql(
        ["ord", "url", "status", "url_context"],
        """SELECT count(*) AS unchecked FROM url WHERE valid AND id NOT IN (SELECT url_id FROM status)
           AND id IN (SELECT url_id FROM url_context WHERE active)""",
    ),
    "never_checked": sql(
        ["ord", "url", "status", "url_context"],
        """SELECT id, name FROM url WHERE valid AND id NOT IN (SELECT url_id FROM status)
           AND id IN (SELECT url_id FROM url_context WHERE active)""",
    ),
    "select_sql_source": sql(
        ["ord", "url", "url_context"],
        "SELECT id, name FROM url WHERE valid AND priority >= 4 AND id IN (SELECT url_id FROM url_context WHERE active)",
    ),
    "in_flight_excluded": sql(
        _ALL, "SELECT id, name FROM due_all WHERE name NOT IN (SELECT name FROM url WHERE id % 13 = 0)"
    ),
    "seed_frontier": sql(
        ["ord", "url"],
        """SELECT id AS url_id, name AS original_url, name AS url, 'HEAD' AS method, 0 AS redirect_count
           FROM url WHERE valid""",
    ),
    "malformed_split": sql(
        ["ord", "odd_urls"],
        f"""SELECT url_id, url, CASE WHEN {_BAD} THEN 'malformed' ELSE 'well-formed' END AS kind FROM odd_urls
            WHERE NOT regexp_matches(url, '^\\s*$')""",
    ),
    "queue_keys": sql(
        ["ord", "odd_urls"],
        f"""SELECT {_KEY} AS queue_key, count(*) AS urls, count(*) FILTER ({_KEY} = lower({_HOST.format(u='url')}))
            AS with_host FROM {_ANY_URL} GROUP BY 1""",
    ),
    "queue_keys_by_domain": sql(
        ["ord", "odd_urls"],
        f"""SELECT CASE WHEN host = '' THEN lower(url)
                WHEN regexp_matches(host, '(^|\\.)example\\.org$') THEN 'example.org'
                WHEN regexp_matches(host, '[^.]+\\.[^.]+\\.(org|net)$') THEN regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1)
                WHEN regexp_matches(host, '\\.co\\.uk$') THEN regexp_extract(host, '([^.]+\\.co\\.uk)$', 1)
                WHEN regexp_matches(host, '\\.com$') THEN regexp_extract(host, '([^.]+\\.[^.]+)$', 1)
                ELSE host END AS queue_key, count(*) AS urls FROM {_HOSTS} GROUP BY 1""",
    ),
    "queue_keys_by_ip": sql(
        ["ord", "url"],
        f"""SELECT CASE WHEN length(host) % 3 <> 0 THEN concat('10.0.', length(host), '.1') ELSE host END AS queue_key,
            count(*) AS urls FROM (SELECT {_HOST.format(u='name')} AS host FROM url) GROUP BY 1""",
    ),
    "queue_keys_given": sql(
        ["ord", "url"],
        f"""SELECT lower(CASE WHEN id % 3 = 0 THEN group_key ELSE {_HOST.format(u='name')} END) AS queue_key,
            count(*) AS urls FROM url GROUP BY 1""",
    ),
    "handle_prefixes": sql(
        ["ord", "url"],
        """SELECT regexp_extract(name, 'hdl.handle.net/([^/]*)', 1) AS prefix, count(*) AS urls FROM url GROUP BY 1""",
    ),
    "corrected_urls": sql(
        ["ord", "odd_urls"], "SELECT url_id, replace(url, ' ', '%20') AS requested FROM odd_urls"
    ),
    "resolve_locations": sql(
        ["page_links"], f"SELECT page_id, nr, url, location, {_LOCATION} AS target FROM page_links"
    ),
    "resolve_locations_rfc3986": sql(
        ["page_links"],
        r"""SELECT page_id, nr, CASE WHEN starts_with(location, 'http') THEN location
               WHEN starts_with(location, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || location
               ELSE regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*/)', 1) || regexp_replace(location, '^\./', '') END AS target
           FROM page_links""",
    ),
    "categorize": sql(
        ["ord", "responses"],
        """SELECT method, status_code, category, CASE WHEN category = 'Ok' THEN 'Ok'
               WHEN category = 'Restricted_Access' THEN 'Restricted access, Status code: ' || status_code
               ELSE category || ', Status code: ' || status_code END AS message, count(*) AS n
           FROM (SELECT *, CASE WHEN status_code IN (200, 304) THEN 'Ok' WHEN status_code IN (405, 429) THEN 'Undetermined'
                   WHEN status_code IN (401, 403) THEN 'Restricted_Access' ELSE 'Broken' END AS category
                 FROM responses WHERE status_code IS NOT NULL) GROUP BY ALL""",
    ),
    "exception_categories": sql(
        ["ord", "responses"],
        """SELECT exception_class, CASE WHEN exception_class IN ('java.net.UnknownHostException',
                   'java.net.SocketTimeoutException') THEN 'Broken' ELSE 'Undetermined' END AS category,
               CASE WHEN exception_message LIKE '% timed out%' THEN 'Socket timeout fetching'
                    WHEN exception_class = 'java.net.UnknownHostException' THEN 'Unknown host'
                    ELSE coalesce(exception_message, exception_class) END AS message, count(*) AS n
           FROM responses WHERE exception_class IS NOT NULL GROUP BY ALL""",
    ),
    "route_attempt": sql(
        _ROUTED_CTES,
        f"""SELECT url_id, route, CASE route WHEN 'follow' THEN target WHEN 'retry_get' THEN url END AS next_url,
                CASE route WHEN 'follow' THEN 'HEAD' WHEN 'retry_get' THEN 'GET' END AS next_method,
                CASE route WHEN 'follow' THEN 1 WHEN 'retry_get' THEN 0 END AS next_count,
                CASE WHEN route = 'status' THEN 'Ok' END AS category, CASE WHEN route = 'status' THEN 'Ok' END AS message
            FROM ({_ROUTED.replace('a.*', 'a.target')})""",
    ),
    "route_split": sql(
        _ROUTED_CTES,
        f"""SELECT CASE WHEN route = 'status' THEN 'status' ELSE 'redirect' END AS stream,
                CASE WHEN route = 'retry_get' THEN 'GET' ELSE 'HEAD' END AS method, count(*) AS n
            FROM ({_ROUTED.replace('a.*', 'a.target')}) GROUP BY ALL""",
    ),
    "feedback_frontier": sql(
        _ROUTED_CTES,
        f"""SELECT url_id, url AS original_url, CASE WHEN route = 'follow' THEN target ELSE url END AS url,
                CASE WHEN route = 'follow' THEN 'HEAD' ELSE 'GET' END AS method,
                CASE WHEN route = 'follow' THEN 1 ELSE 0 END AS redirect_count
            FROM ({_ROUTED.replace('a.*', 'a.target')}) WHERE route <> 'status'""",
    ),
    "resolved_status": resolution("valid_starts", "SELECT * FROM done"),
    "resolved_status_summary": resolution(
        "valid_starts",
        """SELECT category, status_code, count(*) AS n, min(redirect_count) AS min_rc, max(redirect_count) AS max_rc
           FROM done GROUP BY ALL""",
    ),
    "resolved_poll": resolution("poll_starts", _RESOLVED, needs=tuple(_ALL)),
    "resolved_with_gates": resolution("valid_starts", _RESOLVED, gates="robots_gated"),
    "unobserved": resolution(
        "valid_starts",
        "SELECT url_id, url, method, redirect_count FROM done WHERE route = 'unobserved'",
        missing="method = 'GET' AND exception_class IS NOT NULL",
    ),
    "host_timeouts": resolution("valid_starts", _RESOLVED, responses="timed_responses"),
    "read_register": sql(_URLS, "SELECT id, name, group_key, priority, CAST(order_nr AS INT) AS order_nr FROM due_urls"),
    "read_register_catalog": sql(
        ["ord", "url", "status", "url_context"],
        """SELECT id, name FROM url WHERE valid AND id NOT IN (SELECT url_id FROM status)
           AND id IN (SELECT url_id FROM url_context WHERE active)""",
    ),
    "read_login_pages": sql(["ord", "responses"], "SELECT DISTINCT location AS url FROM responses WHERE starts_with(location, 'http')"),
    "read_responses": sql(
        ["ord", "responses"], "SELECT url, method, CAST(content_length AS VARCHAR) AS content_length, 2 AS headers FROM responses"
    ),
    "read_robots_rules": sql(
        ["ord", "url", "rules", "robots"],
        """SELECT r.id, allowed AS robots_allowed, delay AS robots_delay_ms,
               CASE WHEN group_key = 'hdl.handle.net' THEN CAST(100 AS BIGINT) END AS override_delay_ms FROM robots r JOIN url USING (id)""",
    ),
    "robots_gate": sql(
        ["ord", "url", "rules", "robots"],
        "SELECT id, allowed AS robots_allowed, delay AS robots_delay_ms FROM robots",
    ),
    "login_gate": sql(
        ["ord", "responses"],
        """SELECT url AS original_url, url || ' points to a login page, therefore has restricted access.' AS message
           FROM responses WHERE location = 'http://login.example.org/idp'""",
    ),
    "crawl_delay_gate": sql(
        ["ord", "url", "rules", "robots"],
        f"""SELECT group_key, gate, CASE WHEN gate IS NOT NULL THEN 'Blocked_By_Robots_txt' END AS category,
                count(*) AS urls
            FROM (SELECT u.group_key, CASE WHEN NOT allowed THEN 'robots' WHEN delay > {ROBOTS_MAX_MS} THEN 'crawl_delay'
                  END AS gate FROM url u JOIN robots USING (id)) GROUP BY ALL""",
    ),
    "protocol_gate": sql(
        ["ord", "odd_urls"],
        f"""SELECT url_id, gate, CASE gate WHEN 'malformed' THEN 'Broken' WHEN 'protocol' THEN 'Undetermined' END AS category,
                CASE gate WHEN 'malformed' THEN 'java.net.MalformedURLException' WHEN 'protocol' THEN
                    concat('the ''', lower(regexp_extract(url, '^([A-Za-z]+):', 1)),
                           '''-protocol is not supported by the HostProtocolFactory') END AS message
            FROM (SELECT *, CASE WHEN {_BAD} THEN 'malformed'
                  WHEN NOT regexp_matches(url, '(?i)^https?:') THEN 'protocol' END AS gate
                  FROM odd_urls WHERE NOT regexp_matches(url, '^\\s*$'))""",
    ),
    "status_rows": resolution("valid_starts", _STATUS_ROWS),
    "stream_resolved": resolution("valid_starts", _STATUS_ROWS),
    "stream_late_responses": resolution("valid_starts", _STATUS_ROWS),
    "status_from_metadata": """SELECT doc_id AS url_id, CASE WHEN doc_id % 2 = 0 THEN 'Ok' ELSE 'Broken' END AS category,
        CASE WHEN length(text) < 1024 THEN text ELSE substr(text, 1, 1017) || '[...]' END AS message,
        TIMESTAMP '1999-01-01' + to_seconds(doc_id % 10) AS checking_date,
        CASE WHEN doc_id % 4 <> 0 THEN 200 END AS status_code,
        CASE WHEN length(ct) < 256 THEN ct ELSE substr(ct, 1, 250) || '...' END AS content_type,
        CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars AS BIGINT) END AS content_length,
        CASE WHEN doc_id % 7 <> 0 THEN 12 END AS duration,
        CAST(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id % 6 END AS INT) AS redirect_count,
        CASE WHEN doc_id % 3 = 0 THEN 'N/A' WHEN doc_id % 2 = 0 THEN 'HEAD' ELSE 'GET' END AS method
        FROM (SELECT *, lang || '/' || text AS ct FROM documents)""",
    "metadata_keys": resolution(
        "valid_starts",
        """, total AS (SELECT count(*) AS n, count(status_code) AS answered FROM done)
        SELECT key, CASE WHEN answered_only THEN answered ELSE n END AS n,
            CASE WHEN key LIKE 'header.%' THEN 0 WHEN answered_only THEN answered ELSE n END AS persisted
        FROM total, (VALUES ('urlId', false), ('originalUrl', false), ('fetch.checkingDate', false),
            ('fetch.statusCode', true), ('fetch.category', false), ('fetch.message', false),
            ('fetch.contentType', true), ('fetch.byteLength', true), ('fetch.duration', true),
            ('fetch.redirectCount', false), ('http.method.head', false), ('header.server', false),
            ('header.urlId', false)) v(key, answered_only)""",
    ),
    "unknown_urls": sql(
        ["ord", "url", "checks"],
        """SELECT url_id, url_id IN (SELECT id FROM url WHERE valid) AS known, count(*) AS checks
           FROM checks GROUP BY ALL""",
    ),
    "status_upsert": sql(
        ["checks", "full_status"],
        f"""SELECT url_id, category, checking_date, status_code, duration, redirect_count,
                row_number() OVER (PARTITION BY url_id ORDER BY checking_date DESC, src DESC) = 1 AS is_current
            FROM ({_CHECKED})""",
    ),
    "latest_status": sql(
        ["checks"],
        """SELECT url_id, check_id, checking_date, category FROM checks
           QUALIFY row_number() OVER (PARTITION BY url_id ORDER BY checking_date DESC, check_id DESC) = 1""",
    ),
    "history_rows": sql(
        ["checks"],
        """SELECT url_id, check_id, checking_date, category FROM checks
           QUALIFY row_number() OVER (PARTITION BY url_id ORDER BY checking_date DESC, check_id DESC) > 1""",
    ),
    "archive_inactive": sql(
        ["ord", "url", "full_status", "url_context"],
        """SELECT u.*, s.* EXCLUDE (url_id), TIMESTAMP '1999-01-01' AS deletion_date
           FROM url u LEFT JOIN full_status s ON s.url_id = u.id
           WHERE u.id NOT IN (SELECT url_id FROM url_context WHERE active)""",
    ),
    "latest_100": sql(
        ["checks"],
        """SELECT check_id, url_id, checking_date, category FROM checks
           ORDER BY checking_date DESC, check_id DESC LIMIT 100""",
    ),
    "effective_delays": sql(
        _PACED,
        """SELECT queue_key, queue_slots, robots_delay_ms, override_delay_ms, delay_ms, effective_timeout_ms,
               count(*) AS urls FROM delayed GROUP BY ALL""",
    ),
    "planned_schedule": sql(
        _PACED,
        """SELECT url_id, queue_key, gate, delay_ms, CASE WHEN queue_slots = 1 THEN CAST(coalesce(
               sum(CASE WHEN gate IS NULL THEN duration_ms + delay_ms ELSE 0 END) OVER (PARTITION BY queue_key
               ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) END AS start_offset_ms FROM delayed""",
    ),
    "queue_timeout": sql(
        _PACED,
        """SELECT queue_key, queue_slots = 1 AND gate IS NULL AND waited > 60000 AS dropped, count(*) AS urls
           FROM (SELECT *, coalesce(sum(CASE WHEN gate IS NULL THEN duration_ms + delay_ms ELSE 0 END) OVER (
               PARTITION BY queue_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS waited FROM delayed)
           GROUP BY ALL""",
    ),
    "round_robin": sql(
        ["ord", "url"],
        """SELECT row_number() OVER (PARTITION BY group_key ORDER BY id) AS turn, group_key AS queue_key, id AS seq
           FROM url""",
    ),
    "politeness_audit": sql(
        ["checks"],
        """SELECT check_id, host, gap_us, coalesce(gap_us < 60000000, false) AS too_early FROM (SELECT check_id, host,
               date_diff('microsecond', lag(checking_date) OVER (PARTITION BY host ORDER BY checking_date, check_id),
               checking_date) AS gap_us FROM checks)""",
    ),
    "poll_summary": sql(_ALL, "SELECT count(*) AS hits, count(DISTINCT lower(group_key)) AS queues FROM due_all"),
    "queue_summary": sql(
        ["ord", "url", "snapshot"],
        """SELECT queue_key, count(*) FILTER (NOT in_progress) AS size, count(*) FILTER (in_progress) AS in_progress
           FROM snapshot GROUP BY queue_key""",
    ),
    "queue_contents": sql(
        ["ord", "url", "snapshot"],
        """SELECT queue_key, row_number() OVER (PARTITION BY queue_key ORDER BY seq) AS position, url
           FROM snapshot WHERE NOT in_progress""",
    ),
    "being_fetched": sql(["ord", "url", "snapshot"], "SELECT queue_key, url FROM snapshot WHERE in_progress"),
    "throughput_per_100": sql(
        ["checks"],
        """SELECT nr // 100 AS mark, checking_date AS marked_at,
               date_diff('microsecond', lag(checking_date) OVER (ORDER BY nr), checking_date) AS elapsed_us
           FROM (SELECT *, row_number() OVER (ORDER BY checking_date, check_id) AS nr FROM checks) WHERE nr % 100 = 0""",
    ),
    "poll_times": sql(
        ["checks"],
        "SELECT host, count(*) AS polls, round(avg(duration), 6) AS avg_ms, max(duration) AS max_ms FROM checks GROUP BY host",
    ),
    "stream_status": sql(
        ["checks"],
        """SELECT url_id, category, checking_date, duration, redirect_count,
               row_number() OVER (PARTITION BY url_id ORDER BY checking_date DESC) = 1 AS is_current FROM checks""",
    ),
    "stream_latest": sql(
        ["checks"],
        """SELECT check_id, url_id, checking_date, category FROM checks
           ORDER BY checking_date DESC, check_id DESC LIMIT 100""",
    ),
    "stream_in_flight": """WITH RECURSIVE steps AS (
            SELECT user_id AS u, event_id AS seq, ts, event_type IN ('error', 'purchase') AS done,
                row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM events),
        run(u, nr, seq, emitted, since) AS (
            SELECT u, nr, seq, NOT done, CASE WHEN done THEN NULL ELSE ts END FROM steps WHERE nr = 1
            UNION ALL
            SELECT s.u, s.nr, s.seq,
                NOT s.done AND (r.since IS NULL OR s.ts - r.since >= INTERVAL 1 HOUR),
                CASE WHEN s.done THEN NULL WHEN r.since IS NULL OR s.ts - r.since >= INTERVAL 1 HOUR THEN s.ts
                     ELSE r.since END
            FROM run r JOIN steps s ON s.u = r.u AND s.nr = r.nr + 1)
        SELECT CAST(u AS VARCHAR) AS name, seq FROM run WHERE emitted""",
    "stream_repeated_polls": """WITH RECURSIVE steps AS (
            SELECT user_id AS u, event_id AS seq, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM events),
        run(u, nr, seq, passed, since) AS (
            SELECT u, nr, seq, true, ts FROM steps WHERE nr = 1
            UNION ALL
            SELECT s.u, s.nr, s.seq, s.ts - r.since >= INTERVAL 1 HOUR, CASE WHEN s.ts - r.since >= INTERVAL 1 HOUR THEN s.ts ELSE r.since END
            FROM run r JOIN steps s ON s.u = r.u AND s.nr = r.nr + 1)
        SELECT concat('u', u) AS name, seq FROM run WHERE passed""",
    "stream_attempts": """WITH RECURSIVE steps AS (
            SELECT user_id AS u, event_id AS seq, event_type AS e,
                row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nr FROM events),
        run AS (
            SELECT u, nr, seq, e, 'HEAD' AS method, 0 AS before FROM steps WHERE nr = 1
            UNION ALL
            SELECT s.u, s.nr, s.seq, s.e,
                CASE WHEN r.e = 'click' AND r.before < 2 THEN r.method
                     WHEN r.e IN ('click', 'purchase') AND r.before >= 2 THEN 'HEAD'
                     WHEN r.method = 'HEAD' AND r.e <> 'view' THEN 'GET' ELSE 'HEAD' END,
                CASE WHEN r.e = 'click' AND r.before < 2 THEN r.before + 1
                     WHEN r.e IN ('click', 'purchase') AND r.before >= 2 THEN 0
                     WHEN r.method = 'HEAD' AND r.e <> 'view' THEN r.before ELSE 0 END
            FROM run r JOIN steps s ON s.u = r.u AND s.nr = r.nr + 1),
        routed AS (SELECT *, concat('http://h', u, '.example.org/p/', seq) AS url,
            CASE WHEN e = 'click' AND before < 2 THEN 'follow' WHEN e IN ('click', 'purchase') AND before >= 2 THEN 'status'
                 WHEN method = 'HEAD' AND e <> 'view' THEN 'retry_get' ELSE 'status' END AS route FROM run)
        SELECT u AS url_id, seq, url, method, CAST(CASE WHEN route = 'follow' OR (e IN ('click', 'purchase') AND before >= 2)
                THEN before + 1 ELSE before END AS INT) AS redirect_count, route,
            CASE route WHEN 'follow' THEN concat('http://h', u, '.example.org/p/next') WHEN 'retry_get' THEN url END
                AS next_url,
            CASE WHEN route <> 'status' THEN NULL WHEN e IN ('click', 'purchase') AND before >= 2 THEN 'Undetermined'
                WHEN e = 'view' THEN 'Ok' WHEN e = 'error' THEN 'Undetermined' ELSE 'Broken' END AS category,
            CASE WHEN route <> 'status' THEN NULL
                WHEN e IN ('click', 'purchase') AND before >= 2 THEN concat('Redirects exceeded 2 redirects for ', url)
                WHEN e = 'view' THEN 'Ok' WHEN e = 'error' THEN 'java.net.SocketException'
                WHEN e = 'purchase' THEN 'Location Header in a redirect shouldn''t be null.'
                ELSE 'Broken, Status code: 404' END AS message FROM routed""",
    "stream_marks_per_100": sql(
        ["checks"],
        """SELECT nr // 100 AS mark, checking_date AS marked_at,
               date_diff('microsecond', lag(checking_date) OVER (ORDER BY nr), checking_date) AS elapsed_us
           FROM (SELECT *, row_number() OVER (ORDER BY checking_date, check_id) AS nr FROM checks) WHERE nr % 100 = 0""",
    ),
    "stream_throughput": "SELECT date_trunc('minute', ts) AS minute, count(*) AS checks FROM events GROUP BY 1",
    "stream_cycle": resolution(
        "two_polls",
        """SELECT coalesce(d.url_id, f.url_id) AS url_id, CASE WHEN d.url_id IS NULL THEN f.category ELSE d.category END AS category,
               CASE WHEN d.url_id IS NULL THEN f.checking_date WHEN d.url_id IN (SELECT id FROM due_all) THEN TIMESTAMP '1999-01-01'
                    ELSE TIMESTAMP '1999-01-01 02:00:00' END AS checking_date,
               CASE WHEN d.url_id IS NULL THEN f.status_code ELSE d.status_code END AS status_code,
               CAST(coalesce(d.redirect_count, f.redirect_count) AS INT) AS redirect_count, coalesce(d.method, f.method) AS method
           FROM done d FULL JOIN full_status f ON f.url_id = d.url_id""",
        needs=(*_ALL, "full_status", "status_again", *[f"{name}_again" for name in _CHAIN]),
    ),
    "daily_unchecked": sql(
        ["ord", "url", "status", "url_context"],
        """SELECT DATE '1999-01-01' AS day, count(*) AS unchecked FROM url WHERE valid AND id NOT IN (SELECT url_id FROM status)
           AND id IN (SELECT url_id FROM url_context WHERE active)""",
    ),
}
