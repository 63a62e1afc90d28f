"""Resolution against a plain simulation of the decision list, and both forms against it."""

import random

import pytest
from pyspark.sql import functions as F

from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.operators import resolve
from urlaudit.operators.selection import seed_frontier

TIMEOUT = "java.net.SocketTimeoutException"


def response(url, method, code=None, location=None, exc=None, message=None, headers=None):
    return (url, method, code, location, headers or {"content-length": "7"}, exc, None, message, 5)


def frontier_of(spark, urls, method="HEAD"):
    rows = [(i, u) for i, u in enumerate(urls)]
    return seed_frontier(spark.createDataFrame(rows, "id long, name string")).withColumn("method", F.lit(method))


def table(spark, rows):
    return spark.createDataFrame(rows, schema.RESPONSES)


def login_table(spark, *pages):
    return spark.createDataFrame([(p,) for p in pages], "url string")


def test_redirect_codes_follow_with_head_and_count_one(spark):
    conf = AuditConfig(redirect_limit=15)
    urls = [f"http://site{i}.example.com/doc/{i}" for i in range(5)]
    rows = [response(u, "HEAD", code, "http://elsewhere.example.net/") for u, code in zip(urls, conf.redirect_codes)]
    routed = resolve.route_attempt(frontier_of(spark, urls), table(spark, rows), conf).collect()
    assert {(r.route, r.next_url, r.next_method, r.next_count) for r in routed} == {
        ("follow", "http://elsewhere.example.net/", "HEAD", 1)
    }


def test_failed_head_is_repeated_with_get(spark):
    codes = [400, 401, 402, 403, 404, 500, 501, 502, 503]
    urls = [f"http://site{i}.example.com/doc/{i}" for i in range(10)]
    rows = [response(u, "HEAD", code) for u, code in zip(urls, codes)]
    rows.append(response(urls[9], "HEAD", exc="java.net.SocketException"))
    routed = resolve.route_attempt(frontier_of(spark, urls), table(spark, rows), AuditConfig())
    assert {(r.route, r.next_method, r.next_count) for r in routed.collect()} == {("retry_get", "GET", 0)}
    status, redirect = resolve.split_routes(routed)
    assert status.count() == 0 and redirect.count() == 10
    assert {r.url for r in resolve.next_frontier(routed).collect()} == set(urls)


def test_categories_of_get_answers(spark):
    codes = [200, 304, 301, 302, 303, 307, 308, 405, 429, 401, 403]
    urls = [f"http://one.example.com/doc/{i}" for i in range(len(codes))]
    rows = [response(u, "GET", c) for u, c in zip(urls, codes)]
    found = resolve.resolve(frontier_of(spark, urls, "GET"), table(spark, rows), AuditConfig()).collect()
    counts = {}
    for r in found:
        counts[r.category] = counts.get(r.category, 0) + 1
    assert counts == {"Ok": 2, "Broken": 5, "Undetermined": 2, "Restricted_Access": 2}
    lost = next(r for r in found if r.url.endswith("/2"))
    assert lost.message == "Location Header in a redirect shouldn't be null." and lost.status_code is None


def test_a_hundred_urls_on_ten_hosts_all_get_a_status(spark):
    urls = [f"http://site{i % 10}.example.com/doc/{i}" for i in range(100)]
    rows = [response(u, "HEAD", 200) for u in urls]
    found = resolve.resolve(frontier_of(spark, urls), table(spark, rows), AuditConfig()).collect()
    assert len(found) == 100 and {(r.route, r.category) for r in found} == {("status", "Ok")}


def test_timeout_is_repeated_then_broken(spark):
    slow, patient = "http://slow.com/a", "http://patient.com/a"
    rows = [response(slow, m, exc=TIMEOUT, message="Read timed out") for m in ("HEAD", "GET")]
    rows.append(response(patient, "HEAD", 200))
    found = {r.url: r for r in resolve.resolve(frontier_of(spark, [slow, patient]), table(spark, rows), AuditConfig()).collect()}
    assert (found[slow].category, found[slow].message, found[slow].method) == ("Broken", "Socket timeout fetching", "GET")
    assert found[patient].category == "Ok" and found[patient].content_length == 7


def slow_web(spark):
    """One page on each of three hosts that answers after 7 seconds."""
    urls = [f"http://{host}.example.org/doc" for host in ("plain", "patient", "listed")]
    rows = [(*response(u, m, 200)[:-1], 7000) for u in urls for m in ("HEAD", "GET")]
    return urls, table(spark, rows)


@pytest.mark.parametrize("method", ["walk", "lifting"])
def test_an_answer_after_the_timeout_of_its_host_is_a_timeout(spark, method):
    urls, responses = slow_web(spark)
    overrides = spark.createDataFrame([("patient.example.org", None, 10_000)], schema.HOST_OVERRIDES)
    conf = AuditConfig(timeout_ms=5000, host_timeouts=(("listed.example.org", 8000),))
    found = {r.url: r for r in resolve.resolve(frontier_of(spark, urls), responses, conf, host_overrides=overrides, method=method).collect()}
    late = found[urls[0]]
    assert (late.category, late.message, late.method, late.duration_ms) == ("Broken", "Socket timeout fetching", "GET", None)
    assert all((found[u].category, found[u].method, found[u].duration_ms) == ("Ok", "HEAD", 7000) for u in urls[1:])
    unbound = resolve.resolve(frontier_of(spark, urls), responses, AuditConfig(timeout_ms=-1), method=method)
    assert {r.category for r in unbound.collect()} == {"Ok"}


def test_a_row_that_was_redirected_before_stops_at_the_limit(spark):
    urls = [f"http://chain.example.org/{i}" for i in range(9)]
    rows = [response(a, "HEAD", 301, b) for a, b in zip(urls, urls[1:])]
    starts = [frontier_of(spark, urls[:1]).withColumn("redirect_count", F.lit(n)) for n in (0, 3, 5, 6)]
    start = starts[0].unionByName(starts[1]).unionByName(starts[2]).unionByName(starts[3])
    for method in ("walk", "lifting"):
        found = resolve.resolve(start, table(spark, rows), AuditConfig(redirect_limit=5), method=method).collect()
        assert sorted((r.url, r.redirect_count, r.category) for r in found) == [(urls[k], n, "Undetermined") for k, n in ((0, 6), (0, 7), (2, 6), (5, 6))]


def test_responses_are_grouped_once_and_a_walk_groups_only_what_it_reaches(spark, monkeypatch):
    calls, group = [], resolve.response_nodes

    def counted(responses, wanted=None, **more):
        calls.append(wanted)
        return group(responses, wanted, **more)

    urls, rows = random_web(11)
    monkeypatch.setattr(resolve, "response_nodes", counted)
    resolve.resolve(frontier_of(spark, urls), table(spark, rows), AuditConfig(redirect_limit=5)).collect()
    assert calls == [None]
    calls.clear()
    monkeypatch.setattr(resolve, "response_nodes", lambda responses, wanted=None, *more: calls.append(wanted) or group(responses, wanted, *more))
    monkeypatch.setattr(resolve, "redirect_edges", None)
    resolve.resolve(frontier_of(spark, urls), table(spark, rows), AuditConfig(redirect_limit=5), method="walk").collect()
    assert calls and None not in calls


def simulate(start, seen, limit, login, blocked):
    """One URL by the decision list, as plain control flow."""
    url, method, count = start, "HEAD", 0
    while True:
        if url in blocked:
            return "Blocked_By_Robots_txt", url, method, count
        if url in login and url != start:
            return "Restricted_Access", url, method, count
        r = seen.get((url, method))
        if r is None:
            return None, url, method, count
        code, location, failed = r[2], r[3], r[5]
        if not failed and code in (301, 302, 303, 307, 308):
            if count + 1 > limit:
                return "Undetermined", url, method, count + 1
            if location is not None:
                url, count = location, count + 1
                continue
            failed = "java.net.MalformedURLException"
        if method == "HEAD" and (failed or code not in (200, 304)):
            method = "GET"
            continue
        if failed:
            return ("Undetermined" if "ssl" in failed else "Broken"), url, method, count
        kinds = {200: "Ok", 304: "Ok", 405: "Undetermined", 429: "Undetermined", 401: "Restricted_Access", 403: "Restricted_Access"}
        return kinds.get(code, "Broken"), url, method, count


def random_web(seed, n=120):
    rng = random.Random(seed)
    urls = [f"http://h{i % 7}.org/p{i}" for i in range(n)]
    rows = []
    for url in urls:
        for method in ("HEAD", "GET"):
            kind = rng.random()
            if kind < 0.62:  # many redirects, a third of them to one page
                target = urls[0] if rng.random() < 0.33 else rng.choice(urls)
                rows.append(response(url, method, rng.choice([301, 302, 307]), None if rng.random() < 0.05 else target))
            elif kind < 0.72:
                rows.append(response(url, method, exc=rng.choice([TIMEOUT, "javax.net.ssl.SSLException"])))
            elif kind < 0.97:
                rows.append(response(url, method, rng.choice([200, 200, 304, 401, 404, 405])))
    return urls, rows


@pytest.mark.parametrize(
    "seed,limit,method,broadcast",
    [
        (1, 5, "few", True),
        (7, 15, "few", False),
        (1, 5, "lifting", True),
        (1, 5, "lifting", False),
        (2, 3, "walk", False),
        (2, 3, "walk", True),
        (3, 0, "lifting", True),
        (4, 1, "lifting", True),
        (5, 8, "lifting", True),
        (6, 15, "lifting", False),
    ],
)
def test_every_form_equals_the_simulation(spark, seed, limit, method, broadcast):
    urls, rows = random_web(seed)
    login, blocked = [urls[5], urls[6], urls[0]], [u for u in urls if u.startswith("http://h3.org/p1")]
    conf = AuditConfig(redirect_limit=limit)
    rules = spark.createDataFrame([("h3.org", "disallow", "/p1", None)], schema.ROBOTS_RULES)
    seen = {(r[0], r[1]): r for r in rows}
    wanted = {i: simulate(u, seen, limit, login, blocked) for i, u in enumerate(urls)}
    gates = {"robots_rules": rules, "login_pages": login_table(spark, *login)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        how = {"few": True, "index": resolve.index_responses(table(spark, rows), conf, **gates)} if method == "few" else {"method": method}
        found = resolve.resolve(frontier_of(spark, urls), table(spark, rows), conf, **how, **gates).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(found) == len(urls)
    assert {r.url_id: (r.category, r.url, r.method, r.redirect_count) for r in found} == wanted


def test_repeated_observations_collapse_and_the_newest_wins(spark):
    url = "http://h.org/a"
    rows = [response(url, "HEAD", 404), response(url, "HEAD", 200), response(url, "HEAD", 200)]
    stamped = table(spark, rows).withColumn(
        "observed_at", F.when(F.col("status_code") == 404, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")).cast("timestamp")
    )
    found = resolve.resolve(frontier_of(spark, [url]), stamped, AuditConfig()).collect()
    assert len(found) == 1 and found[0].route == "unobserved" and found[0].method == "GET"


def test_malformed_blank_and_unsupported_starts(spark):
    urls = ["htp:/x", " ", "ftp://f.org/x", "http://h.org/a"]
    found = resolve.resolve(frontier_of(spark, urls), table(spark, [response("http://h.org/a", "HEAD", 200)]), AuditConfig())
    rows = {r.url: r for r in found.collect()}
    assert set(rows) == {"htp:/x", "ftp://f.org/x", "http://h.org/a"}
    bad, ftp = rows["htp:/x"], rows["ftp://f.org/x"]
    assert (bad.category, bad.message, bad.method) == ("Broken", "java.net.MalformedURLException", "HEAD")
    assert (ftp.category, ftp.method) == ("Undetermined", "GET") and ftp.message.startswith("the 'ftp'-protocol")


def test_a_spaced_url_is_reported_raw_and_matched_corrected(spark):
    start, page = "http://h.org/a", "http://login.org/a b"
    rows = [response(start, "HEAD", 302, page)]
    pages = login_table(spark, "http://login.org/a%20b")
    found = resolve.resolve(frontier_of(spark, [start]), table(spark, rows), AuditConfig(), login_pages=pages).collect()[0]
    assert (found.url, found.category, found.redirect_count) == (page, "Restricted_Access", 1)
    assert found.message == f"{start} points to a login page, therefore has restricted access."
