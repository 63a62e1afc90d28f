import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.operators import gates, politeness, resolve


def test_longest_rule_wins_and_allow_wins_a_tie(spark):
    rules = [
        ("h.org", "disallow", "/", None),
        ("h.org", "allow", "/a", 2000),
        ("h.org", "disallow", "/a/b", None),
        ("h.org", "allow", "/a/b", None),
        ("h.org", "disallow", "/a/bc", None),
        ("k.org", "disallow", "/x?q", None),
        ("q.org", "allow", None, 3000),
        ("e.org", "disallow", "", None),
        ("w.org", "disallow", "/*.pdf$", None),
        ("w.org", "disallow", "/a.b*c(", None),
        ("w.org", "allow", "/keep*.pdf$", None),
    ]
    table = spark.createDataFrame(rules, schema.ROBOTS_RULES)
    urls = ["http://H.org/a/b", "http://h.org/a/bcd", "http://h.org", "http://h.org/a", "http://k.org/x?q=1", "http://k.org/x",
            "http://none.org/", "http://q.org/", "http://e.org/a", "http://w.org/x/y.pdf", "http://w.org/x.pdf?d", "http://w.org/keep/it.pdf",
            "http://w.org/a.bxxc(", "http://w.org/aXbxxc("]
    df = spark.createDataFrame([(u,) for u in urls + urls], "url string")
    found = {r.url: (r.robots_allowed, r.robots_delay_ms) for r in gates.with_robots(df, table).collect()}

    def brute(url):
        host, _, rest = url[len("http://"):].partition("/")
        mine = [r for r in rules if r[0] == host.lower()]

        def matches(rule):
            parts = [re.escape(part) for part in rule.removesuffix("$").split("*")]
            return re.match(".*".join(parts) + (r"\Z" if rule.endswith("$") else ""), "/" + rest)

        hits = [r for r in mine if r[2] and matches(r[2])]
        best = max(hits, key=lambda r: (len(r[2]), r[1] == "allow"), default=(None, "allow"))
        return best[1] == "allow", max((r[3] for r in mine if r[3]), default=None)

    assert found == {u: brute(u) for u in urls}
    assert gates.with_robots(df, table).count() == len(urls) * 2


def test_the_longest_of_many_prefixes_is_found(spark):
    pick = random.Random(12)
    letters = lambda: "".join(pick.choices("ab/é", k=pick.randint(0, 7)))
    rules = {(f"h{pick.randint(0, 4)}.org", "/" + letters(), pick.choice(["allow", "disallow"])) for _ in range(3000)}
    rules |= {("deep.org", "/" + "a" * k, "allow" if k % 2 else "disallow") for k in range(60)} | {("one.org", "/x", "disallow")}
    many = {(f"big.org", f"/page{i}", "disallow" if i % 3 else "allow") for i in range(10_000)}
    table = spark.createDataFrame([(h, r, p, None) for h, p, r in rules | many], schema.ROBOTS_RULES)
    urls = {f"http://{pick.choice(['h0', 'h1', 'h2', 'h3', 'h4', 'h5'])}.org/" + letters() for _ in range(400)}
    urls |= {"http://deep.org/" + "a" * k + end for k in (0, 5, 59, 80) for end in ("", "b")} | {"http://one.org/xy", "http://one.org/", "http://one.org/a", "http://one.org/z"}
    urls |= {f"http://big.org/page{k}" for k in (0, 1, 7, 77, 9999, 10_000, 99_999, "", "x")} | {"http://big.org/"}
    by_host = {}
    for h, p, r in rules | many:
        by_host.setdefault(h, []).append((p, r))

    def brute(url):
        host, _, rest = url.removeprefix("http://").partition("/")
        hits = [(len(p), r == "allow") for p, r in by_host.get(host, []) if ("/" + rest).startswith(p)]
        return max(hits)[1] if hits else True

    found = gates.with_robots(spark.createDataFrame([(u,) for u in urls], "url string"), table).collect()
    assert {r.url: r.robots_allowed for r in found} == {u: brute(u) for u in urls}


def test_suffix_rules_with_wildcards_and_exceptions(spark):
    rules = ["com", "uk", "co.uk", "jp", "*.kobe.jp", "!city.kobe.jp", "*.ck", "!www.ck", "Net"]
    wanted = {
        "com": None, "a.com": "a.com", "x.a.com": "a.com", "uk": None, "co.uk": None, "a.co.uk": "a.co.uk", "b.a.co.uk": "a.co.uk", "b.uk": "b.uk",
        "kobe.jp": "kobe.jp", "c.kobe.jp": None, "b.c.kobe.jp": "b.c.kobe.jp", "a.b.c.kobe.jp": "b.c.kobe.jp", "city.kobe.jp": "city.kobe.jp", "www.city.kobe.jp": "city.kobe.jp",
        "ck": None, "test.ck": None, "b.test.ck": "b.test.ck", "a.b.test.ck": "b.test.ck", "www.ck": "www.ck", "www.www.ck": "www.ck", "a.net": "a.net", "a.zz": None,
    }
    df = spark.createDataFrame([(f"http://{host.upper()}/x",) for host in wanted] * 2, "url string")
    table = spark.createDataFrame([(rule,) for rule in rules], "suffix string")
    found = gates.with_domain(df, table).collect()
    assert len(found) == 2 * len(wanted)
    assert {r.url.split("/")[2].lower(): r.domain for r in found} == wanted


def delay_by_rule(robots, override, slots, conf):
    delay = conf.delay_ms
    if override is not None:
        delay = override
    elif robots is not None and robots > 0 and robots != conf.delay_ms:
        if conf.max_crawl_delay_ms >= 0 and robots > conf.max_crawl_delay_ms:
            delay = conf.max_crawl_delay_ms if conf.max_crawl_delay_force else conf.delay_ms
        elif robots < conf.delay_ms and conf.delay_force:
            delay = conf.delay_ms
        else:
            delay = robots
    return conf.min_delay_ms if slots > 1 else delay


@pytest.mark.parametrize("force,max_force,limit", list(itertools.product([False, True], [False, True], [-1, 0, 5000])))
def test_effective_delay_truth_table(value, force, max_force, limit):
    conf = AuditConfig(delay_force=force, max_crawl_delay_force=max_force, max_crawl_delay_ms=limit, min_delay_ms=7)
    rows = list(itertools.product([None, 0, 500, 1000, 2000, 9000], [None, 100], [1, 2]))
    column = gates.effective_delay(F.col("r"), F.col("o"), F.col("s"), conf)
    assert value(column, rows, "r long, o long, s int") == [delay_by_rule(*row, conf) for row in rows]
    blocked = gates.crawl_delay_too_long(F.col("r"), F.col("o"), conf)
    wanted = [limit >= 0 and not max_force and o is None and bool(r) and r != 1000 and r > limit for r, o, _ in rows]
    assert value(blocked, rows, "r long, o long, s int") == wanted


def test_first_matching_pattern_sets_the_slots(value):
    conf = AuditConfig(queue_threads=((r"hdl\..*", 2), ("h.*", 3)))
    keys = [("hdl.handle.net",), ("host",), ("xhost",)]
    assert value(gates.slots(F.col("k"), conf), keys, "k string") == [2, 3, 1]


def test_domain_and_address_fall_back_to_the_host(spark):
    urls = ["http://a.b.co.uk/x", "http://c.d.org", "http://odd.zz/", "http://localhost/", "mailto:x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    suffixes = spark.createDataFrame([("uk",), ("co.uk",), ("org",)], "suffix string")
    keyed = gates.with_queue_key(df, AuditConfig(queue_mode="byDomain"), public_suffixes=suffixes)
    assert {r.url: r.queue_key for r in keyed.collect()} == dict(
        zip(urls, ["b.co.uk", "d.org", "odd.zz", "localhost", "mailto:x"])
    )
    known = spark.createDataFrame([("c.d.org", "10.0.0.1")], "host string, ip string")
    keyed = gates.with_queue_key(df, AuditConfig(queue_mode="byIP"), host_ip=known)
    assert {r.queue_key for r in keyed.collect()} == {"a.b.co.uk", "10.0.0.1", "odd.zz", "localhost", "mailto:x"}


def test_gates_in_order_and_a_submitted_login_page_passes(spark):
    rows = [("http://l.org/in", "http://l.org/in"), ("http://l.org/in", "http://o.org/"), ("ftp://x", "ftp://x"), ("zz", "zz")]
    df = spark.createDataFrame(rows, "url string, original_url string")
    pages = spark.createDataFrame([("http://l.org/in",), ("ftp://x",)], "url string")
    found = gates.with_gates(df, AuditConfig(), login_pages=pages).collect()
    assert {(r.url, r.original_url): r.gate for r in found} == dict(zip(rows, [None, "login", "protocol", "malformed"]))


def test_crawl_delay_gate_spares_an_overridden_host(spark):
    df = spark.createDataFrame([("http://a.org/1",), ("http://b.org/1",)], "url string").withColumn("original_url", F.col("url"))
    rules = spark.createDataFrame([(h, "allow", "/", 40000) for h in ("a.org", "b.org")], schema.ROBOTS_RULES)
    overrides = spark.createDataFrame([("b.org", 100, None)], schema.HOST_OVERRIDES)
    conf = AuditConfig(max_crawl_delay_ms=30000)
    found = gates.with_gates(df, conf, robots_rules=rules, host_overrides=overrides).collect()
    assert {r.url: r.gate for r in found} == {"http://a.org/1": "crawl_delay", "http://b.org/1": None}


def checks_of(spark, host, gaps, start=0):
    at, rows = 0, []
    for i, gap in enumerate([0, *gaps]):
        at += gap
        rows.append((start + i, host, at))
    df = spark.createDataFrame(rows, "check_id long, host string, ms long")
    return df.select("check_id", "host", F.timestamp_millis("ms").alias("checking_date"))


def test_gap_audit_uses_the_delay_of_the_host(spark):
    checks = checks_of(spark, "h.org", [2000, 1999, 5000]).unionByName(checks_of(spark, "hdl.handle.net", [100, 99], 10))
    delay = F.when(F.col("host") == "hdl.handle.net", 100).otherwise(2000)
    found = {r.check_id: (r.gap_us, r.too_early) for r in politeness.audit_gaps(checks, delay).collect()}
    assert found == {
        0: (None, False), 1: (2_000_000, False), 2: (1_999_000, True), 3: (5_000_000, False),
        10: (None, False), 11: (100_000, False), 12: (99_000, True),
    }


def test_schedule_adds_delay_except_after_asap(spark):
    rows = [(1, "q", 10, None, 1000, 1), (2, "q", 9, "robots", 1000, 1), (3, "q", 30, None, 1000, 1), (4, "q", 5, None, 1000, 1)]
    rows += [(5, "p", 1, "crawl_delay", 7, 1), (6, "p", 1, "crawl_delay", 7, 1), (7, "w", 5, None, 7, 2), (8, "w", 5, None, 7, 2)]
    df = spark.createDataFrame(rows, "seq long, queue_key string, d long, gate string, delay_ms long, queue_slots int")
    planned = politeness.plan_schedule(df, F.col("d"))
    assert {r.seq: r.start_offset_ms for r in planned.collect()} == {1: 0, 2: 1010, 3: 1010, 4: 2040, 5: 0, 6: 0, 7: None, 8: None}
    kept, dropped = resolve.drop_queue_timeouts(planned, AuditConfig(queue_timeout_ms=1000))
    assert sorted(r.seq for r in dropped.collect()) == [3, 4] and kept.count() == 6
    turns = politeness.interleave(df).select("turn", "queue_key", "seq").collect()
    assert [tuple(r) for r in turns] == [
        (1, "p", 5), (1, "q", 1), (1, "w", 7), (2, "p", 6), (2, "q", 2), (2, "w", 8), (3, "q", 3), (4, "q", 4)
    ]
