import html as markup
import math
import random
import re
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as registry
from urlaudit.llm import reputation

PAGES = "page_id long, url string, html string"


def place(url):
    _, found, rest = (url or "").partition("://")
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest if found else "").groups()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule(host, path, rules=reputation.RULES):
    fits = []
    for entry in rules:
        says, what = entry.split(" ")
        own, slash, start = what.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start):
            fits.append((len(what), says == "block", what, says))
    return max(fits)[2:] if fits else (None, None)


def owner(host):
    name = re.sub(r":[0-9]*$", "", host.rpartition("@")[2])
    labels = name.split(".")
    if len(labels) < 2 or re.fullmatch("[0-9.]+", name):
        return name, ""
    n = 2 if ".".join(labels[-2:]) in reputation.TWO_LABELS else 1
    return ".".join(labels[-n - 1 :]), ".".join(labels[-n:])


def posterior(outcomes, hosts):
    """Whether a host is blocked, by sums over dictionaries."""
    counts = {host: [0, 0] for host in hosts}
    for host, bad in outcomes:
        counts.setdefault(host, [0, 0])
        counts[host][0] += 1
        counts[host][1] += bad

    def pooled(rows, key):
        out = defaultdict(lambda: [0, 0])
        for name, (n, bad) in rows.items():
            out[key(name)][0] += n
            out[key(name)][1] += bad
        return out

    def strength(children, parents, key):
        seen = chance = room = 0.0
        for name, (n, bad) in children.items():
            if n:
                all_n, all_bad = parents[key(name)]
                m = all_bad / all_n
                free = m * (1 - m) * (1 - n / all_n)
                seen, chance, room = seen + n * (bad / n - m) ** 2, chance + free, room + free * (n - 1)
        s = min(max((seen - chance) / room, 0.001), 0.5) if room else 0.1
        return (1 - s) / s

    domains = pooled(counts, lambda host: owner(host))
    suffixes = pooled(domains, lambda pair: pair[1])
    whole = pooled(suffixes, lambda _: None)
    k1 = strength(suffixes, whole, lambda _: None)
    k2 = strength(domains, suffixes, lambda pair: pair[1])
    k3 = strength(counts, domains, owner)
    n, bad = whole[None]
    rate = (bad + 1) / (n + 2)
    by_suffix = {s: (bad + k1 * rate) / (n + k1) for s, (n, bad) in suffixes.items()}
    by_domain = {d: (bad + k2 * by_suffix[d[1]]) / (n + k2) for d, (n, bad) in domains.items()}
    out = {}
    for host, (n, bad) in counts.items():
        mean = (bad + k3 * by_domain[owner(host)]) / (n + k3)
        out[host] = math.sin(max(math.asin(math.sqrt(mean)) - 1.645 / (2 * math.sqrt(n + k3 + 1)), 0)) ** 2 > 0.5
    return out


def verdicts(spark, pages, outcomes, **options):
    rows = spark.createDataFrame([(i, url, None) for i, url in pages], PAGES)
    known = spark.createDataFrame(outcomes, "url string, bad int")
    return {r["page_id"]: r for r in reputation.judge(rows, known, **options).collect()}


def test_rules_and_places(spark):
    urls = [
        "http://a.com/x", "http://COM/", "http://example.com/en/1?q#f", "https://www.example.com/en/", "http://m.www.example.com/en/2", "http://xexample.com/en/",
        "http://a.net/es/", "http://a.net/es", "http://net/fr/1", "http://a.net?u=/es/", "http://a.com", "http://a.org/es/", None, "", "a.com/x", "x://a.com://b.net/es/",
        "HTTP://A.NET/ES/", "ftp://u:p@b.net:80/fr/x", "http://é.COM/é?x", "http://a.com#x/y", "//a.com/",
    ]
    found = verdicts(spark, list(enumerate(urls)), [])
    for number, url in enumerate(urls):
        host, path = place(url)
        what, says = rule(host, path)
        assert (found[number]["host"], found[number]["path"], found[number]["rule"], found[number]["verdict"]) == (host, path, what, says or "allow"), url


def test_equal_rules_block(spark):
    rules = ("allow a.org/x/", "block a.org/x/")
    found = verdicts(spark, [(1, "http://a.org/x/1"), (2, "http://b.a.org/x/"), (3, "http://a.org/y")], [], rules=rules)
    assert [found[k]["verdict"] for k in (1, 2, 3)] == ["block", "block", "allow"]


def test_reputation_follows_host_domain_and_suffix(spark):
    outcomes = [("http://bad.fine.org/p", 1)] * 60 + [("http://once.fine.org/p", 1)] + [("http://good.fine.org/p", 0)] * 300
    outcomes += [(f"http://h{k}.farm.org/p", 1) for k in range(200)] + [(f"http://h{k}.plain.org/p", int(k % 20 == 0)) for k in range(400)]
    outcomes += [(f"http://s{k}.d{k}.pro/", int(k % 10 == 0)) for k in range(300)]
    asked = {1: "http://bad.fine.org/new", 2: "http://once.fine.org/", 3: "http://good.fine.org/", 4: "http://new.farm.org/", 5: "http://new.plain.org/", 6: "http://x.new.org/", 7: "http://new.pro/", 8: None}
    found = verdicts(spark, list(asked.items()), outcomes)
    assert {k: r["verdict"] for k, r in found.items()} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow"}
    assert (found[1]["host_pages"], found[1]["host_bad"], found[4]["host_pages"]) == (60, 60, 0)


def test_equals_brute_force(spark):
    pick = random.Random(8)
    names = [f"h{a}.d{b}.{s}" for a in range(6) for b in range(12) for s in ("org", "co.uk", "info")] + ["localhost", "10.0.0.1", "u@x.org:8080", ""]
    rate = {name: pick.choice([0.02, 0.1, 0.9]) for name in {owner(n)[0] for n in names}}
    outcomes = [(f"http://{n}/{k}" if n else "no place", int(pick.random() < rate[owner(n)[0]])) for n in names for k in range(pick.choice([0, 1, 4, 40]))]
    asked = {k: f"http://{n}/p" if n else None for k, n in enumerate([*names, "new.d3.org", "new.d5.co.uk", "x.new.info", "new.dev"])}
    blocked = posterior([(place(u)[0], bad) for u, bad in outcomes], [place(u)[0] for u in asked.values()])
    found = verdicts(spark, list(asked.items()), outcomes)
    assert {k: r["verdict"] for k, r in found.items()} == {k: "block" if blocked[place(u)[0]] else "allow" for k, u in asked.items()}
    assert 10 < sum(blocked.values()) < len(blocked) - 10


def test_outcomes_come_from_whole_lines(spark):
    line = "{} one two three four five six & <seven> eight"
    docs = spark.createDataFrame(
        [(1, line.format("a") + "\n" + line.format("b")), (2, line.format("c") + "\nshort"), (3, line.format("d")), (None, line.format("e")), (4, None), (5, ""), (2, line.format("f"))],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 1), (3, 1, 0), (None, 0, 1), (4, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    show = lambda *keys: "<p>" + "<br>\n ".join(markup.escape(line.format(k)).replace(" two ", " \t two\n") for k in keys) + "</p>"
    pages = [(1, "u1", show("a", "b", "c")), (2, "u2", show("a", "c")), (3, "u3", show("d")), (4, "u4", show("e")), (5, "u5", None), (6, "u6", ""), (7, "u7", show("c", "f")), (1, "u1", show("a", "b", "c")), (8, None, show("a"))]
    found = reputation.page_outcomes(spark.createDataFrame(pages, PAGES), docs, labels).collect()
    assert sorted(((r["url"], r["bad"]) for r in found), key=repr) == sorted([("u1", 1), ("u2", 0), ("u3", 1), ("u7", 0), (None, 1)], key=repr)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "x", 1.0), (None, "http://a.org/", "", "x", 2.0), (2, "http://a.org/" + "x" * 100_000, "<p>" * 9, "x", None), (2, "", "é", None, 0.0)] * 2, PAGES + ", host string, bound double")
    nothing = spark.createDataFrame([], "url string, bad int")
    rows = reputation.judge(pages, nothing).collect()
    assert len(rows) == 8 and {r["verdict"] for r in rows} == {"allow"} and {r["host"] for r in rows} == {"", "a.org"}
    assert reputation.judge(pages.where("false"), nothing).count() == 0
    assert reputation.judge(pages, spark.createDataFrame([("http://a.org/1", None)], "url string, bad int")).where("host_pages > 0").count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    found = registry.queries()["op11_url_filter"](spark, folder).collect()
    con = duckdb.connect()
    for name in ("pages", "documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    wanted = con.execute(registry.oracle_sql()["op11_url_filter"]).fetchall()
    assert sorted(map(tuple, found)) == sorted(wanted)
    rows = {page_id: url for page_id, url in con.execute("SELECT page_id, url FROM pages").fetchall()}
    for r in found:
        assert (r["host"], r["path"]) == place(rows[r["page_id"]]) and r["rule"] == rule(r["host"], r["path"])[0]
