import pytest
from pyspark.sql import functions as F

from urlaudit.config import AuditConfig
from urlaudit.functions import classify, records, urls

LOCATIONS = [
    ("http://h/dir/x?q", "./a", "http://h/dir/a"),
    ("http://h/dir/x?q", "../a", "http://h/dir./a"),
    ("http://h/dir/x?q=/b/", "./a", "http://h/dir/a"),
    ("http://h.org", "./a", "http:/" + "/a"),
    ("http://h:8080/dir/x", "/a", "http://h/a"),
    ("http://u@h.org:8080/dir/x", "/a", "http://h.org/a"),
    ("http://h/x", "//o/a", "http://h//o/a"),
    ("http://h/x", "httpfoo.html", "httpfoo.html"),
    ("http://h/x", "ftp://f/y", "ftp://f/y"),
    ("http://h/dir/x", "a", "http://h/dira"),
    ("http://h/dir/x", "", "http://h/dir"),
    ("http://bad_host/x", "/a", "http://null/a"),
    ("http://[::1]:80/x", "/a", "http://[::1]/a"),
    ("http://127.0.0.1/x", "/a", "http://127.0.0.1/a"),
    ("http://h/a b", "/a", None),
    ("http://h/a b", "./c", "http://h/c"),
    ("http://h/x", None, None),
]


def test_resolve_location(value):
    found = value(urls.resolve_location(F.col("u"), F.col("l")), [r[:2] for r in LOCATIONS], "u string, l string")
    assert found == [r[2] for r in LOCATIONS]


def test_location_error_names_the_reason(value):
    rows = [("http://h/a b", "/a"), ("http://h/x?a|b", "/a"), ("http://h/x", None), ("http://h/x", "/a")]
    found = value(urls.location_error(F.col("u"), F.col("l")), rows, "u string, l string")
    assert found[0] == ("java.net.URISyntaxException", "Illegal character in path at index 10: http://h/a b")
    assert found[1] == ("java.net.URISyntaxException", "Illegal character in query at index 12: http://h/x?a|b")
    assert found[2] == ("java.net.MalformedURLException", "Location Header in a redirect shouldn't be null.")
    assert found[3] is None


def test_resolve_location_rfc3986(value):
    rows = [("http://h/dir/x?q", "../a"), ("http://h:1/dir/x", "/a"), ("http://h/dir/x", "a"), ("http://h/x", None)]
    found = value(urls.resolve_location(F.col("u"), F.col("l"), "rfc3986"), rows, "u string, l string")
    assert found == ["http://h/a", "http://h:1/a", "http://h/dir/a", None]
    with pytest.raises(ValueError):
        urls.resolve_location(F.col("u"), F.col("l"), "other")


def test_malformed_and_blank(value):
    rows = [("http://h",), ("HTTPS://h",), ("htp:/x",), ("no scheme",), ("http://h:x/",), ("http://[::1]:80/",), ("mailto:a",)]
    assert value(urls.is_malformed(F.col("u")), rows, "u string") == [False, False, True, True, True, False, False]
    blanks = [(None,), ("",), (" \t\n",), ("x",)]
    assert value(urls.is_blank(F.col("u")), blanks, "u string") == [True, True, True, False]


def test_queue_key_prefers_a_given_key(value):
    rows = [("http://Host.ORG:1/x", "KEY"), ("http://Host.ORG:1/x", " "), ("http://Host.ORG/x", None), ("mailto:A", None)]
    found = value(urls.queue_key(F.col("u"), F.col("k")), rows, "u string, k string")
    assert found == ["key", "host.org", "host.org", "mailto:a"]


def test_paths_and_prefixes(value):
    rows = [("http://h",), ("http://h?q=1#f",), ("http://h/a/b?c#d",), ("http://hdl.handle.net/11/22",)]
    assert value(urls.path_and_query(F.col("u")), rows, "u string") == ["/", "/?q=1", "/a/b?c", "/11/22"]
    assert value(urls.handle_prefix(F.col("u")), rows, "u string") == ["", "", "", "11"]


def test_status_categories(value):
    conf = AuditConfig()
    codes = [(200,), (304,), (405,), (429,), (401,), (403,), (404,), (301,), (500,)]
    category = classify.category_of_status(F.col("c"), conf)
    assert value(category, codes, "c int") == [
        "Ok", "Ok", "Undetermined", "Undetermined", "Restricted_Access", "Restricted_Access", "Broken", "Broken", "Broken",
    ]
    message = classify.message_of_status(category, F.col("c"))
    assert value(message, codes, "c int")[2:7:2] == [
        "Undetermined, Status code: 405", "Restricted access, Status code: 401", "Broken, Status code: 404",
    ]


def test_exception_message_looks_at_the_cause_first(value):
    timeout, unknown = "java.util.concurrent.TimeoutException", "java.net.UnknownHostException"
    rows = [
        ("x.Y", timeout, "anything"),
        ("x.Y", None, "read timed out"),
        ("x.Y", unknown, "m"),
        (unknown, None, "m"),
        ("x.Y", None, " "),
        ("x.Y", None, "m"),
    ]
    message = classify.message_of_exception(F.col("c"), F.col("k"), F.col("m"))
    assert value(message, rows, "c string, k string, m string") == [
        "Socket timeout fetching", "Socket timeout fetching", "Unknown host", "Unknown host", "x.Y", "m",
    ]
    category = classify.category_of_exception(F.col("c"))
    classes = [(unknown,), ("javax.net.ssl.SSLHandshakeException",), ("java.lang.NumberFormatException",), ("x.Y",), (None,)]
    assert value(category, classes, "c string") == ["Broken", "Undetermined", "Broken", "Undetermined", None]


def test_truncation_boundaries(value):
    rows = [("m" * 1023,), ("m" * 1024,), (None,)]
    found = value(records.truncate_message(F.col("m")), rows, "m string")
    assert found == ["m" * 1023, "m" * 1017 + "[...]", None]
    types = [("t" * 255,), ("t" * 256,), (None,)]
    assert value(records.truncate_content_type(F.col("m")), types, "m string") == ["t" * 255, "t" * 250 + "...", None]


def test_numbers_need_digits_only(value):
    rows = [("12",), ("12 ",), ("-1",), ("1.5",), ("",), (None,), ("99999999999",), ("1\n",)]
    assert value(records.digits_to_number(F.col("s")), rows, "s string") == [12, None, None, None, None, None, None, None]
    assert value(records.digits_to_number(F.col("s"), "bigint"), rows[-2:-1], "s string") == [99999999999]


def test_metadata_maps(value):
    ddl = "m map<string,array<string>>"
    rows = [({"a": ["1", "2"], "fetch.message": ["x"]},)]
    m = F.col("m")
    assert value(records.first_value(m, "a"), rows, ddl) == ["1"]
    assert value(records.first_value(m, "zz"), rows, ddl) == [None]
    assert value(records.set_value(m, "a", F.lit("9")), rows, ddl) == [{"fetch.message": ["x"], "a": ["9"]}]
    assert value(records.remove_key(m, "a"), rows, ddl) == [{"fetch.message": ["x"]}]
    assert value(records.persisted(m), rows, ddl) == [{"fetch.message": ["x"]}]
    added = F.create_map(F.lit("a"), F.array(F.lit("h")))
    assert value(records.merge_prefixed(m, added), rows, ddl) == [{"fetch.message": ["x"], "a": ["h"]}]
    assert value(records.merge_prefixed(m, added, "p."), rows, ddl)[0]["p.a"] == ["h"]
    labels = [("true",), ("TRUE",), ("false",), (None,)]
    assert value(records.method_label(F.col("f")), labels, "f string") == ["HEAD", "HEAD", "GET", "N/A"]


def test_configuration():
    lists = {
        "ok.status.codes": [200, "x", 304],
        "redirect.status.codes": [301],
        "undetermined.status.codes": [405],
        "restricted.access.status.codes": [401],
    }
    conf = AuditConfig.from_mapping({**lists, "fetcher.queue.mode": "odd", "fetcher.server.delay": 0.1, "fetcher.maxThreads.h.*": 2})
    assert conf.ok_codes == (200, 304) and conf.queue_mode == "byHost" and conf.redirect_limit == 5
    assert conf.delay_ms == 100 and conf.max_crawl_delay_ms == 30_000 and conf.queue_threads == (("h.*", 2),)
    with pytest.raises(ValueError):
        AuditConfig.from_mapping({**lists, "ok.status.codes": None})
