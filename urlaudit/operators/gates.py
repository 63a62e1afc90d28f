"""Checks made before a URL is requested, and the host lookups they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlaudit.config import BLOCKED, BROKEN, RESTRICTED, UNDETERMINED, AuditConfig
from urlaudit.functions import classify, urls
from urlaudit.session import materialize


def _of_host(settings: tuple[tuple[str, int], ...], host: Column) -> Column:
    """The setting of a host from the configuration, a literal in the plan; NULL without one."""
    if not settings:
        return F.lit(None).cast("long")
    return F.create_map(*[F.lit(part) for pair in settings for part in pair])[host].cast("long")


def overrides_index(host_overrides: DataFrame) -> DataFrame:
    """The overrides of a host as one row; rows that have this form already stay as they are."""
    if "_delay_ms" in host_overrides.columns:
        return host_overrides
    return host_overrides.groupBy(F.col("host").alias("_host")).agg(
        F.max("delay_ms").cast("long").alias("_delay_ms"),
        F.max("timeout_ms").cast("long").alias("_timeout_ms"),
    )


def prepared_gates(robots_rules: DataFrame | None = None, login_pages: DataFrame | None = None, host_overrides: DataFrame | None = None) -> dict[str, DataFrame | None]:
    """The tables of the gates as they are joined, written once.

    A table without a true size is joined by shuffling the URLs, and each join would index the rules again; a written one is broadcast if
    it is small."""
    return {
        "robots_rules": None if robots_rules is None else materialize(robots_index(robots_rules), "robots"),
        "login_pages": None if login_pages is None else materialize(login_pages.select("url").distinct(), "login"),
        "host_overrides": None if host_overrides is None else materialize(overrides_index(host_overrides), "overrides"),
    }


def with_overrides(df: DataFrame, host_overrides: DataFrame | None, conf: AuditConfig, url: str = "url") -> DataFrame:
    """Add ``override_delay_ms`` (NULL without override) and ``effective_timeout_ms``; hosts match case as given.

    A table of overrides stands above the hosts named in the configuration."""
    host = urls.host(F.col(url))
    delay, timeout = _of_host(conf.host_delays, host), _of_host(conf.host_timeouts, host)
    default = F.lit(conf.timeout_ms).cast("long")
    if host_overrides is None:
        return df.withColumns({"override_delay_ms": delay, "effective_timeout_ms": F.coalesce(timeout, default)})
    one_per_host = overrides_index(host_overrides)
    joined = df.withColumn("_host", host).join(one_per_host, ["_host"], "left")
    return joined.withColumns(
        {"override_delay_ms": F.coalesce("_delay_ms", delay), "effective_timeout_ms": F.coalesce("_timeout_ms", timeout, default)}
    ).drop("_host", "_delay_ms", "_timeout_ms")


def path_pattern(path: Column) -> Column:
    """The regular expression of a rule's path with ``*`` (anything) or a final ``$`` (end of the path); NULL for a plain prefix."""
    quoted = F.regexp_replace(F.regexp_replace(path, r"\$$", ""), r"([\\.\[\](){}+?^$|])", r"\\$1")
    ends = F.when(path.endswith("$"), F.lit(r"\z")).otherwise(F.lit(""))
    return F.when(path.contains("*") | path.endswith("$"), F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), ends))


def robots_index(robots_rules: DataFrame) -> DataFrame:
    """The rules of a host as one row, no longer than its robots.txt.

    ``_plain`` has the plain prefixes in order, each with its weight and the place of the longest other one that it begins with (-1
    without any), ``_depth`` how many such steps there are at most. ``_patterns`` are the rules with wildcards. Rows that have this form
    already stay as they are."""
    if "_plain" in robots_rules.columns:
        return robots_rules
    path = F.col("path_prefix")
    weight = F.length(path) * 2 + (F.col("rule") == "allow").cast("int")
    rules = robots_rules.select(F.lower("host").alias("_host"), path.alias("prefix"), path_pattern(path).alias("pattern"), weight.alias("weight"), "crawl_delay_ms")
    plain = rules.where("prefix != '' AND pattern IS NULL").groupBy("_host", "prefix").agg(F.max("weight").alias("weight"))
    placed = plain.withColumn("place", F.row_number().over(Window.partitionBy("_host").orderBy("prefix")) - 1)
    begun = placed.where(F.length("prefix") > 1).select(
        "_host", F.col("place").alias("_of"), F.explode(F.expr("transform(sequence(1, length(prefix) - 1), n -> substring(prefix, 1, n))")).alias("prefix")
    )
    above = begun.join(placed, ["_host", "prefix"]).groupBy("_host", "_of").agg(
        F.max_by("place", F.length("prefix")).alias("parent"), F.count("*").cast("int").alias("steps")
    )
    linked = placed.join(above.withColumnRenamed("_of", "place"), ["_host", "place"], "left")
    entry = F.struct("prefix", "weight", F.coalesce("parent", F.lit(-1)).alias("parent"))
    arrays = linked.groupBy("_host").agg(
        F.sort_array(F.collect_list(entry)).alias("_plain"), F.coalesce(F.max("steps"), F.lit(0)).alias("_depth")
    )
    # What stands before the first wildcard tells most patterns apart without a look at them.
    begins = F.regexp_replace(F.substring_index("prefix", "*", 1), r"\$$", "")
    pattern = F.when(F.col("pattern").isNotNull(), F.struct(begins.alias("begins"), "pattern", "weight"))
    hosts = rules.groupBy("_host").agg(F.collect_set(pattern).alias("_patterns"), F.max("crawl_delay_ms").cast("long").alias("robots_delay_ms"))
    return hosts.join(arrays, "_host", "left")


def longest_prefix(path: Column, plain: Column, depth: Column) -> Column:
    """The weight of the longest of the sorted prefixes that ``path`` begins with, NULL without one.

    Binary search finds the last entry that is not greater than the path. Whatever the path begins with, that entry begins with too, so
    the answer is the entry itself or one that its links lead to."""
    mid = lambda s: F.shiftright(s["lo"] + s["hi"], 1)
    not_greater = lambda s: F.get(plain, mid(s))["prefix"] <= path
    halved = F.aggregate(
        F.sequence(F.lit(0), F.ceil(F.log2(F.size(plain) + 1)).cast("int")),
        F.struct(F.lit(0).alias("lo"), F.size(plain).alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s)
        .when(not_greater(s), F.struct((mid(s) + 1).alias("lo"), s["hi"].alias("hi")))
        .otherwise(F.struct(s["lo"].alias("lo"), mid(s).alias("hi"))),
        lambda s: s["lo"] - 1,
    )
    return F.aggregate(
        F.sequence(F.lit(0), depth),
        halved,
        lambda at, _: F.when((at < 0) | path.startswith(F.get(plain, at)["prefix"]), at).otherwise(F.get(plain, at)["parent"]),
        lambda at: F.when(at >= 0, F.get(plain, at)["weight"]),
    )


def with_robots(df: DataFrame, robots_rules: DataFrame | None, url: str = "url") -> DataFrame:
    """Add ``robots_allowed`` and ``robots_delay_ms``. The longest matching path decides, allow wins a tie; an empty path matches
    nothing, and ``*`` and a final ``$`` are wildcards.

    Each URL joins once by host and looks for its rule inside the host's row; rules and URLs of a host never multiply. Plain prefixes are
    found by binary search, so a host may have many; patterns are tried one by one where the path begins as they do.
    """
    if robots_rules is None:
        return df.withColumns({"robots_allowed": F.lit(True), "robots_delay_ms": F.lit(None).cast("long")})
    corrected = urls.correct_url(F.col(url))
    keyed = df.withColumn("_host", F.lower(urls.host(corrected))).join(robots_index(robots_rules), ["_host"], "left")
    keyed = keyed.withColumn("_path", F.when(F.col("_plain").isNotNull() | (F.size("_patterns") > 0), urls.path_and_query(corrected)))
    path = F.col("_path")
    hits = F.filter("_patterns", lambda r: path.startswith(r["begins"]) & F.regexp_like(path, r["pattern"]))
    by_pattern = F.array_max(F.transform(hits, lambda r: r["weight"]))
    by_prefix = F.when(F.col("_plain").isNotNull(), longest_prefix(path, F.col("_plain"), F.col("_depth")))
    keyed = keyed.withColumn("robots_allowed", F.coalesce(F.greatest(by_prefix, by_pattern) % 2 == 1, F.lit(True)))
    return keyed.drop("_host", "_plain", "_depth", "_patterns", "_path")


def with_login(df: DataFrame, login_pages: DataFrame | None, url: str = "url") -> DataFrame:
    """Add ``is_login_page``: the corrected URL equals a listed page."""
    if login_pages is None:
        return df.withColumn("is_login_page", F.lit(False))
    listed = login_pages.select(F.col("url").alias("_page"), F.lit(True).alias("_listed")).distinct()
    joined = df.withColumn("_page", urls.correct_url(F.col(url))).join(listed, ["_page"], "left")
    return joined.withColumn("is_login_page", F.coalesce("_listed", F.lit(False))).drop("_page", "_listed")


def slots(queue_key: Column, conf: AuditConfig) -> Column:
    """Parallel slots of a queue. The patterns are configuration, so they become one CASE, not a theta join."""
    rule = F.lit(conf.threads_per_queue)
    for pattern, threads in reversed(conf.queue_threads):
        rule = F.when(queue_key.rlike(rf"^(?:{pattern})\z"), threads).otherwise(rule)
    return rule


def crawl_delay_too_long(robots_delay: Column, override: Column, conf: AuditConfig) -> Column:
    if conf.max_crawl_delay_ms < 0 or conf.max_crawl_delay_force:
        return F.lit(False)
    asked = (robots_delay > 0) & (robots_delay != conf.delay_ms) & (robots_delay > conf.max_crawl_delay_ms)
    return override.isNull() & F.coalesce(asked, F.lit(False))


def effective_delay(robots_delay: Column, override: Column, queue_slots: Column, conf: AuditConfig) -> Column:
    """Milliseconds to wait between checks of one queue.

    A host override dominates. A robots delay is taken, bounded by the maximum if that is forced and
    raised to the default if that is forced. A queue with several slots uses the minimum delay.
    """
    asked = (robots_delay > 0) & (robots_delay != conf.delay_ms)
    default = F.lit(conf.delay_ms).cast("long")
    by_robots = robots_delay.cast("long")
    if conf.delay_force:
        by_robots = F.greatest(by_robots, default)
    if conf.max_crawl_delay_ms >= 0:
        over = F.lit(conf.max_crawl_delay_ms).cast("long") if conf.max_crawl_delay_force else default
        by_robots = F.when(robots_delay > conf.max_crawl_delay_ms, over).otherwise(by_robots)
    single = F.when(override.isNotNull(), override).when(asked, by_robots).otherwise(default)
    return F.when(queue_slots > 1, F.lit(conf.min_delay_ms).cast("long")).otherwise(single)


def with_gates(
    df: DataFrame,
    conf: AuditConfig,
    robots_rules: DataFrame | None = None,
    login_pages: DataFrame | None = None,
    host_overrides: DataFrame | None = None,
    url: str = "url",
    original_url: str | None = "original_url",
) -> DataFrame:
    """Add ``gate`` (NULL, malformed, protocol, robots, crawl_delay or login), in that order of precedence.

    The login gate spares a page that was submitted itself; without ``original_url`` every page is
    taken as reached by redirect.
    """
    prepared = with_robots(df, robots_rules, url)
    prepared = with_login(prepared, login_pages, url)
    if conf.max_crawl_delay_ms >= 0:
        prepared = with_overrides(prepared, host_overrides, conf, url).drop("effective_timeout_ms")
        too_long = crawl_delay_too_long(F.col("robots_delay_ms"), F.col("override_delay_ms"), conf)
    else:
        too_long = F.lit(False)
    submitted = F.col(url).eqNullSafe(F.col(original_url)) if original_url else F.lit(False)
    gate = (
        F.when(urls.is_malformed(F.col(url)), "malformed")
        .when(~urls.is_fetchable(F.col(url)), "protocol")
        .when(~F.col("robots_allowed"), "robots")
        .when(too_long, "crawl_delay")
        .when(F.col("is_login_page") & ~submitted, "login")
    )
    helpers = ("robots_allowed", "robots_delay_ms", "is_login_page", "override_delay_ms")
    return prepared.withColumn("gate", gate).drop(*helpers)


def category_of_gate(gate: Column) -> Column:
    return (
        F.when(gate == "malformed", BROKEN)
        .when(gate == "protocol", UNDETERMINED)
        .when(gate.isin("robots", "crawl_delay"), BLOCKED)
        .when(gate == "login", RESTRICTED)
    )


def message_of_gate(gate: Column, url: Column, original_url: Column) -> Column:
    return (
        F.when(gate == "malformed", classify.MSG_MALFORMED)
        .when(gate == "protocol", classify.message_of_protocol(urls.scheme(url)))
        .when(gate == "robots", classify.MSG_ROBOTS)
        .when(gate == "crawl_delay", classify.MSG_CRAWL_DELAY)
        .when(gate == "login", classify.message_of_login(original_url))
    )


def with_domain(df: DataFrame, public_suffixes: DataFrame, url: str = "url") -> DataFrame:
    """Add ``domain``: the public suffix of the host plus one label, NULL where no rule matches or the host is itself a suffix.

    ``public_suffixes`` are rules: ``x`` is a suffix, ``*.x`` makes one of every label before ``x``, ``!y.x`` says that ``y.x`` is none. The
    longest rule decides, but an exception goes before all. Matching runs on distinct hosts: every tail of a host is looked up by
    equality, as each kind of rule would write it.
    """
    hosted = df.withColumn("_host", F.lower(urls.host(F.col(url))))
    tail = "array_join(slice(_labels, {}, size(_labels)), '.')"
    tails = (
        hosted.select("_host")
        .filter("_host != ''")
        .distinct()
        .select("_host", F.split("_host", r"\.").alias("_labels"))
        .select("_host", "_labels", F.explode(F.sequence(F.lit(1), F.size("_labels"))).alias("_at"))
    )
    own, rest = tail.format("_at"), tail.format("_at + 1")
    before = f"CASE WHEN _at > 1 THEN {tail.format('_at - 1')} END"
    kinds = (
        f"named_struct('suffix', {own}, 'exception', false, 'domain', {before})",
        f"named_struct('suffix', CASE WHEN _at < size(_labels) THEN concat('*.', {rest}) END, 'exception', false, 'domain', {before})",
        f"named_struct('suffix', concat('!', {own}), 'exception', true, 'domain', {own})",
    )
    written = tails.selectExpr("_host", "size(_labels) - _at AS _size", f"inline(array({', '.join(kinds)}))")
    listed = public_suffixes.select(F.lower("suffix").alias("suffix")).distinct()
    longest = F.max_by("domain", F.struct("exception", "_size"))
    domains = written.join(listed, ["suffix"], "left_semi").groupBy("_host").agg(longest.alias("domain"))
    return hosted.join(domains, ["_host"], "left").drop("_host")


def with_ip(df: DataFrame, host_ip: DataFrame, url: str = "url") -> DataFrame:
    """Add ``ip`` of the URL's host, NULL where it is not known."""
    known = host_ip.groupBy(F.lower("host").alias("_host")).agg(F.min("ip").alias("ip"))
    return df.withColumn("_host", F.lower(urls.host(F.col(url)))).join(known, ["_host"], "left").drop("_host")


def with_queue_key(
    df: DataFrame,
    conf: AuditConfig,
    public_suffixes: DataFrame | None = None,
    host_ip: DataFrame | None = None,
    url: str = "url",
    given: str | None = None,
) -> DataFrame:
    """Add ``queue_key`` by the configured mode."""
    given_key = F.col(given) if given else None
    if conf.queue_mode == "byDomain" and public_suffixes is not None:
        looked_up, found = with_domain(df, public_suffixes, url), "domain"
    elif conf.queue_mode == "byIP" and host_ip is not None:
        looked_up, found = with_ip(df, host_ip, url), "ip"
    else:
        return df.withColumn("queue_key", urls.queue_key(F.col(url), given_key))
    return looked_up.withColumn("queue_key", urls.queue_key(F.col(url), given_key, F.col(found))).drop(found)
