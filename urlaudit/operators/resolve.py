"""Following every URL to its final state: HEAD, then GET if that failed, redirects up to a limit.

An attempt is looked up in a table of observed responses. A node is one URL with its HEAD and GET
observation side by side, so a HEAD-to-GET retry never needs a join; only a redirect does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlaudit.config import GET, HEAD, UNDETERMINED, AuditConfig
from urlaudit.functions import classify, records, urls
from urlaudit.operators.gates import category_of_gate, message_of_gate, prepared_gates, with_gates, with_overrides
from urlaudit.operators.selection import drop_blank
from urlaudit.session import materialize, sized_in_memory, split_for_hotspot

FRONTIER = ["url_id", "original_url", "url", "method", "redirect_count"]
OUTCOME = [
    "url_id",
    "original_url",
    "url",
    "method",
    "redirect_count",
    "route",
    "category",
    "message",
    "status_code",
    "content_length",
    "content_type",
    "duration_ms",
]


# The fields of an observation that decide its route.
ROUTE_FIELDS = ["status_code", "location", "exception_class"]
# How an answer that comes after the host's timeout is seen.
LATE_CLASS, LATE_MESSAGE = "java.net.SocketTimeoutException", "Read timed out"


def with_timeouts(responses: DataFrame, conf: AuditConfig, host_overrides: DataFrame | None = None) -> DataFrame:
    """Answers slower than the timeout of their host become socket timeouts, as the request would have been given up."""
    if conf.timeout_ms < 0 and host_overrides is None:
        return responses
    timed = with_overrides(responses, host_overrides, conf)
    bound = F.col("effective_timeout_ms")
    late = F.coalesce(F.col("exception_class").isNull() & (bound >= 0) & (F.col("duration_ms") > bound), F.lit(False))
    timed = timed.withColumn("_late", late).withColumns(
        {
            "status_code": F.when(~late, F.col("status_code")),
            "location": F.when(~late, F.col("location")),
            "exception_class": F.when(late, LATE_CLASS).otherwise(F.col("exception_class")),
            "exception_message": F.when(late, LATE_MESSAGE).otherwise(F.col("exception_message")),
        }
    )
    return timed.select(*responses.columns)


def response_nodes(
    responses: DataFrame, wanted: DataFrame | None = None, conf: AuditConfig | None = None, host_overrides: DataFrame | None = None
) -> DataFrame:
    """One row per URL with structs ``head`` and ``get``; NULL where that method was not observed.

    Repeated observations are collapsed before the shuffle; ``observed_at``, if the table has it,
    lets the newest win, otherwise the greatest does, so the result does not depend on row order.
    With ``wanted``, only its URLs are grouped. Header names are expected in lower case.
    """
    seen = responses
    if wanted is not None:
        seen = seen.join(wanted.select("url").distinct(), "url", "left_semi")
    if conf is not None:
        seen = with_timeouts(seen, conf, host_overrides)
    fields = [F.col(name) for name in ROUTE_FIELDS]
    fields += [
        F.col("cause_class"),
        F.col("exception_message"),
        F.col("headers")["content-length"].alias("content_length"),
        F.col("headers")["content-type"].alias("content_type"),
        F.col("duration_ms"),
    ]
    at = [F.col("observed_at")] if "observed_at" in responses.columns else []
    seen = seen.select("url", "method", F.struct(*at, *fields).alias("seen"))
    return seen.groupBy("url").agg(
        *[
            F.max(F.when(F.col("method") == method, F.col("seen"))).alias(name)
            for method, name in ((HEAD, "head"), (GET, "get"))
        ]
    )


def _routed(df: DataFrame, seen: str, method: Column, conf: AuditConfig, mode: str) -> DataFrame:
    """Route the observation ``seen``: adds ``{seen}_over``, ``_lost``, ``_target`` and ``_route``.

    The order is the semantics: limit, redirect, HEAD-to-GET retry, status. A redirect without a
    target that can be built is ``lost`` and fails like an exception. Intermediate results are
    columns, not repeated expressions: the generated code stays small enough to be compiled.
    """
    a, answered = F.col(seen), F.col(seen)["exception_class"].isNull()
    redirects = F.coalesce(answered & a["status_code"].isin(*conf.redirect_codes), F.lit(False))
    located = df.withColumns(
        {
            f"{seen}_over": redirects & (F.col("redirect_count") + 1 > conf.redirect_limit),
            f"{seen}_lost": redirects & (F.col("redirect_count") + 1 <= conf.redirect_limit),
            f"{seen}_ok": F.coalesce(answered & a["status_code"].isin(*conf.ok_codes), F.lit(False)),
        }
    )
    target = urls.resolve_location(F.col("url"), a["location"], mode)
    located = located.withColumn(f"{seen}_target", F.when(F.col(f"{seen}_lost"), target))
    located = located.withColumn(f"{seen}_lost", F.col(f"{seen}_lost") & F.col(f"{seen}_target").isNull())
    route = (
        F.when(a.isNull(), "unobserved")
        .when(F.col(f"{seen}_over"), "status")
        .when(F.col(f"{seen}_target").isNotNull(), "follow")
        .when((method == HEAD) & ~F.col(f"{seen}_ok"), "retry_get")
        .otherwise("status")
    )
    return located.withColumn(f"{seen}_route", route)


def _with_record(df: DataFrame, seen: str, conf: AuditConfig) -> DataFrame:
    """Add the columns of a finished attempt; metrics only where a response arrived."""
    a, over, lost = F.col(seen), F.col(f"{seen}_over"), F.col(f"{seen}_lost")
    fault = F.when(lost, urls.location_error(F.col("url"), a["location"]))
    staged = df.withColumn("_fault", fault).withColumns(
        {
            "_class": F.coalesce(a["exception_class"], F.col("_fault")["class"]),
            "_text": F.coalesce(a["exception_message"], F.col("_fault")["message"]),
            "_status": classify.category_of_status(a["status_code"], conf),
        }
    )
    failed = F.col("_class").isNotNull()
    staged = staged.withColumns(
        {
            "_raised": F.when(
                failed, classify.message_of_exception(F.col("_class"), a["cause_class"], F.col("_text"))
            ),
            "_said": classify.message_of_status(F.col("_status"), a["status_code"]),
        }
    )
    return staged.withColumns(
        {
            "category": F.when(over, UNDETERMINED)
            .when(failed, classify.category_of_exception(F.col("_class"), conf.broken_exceptions))
            .otherwise(F.col("_status")),
            "message": F.when(over, classify.message_of_limit(F.col("original_url"), conf)).otherwise(
                F.coalesce("_raised", "_said")
            ),
            "status_code": F.when(~failed, a["status_code"]),
            "content_length": F.when(~failed, records.digits_to_number(a["content_length"], "bigint")),
            "content_type": F.when(~failed, a["content_type"]),
            "duration_ms": F.when(~failed, a["duration_ms"]),
        }
    )


RECORD = ["category", "message", "status_code", "content_length", "content_type", "duration_ms"]


def route_attempt(
    frontier: DataFrame, responses: DataFrame, conf: AuditConfig, mode: str = "compat", host_overrides: DataFrame | None = None
) -> DataFrame:
    """One round of the decision list: each frontier row against the response to its method.

    Adds ``route`` (``unobserved``, ``follow``, ``retry_get`` or ``status``), the next attempt's
    ``next_url``, ``next_method`` and ``next_count``, and the columns of a finished attempt.
    """
    seen = F.when(F.col("method") == HEAD, F.col("head")).otherwise(F.col("get"))
    nodes = response_nodes(responses, conf=conf, host_overrides=host_overrides)
    joined = frontier.join(nodes, "url", "left").withColumn("_a", seen)
    routed = _with_record(_routed(joined, "_a", F.col("method"), conf, mode), "_a", conf)
    routed = routed.withColumnRenamed("_a_route", "route")
    goes, again, ends = (F.col("route") == r for r in ("follow", "retry_get", "status"))
    count = F.col("redirect_count")
    return routed.select(
        *frontier.columns,
        "route",
        F.when(goes, F.col("_a_target")).when(again, F.col("url")).alias("next_url"),
        F.when(goes, F.col("method")).when(again, GET).alias("next_method"),
        F.when(goes | F.col("_a_over"), count + 1).when(again, count).alias("next_count"),
        *[F.when(ends, F.col(name)).alias(name) for name in RECORD],
    )


def _decided(df: DataFrame, conf: AuditConfig, mode: str) -> DataFrame:
    """Route rows that carry ``head`` and ``get`` as far as their own URL goes.

    A HEAD attempt that must be repeated is decided by the GET observation beside it. Adds ``last``,
    the observation that decided, with its ``last_*`` columns, and ``last_method``.
    """
    first = F.when(F.col("method") == HEAD, F.col("head")).otherwise(F.col("get"))
    once = _routed(df.withColumn("first", first), "first", F.col("method"), conf, mode)
    once = once.withColumn("_retry", F.col("first_route") == "retry_get")
    # Without a retry there is nothing to route a second time: the observation is NULL.
    twice = _routed(once.withColumn("again", F.when(F.col("_retry"), F.col("get"))), "again", F.lit(GET), conf, mode)
    parts = ("", "_over", "_lost", "_target", "_route")
    last = {f"last{part}": F.when(F.col("_retry"), F.col(f"again{part}")).otherwise(F.col(f"first{part}")) for part in parts}
    return twice.withColumns({**last, "last_method": F.when(F.col("_retry"), GET).otherwise(F.col("method"))})


def _settled(observed: DataFrame, gates: dict, conf: AuditConfig, mode: str) -> DataFrame:
    """Decide each frontier row, given with its observations: final, unobserved, or ``follow`` with ``next_url``."""
    decided = _decided(with_gates(observed, conf, **gates), conf, mode)
    gate, gated, count = F.col("gate"), F.col("gate").isNotNull(), F.col("redirect_count")
    decided = decided.withColumn("route", F.when(gated, "status").otherwise(F.col("last_route")))
    recorded = _with_record(decided, "last", conf).withColumns(
        {
            "_gate_category": category_of_gate(gate),
            "_gate_message": message_of_gate(gate, F.col("url"), F.col("original_url")),
        }
    )
    final = F.col("route") == "status"
    found = {name: F.when(final & ~gated, F.col(name)) for name in RECORD}
    found["category"] = F.coalesce("_gate_category", found["category"])
    found["message"] = F.coalesce("_gate_message", found["message"])
    method = F.when(gate == "protocol", GET).when(gated, F.col("method")).otherwise(F.col("last_method"))
    return recorded.select(
        "url_id",
        "original_url",
        "url",
        method.alias("method"),
        F.when(~gated & F.col("last_over"), count + 1).otherwise(count).alias("redirect_count"),
        "route",
        *[column.alias(name) for name, column in found.items()],
        F.when(F.col("route") == "follow", F.col("last_target")).alias("next_url"),
    )


def _advance(followed: DataFrame) -> DataFrame:
    """The next frontier: the redirect target, method kept, one more redirect."""
    return followed.filter(F.col("route") == "follow").select(
        "url_id",
        "original_url",
        F.col("next_url").alias("url"),
        "method",
        (F.col("redirect_count") + 1).alias("redirect_count"),
    )


def _finished(settled: DataFrame) -> DataFrame:
    return settled.filter(F.col("route") != "follow").select(*OUTCOME)


def resolve_walk(frontier, responses, conf, mode: str = "compat", index=None, **gates) -> DataFrame:
    """One settled round per redirect until nothing is left to follow. The readable definition.

    A round groups only the responses of the URLs it has reached, so for a frontier far smaller than the responses it shuffles in
    proportion to the frontier. With an index it looks them up there and reads no responses."""
    outcomes = []
    current = materialize(drop_blank(frontier.select(*FRONTIER)), "start")
    for _ in range(conf.redirect_limit + 1):
        if index is None:
            observed = current.join(response_nodes(responses, current, conf, gates.get("host_overrides")), "url", "left")
        else:
            observed = index.observed(current, few=True)
        settled = materialize(_settled(observed, gates, conf, mode), "round")
        outcomes.append(_finished(settled))
        current = _advance(settled)
        if current.isEmpty():
            break
    return _union(outcomes)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def state_of(method: Column | str, url: Column | str) -> Column:
    """A method and a URL as one value, the key of jumps."""
    return F.concat(F.col(method) if isinstance(method, str) else method, F.lit(" "), F.col(url) if isinstance(url, str) else url)


def redirect_edges(nodes: DataFrame, conf: AuditConfig, mode: str = "compat", **gates) -> DataFrame:
    """The redirect a state, a method and a URL, takes: for states that take one and pass the gates.

    Far narrower than the responses: only redirecting states, only URLs and methods.
    """
    some = F.lit(False)
    for seen in ("head", "get"):
        some = some | F.coalesce(F.col(f"{seen}.status_code").isin(*conf.redirect_codes), F.lit(False))
    # Of an observation only what decides the route is read.
    routed = [F.when(F.col(seen).isNotNull(), F.struct(*[F.col(seen)[name].alias(name) for name in ROUTE_FIELDS])).alias(seen) for seen in ("head", "get")]
    states = nodes.filter(some).select(
        "url", *routed, F.explode(F.array(F.lit(HEAD), F.lit(GET))).alias("method"), F.lit(0).alias("redirect_count")
    )
    edge = F.struct(
        "url", "method", F.col("last_target").alias("to_url"), F.col("last_method").alias("to_method"), F.lit(1).alias("steps")
    )
    # A generator instead of a filter: a filter would be pushed down and repeat the whole decision.
    follows = F.col("last_route") == "follow"
    edges = _decided(states, conf, mode).select(F.inline(F.when(follows, F.array(edge))))
    gated = with_gates(edges, conf, original_url=None, **gates)
    return gated.filter(F.col("gate").isNull()).select(state_of("method", "url").alias("state"), "to_url", "to_method", "steps")


def jumped(frontier: DataFrame, jumps: DataFrame) -> DataFrame:
    """Move each row along its jump; a row without one stays. Further columns of the frontier are kept."""
    joined = frontier.withColumn("state", state_of("method", "url")).join(jumps, "state", "left")
    after = {
        "url": F.coalesce("to_url", "url").alias("url"),
        "method": F.coalesce("to_method", "method").alias("method"),
        "redirect_count": (F.col("redirect_count") + F.coalesce("steps", F.lit(0))).alias("redirect_count"),
    }
    return joined.select(*[after.get(name, F.col(name)) for name in frontier.columns])


def doubled(jumps: DataFrame, onward: DataFrame) -> DataFrame:
    """Each jump continued by the jump in ``onward`` that starts where it ends."""
    next_jump = onward.select(
        F.col("state").alias("to_state"), F.col("to_url").alias("end_url"), F.col("to_method").alias("end_method"), F.col("steps").alias("more")
    )
    return jumps.withColumn("to_state", state_of("to_method", "to_url")).join(next_jump, "to_state", "left").select(
        "state",
        F.coalesce("end_url", "to_url").alias("to_url"),
        F.coalesce("end_method", "to_method").alias("to_method"),
        (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
    )


def levels_for(limit: int) -> int:
    """How many tables of jumps of 1, 2, 4, ... redirects it takes to move up to ``limit``."""
    return limit.bit_length()


@dataclass
class ResponseIndex:
    """Responses made ready for many polls: nodes, and jumps along redirects of up to 1, 2, 4, ... steps, as written tables."""

    nodes: DataFrame
    jumps: list[DataFrame]

    def moved(self, frontier: DataFrame, level: int, few: bool) -> DataFrame:
        """Each row moved along its jump of 2 to the ``level`` redirects. With ``few``, jumps that start elsewhere are left out by a
        semi join with the small frontier, so that the table stays where it is."""
        table = self.jumps[level]
        if few:
            states = frontier.select(state_of("method", "url").alias("state"))
            table = table.join(states, "state", "left_semi")
        return jumped(frontier, table)

    def observed(self, frontier: DataFrame, few: bool) -> DataFrame:
        """Add ``head`` and ``get`` of each row's URL."""
        nodes = self.nodes.join(frontier.select("url"), "url", "left_semi") if few else self.nodes
        return frontier.join(nodes, "url", "left")


def index_responses(
    responses: DataFrame,
    conf: AuditConfig,
    robots_rules: DataFrame | None = None,
    login_pages: DataFrame | None = None,
    host_overrides: DataFrame | None = None,
    mode: str = "compat",
) -> ResponseIndex:
    """Group the responses once and double the jumps up to the redirect limit. Each table is written, so no plan grows with the limit.

    The index holds for the settings and gates it was built with, and for these responses; ``sources.index`` keeps one up to date."""
    gates = {"robots_rules": robots_rules, "login_pages": login_pages, "host_overrides": host_overrides}
    nodes = materialize(response_nodes(responses, conf=conf, host_overrides=host_overrides), "nodes")
    jumps = [materialize(redirect_edges(nodes, conf, mode, **gates), "edges")] if conf.redirect_limit > 0 else []
    while len(jumps) < levels_for(conf.redirect_limit):
        jumps.append(materialize(doubled(jumps[-1], jumps[-1]), "jumps"))
    return ResponseIndex(nodes, jumps)


def _travel(frontier: DataFrame, index, limit: int, few: bool) -> DataFrame:
    """Move every new row up to ``limit`` redirects, stopping early where no edge leads on: the jumps for the bits of the limit."""
    for level in range(levels_for(limit)):
        if limit >> level & 1:
            frontier = index.moved(materialize(frontier, "frontier") if few else frontier, level, few)
    return materialize(frontier, "frontier") if few else frontier


def _travel_on(frontier: DataFrame, index, limit: int, few: bool) -> DataFrame:
    """The same for rows that have been redirected before: each takes the jumps for the bits of the redirects it has left."""
    frontier = frontier.withColumn("_left", F.greatest(F.lit(limit) - F.col("redirect_count"), F.lit(0)))
    for level in range(levels_for(limit)):
        frontier = materialize(frontier, "frontier")
        goes = F.col("_left").bitwiseAND(F.lit(1 << level)) != 0
        frontier = index.moved(frontier.filter(goes), level, few).unionByName(frontier.filter(~goes))
    return materialize(frontier.drop("_left"), "frontier")


def resolve(
    frontier: DataFrame,
    responses: DataFrame | None,
    conf: AuditConfig,
    robots_rules: DataFrame | None = None,
    login_pages: DataFrame | None = None,
    host_overrides: DataFrame | None = None,
    mode: str = "compat",
    method: str = "lifting",
    index=None,
    few: bool = False,
) -> DataFrame:
    """Final state of every frontier row; route ``status``, or ``unobserved`` where a response is missing.

    ``lifting`` groups the responses once, moves every row by log2(limit) joins to where its redirects end, and settles it there
    once. An ``index`` of the responses, kept from an earlier call, takes their place; with ``few``, for a frontier far smaller than
    the responses such as a poll, the index is filtered by the frontier before each join, so that what moves is in proportion to the
    poll. ``walk`` settles and moves one redirect at a time; it is the definition the other is tested against.
    """
    with sized_in_memory(frontier.sparkSession), split_for_hotspot(frontier.sparkSession):
        return _resolved(frontier, responses, conf, robots_rules, login_pages, host_overrides, mode, method, index, few)


def _resolved(frontier, responses, conf, robots_rules, login_pages, host_overrides, mode, method, index, few) -> DataFrame:
    gates = prepared_gates(robots_rules, login_pages, host_overrides)
    if method == "walk":
        return resolve_walk(frontier, responses, conf, mode, index=index, **gates)
    if method != "lifting":
        raise ValueError(f"unknown method {method!r}")
    start = drop_blank(frontier.select(*FRONTIER))
    # Jumps do not know the submitted URL: a submitted login page, which its own gate spares, is walked.
    listed = F.lit(False)
    if login_pages is not None:
        pages = gates["login_pages"].select(F.col("url").alias("_page"), F.lit(True).alias("_listed")).distinct()
        start = start.withColumn("_page", urls.correct_url(F.col("original_url"))).join(pages, "_page", "left")
        listed = F.coalesce("_listed", F.lit(False))
    kind = F.when(listed, "listed").when(F.col("redirect_count") > 0, "before").otherwise("new")
    start = materialize(start.withColumn("_kind", kind).select(*FRONTIER, "_kind"), "start")
    kinds = {row["_kind"] for row in start.select("_kind").distinct().collect()}  # three at most
    of_kind = lambda name: start.filter(F.col("_kind") == name).select(*FRONTIER)
    outcomes = []
    if "listed" in kinds:
        outcomes.append(resolve_walk(of_kind("listed"), responses, conf, mode, index=index, **gates))
    if index is None:
        index = index_responses(responses, conf, mode=mode, **gates)
    ended = _travel(of_kind("new"), index, conf.redirect_limit, few)
    if "before" in kinds:
        ended = ended.unionByName(_travel_on(of_kind("before"), index, conf.redirect_limit, few))
    # Written, so that what follows is not compiled together with the decision.
    outcomes.append(_finished(materialize(_settled(index.observed(ended, few), gates, conf, mode), "settled")))
    return _union(outcomes)


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(status, redirect) views of routed attempts; retries and followed redirects go back to work."""
    return routed.filter(F.col("route") == "status"), routed.filter(F.col("route").isin("follow", "retry_get"))


def next_frontier(routed: DataFrame) -> DataFrame:
    """The redirect view as frontier rows."""
    return split_routes(routed)[1].select(
        "url_id",
        "original_url",
        F.col("next_url").alias("url"),
        F.col("next_method").alias("method"),
        F.col("next_count").alias("redirect_count"),
    )


def split_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(final, unobserved) rows; only the first go on to status."""
    return outcomes.filter(F.col("route") == "status"), outcomes.filter(F.col("route") == "unobserved")


def drop_queue_timeouts(scheduled: DataFrame, conf: AuditConfig) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) by planned wait; a dropped row leaves no status. A row whose wait is not known is kept, and so is one that a
    gate answers before the wait is looked at."""
    if conf.queue_timeout_ms < 0:
        return scheduled, scheduled.filter(F.lit(False))
    waited = F.coalesce(F.col("start_offset_ms") > conf.queue_timeout_ms, F.lit(False))
    if "gate" in scheduled.columns:
        waited = waited & F.col("gate").isNull()
    return scheduled.filter(~waited), scheduled.filter(waited)
