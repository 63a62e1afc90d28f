"""Registered queries: each callable takes a session and a table folder and reads whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit import schema
from urlaudit.config import AuditConfig
from urlaudit.functions import classify, records, urls
from urlaudit.operators import gates, politeness, reports, resolve, selection, status
from urlaudit.plans import cycle
from urlaudit.session import materialize, scratch_path, scratch_root
from urlaudit.sources import projections as tables
from urlaudit.sources import readers, sinks
from urlaudit.sources.index import KeptIndex
from urlaudit.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CONF, DELAY_CONF = tables.CONF, tables.DELAY_CONF


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _register(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tables.url(spark, sf_dir), tables.status(spark, sf_dir), tables.url_context(spark, sf_dir)


# Selection


@query
def due_urls(spark, sf_dir):
    due = selection.due_urls(*_register(spark, sf_dir), tables.AS_OF)
    return due.select("id", "name", "group_key", "priority", "order_nr")


@query
def due_handles(spark, sf_dir):
    due = selection.due_handles(*_register(spark, sf_dir), tables.AS_OF)
    return due.select("id", "name", F.col("rank_group").alias("handle_prefix"), "priority", "order_nr")


@query
def due_all(spark, sf_dir):
    return selection.due_all(*_register(spark, sf_dir), tables.AS_OF).select("id", "name", "group_key")


@query
def due_candidates(spark, sf_dir):
    found = selection.due_candidates(*_register(spark, sf_dir), tables.AS_OF)
    return found.groupBy("group_key").agg(F.count("*").alias("due"), F.count("checking_date").alias("rechecked"))


@query
def unchecked_count(spark, sf_dir):
    return selection.count_unchecked(*_register(spark, sf_dir))


@query
def never_checked(spark, sf_dir):
    return selection.never_checked(*_register(spark, sf_dir)).select("id", "name")


#: A selection as an operator may write it: known dates beside the valid URLs that some active context uses.
SELECT_SQL = """
    SELECT reg.id, reg.name, done.checking_date FROM {register} AS reg
    LEFT OUTER JOIN {last_checks} AS done ON reg.id = done.url_id
    WHERE EXISTS (SELECT 1 FROM {contexts} AS used WHERE used.url_id = reg.id AND used.active)
      AND reg.priority >= :least AND reg.valid
"""


@query
def select_sql_source(spark, sf_dir):
    url, last, context = _register(spark, sf_dir)
    return selection.select_sql(spark, SELECT_SQL, {"least": 4}, register=url, last_checks=last, contexts=context)


@query
def in_flight_excluded(spark, sf_dir):
    due = selection.due_all(*_register(spark, sf_dir), tables.AS_OF)
    return selection.exclude_in_flight(due, tables.in_flight(spark, sf_dir)).select("id", "name")


@query
def seed_frontier(spark, sf_dir):
    return selection.seed_frontier(tables.url(spark, sf_dir).filter("valid"))


@query
def malformed_split(spark, sf_dir):
    good, bad = selection.split_malformed(tables.odd_urls(spark, sf_dir))
    kinds = good.withColumn("kind", F.lit("well-formed")).unionByName(bad.withColumn("kind", F.lit("malformed")))
    return kinds.select("url_id", "url", "kind")


# URLs and classification


@query
def queue_keys(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages").select("url").unionByName(tables.odd_urls(spark, sf_dir).select("url"))
    key = urls.queue_key(F.col("url"))
    return gates.with_queue_key(selection.drop_blank(pages), CONF).groupBy("queue_key").agg(
        F.count("*").alias("urls"), F.count_if(key == F.lower(urls.host(F.col("url")))).alias("with_host")
    )


@query
def queue_keys_by_domain(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages").select("url").unionByName(tables.odd_urls(spark, sf_dir).select("url"))
    conf = AuditConfig(queue_mode="byDomain")
    keyed = gates.with_queue_key(selection.drop_blank(pages), conf, public_suffixes=tables.public_suffixes(spark))
    return keyed.groupBy("queue_key").agg(F.count("*").alias("urls"))


@query
def queue_keys_by_ip(spark, sf_dir):
    register = tables.url(spark, sf_dir).select(F.col("name").alias("url"), "group_key")
    conf = AuditConfig(queue_mode="byIP")
    keyed = gates.with_queue_key(register, conf, host_ip=tables.host_ip(spark, sf_dir))
    return keyed.groupBy("queue_key").agg(F.count("*").alias("urls"))


@query
def queue_keys_given(spark, sf_dir):
    register = tables.url(spark, sf_dir).selectExpr(
        "name AS url", "CASE id % 3 WHEN 0 THEN upper(group_key) WHEN 1 THEN ' ' END AS key"
    )
    return gates.with_queue_key(register, CONF, given="key").groupBy("queue_key").agg(F.count("*").alias("urls"))


@query
def handle_prefixes(spark, sf_dir):
    prefix = urls.handle_prefix(F.col("name")).alias("prefix")
    return tables.url(spark, sf_dir).groupBy(prefix).agg(F.count("*").alias("urls"))


@query
def corrected_urls(spark, sf_dir):
    return tables.odd_urls(spark, sf_dir).select("url_id", urls.correct_url(F.col("url")).alias("requested"))


@query
def resolve_locations(spark, sf_dir):
    target = urls.resolve_location(F.col("url"), F.col("location"))
    return tables.page_links(spark, sf_dir).select("page_id", "nr", "url", "location", target.alias("target"))


@query
def resolve_locations_rfc3986(spark, sf_dir):
    target = urls.resolve_location(F.col("url"), F.col("location"), "rfc3986")
    return tables.page_links(spark, sf_dir).select("page_id", "nr", target.alias("target"))


@query
def categorize(spark, sf_dir):
    seen = tables.responses(spark, sf_dir).filter("status_code IS NOT NULL")
    category = classify.category_of_status(F.col("status_code"), CONF)
    labelled = seen.withColumn("category", category)
    message = classify.message_of_status(F.col("category"), F.col("status_code"))
    return labelled.groupBy("method", "status_code", "category", message.alias("message")).agg(F.count("*").alias("n"))


@query
def exception_categories(spark, sf_dir):
    failed = tables.responses(spark, sf_dir).filter("exception_class IS NOT NULL")
    cls, cause, text = F.col("exception_class"), F.col("cause_class"), F.col("exception_message")
    labelled = failed.select(
        "exception_class",
        classify.category_of_exception(cls).alias("category"),
        classify.message_of_exception(cls, cause, text).alias("message"),
    )
    return labelled.groupBy("exception_class", "category", "message").agg(F.count("*").alias("n"))


# Resolution


def _valid_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.seed_frontier(tables.url(spark, sf_dir).filter("valid"))


def _outcomes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    frontier, responses = _valid_frontier(spark, sf_dir), tables.responses(spark, sf_dir)
    return resolve.resolve(frontier, responses, CONF, login_pages=tables.login_pages(spark), **options)


@query
def route_attempt(spark, sf_dir):
    routed = resolve.route_attempt(_valid_frontier(spark, sf_dir), tables.responses(spark, sf_dir), CONF)
    return routed.select("url_id", "route", "next_url", "next_method", "next_count", "category", "message")


@query
def route_split(spark, sf_dir):
    routed = resolve.route_attempt(_valid_frontier(spark, sf_dir), tables.responses(spark, sf_dir), CONF)
    final, again = resolve.split_routes(routed)
    streams = final.select(F.lit("status").alias("stream"), "method").unionByName(
        again.select(F.lit("redirect").alias("stream"), F.col("next_method").alias("method"))
    )
    return streams.groupBy("stream", "method").agg(F.count("*").alias("n"))


@query
def feedback_frontier(spark, sf_dir):
    routed = resolve.route_attempt(_valid_frontier(spark, sf_dir), tables.responses(spark, sf_dir), CONF)
    return resolve.next_frontier(routed)


@query
def resolved_status(spark, sf_dir):
    return _outcomes(spark, sf_dir).select(*resolve.OUTCOME)


@query
def resolved_status_summary(spark, sf_dir):
    return _outcomes(spark, sf_dir).groupBy("category", "status_code").agg(
        F.count("*").alias("n"), F.min("redirect_count").alias("min_rc"), F.max("redirect_count").alias("max_rc")
    )


def _kept_index(spark: SparkSession, sf_dir: str) -> KeptIndex:
    """The index of a folder's responses, kept as long as the application: the first poll builds it, later ones find it."""
    root = f"{scratch_root(spark)}/urlaudit/{spark.sparkContext.applicationId}/index-{sf_dir.strip('/').replace('/', '-')}"
    index = KeptIndex(spark, root, CONF, login_pages=tables.login_pages(spark))
    return index if index.exists() else index.build(tables.responses(spark, sf_dir))


@query
def resolved_poll(spark, sf_dir):
    """One poll against the kept index of the responses, as a cycle does it."""
    due = selection.due_all(*_register(spark, sf_dir), tables.AS_OF)
    index = _kept_index(spark, sf_dir)
    found = resolve.resolve(selection.seed_frontier(due), None, CONF, login_pages=tables.login_pages(spark), index=index, few=True)
    return found.select("url_id", "url", "method", "redirect_count", "category", "message")


@query
def resolved_with_gates(spark, sf_dir):
    found = resolve.resolve(
        _valid_frontier(spark, sf_dir),
        tables.responses(spark, sf_dir),
        DELAY_CONF,
        robots_rules=tables.robots_rules(spark, sf_dir),
        login_pages=tables.login_pages(spark),
        host_overrides=tables.host_overrides(spark),
    )
    return found.select("url_id", "url", "method", "redirect_count", "category", "message")


@query
def unobserved(spark, sf_dir):
    """The URLs that cannot be decided where a crawl logs no failed GET."""
    seen = tables.responses(spark, sf_dir).filter("method = 'HEAD' OR exception_class IS NULL")
    found = resolve.resolve(_valid_frontier(spark, sf_dir), seen, CONF, login_pages=tables.login_pages(spark))
    return resolve.split_outcomes(found)[1].select("url_id", "url", "method", "redirect_count")


@query
def host_timeouts(spark, sf_dir):
    """What becomes of the register where two hosts are given less time than some of their answers took."""
    frontier, responses = _valid_frontier(spark, sf_dir), tables.responses(spark, sf_dir)
    found = resolve.resolve(frontier, responses, CONF, login_pages=tables.login_pages(spark), host_overrides=tables.short_timeouts(spark))
    return found.select("url_id", "url", "method", "redirect_count", "category", "message")


# Gates


@query
def robots_gate(spark, sf_dir):
    checked = gates.with_robots(tables.url(spark, sf_dir), tables.robots_rules(spark, sf_dir), "name")
    return checked.select("id", "robots_allowed", "robots_delay_ms")


@query
def login_gate(spark, sf_dir):
    found = tables.responses(spark, sf_dir).filter("location IS NOT NULL").selectExpr("url AS original_url", "location AS url")
    gated = gates.with_gates(found, CONF, login_pages=tables.login_pages(spark))
    message = gates.message_of_gate(F.col("gate"), F.col("url"), F.col("original_url"))
    return gated.filter("gate = 'login'").select("original_url", message.alias("message"))


@query
def crawl_delay_gate(spark, sf_dir):
    register = tables.url(spark, sf_dir).withColumnsRenamed({"name": "url"}).withColumn("original_url", F.col("url"))
    robots, overrides = tables.robots_rules(spark, sf_dir), tables.host_overrides(spark)
    gated = gates.with_gates(register, DELAY_CONF, robots_rules=robots, host_overrides=overrides)
    category = gates.category_of_gate(F.col("gate"))
    return gated.groupBy("group_key", "gate", category.alias("category")).agg(F.count("*").alias("urls"))


@query
def protocol_gate(spark, sf_dir):
    odd = selection.drop_blank(tables.odd_urls(spark, sf_dir)).withColumn("original_url", F.col("url"))
    gated = gates.with_gates(odd, CONF)
    message = gates.message_of_gate(F.col("gate"), F.col("url"), F.col("original_url"))
    return gated.select("url_id", "gate", gates.category_of_gate(F.col("gate")).alias("category"), message.alias("message"))


# Status


@query
def status_rows(spark, sf_dir):
    return status.build_status(_outcomes(spark, sf_dir), tables.CHECKED_AT)


@query
def status_from_metadata(spark, sf_dir):
    """The same outcomes through the metadata records a stream carries, with the documents' text as messages."""
    docs = tables.table(spark, sf_dir, "documents")
    md = F.create_map(
        *[
            part
            for key, value in {
                "urlId": F.col("doc_id").cast("string"),
                "fetch.category": F.when(F.col("doc_id") % 2 == 0, "Ok").otherwise("Broken"),
                "fetch.message": F.col("text"),
                "fetch.checkingDate": F.concat(F.lit("1999-01-01T00:00:0"), (F.col("doc_id") % 10).cast("string")),
                "fetch.statusCode": F.when(F.col("doc_id") % 4 == 0, "abc").otherwise(F.lit("200")),
                "fetch.contentType": F.concat_ws("/", "lang", "text"),
                "fetch.byteLength": F.when(F.col("doc_id") % 5 == 0, "99999999999999999999").otherwise(
                    F.col("n_chars").cast("string")
                ),
                "fetch.duration": F.when(F.col("doc_id") % 7 == 0, "99999999999").otherwise(F.lit("12")),
                "http.method.head": F.when(F.col("doc_id") % 2 == 0, "TRUE").otherwise(F.lit("false")),
            }.items()
            for part in (F.lit(key), F.array(value))
        ]
    )
    kept = docs.select(F.col("doc_id"), records.persisted(md).alias("metadata"))
    kept = kept.withColumn(
        "metadata",
        F.when(F.col("doc_id") % 3 == 0, records.remove_key(F.col("metadata"), "http.method.head")).otherwise(
            records.set_value(F.col("metadata"), "fetch.redirectCount", (F.col("doc_id") % 6).cast("string"))
        ),
    )
    return status.status_from_metadata(kept, fallback_date=tables.CHECKED_AT)


@query
def metadata_keys(spark, sf_dir):
    """Persisted keys of resolved URLs after response headers were merged under a prefix."""
    md = status.outcome_metadata(_outcomes(spark, sf_dir), tables.CHECKED_AT)
    headers = F.create_map(F.lit("server"), F.array(F.lit("x")), F.lit("urlId"), F.array(F.lit("y")))
    merged = records.merge_prefixed(F.col("metadata"), headers, "header.")
    both = md.select(merged.alias("merged"))
    # Both maps are built once for a record and only a flag goes with a key, not the persisted map.
    flags = F.map_zip_with("merged", records.persisted(F.col("merged")), lambda _, __, kept: kept.isNotNull())
    keys = both.select(F.explode(flags).alias("key", "kept"))
    return keys.groupBy("key").agg(F.count("*").alias("n"), F.count_if("kept").alias("persisted"))


@query
def unknown_urls(spark, sf_dir):
    """Checks of the log whose URL is not registered as valid."""
    log = tables.check_records(tables.checks(spark, sf_dir))
    valid = tables.url(spark, sf_dir).filter("valid")
    return status.with_known(log, valid).groupBy("url_id", "known").agg(F.count("*").alias("checks"))


@query
def status_upsert(spark, sf_dir):
    log = tables.check_records(tables.checks(spark, sf_dir))
    applied = status.apply_checks(tables.full_status(spark, sf_dir), log)
    return applied.select("url_id", "category", "checking_date", "status_code", "duration", "redirect_count", "is_current")


@query
def latest_status(spark, sf_dir):
    return status.latest_status(tables.checks(spark, sf_dir), "check_id").select("url_id", "check_id", "checking_date", "category")


@query
def history_rows(spark, sf_dir):
    _, history = status.split_history(tables.checks(spark, sf_dir), "check_id")
    return history.select("url_id", "check_id", "checking_date", "category")


@query
def archive_inactive(spark, sf_dir):
    url, context = tables.url(spark, sf_dir), tables.url_context(spark, sf_dir)
    return status.archive_inactive(url, tables.full_status(spark, sf_dir), context, tables.CHECKED_AT)


@query
def latest_100(spark, sf_dir):
    return reports.latest_n(tables.checks(spark, sf_dir), 100, "check_id").select("check_id", "url_id", "checking_date", "category")


# Politeness


def _paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid register in id order with delays, gates and a planned duration."""
    register = tables.url(spark, sf_dir).filter("valid")
    frontier = register.selectExpr("id AS url_id", "id AS seq", "name AS url", "group_key", "20 + id % 500 AS duration_ms")
    robots, overrides = tables.robots_rules(spark, sf_dir), tables.host_overrides(spark)
    return politeness.with_delay(frontier, DELAY_CONF, robots, overrides, given="group_key")


@query
def effective_delays(spark, sf_dir):
    return _paced(spark, sf_dir).groupBy(
        "queue_key", "queue_slots", "robots_delay_ms", "override_delay_ms", "delay_ms", "effective_timeout_ms"
    ).agg(F.count("*").alias("urls"))


@query
def planned_schedule(spark, sf_dir):
    planned = politeness.plan_schedule(_paced(spark, sf_dir), F.col("duration_ms"))
    return planned.select("url_id", "queue_key", "gate", "delay_ms", "start_offset_ms")


@query
def queue_timeout(spark, sf_dir):
    paced = _paced(spark, sf_dir)
    planned = politeness.plan_schedule(paced, F.col("duration_ms"))
    kept, dropped = resolve.drop_queue_timeouts(planned, DELAY_CONF)
    both = kept.withColumn("dropped", F.lit(False)).unionByName(dropped.withColumn("dropped", F.lit(True)))
    return both.groupBy("queue_key", "dropped").agg(F.count("*").alias("urls"))


@query
def round_robin(spark, sf_dir):
    register = tables.url(spark, sf_dir).selectExpr("id AS seq", "name AS url", "group_key AS queue_key")
    return politeness.interleave(register).select("turn", "queue_key", "seq")


@query
def politeness_audit(spark, sf_dir):
    audited = politeness.audit_gaps(tables.checks(spark, sf_dir), F.lit(60_000))
    return audited.select("check_id", "host", "gap_us", "too_early")


# Reports


@query
def poll_summary(spark, sf_dir):
    due = selection.due_all(*_register(spark, sf_dir), tables.AS_OF)
    return reports.poll_summary(gates.with_queue_key(due, CONF, url="name", given="group_key"))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.url(spark, sf_dir).selectExpr(
        "id AS seq", "name AS url", "group_key AS queue_key", "id % 97 = 0 AS in_progress"
    )


@query
def queue_summary(spark, sf_dir):
    return reports.queue_summary(_snapshot(spark, sf_dir))


@query
def queue_contents(spark, sf_dir):
    return reports.queue_contents(_snapshot(spark, sf_dir)).select("queue_key", "position", "url")


@query
def being_fetched(spark, sf_dir):
    return reports.being_fetched(_snapshot(spark, sf_dir))


@query
def throughput_per_100(spark, sf_dir):
    return reports.throughput(tables.checks(spark, sf_dir))


@query
def poll_times(spark, sf_dir):
    return reports.poll_times(tables.checks(spark, sf_dir), "duration", "host").withColumn("avg_ms", F.round("avg_ms", 6))


# Readers: projections written as files or catalog tables and read back


@query
def read_register(spark, sf_dir):
    path = scratch_path(spark, "register")
    for name, table in zip(("url", "status", "url_context"), (tables.url(spark, sf_dir), tables.full_status(spark, sf_dir), tables.url_context(spark, sf_dir))):
        table.write.parquet(f"{path}/{name}")
    due = selection.due_urls(*readers.read_register(spark, path), tables.AS_OF)
    return due.select("id", "name", "group_key", "priority", "order_nr")


@query
def read_register_catalog(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    schema_name = f"register_{path.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {schema_name} LOCATION '{path}'")
    for name, table in zip(("url", "status", "url_context"), (tables.url(spark, sf_dir), tables.full_status(spark, sf_dir), tables.url_context(spark, sf_dir))):
        table.write.saveAsTable(f"{schema_name}.{name}")
    return selection.never_checked(*readers.read_register(spark, schema_name)).select("id", "name")


@query
def read_login_pages(spark, sf_dir):
    """The targets of redirects as a list of pages, one a line."""
    path = scratch_path(spark, "login-pages")
    tables.responses(spark, sf_dir).filter("location LIKE 'http%'").select("location").write.text(path)
    return readers.read_login_pages(spark, path)


@query
def read_responses(spark, sf_dir):
    """Headers whose names differ in case, some of them twice."""
    path = scratch_path(spark, "responses")
    spelled = "map('Content-Length', '1', 'content-length', headers['content-length'], 'Content-Type', headers['content-type'])"
    tables.responses(spark, sf_dir).withColumn("headers", F.expr(spelled)).write.parquet(path)
    found = readers.read_responses(spark, path)
    return found.select("url", "method", F.col("headers")["content-length"].alias("content_length"), F.size("headers").alias("headers"))


@query
def read_robots_rules(spark, sf_dir):
    rules, overrides = scratch_path(spark, "robots"), scratch_path(spark, "overrides")
    tables.robots_rules(spark, sf_dir).write.parquet(rules)
    tables.host_overrides(spark).write.parquet(overrides)
    register = tables.url(spark, sf_dir).selectExpr("id", "name AS url")
    checked = gates.with_robots(register, readers.read_robots_rules(spark, rules))
    checked = gates.with_overrides(checked, readers.read_host_overrides(spark, overrides), CONF)
    return checked.select("id", "robots_allowed", "robots_delay_ms", "override_delay_ms")


# Streams


def _landed_checks(spark: SparkSession, sf_dir: str, files: int = 4) -> str:
    """The check log as the files a stream would find, in no order of time."""
    path = scratch_path(spark, "landed-checks")
    tables.check_records(tables.checks(spark, sf_dir)).repartition(files, "check_id").write.parquet(path)
    return path


def _check_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_checks(spark, sf_dir)
    return jobs.stream_table(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)


@query
def stream_status(spark, sf_dir):
    root = scratch_path(spark, "stream-status")
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), root)
    jobs.run_available(jobs.record_checks(_check_stream(spark, sf_dir), root), f"{root}-checkpoint")
    current = sinks.read_status(spark, root).withColumn("is_current", F.lit(True))
    both = current.unionByName(sinks.read_history(spark, root).withColumn("is_current", F.lit(False)))
    return both.select("url_id", "category", "checking_date", "duration", "redirect_count", "is_current")


@query
def stream_latest(spark, sf_dir):
    """The latest checks after two starts, the second with a checkpoint of its own and other files."""
    root = scratch_path(spark, "stream-latest")
    checks = tables.check_records(tables.checks(spark, sf_dir))
    for start in (0, 1):
        landed = scratch_path(spark, "landed-checks")
        checks.filter(F.col("check_id") % 2 == start).repartition(2, "check_id").write.parquet(landed)
        stream = jobs.stream_table(spark, landed, checks.schema, files_per_trigger=1)
        jobs.run_available(jobs.keep_latest(stream, root, 100, "check_id"), f"{root}-checkpoint-{start}")
    return sinks.read_latest(spark, root, checks.schema).select("check_id", "url_id", "checking_date", "category")


@query
def stream_marks_per_100(spark, sf_dir):
    """Every 100th check of a log that arrives file by file in the order of time, with the time since the mark before."""
    root, landed = scratch_path(spark, "stream-marks"), scratch_path(spark, "landed-in-order")
    log = tables.checks(spark, sf_dir).select("checking_date", "check_id")
    ranges = materialize(log.repartitionByRange(4, "checking_date", "check_id").withColumn("part", F.spark_partition_id()), "ranges")
    for part in range(4):
        ranges.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(landed)
    stream = jobs.stream_table(spark, landed, log.schema, files_per_trigger=1)
    jobs.run_available(jobs.mark_checks(stream, root), f"{root}-checkpoint")
    return jobs.read_marks(spark, root)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = tables.table(spark, sf_dir, "events").schema
    events = jobs.stream_table(spark, sf_dir, layout, glob="events.parquet")
    return events.withColumn("at", F.col("ts").cast("timestamp"))


def _run_to_parquet(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    jobs.run_available(stream.writeStream.format("parquet").option("path", path), f"{path}-checkpoint")
    return spark.read.schema(stream.schema).parquet(path)


@query
def stream_in_flight(spark, sf_dir):
    """Views, clicks and signups ask for a user's URL, errors and purchases end its check."""
    events = _event_stream(spark, sf_dir).selectExpr(
        "cast(user_id AS string) AS name",
        "CASE WHEN event_type IN ('error', 'purchase') THEN 'done' ELSE 'select' END AS kind",
        "at",
        "event_id AS seq",
    )
    emitted = _run_to_parquet(spark, jobs.emit_not_in_flight(events), "stream-in-flight")
    return emitted.select("name", "seq")


@query
def stream_repeated_polls(spark, sf_dir):
    """Each user's URL once an hour."""
    polled = _event_stream(spark, sf_dir).selectExpr("concat('u', user_id) AS name", "at", "event_id AS seq")
    return _run_to_parquet(spark, jobs.drop_repeated_polls(polled), "stream-polls").select("name", "seq")


@query
def stream_attempts(spark, sf_dir):
    """Each event answers the attempt its user's URL is at."""
    seen = _event_stream(spark, sf_dir).selectExpr(
        "user_id AS url_id",
        "event_id AS seq",
        "at",
        "concat('http://h', user_id, '.example.org/p/', event_id) AS url",
        """CASE event_type WHEN 'view' THEN 200 WHEN 'signup' THEN 404 WHEN 'click' THEN 302
           WHEN 'purchase' THEN 301 END AS status_code""",
        "CASE event_type WHEN 'click' THEN './next' END AS location",
        "CASE event_type WHEN 'error' THEN 'java.net.SocketException' END AS exception_class",
    )
    routed = jobs.route_observations(seen, AuditConfig(redirect_limit=2))
    return _run_to_parquet(spark, routed, "stream-attempts")


@query
def stream_throughput(spark, sf_dir):
    root = scratch_path(spark, "stream-throughput")
    counted = jobs.count_throughput(_event_stream(spark, sf_dir))
    jobs.run_available(jobs.record_throughput(counted, root), f"{root}-checkpoint")
    return jobs.read_throughput(spark, root).select(F.col("minute").cast("timestamp_ntz").alias("minute"), "checks")


def _landed_register(spark: SparkSession, sf_dir: str, files: int | None = 2) -> DataFrame:
    """The valid register as a stream: so many files, each a batch, or one batch of as many files as its size asks for."""
    landed = scratch_path(spark, "landed-register")
    valid = tables.url(spark, sf_dir).filter("valid")
    (valid.repartition(files, "id") if files else valid.repartition("id")).write.parquet(landed)
    return jobs.stream_table(spark, landed, schema.URL, **({"files_per_trigger": 1} if files else {}))


@query
def stream_resolved(spark, sf_dir):
    """The register arriving as a stream, resolved against the kept index and recorded per batch."""
    root = scratch_path(spark, "stream-resolved")
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), root)
    index, pages = _kept_index(spark, sf_dir), jobs.Refreshed(lambda: tables.login_pages(spark))
    writer = jobs.resolve_selected(
        _landed_register(spark, sf_dir),
        lambda: {"index": index, "login_pages": pages.get()},
        CONF,
        root,
        checked_at=lambda _: tables.CHECKED_AT,
    )
    jobs.run_available(writer, f"{root}-checkpoint")
    return sinks.read_status(spark, root)


@query
def stream_late_responses(spark, sf_dir):
    """The register is selected when half of the responses are known. The others arrive as a stream and take up the attempts that
    wait for them, so that every URL ends as if all had been there from the start."""
    root = scratch_path(spark, "stream-late")
    sinks.seed_status(spark.createDataFrame([], schema.STATUS), root)
    pages = tables.login_pages(spark)
    responses = tables.responses(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("url", "method"), F.lit(4)))
    index = KeptIndex(spark, f"{root}/index", CONF, login_pages=pages).build(responses.filter("part < 2").drop("part"))
    selected = _landed_register(spark, sf_dir, files=None)
    tables_of = lambda: {"index": index, "login_pages": pages}
    writer = jobs.resolve_selected(selected, tables_of, CONF, root, checked_at=lambda _: tables.CHECKED_AT)
    jobs.run_available(writer, f"{root}-selected")
    landed = scratch_path(spark, "landed-responses")
    load = lambda: {"login_pages": pages}
    for part in (2, 3):  # each is a batch, of as many files as its size asks for
        responses.filter(F.col("part") == part).drop("part").repartition("url").write.mode("append").parquet(landed)
        stream = jobs.stream_table(spark, landed, schema.RESPONSES)
        writer = jobs.resolve_on_arrival(stream, index, CONF, root, load, checked_at=lambda _: tables.CHECKED_AT)
        jobs.run_available(writer, f"{root}-responses")
    return sinks.read_status(spark, root)


def _polled(spark: SparkSession, sf_dir: str, label: str, starts: tuple[int, ...]) -> str:
    """The folder after a poller has run; each of its starts has so many ticks, two hours apart, and a checkpoint of its own."""
    root = scratch_path(spark, label)
    index, hours = _kept_index(spark, sf_dir), iter(range(0, 24, 2))

    def load() -> cycle.CycleTables:
        begun = sinks.has_status(spark, root)
        return cycle.CycleTables(
            url=tables.url(spark, sf_dir),
            status=sinks.read_status(spark, root) if begun else tables.full_status(spark, sf_dir),
            url_context=tables.url_context(spark, sf_dir),
            responses=None,
            login_pages=tables.login_pages(spark),
            index=index,
        )

    clock = lambda: dt.datetime.fromisoformat(tables.CHECKED_AT) + dt.timedelta(hours=next(hours))
    for start, count in enumerate(starts):
        folder = f"{root}-ticks-{start}"
        for tick in range(count):
            spark.range(tick, tick + 1).coalesce(1).write.mode("append").parquet(folder)
        ticks = jobs.stream_table(spark, folder, spark.range(0).schema, files_per_trigger=1)
        poll = cycle.audit_poll(load, CONF, root, lambda: tables.AS_OF, clock)
        jobs.run_available(jobs.on_ticks(ticks, poll), f"{folder}-checkpoint")
    return root


@query
def stream_cycle(spark, sf_dir):
    """The status after two polls that select, resolve and record."""
    root = _polled(spark, sf_dir, "stream-cycle", (2,))
    return sinks.read_status(spark, root).select("url_id", "category", "checking_date", "status_code", "redirect_count", "method")


@query
def daily_unchecked(spark, sf_dir):
    """The count the poller writes once a day, before it polls; on this day it is started twice."""
    return cycle.read_unchecked(spark, _polled(spark, sf_dir, "daily-unchecked", (1, 1)))
