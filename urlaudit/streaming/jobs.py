"""Streams: record checks, keep the latest, keep URLs in flight apart, route attempts, poll."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from urlaudit.config import UNDETERMINED, AuditConfig
from urlaudit.functions import classify
from urlaudit.operators import reports
from urlaudit.operators import resolve as resolving
from urlaudit.operators.selection import seed_frontier
from urlaudit.operators.status import build_status
from urlaudit.session import materialize, scratch_tables, sized_in_memory
from urlaudit.sources import ledger, sinks
from urlaudit.sources.index import KeptIndex
from urlaudit.sources.kept import Kept
from urlaudit.streaming import state


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def stream_table(
    spark: SparkSession, path: str, layout: StructType, files_per_trigger: int = 1000, glob: str | None = None
) -> DataFrame:
    """New parquet files below ``path``; ``glob`` picks one table in a folder of many."""
    reader = spark.readStream.schema(layout).option("maxFilesPerTrigger", files_per_trigger)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what is there, in as many batches as the source cuts it into, and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name for the output of a batch: a repeated batch has the same, a batch of another checkpoint another."""
    return f"{ledger.stream_key(batch) or 'batch'}-{batch_id}"


def record_checks(checks: DataFrame, root: str) -> DataStreamWriter:
    """Add each batch of status rows to the status below ``root``.

    A batch that is repeated takes the place of what its first attempt wrote, and checks that come again under a new checkpoint are
    there already, so each is stored once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_tables(batch.sparkSession):
            sinks.write_status(batch, root, batch_name(batch, batch_id))

    return checks.writeStream.foreachBatch(write)


def keep_latest(checks: DataFrame, root: str, n: int = 100, seq: str | None = None) -> DataStreamWriter:
    """The newest ``n`` checks so far, brought up to date by each batch; start it with a 10-second trigger.

    The snapshot in use stands in the ledger, so a restart, a repeated batch and a new checkpoint go on from it."""
    return checks.writeStream.foreachBatch(lambda batch, _: sinks.keep_latest(batch, root, n, seq))


def drop_repeated_polls(polled: DataFrame, late: str = "1 hour") -> DataFrame:
    """Pass a URL (``name``, ``at``, ``seq``) once an hour: release by time only."""
    return emit_not_in_flight(polled.withColumn("kind", F.lit("select")), late)


def emit_not_in_flight(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Selections of URLs that are not in flight, released by ``done`` or an hour after emission.

    ``events`` has ``name``, ``kind`` (``select`` or ``done``), ``at`` and a unique ``seq``; events more than ``late`` behind the newest
    are dropped. The state of a URL ends by a timer once the watermark has passed its release."""
    state.use_typed_state(events.sparkSession)
    timed = events.withWatermark("at", late).withColumn("at_us", F.unix_micros("at"))
    return timed.groupBy("name").transformWithState(state.InFlight(), state.EMITTED, "append", "EventTime")


def in_flight_now(emitted: DataFrame, done: DataFrame, now: Any) -> DataFrame:
    """Names in flight at a time, for a poll to leave out: emitted within the hour, and not ``done`` (``name``, ``at``) since."""
    moment = F.lit(str(now)).cast("timestamp")
    recent = emitted.where((F.col("at") > moment - F.expr("INTERVAL 1 HOUR")) & (F.col("at") <= moment))
    last = recent.groupBy("name").agg(F.max("at").alias("at"))
    ended = done.where(F.col("at") <= moment).groupBy("name").agg(F.max("at").alias("_done"))
    return last.join(ended, "name", "left").where(F.col("_done").isNull() | (F.col("_done") < F.col("at"))).select("name")


def route_observations(observations: DataFrame, conf: AuditConfig, mode: str = "compat", late: str = "1 hour") -> DataFrame:
    """Route each observation of a URL by the attempt it answers, carried as state between them.

    An attempt without an observation for an hour is given up by a timer: by the observations' time ``at``, or, where they have none, by
    the time of their batch.
    ``observations`` has ``url_id``, ``seq``, ``url``, ``status_code``, ``location`` and ``exception_class``, and may have
    ``cause_class``, ``exception_message`` and ``original_url``. What an observation says by itself is computed here as columns, also
    the category and message it ends with.
    """
    # A large file may be read by one task; what is computed of its rows is spread first.
    observations = observations.repartition("url_id")
    given = lambda name, other: F.col(name) if name in observations.columns else other
    nothing = F.lit(None).cast("string")
    answered = F.col("exception_class").isNull()
    redirects = F.coalesce(answered & F.col("status_code").isin(*conf.redirect_codes), F.lit(False))
    target = F.when(redirects, resolving.urls.resolve_location(F.col("url"), F.col("location"), mode))
    fault = F.when(redirects & target.isNull(), resolving.urls.location_error(F.col("url"), F.col("location")))
    raised = F.coalesce("exception_class", fault["class"])
    text = F.coalesce(given("exception_message", nothing), fault["message"])
    by_code = classify.category_of_status(F.col("status_code"), conf)
    ok = F.coalesce(answered & F.col("status_code").isin(*conf.ok_codes), F.lit(False))
    kind = redirects.cast("int") * state.REDIRECT + F.coalesce(target.isNotNull(), F.lit(False)).cast("int") * state.TARGET + ok.cast("int") * state.OK
    message = F.coalesce(
        F.when(raised.isNotNull(), classify.message_of_exception(raised, given("cause_class", nothing), text)),
        classify.message_of_status(by_code, F.col("status_code")),
    )
    facts = F.struct(
        F.col("url").cast("string").alias("url"),
        target.alias("target"),
        F.coalesce(classify.category_of_exception(raised, conf.broken_exceptions), by_code).alias("category"),
        message.alias("message"),
        classify.message_of_limit(given("original_url", F.col("url")), conf).alias("over"),
    )
    seen = observations.select(
        "url_id",
        "seq",
        given("at", F.current_timestamp()).alias("at"),
        F.concat(kind.cast("string"), F.to_json(facts)).alias("facts"),
    )
    state.use_typed_state(observations.sparkSession)
    steps = seen.withWatermark("at", late).groupBy("url_id").transformWithState(state.Attempt(conf.redirect_limit), state.STEPS, "append", "EventTime")
    each = steps.select("url_id", F.inline(F.arrays_zip("seq", "method", "redirect_count", "route", "facts")))
    each = each.withColumn("facts", F.from_json(F.substr("facts", F.lit(2)), "url string, target string, category string, message string, over string"))
    over, ends = F.col("route") == state.OVER, F.col("route").isin(state.OVER, "status")
    return each.select(
        "url_id",
        "seq",
        F.col("facts.url").alias("url"),
        "method",
        "redirect_count",
        F.when(ends, F.lit("status")).otherwise(F.col("route")).alias("route"),
        F.when(F.col("route") == "follow", F.col("facts.target")).when(F.col("route") == "retry_get", F.col("facts.url")).alias("next_url"),
        F.when(over, F.lit(UNDETERMINED)).when(ends, F.col("facts.category")).alias("category"),
        F.when(over, F.col("facts.over")).when(ends, F.col("facts.message")).alias("message"),
    )


def count_throughput(checks: DataFrame, at: str = "at", late: str = "10 minutes") -> DataFrame:
    """Checks per minute; the count of a minute grows until the watermark has passed it."""
    counted = checks.withWatermark(at, late).groupBy(F.window(at, "1 minute")).agg(F.count("*").alias("checks"))
    return counted.select(F.col("window.start").alias("minute"), "checks")


def record_throughput(counted: DataFrame, root: str) -> DataStreamWriter:
    """Write the minutes whose count has grown, batch by batch, also those the watermark has not passed when a run ends.

    A checkpoint counts what it has read itself; its batches lie below its own name."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/run={ledger.stream_key(batch) or 'batch'}/batch={batch_id}")

    return counted.writeStream.outputMode("update").foreachBatch(write)


def read_throughput(spark: SparkSession, root: str) -> DataFrame:
    """The count of every minute so far: of each checkpoint the greatest one written, because counts only grow, and these added up."""
    layout = "minute TIMESTAMP, checks LONG, run STRING, batch LONG"
    each = spark.read.schema(layout).parquet(root).groupBy("run", "minute").agg(F.max("checks").alias("checks"))
    return each.groupBy("minute").agg(F.sum("checks").alias("checks"))


def mark_checks(checks: DataFrame, root: str, every: int = 100, at: str = "checking_date", tie: str = "check_id") -> DataStreamWriter:
    """Every ``every``-th check of the stream: the running number of checks is carried from batch to batch in the ledger.

    Checks of a batch are numbered by date, batches in the order they come. The entry of a batch is written after its marks and names the
    batch, so a repeated batch begins where it began before; a new checkpoint counts on."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch, batch_id)
        entry = ledger.last(spark, root, "marks")
        done = {} if entry is None else json.loads(entry.value)
        if done.get("name") == name:
            return
        before = done.get("checks", 0)
        with scratch_tables(spark):
            rows = materialize(batch.select(at, tie), "checks")
            reports.marks(rows, every, at, tie, before).write.mode("overwrite").parquet(f"{root}/marks/batch={name}")
            after = {"name": name, "checks": before + rows.count()}
        ledger.commit(spark, root, "marks", 0 if entry is None else entry.number + 1, json.dumps(after))

    return checks.writeStream.foreachBatch(write)


def read_marks(spark: SparkSession, root: str, at: str = "checking_date") -> DataFrame:
    """The marks of all batches with the time since the mark before."""
    return reports.elapsed_between(spark.read.schema(f"mark LONG, {at} TIMESTAMP_NTZ").parquet(f"{root}/marks/*"), at)


def resolve_selected(
    selected: DataFrame,
    load: Callable[[], dict[str, Any]],
    conf: AuditConfig,
    root: str,
    checked_at: Callable[[int], Any] | None = None,
    **options: Any,
) -> DataStreamWriter:
    """Resolve and record each batch of selected URLs; the feedback of redirects stays in the batch.

    ``load`` returns whatever ``resolve`` takes as a table (``login_pages``, ``robots_rules``, ...) and an ``index``, or ``responses``
    that are grouped anew for each batch. It is called for each batch, so what has come since is seen; what need not be read so often it
    can hold in a ``Refreshed``. URLs whose answer has not been observed wait in the table of ``pending`` attempts.
    ``checked_at`` gives the date of a batch's checks, by default the time the batch begins."""

    def write(batch: DataFrame, batch_id: int) -> None:
        at = checked_at(batch_id) if checked_at else now_utc()
        with scratch_tables(batch.sparkSession), sized_in_memory(batch.sparkSession):
            frontier = seed_frontier(materialize(batch, "selected"))
            tables = {"responses": None, **load()}
            _settle(frontier, tables, conf, root, at, batch_name(batch, batch_id), options)

    return selected.writeStream.foreachBatch(write)


def pending_attempts(spark: SparkSession, root: str) -> Kept:
    """Attempts that wait for their response, by URL: the state that attempts carry between observations."""
    fields = [StructField("version", LongType()), *[StructField(name, kind) for name, kind in ATTEMPT.items()]]
    return Kept(spark, root, "pending", "url_id", StructType([StructField("url_id", LongType()), StructField("attempt", StructType(fields))]))


ATTEMPT = {"original_url": StringType(), "url": StringType(), "method": StringType(), "redirect_count": IntegerType()}


def read_pending(spark: SparkSession, root: str) -> DataFrame:
    """The frontier of the waiting attempts."""
    kept = pending_attempts(spark, root)
    if not kept.exists():
        return spark.createDataFrame([], StructType([StructField("url_id", LongType()), *[StructField(n, k) for n, k in ATTEMPT.items()]]))
    return kept.read().select("url_id", *[F.col("attempt")[name].alias(name) for name in ATTEMPT]).where("url IS NOT NULL")


def _settle(frontier: DataFrame, tables: dict, conf: AuditConfig, root: str, at: Any, name: str, options: dict) -> None:
    """Resolve a frontier; record what is final, and keep what still waits, or waits no longer, as pending."""
    spark = frontier.sparkSession
    outcomes = resolving.resolve(frontier, conf=conf, **tables, **options)
    final, waiting = resolving.split_outcomes(outcomes)
    sinks.write_status(build_status(final, at), root, name)
    kept = pending_attempts(spark, root)
    if not kept.exists():
        kept.seed(spark.createDataFrame([], kept.layout))
    version = F.lit(ledger.next_number(spark, root, "attempts")).cast("long").alias("version")
    nothing = [F.lit(None).cast(kind).alias(field) for field, kind in ATTEMPT.items()]
    rows = waiting.select("url_id", F.struct(version, *[F.col(field).cast(kind).alias(field) for field, kind in ATTEMPT.items()]).alias("attempt"))
    # Only an attempt that has waited needs a row to say that it waits no longer. A second attempt at a batch finds what the first has
    # left, so the rows are written before they take its place.
    ended = final.join(kept.read().select("url_id"), "url_id", "left_semi")
    rows = rows.unionByName(ended.select("url_id", F.struct(version, *nothing).alias("attempt")))
    kept.add(materialize(rows, "attempts"), name)
    kept.fold_if_long()
    ledger.commit(spark, root, "attempts", ledger.next_number(spark, root, "attempts"), name)


def resolve_on_arrival(
    responses: DataFrame,
    index: KeptIndex,
    conf: AuditConfig,
    root: str,
    load: Callable[[], dict[str, Any]] = dict,
    checked_at: Callable[[int], Any] | None = None,
    **options: Any,
) -> DataStreamWriter:
    """Fold each batch of responses into the index, and take up the attempts that have waited for one of them where they stood."""

    def write(batch: DataFrame, batch_id: int) -> None:
        at = checked_at(batch_id) if checked_at else now_utc()
        with scratch_tables(batch.sparkSession), sized_in_memory(batch.sparkSession):
            come = materialize(batch, "responses")
            index.update(come)
            frontier = read_pending(batch.sparkSession, root).join(come.select("url").distinct(), "url", "left_semi")
            frontier = materialize(frontier.select(*resolving.FRONTIER), "waiting")
            if rows := frontier.count():
                tables = {"responses": None, "index": index, **load()}
                _settle(frontier, tables, conf, root, at, batch_name(batch, batch_id), {"few": index.is_few(rows), **options})

    return responses.writeStream.foreachBatch(write)


class Refreshed:
    """A value loaded again once it is older than ``seconds``: login pages, a daily report."""

    def __init__(self, load: Callable[[], Any], seconds: float = 86_400, clock: Callable[[], float] = time.time):
        self._load, self._seconds, self._clock = load, seconds, clock
        self._value: Any = None
        self._loaded_at: float | None = None

    def get(self) -> Any:
        now = self._clock()
        if self._loaded_at is None or now - self._loaded_at >= self._seconds:
            self._value, self._loaded_at = self._load(), now
        return self._value


def on_ticks(ticks: DataFrame, poll: Callable[[int], Any]) -> DataStreamWriter:
    """Call ``poll(batch_id)`` for every batch of any stream of ticks."""
    return ticks.writeStream.foreachBatch(lambda _, batch_id: poll(batch_id))


def start_polling(
    spark: SparkSession, poll: Callable[[int], Any], checkpoint: str, every: str = "1 minute"
) -> StreamingQuery:
    """Call ``poll(batch_id)`` every interval; it re-reads the register, so each poll sees its changes, and says itself whether a poll
    is due between the least and the greatest interval (``plans.cycle.audit_poll``)."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return on_ticks(ticks, poll).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
