"""The response index that lives between polls: nodes and jumps as kept tables, brought up to date by the responses that have come.

New responses are grouped by themselves and added to the nodes. A redirect that changes changes the jumps that pass through it, and no
others: those that start there, and those whose first half ends there; they are found level by level and only they are doubled again.
The second kind is found by a semi join of the level's jumps with the changed states, a scan of narrow rows that stay where they are.
What has come is looked up again and again on that way, so responses of more than one URL in ``REMAKE_SHARE`` are folded into the nodes at
once, and all jumps are made anew as in the beginning: one join a level.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from urlaudit.config import GET, HEAD, AuditConfig
from urlaudit.operators.gates import prepared_gates
from urlaudit.operators.resolve import doubled, jumped, levels_for, redirect_edges, response_nodes, state_of
from urlaudit.session import materialize, sized_in_memory, split_for_hotspot
from urlaudit.sources import ledger
from urlaudit.sources.kept import Kept

HOP = StructType(
    [StructField("version", LongType()), StructField("to_url", StringType()), StructField("to_method", StringType()), StructField("steps", IntegerType())]
)
JUMPS = StructType([StructField("state", StringType()), StructField("hop", HOP)])
TO = ["to_url", "to_method", "steps"]
REMAKE_SHARE = 8  # an update of at least one node in so many makes all jumps anew
FEW_SHARE = 8  # a frontier of less than one row for so many nodes is few


def _open(jumps: DataFrame) -> DataFrame:
    """Jumps of a kept table as plain columns; a state that no longer redirects has none."""
    return jumps.select("state", *[F.col("hop")[name].alias(name) for name in TO]).filter("to_url IS NOT NULL")


class KeptIndex:
    """What ``operators.resolve`` takes as ``index``. It holds for the settings and gates it was opened with."""

    def __init__(self, spark: SparkSession, root: str, conf: AuditConfig, mode: str = "compat", buckets: int | None = None, **gates: DataFrame | None):
        self.spark, self.root, self.conf, self.mode, self.buckets, self.gates = spark, root, conf, mode, buckets, gates
        self.levels = [Kept(spark, root, f"jumps_{level}", "state", JUMPS, buckets) for level in range(levels_for(conf.redirect_limit))]

    def _nodes(self, layout: StructType | None = None) -> Kept:
        if layout is None:  # the type of a response's date is that of the first responses
            entry = ledger.last(self.spark, self.root, "index")
            if entry is None:
                raise ValueError(f"no index below {self.root}")
            layout = StructType.fromJson(json.loads(entry.value))
        return Kept(self.spark, self.root, "nodes", "url", layout, self.buckets)

    def exists(self) -> bool:
        return ledger.last(self.spark, self.root, "index") is not None

    def _grouped(self, responses: DataFrame, gates: dict[str, DataFrame | None]) -> DataFrame:
        return response_nodes(responses, conf=self.conf, host_overrides=gates["host_overrides"])

    def _edges(self, nodes: DataFrame, gates: dict[str, DataFrame | None]) -> DataFrame:
        return redirect_edges(nodes, self.conf, self.mode, **gates)

    def build(self, responses: DataFrame) -> KeptIndex:
        """Group all responses and double all jumps, once.

        Each table is written once, from the buckets of the one before: jumps stay where they begin, and only where they end is shuffled."""
        with sized_in_memory(*(sessions := {self.spark, responses.sparkSession})), split_for_hotspot(*sessions):
            gates = prepared_gates(**self.gates)
            grouped = self._grouped(responses, gates)
            nodes = self._nodes(grouped.schema)
            urls = responses.agg(F.approx_count_distinct("url")).head()[0]
            nodes.seed(grouped, urls)
            self._write_jumps(nodes, gates, 0, Kept.seed)
            ledger.commit(self.spark, self.root, "index", 0, grouped.schema.json())
        return self

    def _write_jumps(self, nodes: Kept, gates: dict[str, DataFrame | None], version: int, write: Callable[[Kept, DataFrame, int], None]) -> None:
        """The jumps of all levels, from the base of the nodes."""
        if not self.levels:
            return
        jumps = materialize(self._edges(nodes.base(), gates), "jumps")
        number = jumps.count()
        for kept in self.levels:
            write(kept, jumps.select("state", F.struct(F.lit(version).cast("long").alias("version"), *TO).alias("hop")), number)
            jumps = doubled(_open(kept.base()), _open(kept.base()))

    def is_few(self, rows: int) -> bool:
        """Whether a frontier of so many rows is far smaller than the index, so that looking its keys up first is less work."""
        return rows * FEW_SHARE < self._nodes().base().count()

    def update(self, responses: DataFrame) -> int:
        """Fold in responses that have come since; returns how many states redirect otherwise than before.

        Only they are grouped. An update that was broken off is done again with the next: what it added stays in its place or is replaced."""
        if not self.exists():
            self.build(responses)
            return 0
        with sized_in_memory(*(sessions := {self.spark, responses.sparkSession})), split_for_hotspot(*sessions):
            return self._update(responses)

    def _update(self, responses: DataFrame) -> int:
        entry = ledger.last(self.spark, self.root, "index")
        version, nodes, gates = entry.number + 1, self._nodes(), prepared_gates(**self.gates)
        fresh = materialize(self._grouped(responses, gates).select(*nodes.layout.fieldNames()), "fresh")
        nodes.add(fresh, str(version))
        # What a broken-off attempt has made anew in part is made anew as a whole, also by a smaller update.
        if ledger.is_committed(self.spark, self.root, "remade", version) or fresh.count() * REMAKE_SHARE >= nodes.base().count():
            ledger.commit(self.spark, self.root, "remade", version)
            changed = self._remake(nodes, gates, version)
            ledger.commit(self.spark, self.root, "index", version, entry.value)
            return changed
        changed = 0
        if self.levels:
            now = self._edges(nodes.lookup(fresh.select("url")), gates)
            states = fresh.select(F.explode(F.array(*[state_of(F.lit(m), F.col("url")) for m in (HEAD, GET)])).alias("state"))
            moved = self._changed(0, states, now, version)
            changed = moved.count()
            for level in range(1, len(self.levels)):
                if moved.isEmpty():
                    break
                below = self.levels[level - 1]
                through = _open(below.read()).withColumn("to_state", state_of("to_method", "to_url"))
                through = through.join(moved.select(F.col("state").alias("to_state")), "to_state", "left_semi")
                states = materialize(moved.unionByName(through.select("state")).distinct(), "states")
                half = materialize(_open(below.lookup(states)), "half")
                ends = half.select(state_of("to_method", "to_url").alias("state"))
                moved = self._changed(level, states, doubled(half, _open(below.lookup(ends))), version)
        ledger.commit(self.spark, self.root, "index", version, entry.value)
        for kept in (nodes, *self.levels):
            kept.fold_if_long()
        return changed

    def _remake(self, nodes: Kept, gates: dict[str, DataFrame | None], version: int) -> int:
        """Fold the nodes and make all jumps anew; returns how many states redirect otherwise than before."""
        nodes.fold()
        if not self.levels:
            return 0
        before = _open(self.levels[0].read()).select("state", F.struct(*TO).alias("_before"))
        self._write_jumps(nodes, gates, version, Kept.replace)
        both = _open(self.levels[0].base()).select("state", F.struct(*TO).alias("_now")).join(before, "state", "full_outer")
        return both.filter(~F.col("_now").eqNullSafe(F.col("_before"))).count()

    def _changed(self, level: int, states: DataFrame, now: DataFrame, version: int) -> DataFrame:
        """Add what the jumps of the given states are now, where they differ from before; returns these states."""
        kept = self.levels[level]
        before = kept.lookup(states).select("state", F.col("hop").alias("_before"))
        both = states.join(now, "state", "left").join(before, "state", "left")
        differs = F.lit(False)
        for name in TO:
            differs = differs | ~F.col(name).eqNullSafe(F.col("_before")[name])
        rows = both.filter(differs).select("state", F.struct(F.lit(version).cast("long").alias("version"), *TO).alias("hop"))
        rows = materialize(rows, "changed")
        kept.add(rows, str(version))
        return rows.select("state")

    def moved(self, frontier: DataFrame, level: int, few: bool) -> DataFrame:
        kept = self.levels[level]
        if few:
            states = frontier.select(state_of("method", "url").alias("state"))
            return jumped(frontier, _open(kept.lookup(states)))
        # The frontier is shuffled to the buckets; the jumps stay.
        rows = kept.attach(frontier.withColumn("state", state_of("method", "url")))
        there = F.col("hop")["to_url"].isNotNull()
        after = {
            "url": F.when(there, F.col("hop")["to_url"]).otherwise(F.col("url")).alias("url"),
            "method": F.when(there, F.col("hop")["to_method"]).otherwise(F.col("method")).alias("method"),
            "redirect_count": (F.col("redirect_count") + F.when(there, F.col("hop")["steps"]).otherwise(0)).alias("redirect_count"),
        }
        return rows.select(*[after.get(name, F.col(name)) for name in frontier.columns])

    def observed(self, frontier: DataFrame, few: bool) -> DataFrame:
        nodes = self._nodes()
        if few:
            return frontier.join(nodes.lookup(frontier.select("url")), "url", "left")
        return nodes.attach(frontier)
