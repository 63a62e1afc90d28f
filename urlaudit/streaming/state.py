"""State of a URL between events, kept by Spark's state store and ended by its timers.

What an event says by itself is computed as columns before; here is only what depends on the event before. Events of one URL and one
trigger are ordered in memory, ``maxFilesPerTrigger`` bounds them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from urlaudit.config import GET, HEAD

HOUR_MS = 3_600_000
#: Fixed value: the state store that keeps typed state and timers.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

EMITTED = "name string, at timestamp, seq long"
#: What is said of the observations of a URL, as lists side by side, so that a URL costs one row however many it has.
STEPS = "url_id long, seq array<long>, method array<string>, redirect_count array<int>, route array<string>, facts array<string>"
CHUNK = 1000  # observations in one such row
#: What an observation is by itself, as far as the attempt depends on it, and the route of a redirect beyond the limit.
REDIRECT, TARGET, OK, OVER = 1, 2, 4, "over"
EPOCH, MILLISECOND = dt.datetime(1970, 1, 1, tzinfo=dt.UTC), dt.timedelta(milliseconds=1)


def use_typed_state(spark: SparkSession) -> None:
    """Streams that are started from now on can keep typed state."""
    spark.conf.set(*STORE)


class InFlight(StatefulProcessor):
    """Passes a selection of a URL that is not in flight. A URL is in flight from there until it is done, or for an hour.

    The state of a URL is the time of the selection that was passed. A timer ends it once the watermark has gone by its hour, whether
    another event comes or not; an event that comes before is told by its own time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.since = handle.getValueState("since", "at_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.since.get()
        since = began = held[0] if held is not None else None
        for event in sorted(rows, key=lambda row: (row.at, row.seq)):
            at = event.at_us / 1000
            if event.kind == "done":
                since = None
            elif since is None or at - since >= HOUR_MS:
                since = at
                yield Row(name=key[0], at=event.at, seq=event.seq)
        if since is None:
            self.since.clear()
        elif since != began:
            self.since.update((int(since),))
            self.handle.registerTimer(max(int(since) + HOUR_MS, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.since.get()
        if held is not None and held[0] + HOUR_MS <= expiredTimerInfo.getExpiryTimeInMs():
            self.since.clear()
        return iter(())

    def close(self) -> None:
        pass


class Attempt(StatefulProcessor):
    """Routes each observation of a URL by the attempt it answers. An attempt is given up by a timer, once the watermark has gone an hour
    beyond the last observation.

    Every column of every row is turned into a Python value by itself, so an observation comes in four: URL, number, time and
    ``facts``, a digit of what it is and then a text that is handed on as it is."""

    def __init__(self, redirect_limit: int):
        self.redirect_limit = redirect_limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.attempt = handle.getValueState("attempt", "method string, redirect_count int, at_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.attempt.get()
        method, count, last = held if held is not None else (HEAD, 0, 0)
        rows = sorted(rows, key=itemgetter(1))
        last = max(last, (max(row[2] for row in rows) - EPOCH) // MILLISECOND)
        for start in range(0, len(rows), CHUNK):
            _, seqs, _, facts = zip(*rows[start : start + CHUNK], strict=True)
            methods, counts, routes = [], [], []
            for fact in facts:
                kind, used = int(fact[0]), method
                if kind & REDIRECT and count + 1 > self.redirect_limit:
                    route, count = OVER, count + 1
                elif kind & TARGET:
                    route, count = "follow", count + 1
                elif method == HEAD and not kind & OK:
                    route, method = "retry_get", GET
                else:
                    route = "status"
                methods.append(used)
                counts.append(count)
                routes.append(route)
                if route in (OVER, "status"):
                    method, count = HEAD, 0
            # Lists, unlike tuples, would be copied value by value.
            yield Row(url_id=key[0], seq=seqs, method=tuple(methods), redirect_count=tuple(counts), route=tuple(routes), facts=facts)
        if (method, count) != (HEAD, 0):
            self.attempt.update((method, count, last))
            self.handle.registerTimer(max(last + HOUR_MS, timerValues.getCurrentWatermarkInMs() + 1))
        elif held is not None:
            self.attempt.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.attempt.get()
        if held is not None and held[2] + HOUR_MS <= expiredTimerInfo.getExpiryTimeInMs():
            self.attempt.clear()
        return iter(())

    def close(self) -> None:
        pass
