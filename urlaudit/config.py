"""Settings of an audit. Small, fixed-size lists live here and become literals in the plan, not joins."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from numbers import Number
from typing import Any

OK = "Ok"
BROKEN = "Broken"
UNDETERMINED = "Undetermined"
RESTRICTED = "Restricted_Access"
BLOCKED = "Blocked_By_Robots_txt"
CATEGORIES = (OK, BROKEN, UNDETERMINED, RESTRICTED, BLOCKED)

HEAD = "HEAD"
GET = "GET"

# The group key and per-poll bounds of the two standard selections.
HANDLE_GROUP = "hdl.handle.net"
GROUP_LIMIT, POLL_LIMIT = 100, 3000
PREFIX_LIMIT, HANDLE_POLL_LIMIT = 20, 500

QUEUE_MODES = ("byHost", "byDomain", "byIP")


@dataclass(frozen=True)
class AuditConfig:
    """Delays and timeouts are milliseconds; ``-1`` switches a bound off."""

    ok_codes: tuple[int, ...] = (200, 304)
    redirect_codes: tuple[int, ...] = (301, 302, 303, 307, 308)
    undetermined_codes: tuple[int, ...] = (405, 429)
    restricted_codes: tuple[int, ...] = (401, 403)
    redirect_limit: int = 5
    timeout_ms: int = 5000
    delay_ms: int = 1000
    min_delay_ms: int = 1000
    delay_force: bool = False
    max_crawl_delay_ms: int = -1
    max_crawl_delay_force: bool = False
    queue_mode: str = "byHost"
    threads_per_queue: int = 1
    # (full-match pattern on the queue key, slots), first match wins
    queue_threads: tuple[tuple[str, int], ...] = field(default=())
    queue_timeout_ms: int = -1
    # (host, milliseconds): settings of single hosts, used where no table of them is given
    host_delays: tuple[tuple[str, int], ...] = field(default=())
    host_timeouts: tuple[tuple[str, int], ...] = field(default=())
    # exception classes that count as broken beside the standard ones
    broken_exceptions: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if self.queue_mode not in QUEUE_MODES:
            object.__setattr__(self, "queue_mode", "byHost")
        if self.redirect_limit < 0:
            raise ValueError("redirect_limit must not be negative")
        for pattern, _ in self.queue_threads:
            re.compile(pattern)

    @classmethod
    def from_mapping(cls, conf: Mapping[str, Any]) -> AuditConfig:
        """Build from dotted keys (seconds for delays, as in a crawler configuration file).

        The four status-code lists are required; elements that are not numbers are skipped.
        """

        def codes(key: str) -> tuple[int, ...]:
            value = conf.get(key)
            if not isinstance(value, (list, tuple)):
                raise ValueError(f"{key!r} must be a list of status codes")
            return tuple(int(v) for v in value if isinstance(v, Number) and not isinstance(v, bool))

        def millis(key: str, default: float) -> int:
            return int(float(conf.get(key, default)) * 1000)

        def by_host(key: str, scale: int) -> tuple[tuple[str, int], ...]:
            value = conf.get(key) or {}
            if not isinstance(value, Mapping):
                raise ValueError(f"{key!r} must map hosts to numbers")
            return tuple((str(host), int(float(number) * scale)) for host, number in value.items())

        max_delay = int(conf.get("fetcher.max.crawl.delay", 30))
        timeout = int(conf.get("fetcher.timeout.queue", -1))
        prefix = "fetcher.maxThreads."
        return cls(
            ok_codes=codes("ok.status.codes"),
            redirect_codes=codes("redirect.status.codes"),
            undetermined_codes=codes("undetermined.status.codes"),
            restricted_codes=codes("restricted.access.status.codes"),
            redirect_limit=int(conf.get("http.redirectLimit", 5)),
            timeout_ms=int(conf.get("http.timeout", 5000)),
            delay_ms=millis("fetcher.server.delay", 1.0),
            min_delay_ms=millis("fetcher.server.min.delay", 0.0),
            delay_force=bool(conf.get("fetcher.server.delay.force", False)),
            max_crawl_delay_ms=max_delay * 1000 if max_delay >= 0 else -1,
            max_crawl_delay_force=bool(conf.get("fetcher.max.crawl.delay.force", False)),
            queue_mode=str(conf.get("fetcher.queue.mode", "byHost")),
            threads_per_queue=int(conf.get("fetcher.threads.per.queue", 1)),
            queue_threads=tuple((k[len(prefix):], int(v)) for k, v in conf.items() if k.startswith(prefix)),
            queue_timeout_ms=timeout * 1000 if timeout >= 0 else -1,
            host_delays=by_host("fetcher.server.delay.individual", 1000),
            host_timeouts=by_host("http.timeout.individual", 1),
        )
