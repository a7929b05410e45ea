"""Runs that bring keyed tables up to date: what to fetch, in which order, and what is recorded when.

A table is written before its registry, with the instant taken before the fetch. A run that dies between
the two repeats an upsert, which changes nothing.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.operators.relational import first_per_key, stale_pairs
from tradewinds.sources.control import Instants, instant
from tradewinds.sources.lake import Lake
from tradewinds.sources.planning import by_priority


@dataclass(frozen=True)
class Job:
    """A query by key: its table, the table's key, and ``updates(since)``, whose None is no news."""

    key: str
    table: str
    keys: tuple[str, ...]
    updates: Callable[[datetime | None], DataFrame | None]


@dataclass
class Report:
    written: dict[str, int] = field(default_factory=dict)
    empty: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)
    created: list[str] = field(default_factory=list)
    stopped_early: bool = False


def changed(last_update: str | datetime | None, since: datetime | None) -> bool:
    """Whether there may be news: on a first load, where the last update is unknown, and where it is later."""
    last_update = instant(last_update)
    return since is None or last_update is None or last_update > since


def by_last_update(last_update: Callable[[], datetime | None], whole: Callable[[], DataFrame], recent: Callable[[], DataFrame] | None = None) -> Callable:
    """``updates`` of a service that tells when its data changed: all at first, then what is ``recent``."""

    def updates(since: datetime | None) -> DataFrame | None:
        if since is None:
            return whole()
        return (recent or whole)() if changed(last_update(), since) else None

    return updates


def last_release(released: Mapping[str, str | datetime], periods: Iterable[str] | None = None) -> datetime | None:
    """The last release of any of the periods, or of all; None where it isn't known."""
    held = [instant(released.get(p)) for p in (released if periods is None else periods)]
    return max((h for h in held if h), default=None)


class Once:
    """Calls a function once for each key of its arguments and keeps the answers."""

    def __init__(self, function: Callable):
        self.function, self.held = function, {}

    def __call__(self, *key):
        if key not in self.held:
            self.held[key] = self.function(*key)
        return self.held[key]


def run(jobs: Sequence[Job], lake: Lake, registry: Instants, *, most_seconds: float = 23 * 3600, close: Callable[[], None] = lambda: None, now: Callable[[], datetime] = lambda: datetime.now(UTC), clock: Callable[[], float] = time.monotonic) -> Report:
    """Fetches and writes each job: never done first, then the oldest. One that fails doesn't stop the rest.

    The registry moves on after an empty answer as well, and not after a failure. No job starts beyond
    the deadline.
    """
    report, began, by_key = Report(), clock(), {j.key: j for j in jobs}
    done = {k: w for k in by_key if (w := registry.get(k))}
    try:
        for key in by_priority(sorted(by_key), done):
            if clock() - began >= most_seconds:
                report.stopped_early = True
                break
            job, started = by_key[key], now()
            try:
                news = job.updates(registry.get(key))
                if news is None or news.isEmpty():
                    report.empty.append(key)
                else:
                    if not lake.exists(job.table):
                        report.created.append(job.table)
                    report.written[key] = lake.upsert(job.table, news, job.keys)
                registry.mark(key, started)
            except Exception as error:  # noqa: BLE001 - one job's failure is reported
                logging.getLogger(__name__).exception("job %s failed", key)
                report.errors[key] = f"{type(error).__name__}: {error}"
    finally:
        close()
    return report


def recompute(downloaded: DataFrame, computed: DataFrame, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame], lake: Lake, table: str, primary: Sequence[str], log: str, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> int | None:
    """Recomputes results of stale keys and then records them in the keyed table ``log``; None if none is stale.

    ``downloaded`` has the keys and ``last_download``, ``computed`` the keys and ``last_computed``. The
    stale keys stay a table: ``compute`` joins by them.
    """
    started = now()
    stale = stale_pairs(downloaded, computed, keys)
    if stale.isEmpty():
        return None
    results = compute(stale)
    version = lake.upsert(table, results, primary) if not results.isEmpty() else None
    lake.upsert(log, stale.withColumn("last_computed", F.lit(started)), keys)
    return version


def upsert_batches(lake: Lake, table: str, keys: Sequence[str], order: Sequence) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: of a batch's rows with one key the first in ``order`` goes into the table.

    A batch that is delivered twice leaves the same table.
    """

    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            lake.upsert(table, first_per_key(batch, keys, order), keys)

    return write
