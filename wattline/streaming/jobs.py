"""The standing jobs: every feed into its table, and devices joined with their telemetry."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from wattline import contracts as C
from wattline import feeds
from wattline.contracts import Feed, feed
from wattline.operators.audit import observed
from wattline.operators.conform import conform
from wattline.operators.joins import join_versions, join_versions_within
from wattline.streaming.runner import Job
from wattline.streaming.sinks import Sink, files_sink, guarded, outcome_sink, split_sink
from wattline.streaming.upsert import KeyedTable, LatestLog

# The query names of the standing jobs.
QUERY_NAMES = {
    "device-event": "event",
    "device-telemetry": "telemetry",
    "device": "device",
    "device-measurement": "device_measurement",
    "register-statistic": "register_statistics",
    "device-process": "device_process",
    "device-parameter": "parameters",
    "device-profile-facts": "profile_fact",
}


# Feeds whose state and history keys need more than the table's columns.
_KEYED_FEEDS = {"device-measurement": feeds.MEASUREMENT_POINTS}

SinkFor = Callable[[Feed], Sink]


def keyed_feed(name: str) -> Feed:
    """The feed with the columns that its state and history keys need."""
    return _KEYED_FEEDS.get(name, feed(name))


def keyed_sink(which: Feed, path: str, by: str, *, buckets: int = 64, compact_every: int = 16) -> Sink:
    """A sink into a keyed table under ``path``, with the table's null rule.

    ``by`` is ``table``, ``state`` or ``history``: the table's own key, one row per thing, or every change once. A key
    with a date is merged batch by batch into the partitions of its dates, and a history, whose key has the time of the
    change, into those of its days. Others touch the whole table with every batch, so batches are only appended, and
    every ``compact_every``-th one merges the log into the table; ``LatestLog(path/log, table)`` reads both.
    """
    keys = {"table": which.table.key, "state": which.state_key, "history": which.history_key}
    if by not in keys:
        raise ValueError(f"unknown key {by!r}; known: {', '.join(keys)}")
    key = keys[by]
    order = tuple(dict.fromkeys([which.order, "_partition", "_offset"]))
    stored = (*which.table.columns, *[name for name in key if name not in which.table.columns])
    dates = [name for name in which.table.partition if name in key and which.table.types[name] == "date"]
    times = [name for name in key if which.table.types.get(name) == "timestamp"] if by == "history" else []
    dated = bool(dates or times)
    table = KeyedTable(
        path=path if dated else f"{path}/table",
        columns=stored,
        key=key,
        order=order,
        partition=dates[0] if dates else None,
        day_of=times[-1] if times and not dates else None,
        buckets=buckets,
        nulls=which.table.nulls,
    )
    if dated:
        return _at(table.merge, path)
    log = LatestLog(f"{path}/log", table)
    append = log.append

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        if batch_id % compact_every == compact_every - 1:
            log.compact(batch.sparkSession)

    return _at(write, path)


def _at(write: Sink, path: str) -> Sink:
    def sink(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)

    sink.path = path
    return sink


def feed_jobs(
    messages: Mapping[str, DataFrame],
    sink_for: SinkFor,
    *,
    keyed: bool = False,
    dead_letters: str | None = None,
    outcomes: bool = False,
    strict: bool = True,
    attempts: int = 1,
    keep_failed_batches: bool = False,
    pools: bool = False,
) -> list[Job]:
    """One job per feed name in ``messages``; ``keyed`` reads the columns that state and history keys need.

    With ``dead_letters`` unreadable messages and rows that do not fit their table go to ``<dead_letters>/<query>``
    instead of being written with nulls, and the query's progress counts both; ``strict`` also refuses messages with
    a badly typed field among those used. ``outcomes`` writes both kinds in one pass, under ``outcome=good`` and
    ``=bad`` of the sink's folder, for sinks that are append logs. ``keep_failed_batches`` keeps a batch whose sink
    fails for good under ``dead_letters`` too, and goes on; otherwise the query stops and its restart replays the
    batch. ``pools`` gives each query a scheduler pool of its name.
    """
    if keep_failed_batches and dead_letters is None:
        raise ValueError("failed batches need a dead-letter folder")
    if outcomes and dead_letters is not None:
        raise ValueError("rows go to a dead-letter folder or stay with their outcome, not both")
    jobs = []
    for name, source in messages.items():
        which = keyed_feed(name) if keyed else feed(name)
        query = QUERY_NAMES.get(name, which.table.name)
        sink = sink_for(which)
        rows = feeds.rows(which, source, meta=True)
        if outcomes or dead_letters is not None:
            rows = observed(feeds.checked(which, source, strict=strict), query)
            if outcomes:
                sink = outcome_sink(sink.path)
            else:
                target = getattr(sink, "path", None)
                sink = _at(split_sink(sink, files_sink(f"{dead_letters}/{query}")), target)
        failed = f"{dead_letters}/{query}_failed" if keep_failed_batches else None
        guard = guarded(sink, attempts=attempts, dead_letters=failed)
        jobs.append(Job(query, rows, sink=guard, pool=query if pools else None))
    return jobs


def device_telemetry_job(
    devices: DataFrame,
    telemetry: DataFrame,
    sink: Sink,
    *,
    within: str | None = "30 days",
    lateness: str = "1 day",
    salts: int = 8,
) -> Job:
    """Devices with their telemetry, from two message streams opened on a ``stateful_session``.

    ``salts`` is how many tasks a device's readings are spread over: choose it by the hottest device. ``within=None`` joins without a time bound: every pair, and state that only grows.
    """
    versions, readings = feeds.device_for_join(devices), feeds.telemetry_for_join(telemetry)
    if within is None:
        joined = join_versions(versions, readings, "device", salts=salts)
    else:
        joined = join_versions_within(
            versions,
            readings,
            "device",
            version_time="persisttime",
            reading_time="last_telemetry",
            within=within,
            lateness=lateness,
            salts=salts,
        )
    return Job("device_telemetry", conform(joined, C.DEVICE_TELEMETRY), sink=sink)
