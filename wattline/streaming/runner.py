"""Start many feed queries together, each with its own name and checkpoint."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wattline.streaming.sinks import Sink

# Formats whose output is gone when the query ends, so that a checkpoint would protect nothing.
_VOLATILE = ("console", "memory", "noop")
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Job:
    """A named streaming query: either a ``sink`` for its micro-batches, or a built-in output format.

    ``pool`` is the scheduler pool of its tasks; with ``spark.scheduler.mode=FAIR`` a query with a backlog then
    leaves the others their share of the cores.
    """

    name: str
    rows: DataFrame
    sink: Sink | None = None
    format: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    checkpoint: str | None = None
    pool: str | None = None

    @property
    def durable(self) -> bool:
        return self.sink is not None or self.format not in _VOLATILE


def console(name: str, rows: DataFrame) -> Job:
    """Print every micro-batch in full width."""
    return Job(name, rows, format="console", options={"truncate": "false"})


def stateful_session(spark: SparkSession, partitions: int, *, idle_batches: bool = False) -> SparkSession:
    """A session with the settings that a stream with state fixes for good at its first start.

    State is split into ``partitions``, which the checkpoint keeps for its life, so choose it for the largest cluster
    the query will have. It is kept in RocksDB outside the heap and checkpointed as
    changes; its rows are not counted, which would cost a read per write. Expired state is dropped with the next data:
    right for an inner join. ``idle_batches`` runs a batch for it also when no data comes, for what writes rows when
    state expires: windows, timers, outer joins. The session's time zone is UTC; open the sources and build the query
    on it.
    """
    own = spark.newSession()
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower(),
    }.items():
        own.conf.set(key, value)
    return own


def plan(jobs: Iterable[Job], checkpoint_root: str | None) -> list[tuple[Job, str | None]]:
    """Each job with its checkpoint folder; refuses what would lose or repeat rows.

    Two queries on one folder process only part of what is due, and two queries of one name cannot run.
    """
    jobs = list(jobs)
    planned: list[tuple[Job, str | None]] = []
    for job in jobs:
        if (job.sink is None) == (job.format is None):
            raise ValueError(f"query {job.name}: give a sink or a format")
        folder = job.checkpoint
        if folder is None and checkpoint_root is not None and job.durable:
            folder = f"{checkpoint_root.rstrip('/')}/{job.name}"
        if job.durable and folder is None:
            raise ValueError(f"query {job.name}: a durable sink needs a checkpoint folder")
        planned.append((job, folder))
    names = [job.name for job in jobs]
    folders = [folder.rstrip("/") for _, folder in planned if folder]
    if len(set(names)) < len(names):
        raise ValueError("two queries share a name")
    if len(set(folders)) < len(folders):
        raise ValueError("two queries share a checkpoint folder")
    outputs = [path.rstrip("/") for job in jobs if (path := getattr(job.sink, "path", None))]
    if len(set(outputs)) < len(outputs):
        raise ValueError("two queries share an output folder")
    return planned


def start(
    spark: SparkSession, jobs: Iterable[Job], checkpoint_root: str | None = None, *, trigger: Mapping | None = None
) -> list[StreamingQuery]:
    """Start every job, or none: if one cannot start, those already started are stopped."""
    running: list[StreamingQuery] = []
    try:
        for job, folder in plan(jobs, checkpoint_root):
            writer = job.rows.writeStream.outputMode("append").queryName(job.name).options(**job.options)
            if folder:
                writer = writer.option("checkpointLocation", folder)
            if trigger:
                writer = writer.trigger(**trigger)
            writer = writer.foreachBatch(job.sink) if job.sink else writer.format(job.format)
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.pool)
            running.append(writer.start())
    except Exception:
        stop(running)
        raise
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    return running


def run_available(spark: SparkSession, jobs: Iterable[Job], checkpoint_root: str | None = None) -> None:
    """Process what the sources hold now, all jobs at once, and return; raises if any query failed."""
    running = start(spark, jobs, checkpoint_root, trigger={"availableNow": True})
    try:
        waiting = running
        while waiting:  # awaitTermination raises the error of a query that failed
            waiting = [query for query in waiting if not query.awaitTermination(1)]
    finally:
        stop(running)


def run_until_stopped(
    spark: SparkSession, jobs: Iterable[Job], checkpoint_root: str, *, trigger: Mapping | None = None
) -> None:
    """Run until one of these queries ends, then stop the others; raises if it ended with an error.

    Other queries of the session neither end the run nor lose their records of how they ended.
    """
    running = start(spark, jobs, checkpoint_root, trigger=trigger)
    try:
        while not any(query.awaitTermination(1) for query in running):  # raises the error of a failed query
            pass
    finally:
        stop(running)


def stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
