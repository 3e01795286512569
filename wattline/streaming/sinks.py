"""What a micro-batch is written to, and what happens when that fails.

A sink is a function ``(batch, batch_id)`` for ``foreachBatch``.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.contracts import KEEP, Table
from wattline.operators.conform import check_contract
from wattline.operators.decode import ERROR, split_errors

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


def files_sink(path: str, *, partition_by: Sequence[str] = (), gather: bool = True) -> Sink:
    """Append log: each batch owns ``query_id=…/batch_id=N`` and replaces it, so a replayed batch is written once.

    The query's id stays with its checkpoint. A query with a fresh checkpoint, whose batches count from 0 again, has
    another id, and so never replaces what an earlier one wrote.

    ``gather`` shuffles rows to their directories first, for batches that span many of them; without it every
    task writes its own files. After a stateful stream adaptive execution is off and a hot directory would be one
    task, so pass ``gather=False`` there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/query_id={query_id(batch)}/batch_id={batch_id}"
        rows = gathered(batch, partition_by) if gather else batch
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*partition_by).parquet(target)

    write.path = path
    return write


def query_id(batch: DataFrame) -> str:
    """The persistent id of the streaming query that a micro-batch belongs to; ``none`` outside of one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def outcome_sink(path: str) -> Sink:
    """Good and bad rows of a frame with an ``_error`` column in one pass, under ``outcome=good`` and ``=bad``.

    One write needs neither a second evaluation of the batch nor room to keep it.
    """
    write = files_sink(path, partition_by=["outcome"], gather=False)

    def outcome(batch: DataFrame, batch_id: int) -> None:
        write(batch.withColumn("outcome", F.when(F.col(ERROR).isNull(), "good").otherwise("bad")), batch_id)

    outcome.path = path
    return outcome


def gathered(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one directory brought together so that it gets few files, large ones split over tasks."""
    return rows.hint("rebalance", *partition_by) if partition_by else rows


def external_sink(
    fmt: str, table: Table, *, options: Mapping[str, str] | None = None, null_option: str | None = None
) -> Sink:
    """Append to a keyed store through its Spark data source; ``options`` choose database, table and endpoint.

    ``null_option`` names the connector's switch for leaving stored values under nulls; it is set when the
    table keeps values.
    """
    chosen = dict(options or {})
    if null_option and table.nulls == KEEP:
        chosen[null_option] = "true"

    def write(batch: DataFrame, batch_id: int) -> None:
        check_contract(batch, table)
        stored = batch.select(*[name for name in batch.columns if name in table.types])
        stored.write.format(fmt).mode("append").options(**chosen).save()

    return write


def split_sink(good: Sink, bad: Sink) -> Sink:
    """Rows with an ``_error`` to one sink, the others to another, from one evaluation of the batch.

    The batch is kept on the executors meanwhile, so bound its size at the source; for files see ``outcome_sink``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good_rows, bad_rows = split_errors(batch)
            good(good_rows, batch_id)
            bad(bad_rows, batch_id)
        finally:
            batch.unpersist()

    return write


def guarded(
    write: Sink, *, attempts: int = 1, pause_seconds: float = 1.0, dead_letters: str | None = None
) -> Sink:
    """A sink's failure policy.

    The last failure is raised, so the query stops and a restart replays the batch. With ``dead_letters`` the
    failed batch is instead kept there under its id and the query goes on; a failure that is only logged would
    commit the batch and lose its rows.
    """
    keep = files_sink(dead_letters) if dead_letters else None

    def attempt(batch: DataFrame, batch_id: int) -> None:
        for number in range(1, attempts + 1):
            try:
                return write(batch, batch_id)
            except Exception:
                log.exception("batch %d: attempt %d of %d failed", batch_id, number, attempts)
                if number < attempts:
                    time.sleep(pause_seconds)
                elif keep is None:
                    raise
                else:
                    keep(batch, batch_id)

    attempt.path = getattr(write, "path", None)
    return attempt
