"""An audit table of what each micro-batch of a query observed on its way to the sink."""

from __future__ import annotations

import json
import logging
import threading
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from wattline.streaming.storage import exists, write_whole

log = logging.getLogger(__name__)

SCHEMA = "query string, query_id string, run_id string, batch_id bigint, observation string, rows bigint, errors bigint, good bigint"


class AuditLog(StreamingQueryListener):
    """Stores the counts that ``audit.observed`` adds to a stream, one small JSON file per batch and observation.

    Files are named by query, batch and observation, so a batch that is replayed after a failure counts once: the log
    says what the sink then holds. Use it as a context around the run; ``settle`` waits for the listener's last calls.
    A batch without data writes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, observations: Iterable[str]):
        self._spark, self._path, self._wanted = spark, path, set(observations)
        self._ended, self._started, self._lock = 0, 0, threading.Lock()
        self._failed: Exception | None = None

    def __enter__(self) -> AuditLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._started += 1

    def onQueryProgress(self, event) -> None:
        try:
            self._store(event.progress)
        except Exception as error:  # a listener's error would only be logged by Spark
            log.exception("audit log %s", self._path)
            self._failed = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended += 1

    def settle(self, seconds: float = 60) -> None:
        """Wait until all queries that started have reported their end; raises if counts could not be stored."""
        until = time.monotonic() + seconds
        while time.monotonic() < until and (self._started == 0 or self._ended < self._started):
            time.sleep(0.05)
        if self._failed:
            raise self._failed

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per batch and observation."""
        if not exists(spark, self._path):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).json(self._path)

    def _store(self, progress) -> None:
        for name, counts in progress.observedMetrics.items():
            if name not in self._wanted or not progress.numInputRows:
                continue
            row = {
                "query": progress.name,
                "query_id": str(progress.id),
                "run_id": str(progress.runId),
                "batch_id": progress.batchId,
                "observation": name,
                **counts.asDict(),
            }
            file = f"{self._path}/{progress.id}-{progress.batchId:012d}-{name}.json"
            if not exists(self._spark, file):
                write_whole(self._spark, file, json.dumps(row))
