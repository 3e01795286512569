"""A keyed Parquet table that micro-batches are merged into, and an append log that is merged into one now and then."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from wattline.contracts import KEEP, OVERWRITE
from wattline.operators.keyed import latest_row, newest_present
from wattline.streaming.sinks import files_sink, gathered, query_id
from wattline.streaming.storage import delete, exists, names

_BUCKET = "_bucket"
_DAY = "_day"
_ORDER = "_order"
_STAMPS = "_stamps"


@dataclass(frozen=True)
class KeyedTable:
    """Latest row per key, stored in partitions that a merge overwrites.

    ``partition`` is a date or text column; it is part of the key, or ``partition_follows_key`` states that each key
    always has the same value there. ``day_of`` instead names a time in the key, whose day is the partition. Without
    either, rows are put in ``buckets`` partitions by key hash. A merge reads and rewrites only the partitions its batch
    touches, so it suits feeds whose batches fall in few of them; for others see ``LatestLog``.

    A merge first writes the touched partitions as they will be into a staging folder beside the table, and then
    overwrites them from there by Spark's dynamic partition overwrite. Cut short before the staging folder is whole, it
    has not happened; after that, the next merge, be it the same batch replayed or another, finishes it first. So no row
    is lost, but a plain Parquet table has no snapshots: one merge at a time, and readers run between merges. Where
    they must run beside them, give the batches to a table format's ``MERGE`` by ``external_sink``.

    Each row keeps the order it was written under, and with ``nulls="keep"`` each cell that is older than its
    row does too. A merge is then the same whatever the batches are and however often one is replayed.
    """

    path: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    order: tuple[str, ...]
    partition: str | None = None
    partition_follows_key: bool = False
    day_of: str | None = None
    buckets: int = 64
    nulls: str = OVERWRITE

    def __post_init__(self) -> None:
        unknown = [name for name in self.key if name not in self.columns]
        if unknown:
            raise ValueError(f"key columns not stored: {', '.join(unknown)}")
        if self.partition and self.day_of:
            raise ValueError("a table is partitioned by a column or by the day of one, not both")
        if self.partition and self.partition not in self.key and not self.partition_follows_key:
            raise ValueError(f"a key could be stored under several values of {self.partition}: put it into the key")
        if self.day_of and self.day_of not in self.key:
            raise ValueError(f"a key could be stored under several days of {self.day_of}: put it into the key")

    @property
    def directory(self) -> str:
        return self.partition or (_DAY if self.day_of else _BUCKET)

    @property
    def values(self) -> list[str]:
        return [name for name in self.columns if name not in self.key]

    @property
    def staged(self) -> str:
        return f"{self.path}_staged"

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one batch; a sink for ``foreachBatch``."""
        spark = batch.sparkSession
        incoming = self._reduced(self._incoming(batch)).persist()
        try:
            self._finish(spark, incoming.schema)
            here = F.col(self.directory)
            seen = incoming.agg(
                F.min(here).alias("low"), F.max(here).alias("high"), F.count_if(here.isNull()).alias("nulls"),
                F.count("*").alias("rows"),
            ).first()
            if not seen.rows:
                return
            merged = incoming
            if exists(spark, self.path):
                within = F.lit(False) if seen.low is None else here.between(F.lit(seen.low), F.lit(seen.high))
                within = within | here.isNull() if seen.nulls else within
                touched = incoming.select(here.alias("_touched")).distinct()
                stored = self._stored(spark, self.path, incoming.schema).where(within)  # prunes by the range
                stored = stored.join(touched, here.eqNullSafe(F.col("_touched")), "left_semi")
                merged = self._reduced(stored.unionByName(incoming))
            target = f"{self.staged}/query_id={query_id(batch)}-batch_id={batch_id}"
            rows = gathered(merged, [self.directory]).write.mode("overwrite")
            rows.option("partitionOverwriteMode", "static").partitionBy(self.directory).parquet(target)
            self._finish(spark, incoming.schema)
        finally:
            incoming.unpersist()

    def read(self, spark: SparkSession, only: tuple | None = None) -> DataFrame:
        """The stored rows; ``only``, the least and greatest partition value, leaves other partitions unread."""
        if not exists(spark, self.path):
            raise ValueError(f"nothing is stored in {self.path}")
        rows = self._stored(spark, self.path)
        if only is not None:
            rows = rows.where(F.col(self.directory).between(F.lit(only[0]), F.lit(only[1])))
        return rows.select(*self.columns)

    def with_rows(self, more: DataFrame) -> DataFrame:
        """The table as it would be with these rows merged, without merging them."""
        spark = more.sparkSession
        rows = incoming = self._incoming(more)
        if exists(spark, self.path):
            rows = self._stored(spark, self.path, incoming.schema).unionByName(incoming)
        return self._reduced(rows).select(*self.columns)

    def _finish(self, spark: SparkSession, schema: StructType) -> None:
        """Overwrite the partitions of a whole staging folder; one that is not whole belongs to a merge that was not."""
        for name in names(spark, self.staged):
            folder = f"{self.staged}/{name}"
            if "_SUCCESS" in names(spark, folder):
                writer = self._stored(spark, folder, schema).write.mode("overwrite").partitionBy(self.directory)
                writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)
            delete(spark, folder)

    def _stored(self, spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
        if schema is not None:
            return spark.read.schema(schema).parquet(path).select(*schema.names)
        rows = spark.read.parquet(path)
        if self.partition and not isinstance(rows.schema[self.partition].dataType, DateType):  # a text, like 007
            types = [StructField(f.name, StringType()) if f.name == self.partition else f for f in rows.schema]
            rows = spark.read.schema(StructType(types)).parquet(path)
        return rows

    def _incoming(self, batch: DataFrame) -> DataFrame:
        rows = batch.select(*self.columns, F.struct(*self.order).alias(_ORDER))
        if self.day_of:
            rows = rows.withColumn(_DAY, F.to_date(self.day_of))
        elif self.partition and isinstance(rows.schema[self.partition].dataType, StringType):
            rows = rows.withColumn(self.partition, F.nullif(F.col(self.partition), F.lit("")))  # one directory for both
        elif not self.partition:
            bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
            rows = rows.withColumn(_BUCKET, bucket)
        if self.nulls == KEEP:
            own = F.lit(None).cast(rows.schema[_ORDER].dataType)
            cells = [own.alias(name) for name in self.values if name != self.partition]
            rows = rows.withColumn(_STAMPS, F.struct(*cells))
        return rows

    def _reduced(self, rows: DataFrame) -> DataFrame:
        by = list(dict.fromkeys([*self.key, self.directory]))
        if self.nulls != KEEP:
            return latest_row(rows, by, [_ORDER])
        values = [name for name in self.values if name not in by]
        cells = [newest_present(F.col(name), self._stamp(name)).alias(name) for name in values]
        merged = rows.groupBy(*by).agg(F.max(_ORDER).alias(_ORDER), *cells)
        stamps = [
            F.when(F.col(f"{name}.rank") != F.col(_ORDER), F.col(f"{name}.rank")).alias(name) for name in values
        ]
        kept = [F.col(f"{name}.value").alias(name) for name in values]
        return merged.select(*by, _ORDER, F.struct(*stamps).alias(_STAMPS), *kept).select(*rows.columns)

    def _stamp(self, name: str) -> Column:
        return F.coalesce(F.col(f"{_STAMPS}.{name}"), F.col(_ORDER))


@dataclass(frozen=True)
class LatestLog:
    """Latest row per key for feeds whose batches touch keys everywhere: append every batch, compact now and then.

    ``append`` is a sink that only writes the batch. ``compact`` merges all whole batches of the log into ``table`` in
    one pass over its partitions and deletes them; run it on a schedule, at which a rewrite of the table is worth it,
    and readers between its runs.
    ``read`` is the table and what the log holds beyond it. Merging is repeatable, so a compaction that was cut short
    between its steps only leaves batches that are merged again.
    """

    path: str
    table: KeyedTable

    @property
    def append(self):
        return files_sink(self.path)

    def compact(self, spark: SparkSession) -> int:
        """Merge and delete the batches that the log holds now; returns how many they were."""
        batches = self._batches(spark)
        if batches:
            self.table.merge(self._rows(spark, batches), 0)
            for batch in batches:
                delete(spark, batch)
        return len(batches)

    def read(self, spark: SparkSession) -> DataFrame:
        """The latest row of every key."""
        batches = self._batches(spark)
        return self.table.with_rows(self._rows(spark, batches)) if batches else self.table.read(spark)

    def _batches(self, spark: SparkSession) -> list[str]:
        """Folders of the batches that are whole: the log is kept short by compaction, so they are listed."""
        return [
            folder
            for query in names(spark, self.path)
            for name in names(spark, f"{self.path}/{query}")
            if "_SUCCESS" in names(spark, folder := f"{self.path}/{query}/{name}")
        ]

    def _rows(self, spark: SparkSession, batches: list[str]) -> DataFrame:
        return spark.read.option("basePath", self.path).parquet(*batches)
