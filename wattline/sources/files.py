"""Messages and change records in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.sources.envelope import ENVELOPE


def message_files(
    spark: SparkSession, path: str, *, stream: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files with the envelope columns, such as an archived topic; as a stream, new files as they land."""
    if not stream:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def json_files(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Typed records from JSON files. Without a schema Spark reads all the files once more to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
