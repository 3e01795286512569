"""From binary payload to typed record, with a dead-letter path."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ERROR = "_error"
PAYLOAD = "_payload"
META = {"topic": "_topic", "partition": "_partition", "offset": "_offset"}


def payload_text(messages: DataFrame, column: str = "value") -> DataFrame:
    """The payload column as text."""
    return messages.withColumn(column, F.col(column).cast("string"))


def needed(message: str, paths: Iterable[str]) -> str:
    """The part of a message schema that the given dotted paths use.

    Fields that are not declared are skipped by the JSON parser, which saves converting them. (Catalyst does this
    itself only when a single field is used.) Paths go through arrays as if they were structs.
    """
    wanted = [path.split(".") for path in paths]
    return ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in _pruned(T.StructType.fromDDL(message), wanted)
    )


def numbers_as_text(message: str) -> str:
    """The schema with numeric leaves as text, so that quoted and bare numbers decode alike.

    ``conform`` then casts them, and can tell a number that is missing from one that cannot be read.
    """
    return ", ".join(
        f"`{field.name}` {_text_for_numbers(field.dataType).simpleString()}"
        for field in T.StructType.fromDDL(message).fields
    )


def _text_for_numbers(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _text_for_numbers(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_text_for_numbers(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _text_for_numbers(kind.valueType))
    return T.StringType() if isinstance(kind, T.NumericType) else kind


def alternatives(path: str) -> list[str]:
    """The paths of a column: ``a | b`` is the first that is present."""
    return [part.strip() for part in path.split("|")]


def present(path: str, prefix: str = "data.") -> Column:
    """The value at a path, or at the first present of its alternatives."""
    return F.coalesce(*[F.col(f"{prefix}{part}") for part in alternatives(path)])


def _pruned(struct: T.StructType, paths: list[list[str]]) -> T.StructType:
    fields = []
    for field in struct.fields:
        rest = [path[1:] for path in paths if path[0] == field.name]
        if rest:
            kind = field.dataType if [] in rest else _pruned_type(field.dataType, rest)
            fields.append(T.StructField(field.name, kind))
    return T.StructType(fields)


def _pruned_type(kind: T.DataType, paths: list[list[str]]) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_pruned_type(kind.elementType, paths))
    if isinstance(kind, T.MapType):
        return kind
    return _pruned(kind, paths)


def decode(
    messages: DataFrame,
    message: str,
    *,
    column: str = "value",
    into: str = "data",
    corrupt: bool = False,
    keep_payload: bool = False,
) -> DataFrame:
    """Parse the payload as JSON with a declared schema into the struct column ``into``.

    Lenient: unreadable text gives a struct of nulls, an empty payload a null struct, a badly typed field a
    null field. ``corrupt`` adds the raw text of such records to the struct.

    The record is produced by a one-element generator rather than a projection: Catalyst pushes later filters
    (a user's, or the ones it infers for ``explode``) through a projection and re-evaluates the JSON parse for
    each of them, while a generator's output is computed once.
    """
    schema = f"{message}, {CORRUPT} string" if corrupt else message
    options = {"columnNameOfCorruptRecord": CORRUPT} if corrupt else {}
    text = F.col(column).cast("string")
    kept = [F.col(source).alias(name) for source, name in META.items() if source in messages.columns]
    if keep_payload:
        kept.append(text.alias(PAYLOAD))
    return messages.select(*kept, F.explode_outer(F.array(F.from_json(text, schema, options))).alias(into))


def expand(records: DataFrame, column: str = "data") -> DataFrame:
    """The fields of a decoded record as columns, next to the message coordinates."""
    return records.select(*_meta(records), f"{column}.*")


def decode_map(messages: DataFrame, message: str, map_path: str, *, key: str, value: str) -> DataFrame:
    """One row per entry of a string-keyed map in the payload, with the map's key as a column."""
    records = decode(messages, message)
    entries = records.select(
        *_meta(records), "data", F.posexplode_outer(F.map_entries(f"data.{map_path}")).alias("_pos", "_entry")
    ).filter(F.col("_pos").isNotNull())
    return entries.select(
        *_meta(records), "data.*", F.col("_entry.key").alias(key), F.col("_entry.value").alias(value)
    )


def decode_checked(
    messages: DataFrame, message: str, required: Iterable[str] = (), *, strict: bool = False
) -> DataFrame:
    """``decode`` plus an ``_error`` column, null for a good record, and ``_payload`` of the bad ones.

    Bad are empty payloads, payloads that are not one JSON object, and records without a required field.
    With ``strict`` a record with any badly typed field is bad too; otherwise its other fields are kept.
    """
    records = decode(messages, message, corrupt=True, keep_payload=True)
    fields = [name for name in records.schema["data"].dataType.names if name != CORRUPT]
    something = reduce(Column.__or__, [F.col(f"data.{name}").isNotNull() for name in fields])
    corrupt = F.col(f"data.{CORRUPT}").isNotNull()
    error = F.when(F.col("data").isNull(), "empty payload").when(corrupt & ~something, "not one JSON object")
    if strict:
        error = error.when(corrupt, "badly typed field")
    for path in required:
        error = error.when(present(path).isNull(), f"missing {' and '.join(alternatives(path))}")
    records = records.withColumn(ERROR, error)
    return records.withColumn(PAYLOAD, F.when(F.col(ERROR).isNotNull(), F.col(PAYLOAD)))


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of a frame with an ``_error`` column.

    Two outputs are two evaluations: write both from one ``foreachBatch`` over a persisted batch.
    """
    good = rows.filter(F.col(ERROR).isNull()).drop(ERROR, PAYLOAD)
    bad = rows.filter(F.col(ERROR).isNotNull())
    return good, bad.select(*_meta(rows), ERROR, PAYLOAD)


def _meta(rows: DataFrame) -> list[str]:
    return [name for name in META.values() if name in rows.columns]
