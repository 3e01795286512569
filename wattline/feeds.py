"""The feed pipelines: message envelope in, rows of the feed's table out.

Every function takes a batch or streaming frame with the envelope columns and returns a frame; none of them
shuffles, so parallelism is that of the source.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline.contracts import Feed, Table
from wattline.functions import default_text, partition_date
from wattline.operators.conform import check_contract, conform
from wattline.operators.decode import (
    ERROR,
    META,
    PAYLOAD,
    alternatives,
    decode,
    decode_checked,
    needed,
    numbers_as_text,
    present,
)
from wattline.operators.project import explode_rows, pick, split_change


def rows(
    feed: Feed,
    messages: DataFrame,
    *,
    meta: bool = False,
    outer: bool = False,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Decode, explode, project, derive the date and fit the table's types.

    ``meta`` keeps the message coordinates, which order writes; ``outer`` keeps messages with no elements. ``only``
    names the table's columns to return: the parser then skips the fields of others that are not in the key.
    """
    if only is not None:
        wanted = {*only, *feed.table.key, *(feed.date or ())}
        feed = feed.using(columns=tuple(f"{path} as {name}" for name, path in feed.projection.items() if name in wanted))
    group = [feed.repeat] if feed.repeat and not any("element." in path for path in feed.columns) else []
    records = decode(messages, _used(feed, group))
    if feed.repeat:
        records = explode_rows(records, f"data.{feed.repeat}", outer=outer)
    passed = [name for name in META.values() if meta and name in records.columns]
    fitted = conform(_projected(feed, records, passed), feed.table)
    return fitted if only is None else fitted.select(*passed, *only)


def checked(
    feed: Feed, messages: DataFrame, *, strict: bool = True, position: str | None = None
) -> DataFrame:
    """``rows`` with message coordinates, ``_error`` (null when the row can be written) and ``_payload``.

    No message is lost without a word: one that is itself bad, or whose repeated group is missing or no array, gives
    one row with an error, and so does an element that is null or does not fit its columns. Only an empty group gives
    no row. ``strict`` also refuses messages in which a used field has a wrong type; without it such a field is null.
    ``position`` adds the element number, keeps a row for a message with an empty group, and adds the flags that the
    audit counts.
    """
    records = decode_checked(messages, _used(feed, feed.required), feed.required, strict=strict)
    made = F.lit(True)
    if feed.repeat:
        group = F.col(f"data.{feed.repeat}")
        error = F.coalesce(F.col(ERROR), F.when(group.isNull(), f"no array {feed.repeat}"))
        records = records.withColumn(PAYLOAD, F.when(error.isNotNull(), F.col(PAYLOAD))).withColumn(ERROR, error)
        records = records.withColumn("_bad_message", F.col(ERROR).isNotNull())
        records = explode_rows(records, f"data.{feed.repeat}", outer=True, position="_pos")
        made = F.col("_pos").isNotNull()
        empty_element = made & F.col("element").isNull()
        records = records.withColumn(
            ERROR, F.coalesce(F.col(ERROR), F.when(empty_element, f"null element of {feed.repeat}"))
        )
        if position is None:
            records = records.filter(made | F.col(ERROR).isNotNull())
    else:
        records = records.withColumn("_bad_message", F.col(ERROR).isNotNull())
    passed = [name for name in (*META.values(), ERROR, PAYLOAD) if name in records.columns]
    if position is not None:
        pos = F.col("_pos") if feed.repeat else F.lit(0)
        records = records.select(
            "*",
            pos.alias(position),
            (made & ~F.col("_bad_message")).alias("_made"),
            (~made & ~F.col("_bad_message")).alias("_empty"),
        )
        passed += [position, "_bad_message", "_made", "_empty"]
    return conform(_projected(feed, records, passed), feed.table, errors=True)


def _used(feed: Feed, also: Iterable[str] = ()) -> str:
    """The part of the feed's message schema that its columns come from, numbers as text."""
    paths = [
        part.replace("element.", f"{feed.repeat}.")
        for path in (*feed.projection.values(), *also)
        for part in alternatives(path)
    ]
    return numbers_as_text(needed(feed.message, paths))


def _projected(feed: Feed, records: DataFrame, passed: list[str]) -> DataFrame:
    columns = {
        name: F.col(path) if path.startswith("element.") else present(path)
        for name, path in feed.projection.items()
    }
    flat = records.select(*passed, *[column.alias(name) for name, column in columns.items()])
    if feed.date:
        date, instant = feed.date
        flat = flat.withColumn(date, partition_date(instant))
    return flat


def events(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.EVENT, messages, **kw)


def telemetry(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.TELEMETRY, messages, **kw)


def device(messages: DataFrame, *, default_manufacturer: str | None = None, **kw) -> DataFrame:
    """Device master data; ``default_manufacturer`` fills missing and empty manufacturers."""
    flat = rows(C.DEVICE, messages, **kw)
    if default_manufacturer is None:
        return flat
    return flat.withColumn("manufacturer", default_text("manufacturer", default_manufacturer, empty=True))


# The element's own time, which the table of readings does not hold but its history key needs.
MEASUREMENT_POINTS = C.MEASUREMENT.using(
    columns=(*C.MEASUREMENT.columns, "element.measureTime as pointtime"),
    table=Table(
        "measurement_points",
        C.MEASUREMENT.table.ddl + ", pointtime timestamp",
        partition=("receive_date",),
        clustering=C.MEASUREMENT.history_key,
    ),
)


def measurement(messages: DataFrame, *, point_time: bool = False, **kw) -> DataFrame:
    """One row per reading; ``point_time`` keeps the time of each data point as ``pointtime``."""
    return rows(MEASUREMENT_POINTS if point_time else C.MEASUREMENT, messages, **kw)


def register_statistic(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.REGISTER_STATISTIC, messages, **kw)


def process(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.PROCESS, messages, **kw)


# Sender variant with times as text: decoded as text, then fitted to the table's timestamps.
PROCESS_TEXT_TIMES = C.PROCESS.using(message=C.PROCESS.message.replace(" timestamp", " string"))


def process_text_times(messages: DataFrame, *, meta: bool = False) -> DataFrame:
    """``process`` for payload times that may not be valid instants; a bad one is null, the rest is kept."""
    feed = PROCESS_TEXT_TIMES
    records = decode(messages, _used(feed))
    kept = [name for name in META.values() if meta and name in records.columns]
    flat = _projected(feed.using(date=None), records, kept)
    flat = flat.withColumn("date", partition_date(F.col("persisttime").try_cast("timestamp")))
    return conform(flat, feed.table)


# Sender variant with any number of parameter kinds.
PROCESS_MAP = C.PROCESS.message.replace(
    "parameters struct<profileRead: struct<profileId: string, readingReasonCode: string>>",
    "parameters map<string, struct<profileId: string, readingReasonCode: string>>",
)


def parameter(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.PARAMETER, messages, **kw)


def profile_facts(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.PROFILE_FACTS, messages, **kw)


def operational_process(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.OPERATIONAL_PROCESS, messages, **kw)


def topology(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.TOPOLOGY, messages, **kw)


def derived_measurement(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.DERIVED_MEASUREMENT, messages, **kw)


def metering_point(messages: DataFrame, **kw) -> DataFrame:
    return rows(C.METERING_POINT, messages, **kw)


def metering_point_from_files(changes: DataFrame) -> DataFrame:
    """The same rows from already typed change records, such as a JSON file scan."""
    flat = split_change(changes, C.METERING_POINT_FIELDS, keep=["persistTime"])
    flat = flat.withColumnRenamed("persistTime", "persisttime")
    flat = flat.withColumn("meteringpoint", F.coalesce("current_meteringpoint", "previous_meteringpoint"))
    check_contract(flat, C.METERING_POINT.table)
    return conform(flat, C.METERING_POINT.table)


def metering_point_devices(messages: DataFrame, side: str = "current") -> DataFrame:
    """One row per device assigned to a metering point in one image of a change record."""
    fields = {"device": "device", "assigntime": "assignTime", "removetime": "removeTime"}
    return _image_group(messages, side, "devices", fields)


def metering_point_states(messages: DataFrame, side: str = "current") -> DataFrame:
    """One row per entry of a metering point's state history in one image of a change record."""
    return _image_group(messages, side, "stateHistory", {"state": "state", "activesince": "activeSince"})


def _image_group(messages: DataFrame, side: str, group: str, fields: dict[str, str]) -> DataFrame:
    paths = ["persistTime", f"{side}.meteringPoint", f"{side}.{group}"]
    records = decode(messages, needed(C.METERING_POINT.message, paths))
    elements = explode_rows(records, f"data.{side}.{group}", position="_pos")
    return pick(
        elements,
        {
            "persisttime": "data.persistTime",
            "meteringpoint": f"data.{side}.meteringPoint",
            "position": "_pos",
            **{name: f"element.{field}" for name, field in fields.items()},
        },
    )


# The seven device columns that the device/telemetry join carries; the rest is not even parsed.
DEVICE_FOR_JOIN = C.DEVICE.using(
    columns=(
        "persistTime", "current.device", "current.type", "current.inventoryState", "current.managementState",
        "current.communicationId", "current.manufacturer",
    ),
    date=None,
    table=Table(
        "device_for_join",
        "device string, persisttime timestamp, type string, inventorystate string, managementstate string, "
        "communicationid string, manufacturer string",
        partition=("device",),
        clustering=("persisttime",),
    ),
)


def device_for_join(messages: DataFrame, **kw) -> DataFrame:
    return rows(DEVICE_FOR_JOIN, messages, **kw)


def telemetry_for_join(messages: DataFrame, **kw) -> DataFrame:
    return telemetry(messages, **kw).withColumnRenamed("lastreceivetime", "last_telemetry")
