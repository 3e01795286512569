"""Feeds and the keyed tables they fill.

A ``Feed`` says what a message looks like and which message paths become which columns; a ``Table``
says what the columns must be when they are written and which of them identify a row.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

KEEP = "keep"  # a null in a newer row leaves the stored value
OVERWRITE = "overwrite"  # a newer row replaces the stored row, nulls included


@dataclass(frozen=True)
class Table:
    """A keyed table: ``partition`` + ``clustering`` identify a row; clustering reads newest first."""

    name: str
    ddl: str
    partition: tuple[str, ...]
    clustering: tuple[str, ...] = ()
    nulls: str = KEEP

    @property
    def key(self) -> tuple[str, ...]:
        return self.partition + self.clustering

    @property
    def types(self) -> dict[str, str]:
        """Column name to type, in declared order (columns are flat and of simple types)."""
        return dict(part.split() for part in self.ddl.split(","))

    @property
    def columns(self) -> list[str]:
        return list(self.types)


@dataclass(frozen=True)
class Feed:
    """One topic: message schema, projected paths, target table and the keys that lose no rows.

    ``columns`` holds message paths; a path is named by its lower-cased leaf unless it says ``path as name``, and
    ``path | path`` is the first that is present.
    ``repeat`` names a repeated group that becomes one row per element, addressed as ``element.<field>``.
    ``date`` is ``(date column, column it is derived from)``.
    """

    name: str
    message: str
    columns: tuple[str, ...]
    table: Table
    history_key: tuple[str, ...]
    state_key: tuple[str, ...]
    order: str
    required: tuple[str, ...]
    repeat: str | None = None
    date: tuple[str, str] | None = None

    @property
    def topic(self) -> str:
        return TOPIC.format(self.name)

    @property
    def projection(self) -> dict[str, str]:
        """Output column name to message path."""
        named = {}
        for column in self.columns:
            path, _, name = column.partition(" as ")
            name = name or path.rsplit(".", 1)[-1].lower()
            if name in named:
                raise ValueError(f"feed {self.name}: two paths give column {name!r}")
            named[name] = path
        return named

    def using(self, **changes) -> Feed:
        return replace(self, **changes)


# Topic names, message schemas, output columns and table contracts of the wire format.

TOPIC = "ext_{}_10121"

_ADDRESS = (
    "city: string, postalCode: string, street: string, houseNumber: string, floor: string, company: string, "
    "country: string, reference: string, timeZone: string, region: string, district: string"
)
_GEO = "latitude: string, longitude: string"

EVENT = Feed(
    name="device-event",
    message="device string, event string, firstOccurrenceTime timestamp, lastOccurrenceTime timestamp, "
    "occurrenceCount int, receiveTime timestamp, persistTime timestamp, state string, context string",
    columns=(
        "device", "event", "firstOccurrenceTime", "lastOccurrenceTime", "occurrenceCount", "receiveTime",
        "persistTime", "state",
    ),
    date=("current_date", "persisttime"),
    table=Table(
        "events",
        "current_date date, receivetime timestamp, device string, event string, firstoccurrencetime timestamp, "
        "lastoccurrencetime timestamp, occurrencecount int, persisttime timestamp, state string",
        partition=("current_date",),
        clustering=("receivetime",),
        nulls=OVERWRITE,
    ),
    history_key=("device", "event", "firstoccurrencetime", "persisttime"),
    state_key=("device", "event", "firstoccurrencetime"),
    order="persisttime",
    required=("device", "event"),
)

TELEMETRY = Feed(
    name="device-telemetry",
    message="device string, lastReceiveTime timestamp",
    columns=("device", "lastReceiveTime"),
    table=Table(
        "telemetry",
        "device string, lastreceivetime timestamp",
        partition=("device",),
        clustering=("lastreceivetime",),
        nulls=OVERWRITE,
    ),
    history_key=("device", "lastreceivetime"),
    state_key=("device",),
    order="lastreceivetime",
    required=("device", "lastReceiveTime"),
)

DEVICE = Feed(
    name="device",
    message="persistTime timestamp, current struct<device: string, type: string, `group`: string, "
    "inventoryState: string, managementState: string, communicationId: string, manufacturer: string, "
    f"description: string, model: string, location: struct<geo: struct<{_GEO}>, address: struct<{_ADDRESS}>, "
    "logicalInstallationPoint: string>, tags: string>",
    columns=(
        "persistTime", "current.device", "current.type", "current.group", "current.inventoryState",
        "current.managementState", "current.communicationId", "current.manufacturer", "current.description",
        "current.model", "current.location.geo.latitude", "current.location.geo.longitude",
        "current.location.address.city", "current.location.address.postalCode", "current.location.address.street",
        "current.location.address.houseNumber", "current.location.address.floor",
        "current.location.address.company", "current.location.address.country",
        "current.location.address.reference", "current.location.address.timeZone",
        "current.location.address.region", "current.location.address.district",
        "current.location.logicalInstallationPoint",
    ),
    date=("date", "persisttime"),
    table=Table(
        "device",
        "date date, persisttime timestamp, city string, communicationid string, company string, country string, "
        "description string, device string, district string, floor string, group string, housenumber string, "
        "inventorystate string, latitude string, logicalinstallationpoint string, longitude string, "
        "managementstate string, manufacturer string, model string, postalcode string, reference string, "
        "region string, street string, timezone string, type string",
        partition=("date",),
        clustering=("persisttime",),
    ),
    history_key=("device", "persisttime"),
    state_key=("device",),
    order="persisttime",
    required=("current.device", "persistTime"),
)

MEASUREMENT = Feed(
    name="device-measurement",
    message="device string, measureTime timestamp, receiveTime timestamp, persistTime timestamp, "
    "readingReason string, dataPoints array<struct<register: string, value: string, unit: string, "
    "measureTime: timestamp>>, status array<string>, profile string",
    repeat="dataPoints",
    columns=(
        "device", "measureTime", "receiveTime", "persistTime", "readingReason", "element.register",
        "element.value", "element.unit", "profile",
    ),
    date=("receive_date", "receivetime"),
    table=Table(
        "measurement",
        "receive_date date, receivetime timestamp, device string, measuretime timestamp, persisttime timestamp, "
        "profile string, readingreason string, register string, unit string, value float",
        partition=("receive_date",),
        clustering=("receivetime",),
    ),
    history_key=("device", "profile", "register", "pointtime", "persisttime"),
    state_key=("device", "profile", "register", "pointtime"),
    order="persisttime",
    required=("device", "receiveTime"),
)

REGISTER_STATISTIC = Feed(
    name="register-statistic",
    message="device string, register string, `date` date, meterReads struct<expected: int, received: int, "
    "edited: int, invalidated: int, estimated: int>, deliveryDelay struct<minimum: int, maximum: int, "
    "average: float>",
    columns=(
        "device", "register", "date", "meterReads.expected as mr_expected", "meterReads.received as mr_received",
        "meterReads.edited as mr_edited", "meterReads.invalidated as mr_invalidated",
        "meterReads.estimated as mr_estimated", "deliveryDelay.minimum as dd_minimum",
        "deliveryDelay.maximum as dd_maximum", "deliveryDelay.average as dd_average",
    ),
    table=Table(
        "regstat",
        "date date, device string, register string, dd_average float, dd_maximum int, dd_minimum int, "
        "mr_edited int, mr_estimated int, mr_expected int, mr_invalidated int, mr_received int",
        partition=("date", "device", "register"),
    ),
    history_key=("device", "register", "date", "_offset"),
    state_key=("device", "register", "date"),
    order="_offset",
    required=("device", "register", "date"),
)

PROCESS = Feed(
    name="device-process",
    message="id int, type string, device string, persistTime timestamp, initTime timestamp, startTime timestamp, "
    "previous struct<status: string>, current struct<status: string, error: string>, completionTime timestamp, "
    "executionType string, parameters struct<profileRead: struct<profileId: string, readingReasonCode: string>>",
    columns=(
        "id", "type", "device", "persistTime", "initTime", "startTime", "previous.status as previous_status",
        "current.status as current_status", "current.error as current_error", "completionTime", "executionType",
        "parameters.profileRead.profileId as profile_id",
        "parameters.profileRead.readingReasonCode as reading_reason_code",
    ),
    date=("date", "persisttime"),
    table=Table(
        "process",
        "date date, persisttime timestamp, completiontime timestamp, current_error string, current_status string, "
        "device string, executiontype string, id int, inittime timestamp, previous_status string, "
        "profile_id string, reading_reason_code string, starttime timestamp, type string",
        partition=("date",),
        clustering=("persisttime",),
    ),
    history_key=("id", "persisttime"),
    state_key=("id",),
    order="persisttime",
    required=("id", "persistTime"),
)

PARAMETER = Feed(
    name="device-parameter",
    message="device string, parameter string, changeTime timestamp, receiveTime timestamp, persistTime timestamp, "
    "newValue string, oldValue string",
    columns=("device", "parameter", "changeTime", "receiveTime", "persistTime", "newValue", "oldValue"),
    date=("date", "receivetime"),
    table=Table(
        "parameter",
        "device string, receivetime timestamp, changetime timestamp, date date, newvalue string, oldvalue string, "
        "parameter string, persisttime timestamp",
        partition=("device", "receivetime"),
    ),
    history_key=("device", "parameter", "changetime"),
    state_key=("device", "parameter"),
    order="changetime",
    required=("device", "receiveTime"),
)

PROFILE_FACTS = Feed(
    name="device-profile-facts",
    message="device string, profile string, gatheredAt timestamp, actual double, expected double, "
    "completeness string, `from` timestamp, `to` timestamp",
    columns=(
        "device", "profile", "gatheredAt", "actual", "expected", "completeness", "from as fromtime",
        "to as totime",
    ),
    date=("date", "gatheredat"),
    table=Table(
        "profile_fact",
        "device string, profile string, date date, gatheredat timestamp, actual double, completeness string, "
        "expected double, fromtime timestamp, totime timestamp",
        partition=("device", "profile"),
        clustering=("date", "gatheredat"),
    ),
    history_key=("device", "profile", "gatheredat"),
    state_key=("device", "profile"),
    order="gatheredat",
    required=("device", "profile", "gatheredAt"),
)

OPERATIONAL_PROCESS = Feed(
    name="operational-process",
    message="id int, type string, persistTime timestamp, current struct<status: string>",
    columns=("id", "type", "persistTime", "current.status"),
    table=Table(
        "dev_operational_process",
        "id int, type string, persisttime timestamp, status string",
        partition=("id",),
    ),
    history_key=("id", "persisttime"),
    state_key=("id",),
    order="persisttime",
    required=("id",),
)

TOPOLOGY = Feed(
    name="device-topology",
    message="device string, receiveTime timestamp, persistTime timestamp, "
    "children array<struct<childDevice: string, addTime: timestamp, dataSource: string>>",
    repeat="children",
    columns=(
        "device", "receiveTime", "persistTime", "element.childDevice", "element.addTime", "element.dataSource",
    ),
    table=Table(
        "device_topology",
        "device string, childdevice string, receivetime timestamp, persisttime timestamp, addtime timestamp, "
        "datasource string",
        partition=("device", "childdevice"),
    ),
    history_key=("device", "childdevice", "persisttime"),
    state_key=("device", "childdevice"),
    order="persisttime",
    required=("device",),
)

DERIVED_MEASUREMENT = Feed(
    name="device-derived-measurement",
    message="device string, register string, persistTime timestamp, unit string, "
    "consumptionDataPoints array<struct<time: timestamp, value: string, quality: string>>",
    repeat="consumptionDataPoints",
    columns=(
        "device", "register", "persistTime", "unit", "element.time", "element.value", "element.quality",
    ),
    table=Table(
        "derived_measurement",
        "device string, register string, persisttime timestamp, unit string, time timestamp, value double, "
        "quality string",
        partition=("device", "register"),
        clustering=("time",),
    ),
    history_key=("device", "register", "time", "persisttime"),
    state_key=("device", "register", "time"),
    order="persisttime",
    required=("device", "register"),
)

# One image serves both sides of a change record.
_METERING_POINT_IMAGE = (
    "struct<meteringPoint: string, `group`: string, serviceLevel: string, "
    "devices: array<struct<device: string, assignTime: timestamp, removeTime: timestamp>>, "
    "stateHistory: array<struct<state: string, activeSince: timestamp>>, "
    f"location: struct<geo: struct<{_GEO}>, address: struct<{_ADDRESS}>>>"
)
METERING_POINT_FIELDS = {
    "meteringpoint": "meteringPoint", "group": "group", "servicelevel": "serviceLevel",
    "latitude": "location.geo.latitude", "longitude": "location.geo.longitude",
    "city": "location.address.city", "postalcode": "location.address.postalCode",
    "street": "location.address.street", "housenumber": "location.address.houseNumber",
    "floor": "location.address.floor", "company": "location.address.company",
    "country": "location.address.country", "reference": "location.address.reference",
    "timezone": "location.address.timeZone", "region": "location.address.region",
    "district": "location.address.district",
}

METERING_POINT = Feed(
    name="metering-point",
    message=f"persistTime timestamp, previous {_METERING_POINT_IMAGE}, current {_METERING_POINT_IMAGE}",
    columns=(
        "persistTime",
        "current.meteringPoint | previous.meteringPoint as meteringpoint",
        *(
            f"{side}.{path} as {side}_{name}"
            for side in ("previous", "current")
            for name, path in METERING_POINT_FIELDS.items()
        ),
    ),
    table=Table(
        "metering_point",
        "persisttime timestamp, meteringpoint string, "
        + ", ".join(
            f"{side}_{name} {'double' if name in ('latitude', 'longitude') else 'string'}"
            for side in ("previous", "current")
            for name in METERING_POINT_FIELDS
        ),
        partition=("meteringpoint",),
        clustering=("persisttime",),
    ),
    history_key=("meteringpoint", "persisttime"),
    state_key=("meteringpoint",),
    order="persisttime",
    required=("current.meteringPoint | previous.meteringPoint", "persistTime"),
)

FEEDS: dict[str, Feed] = {
    feed.name: feed
    for feed in (
        EVENT, TELEMETRY, DEVICE, MEASUREMENT, REGISTER_STATISTIC, PROCESS, PARAMETER, PROFILE_FACTS,
        OPERATIONAL_PROCESS, TOPOLOGY, DERIVED_MEASUREMENT, METERING_POINT,
    )
}

# Target of the device/telemetry join; keyed by device so that every joined row has its key.
DEVICE_TELEMETRY = Table(
    "device_telemetry",
    "device string, persisttime timestamp, type string, inventorystate string, managementstate string, "
    "communicationid string, manufacturer string, last_telemetry timestamp",
    partition=("device",),
    clustering=("persisttime", "last_telemetry"),
)

# The tables of an earlier generation, as (feed, key, columns and types).
EARLIER_TABLES: dict[str, tuple[str, tuple[str, ...], str]] = {
    "dev_event": (
        "device-event", ("device", "event"),
        "device string, event int, receivetime timestamp, firstoccurrencetime timestamp, "
        "lastoccurrencetime timestamp, occurrencecount int, persisttime timestamp, state string",
    ),
    "dev_measurement": (
        "device-measurement", ("device", "register"),
        "device string, measuretime string, receivetime string, persisttime string, readingreason string, "
        "register string, value float, unit string, profile string",
    ),
    "dev_parameter": (
        "device-parameter", ("device", "parameter", "changetime"),
        "device string, parameter string, changetime timestamp, receivetime timestamp, persisttime timestamp, "
        "newvalue string, oldvalue string",
    ),
    "dev_process": (
        "device-process", ("id",),
        "id int, type string, device string, persisttime timestamp, inittime timestamp, starttime timestamp, "
        "previous_status string, status string, error string, completiontime timestamp, executiontype string, "
        "profile_id string, reading_reason_code string",
    ),
    "dev_profile_facts": (
        "device-profile-facts", ("device", "profile", "gatheredat"),
        "device string, profile string, gatheredat timestamp, actual double, expected double, completeness string, "
        "from_time timestamp, to_time timestamp",
    ),
    "dev_telemetry": ("device-telemetry", ("device",), "device string, lastreceivetime timestamp"),
    "device_by_manufacturer": (
        "device", ("manufacturer",),
        "persisttime timestamp, device string, type string, group string, inventorystate string, "
        "managementstate string, communicationid string, manufacturer string, description string, model string, "
        "latitude double, longitude double, city string, postalcode string, street string, housenumber string, "
        "floor string, company string, country string, reference string, timezone string, region string, "
        "district string, logicalinstallationpoint string",
    ),
    "register_statistics": (
        "register-statistic", ("device", "register", "date"),
        "device string, register string, date string, mr_expected int, mr_received int, mr_edited int, "
        "mr_invalidated int, mr_estimated int, dd_minimum int, dd_maximum int, dd_average float",
    ),
}

# Columns that an earlier table names otherwise than the feed's newest table.
EARLIER_NAMES: dict[str, dict[str, str]] = {
    "dev_process": {"current_status": "status", "current_error": "error"},
    "dev_profile_facts": {"fromtime": "from_time", "totime": "to_time"},
}

# Keys that other revisions gave to a feed's table, for "latest by key" views.
EARLIER_KEYS: dict[str, tuple[str, tuple[str, ...]]] = {
    **{name: (which, key) for name, (which, key, _) in EARLIER_TABLES.items()},
    "dev_event_by_receivetime": ("device-event", ("device", "event", "receivetime")),
    "device_event": ("device-event", ("device",)),
    "dev_measurement1": ("device-measurement", ("device", "receivetime")),
}


def feed(name: str) -> Feed:
    """The registered feed, or ``ValueError`` naming the known ones."""
    if name not in FEEDS:
        raise ValueError(f"unknown feed {name!r}; known: {', '.join(FEEDS)}")
    return FEEDS[name]


def earlier_table(name: str) -> Table:
    """A table of the earlier generation: its own columns, types and key."""
    which, key, ddl = EARLIER_TABLES[name]
    return Table(name, ddl, partition=key, nulls=FEEDS[which].table.nulls)


def earlier_names(name: str) -> dict[str, str]:
    """New column name by the feed's column name, for rows that go into an earlier table."""
    return dict(EARLIER_NAMES.get(name, {}))
