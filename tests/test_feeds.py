from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import SF, tuples
from wattline import contracts as C
from wattline import feeds
from wattline.plans import wire
from wattline.sources import json_files, message_files
from wattline.streaming.runner import Job, run_available
from wattline.streaming.sinks import files_sink


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)


def test_event(messages):
    payload = {
        "device": "meter-a", "event": "cover opened", "firstOccurrenceTime": "2031-03-04T01:02:03Z",
        "lastOccurrenceTime": "2031-03-05T06:07:08Z", "occurrenceCount": 3, "receiveTime": "2031-03-05T06:07:09Z",
        "persistTime": "2031-03-06T00:00:01Z", "state": "closed", "context": {},
    }
    assert tuple(feeds.events(messages(payload)).first()) == (
        day("2031-03-06"), at("2031-03-05 06:07:09"), "meter-a", "cover opened", at("2031-03-04 01:02:03"),
        at("2031-03-05 06:07:08"), 3, at("2031-03-06 00:00:01"), "closed",
    )


def test_measurement_gives_a_row_per_data_point(messages):
    points = [
        {"register": f"register {n}", "value": value, "unit": "W", "measureTime": "2031-07-01T12:00:00Z"}
        for n, value in enumerate(["7.5E+1", "0", "x", "4", 5])
    ]
    payload = {"device": "meter-a", "receiveTime": "2031-07-01T12:00:30.125Z", "dataPoints": points, "status": []}
    others = {"device": "meter-b", "dataPoints": []}, {"device": "meter-c"}
    rows = feeds.measurement(messages(payload, *others))
    assert [row.value for row in rows.orderBy("register").collect()] == [75.0, 0.0, None, 4.0, 5.0]
    assert {row.receive_date for row in rows.collect()} == {day("2031-07-01")}
    assert feeds.measurement(messages(payload, *others), outer=True).count() == 7
    kept = feeds.measurement(messages(payload), point_time=True).first()
    assert kept.pointtime == at("2031-07-01 12:00:00")


def test_device(messages):
    payload = {
        "persistTime": "2031-02-28T23:59:59.250Z",
        "current": {
            "device": "meter-a", "type": "A&B", "group": "north", "manufacturer": "",
            "location": {"geo": {"latitude": "-1.25"}, "address": {"city": "Somewhere", "timeZone": "UTC"},
                         "logicalInstallationPoint": "cellar"},
            "tags": [],
        },
    }
    row = feeds.device(messages(payload)).first()
    assert (row.date, row.device, row.group, row.latitude, row.longitude, row.city, row.timezone) == (
        day("2031-02-28"), "meter-a", "north", "-1.25", None, "Somewhere", "UTC",
    )
    assert row.logicalinstallationpoint == "cellar" and row.manufacturer == ""
    assert feeds.device(messages(payload), default_manufacturer="unknown").first().manufacturer == "unknown"
    assert len(row) == 25


def test_process(messages):
    payload = {
        "id": 12, "type": "read", "device": "meter-a", "persistTime": "2031-04-05T06:07:08.009Z",
        "startTime": "not yet", "previous": {"status": "waiting"}, "current": {"status": "stopped", "error": "late"},
        "parameters": {"profileRead": {"profileId": "hourly", "readingReasonCode": "4"}},
    }
    for read in (feeds.process, feeds.process_text_times):
        row = read(messages(payload)).first()
        assert (row.date, row.previous_status, row.current_status, row.current_error) == (
            day("2031-04-05"), "waiting", "stopped", "late",
        )
        assert (row.profile_id, row.starttime, row.persisttime) == ("hourly", None, at("2031-04-05 06:07:08.009000"))
    assert feeds.process(messages({"id": 1, "parameters": {}})).first().profile_id is None


def test_profile_facts(messages):
    payload = {
        "device": "meter-a", "profile": "daily", "gatheredAt": "2031-09-10T11:12:13.141516Z", "actual": 3, "expected": 4,
        "completeness": "NaN", "from": "2031-09-09T00:00:00Z", "to": "2031-09-10T11:12:13.141516Z",
    }
    row = feeds.profile_facts(messages(payload)).first()
    assert (row.actual, row.completeness, row.fromtime) == (3.0, "NaN", at("2031-09-09 00:00:00"))
    assert row.totime == row.gatheredat == at("2031-09-10 11:12:13.141516")


def test_register_statistic_and_operational_process(messages):
    payload = {
        "device": "meter-a", "register": "r", "date": "2031-06-07",
        "meterReads": {"expected": 48, "received": 0}, "deliveryDelay": {"minimum": 1, "average": 2.5},
    }
    row = feeds.register_statistic(messages(payload)).first()
    assert (row.date, row.mr_expected, row.mr_edited, row.dd_average) == (day("2031-06-07"), 48, None, 2.5)
    payload = {"id": 7, "type": "scan", "persistTime": "2031-06-07T08:09:10.250Z", "current": {"status": "idle"}}
    assert tuple(feeds.operational_process(messages(payload)).first())[3] == "idle"


def test_topology_and_derived_measurement(messages):
    children = [{"childDevice": "x", "addTime": "2031-01-02T03:04:05Z", "dataSource": "hand"}, {"childDevice": "y"}]
    rows = feeds.topology(messages({"device": "hub@7", "children": children}))
    assert tuples(rows.select("device", "childdevice", "datasource")) == [("hub@7", "x", "hand"), ("hub@7", "y", None)]
    points = [{"time": "2031-01-02T03:00:00Z", "value": "6", "quality": "good"}, {"value": "none"}]
    rows = feeds.derived_measurement(messages({"device": "meter-a", "unit": "9", "consumptionDataPoints": points}))
    assert tuples(rows.select("unit", "value", "quality")) == [("9", 6.0, "good"), ("9", None, None)]


def test_metering_point(messages):
    before = {
        "meteringPoint": "p9", "group": "old", "location": {"geo": {"latitude": "3.5"}},
        "devices": [{"device": "meter-a", "assignTime": "2030-10-11T12:13:14Z"}],
        "stateHistory": [{"state": "on", "activeSince": "2030-10-12T00:00:00Z"}],
    }
    after = {**before, "group": "new", "devices": [*before["devices"], {"device": "meter-b"}]}
    payload = {"persistTime": "2031-10-11T12:13:14.5Z", "previous": before, "current": after}
    row = feeds.metering_point(messages(payload)).first()
    assert (row.previous_group, row.current_group, row.previous_latitude, row.meteringpoint) == ("old", "new", 3.5, "p9")
    devices = feeds.metering_point_devices(messages(payload))
    assert tuples(devices.select("position", "device", "removetime")) == [(0, "meter-a", None), (1, "meter-b", None)]
    states = feeds.metering_point_states(messages(payload), "previous")
    assert states.first().activesince == at("2030-10-12 00:00:00")
    time = "2031-10-11T12:13:14Z"
    created = feeds.metering_point(messages({"persistTime": time, "current": after})).first()
    assert created.previous_group is None and created.current_group == "new"
    changes = messages({"persistTime": time, "previous": before}, {"persistTime": time})
    deleted, neither = feeds.checked(C.METERING_POINT, changes).orderBy("_offset").collect()
    assert (deleted["_error"], deleted.meteringpoint, deleted.current_group) == (None, "p9", None)
    assert neither["_error"] == "missing current.meteringPoint and previous.meteringPoint"


def test_json_files_with_and_without_a_schema(spark, scratch):
    spark.createDataFrame([('{"id": 1, "at": "2024-01-01T00:00:00Z"}',)], "value string").write.text(f"{scratch}/j")
    assert json_files(spark, f"{scratch}/j").dtypes == [("at", "string"), ("id", "bigint")]
    typed = json_files(spark, f"{scratch}/j", "id int, at timestamp").first()
    assert tuple(typed) == (1, at("2024-01-01 00:00:00"))


SOURCES = {
    C.EVENT: wire.event_messages, C.TELEMETRY: wire.telemetry_messages, C.DEVICE: wire.device_messages,
    C.MEASUREMENT: wire.measurement_messages, C.REGISTER_STATISTIC: wire.register_statistic_messages,
    C.PROCESS: wire.process_messages, C.PARAMETER: wire.parameter_messages,
    C.PROFILE_FACTS: wire.profile_facts_messages, C.OPERATIONAL_PROCESS: wire.operational_process_messages,
    C.TOPOLOGY: wire.topology_messages, C.DERIVED_MEASUREMENT: wire.derived_measurement_messages,
    C.METERING_POINT: wire.metering_point_messages,
}


def test_batch_equals_stream_for_every_feed(spark, scratch):
    jobs = []
    for feed, source in SOURCES.items():
        topic = f"{scratch}/topics/{feed.name}"
        source(spark, SF).write.parquet(topic)
        rows = feeds.rows(feed, message_files(spark, topic, stream=True))
        jobs.append(Job(feed.table.name, rows, sink=files_sink(f"{scratch}/{feed.table.name}")))
    run_available(spark, jobs, f"{scratch}/checkpoints")
    for feed, source in SOURCES.items():
        batch = feeds.rows(feed, source(spark, SF))
        streamed = spark.read.parquet(f"{scratch}/{feed.table.name}").select(*batch.columns)
        assert batch.count() == streamed.count() > 0, feed.name
        assert batch.exceptAll(streamed).isEmpty(), feed.name


@pytest.mark.parametrize("feed", SOURCES, ids=lambda feed: feed.name)
def test_checked_rows_of_good_messages_equal_plain_rows(spark, feed):
    messages = SOURCES[feed](spark, SF)
    plain = feeds.rows(feed, messages)
    checked = feeds.checked(feed, messages)
    if feed in (C.DERIVED_MEASUREMENT,):
        assert checked.filter("_error is not null").select("_error").distinct().first()[0] == "value is not double"
    else:
        assert checked.filter("_error is not null").isEmpty()
    assert plain.exceptAll(checked.select(*plain.columns)).isEmpty()
