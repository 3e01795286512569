from __future__ import annotations

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import optimized, tuples
from wattline import contracts as C
from wattline import feeds
from wattline.functions import default_text, to_instant, to_number
from wattline.operators.decode import (
    ERROR,
    PAYLOAD,
    decode,
    decode_checked,
    decode_map,
    expand,
    needed,
    payload_text,
    split_errors,
)

SCHEMA = "device string, n int, x double, points array<struct<register: string, value: string>>"


def test_lenient_decode_of_bad_payloads(messages):
    bad = ["{bad", '{"device": "a", "n": 2', "null", "3", '"s"', [{"device": "a"}]]
    rows = decode(messages(*bad), SCHEMA).select("data", "data.*").collect()
    assert all(row.data is not None and row.device is None and row.n is None for row in rows)
    for row in decode(messages(None, "", "  "), SCHEMA).collect():
        assert row.data is None


def test_one_bad_field_leaves_the_others(messages):
    payload = {"device": "a", "n": "seven", "x": "1.5", "points": {"register": "r"}}
    row = expand(decode(messages(payload), SCHEMA)).first()
    assert (row.device, row.n, row.x, row.points) == ("a", None, None, None)


def test_field_names_are_case_sensitive(messages):
    row = expand(decode(messages({"Device": "a", "n": 1}), SCHEMA)).first()
    assert (row.device, row.n) == (None, 1)


def test_opaque_subtrees_stay_text(messages):
    row = expand(decode(messages({"a": {}, "b": [1, {"a": 2}]}), "a string, b string")).first()
    assert (row.a, row.b) == ("{}", '[1,{"a":2}]')


def test_instants_of_all_widths(messages):
    payload = {"a": "2031-05-06T07:08:09Z", "b": "2031-05-06T07:08:09.123Z", "c": "2031-05-06T07:08:09.123456Z"}
    row = expand(decode(messages(payload), "a timestamp, b timestamp, c timestamp")).first()
    assert [value.microsecond for value in (row.a, row.b, row.c)] == [0, 123000, 123456]


def test_payload_text(messages):
    assert payload_text(messages("x")).first().value == "x"


def test_json_is_parsed_once_whatever_follows(messages):
    rows = decode(messages({"device": "a"}), SCHEMA)
    exploded = rows.select("data.device", F.explode("data.points").alias("p"))
    later = exploded.filter("device = 'a' and p.value > '1'").select("device", "p.*")
    assert optimized(later).count("from_json(") == 1
    for feed in C.FEEDS.values():
        fed = feeds.rows(feed, messages("{}"))
        column = feed.table.key[0]
        assert optimized(fed.filter(F.col(column).isNotNull())).count("from_json(") == 1


def test_feeds_do_not_shuffle(messages):
    for feed in C.FEEDS.values():
        assert "Exchange" not in feeds.checked(feed, messages("{}"))._jdf.queryExecution().executedPlan().toString()


def test_needed_fields(spark):
    message = "a string, b struct<c: int, d: struct<e: int, f: int>>, g array<struct<h: int, i: int>>, m map<string, int>"
    assert needed(message, ["a", "b.d.e", "g.h"]) == "`a` string, `b` struct<d:struct<e:int>>, `g` array<struct<h:int>>"
    assert needed(message, ["b", "b.c", "m.k"]) == "`b` struct<c:int,d:struct<e:int,f:int>>, `m` map<string,int>"


def test_map_entries(messages):
    schema = "id int, parameters map<string, struct<p: string>>"
    payloads = [{"id": 1, "parameters": {"a": {"p": "x"}, "b": {}}}, {"id": 2, "parameters": {}}, {"id": 3}]
    rows = decode_map(messages(*payloads), schema, "parameters", key="kind", value="read")
    assert tuples(rows.select("id", "kind", "read.p")) == [(1, "a", "x"), (1, "b", None)]


def test_dead_letters(messages):
    payloads = [
        {"device": "a", "n": 1}, "{bad", None, "", "null", [{"device": "a"}], {"n": 1}, {"device": "b", "n": "x"},
    ]
    rows = decode_checked(messages(*payloads), SCHEMA, ["device"])
    errors = {row["_offset"]: row[ERROR] for row in rows.collect()}
    assert errors == {
        0: None, 1: "not one JSON object", 2: "empty payload", 3: "empty payload", 4: "not one JSON object",
        5: "not one JSON object", 6: "missing device", 7: None,
    }
    good, bad = split_errors(rows)
    assert sorted(row["_offset"] for row in good.collect()) == [0, 7]
    assert {row["_offset"]: row[PAYLOAD] for row in bad.collect()}[1] == "{bad"
    strict = decode_checked(messages(*payloads), SCHEMA, ["device"], strict=True)
    assert strict.filter("_offset = 7").first()[ERROR] == "badly typed field"


def test_bad_elements_are_reported(messages):
    point = {"register": "r", "value": "1", "unit": "V"}
    time = "2031-05-06T07:08:09Z"
    payloads = [
        {"device": "a", "receiveTime": time, "dataPoints": [point, {**point, "value": "much"}]},
        {"device": "a", "receiveTime": time, "dataPoints": []},
        {"device": "a", "dataPoints": [point]},
        {"device": "a", "receiveTime": time},
        {"device": "a", "receiveTime": time, "dataPoints": point},
        {"device": "a", "receiveTime": time, "dataPoints": [None, {**point, "value": 2.5}]},
        {"device": "a", "receiveTime": "soon", "dataPoints": [point]},
    ]
    rows = feeds.checked(C.MEASUREMENT, messages(*payloads))
    assert [(row["_offset"], row["_error"], row["value"]) for row in rows.orderBy("_offset", "value").collect()] == [
        (0, "value is not float", None),
        (0, None, 1.0),
        (2, "missing receiveTime", 1.0),
        (3, "no array dataPoints", None),
        (4, "badly typed field", None),
        (5, "null element of dataPoints", None),
        (5, None, 2.5),
        (6, "badly typed field", 1.0),
    ]
    lenient = feeds.checked(C.MEASUREMENT, messages(*payloads), strict=False)
    errors = {row["_offset"]: row["_error"] for row in lenient.where("_offset in (4, 6)").collect()}
    assert errors == {4: "no array dataPoints", 6: "missing receiveTime"}


def test_quoted_numbers_are_numbers(messages):
    base = {"device": "a", "event": "e", "receiveTime": "2031-05-06T07:08:09Z", "persistTime": "2031-05-06T07:08:09Z"}
    counts = [5, "5", "many", None]
    source = messages(*[{**base, "occurrenceCount": count} for count in counts])
    assert [row.occurrencecount for row in feeds.events(source, meta=True).orderBy("_offset").collect()] == [5, 5, None, None]
    errors = [row["_error"] for row in feeds.checked(C.EVENT, source).orderBy("_offset").collect()]
    assert errors == [None, None, "occurrencecount is not int", None]
    facts = {"device": "a", "profile": "p", "gatheredAt": "2031-05-06T07:08:09Z", "actual": "1.5", "expected": 24}
    row = feeds.profile_facts(messages(facts)).first()
    assert (row.actual, row.expected) == (1.5, 24.0)


def test_casts_of_bad_text(spark):
    row = spark.range(1).select(
        to_number(F.lit("7.5E+1")).alias("a"),
        to_number(F.lit("bad")).alias("b"),
        to_number(F.lit("NaN")).alias("c"),
        to_instant(F.lit("2031-05-06T07:08:09.123Z")).alias("d"),
        to_instant(F.lit("soon")).alias("e"),
        default_text(F.lit(None).cast("string")).alias("f"),
        default_text(F.lit("")).alias("g"),
        default_text(F.lit(""), empty=True).alias("h"),
    )
    row = row.first()
    assert (row.a, row.b, row.e, row.f, row.g, row.h) == (75.0, None, None, "unknown", "", "unknown")
    assert row.c != row.c
    assert row.d == dt.datetime(2031, 5, 6, 7, 8, 9, 123000)


TEXT = st.text(alphabet=st.characters(exclude_categories=["Cs", "Cc"]), max_size=8)
RECORD = st.fixed_dictionaries(
    {},
    optional={
        "device": TEXT,
        "n": st.integers(-(2**31), 2**31 - 1),
        "x": st.floats(allow_nan=False, allow_infinity=False),
        "points": st.lists(st.fixed_dictionaries({"register": TEXT}, optional={"value": TEXT}), max_size=3),
    },
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RECORD, min_size=1, max_size=20))
def test_decode_gives_back_what_was_encoded(messages, records):
    rows = expand(decode(messages(*[json.dumps(record) for record in records]), SCHEMA)).orderBy("_offset").collect()
    for record, row in zip(records, rows):
        points = record.get("points")
        assert row.device == record.get("device") and row.n == record.get("n") and row.x == record.get("x")
        assert (row.points is None) == (points is None)
        assert [tuple(p) for p in row.points or []] == [(p["register"], p.get("value")) for p in points or []]
