from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import executed, optimized, tuples
from wattline import contracts as C
from wattline.contracts import Table
from wattline.operators import audit, joins, keyed, project
from wattline.operators.conform import check_contract, conform

NESTED = "id int, a struct<x: int, b: struct<y: int, `group`: string>>, c struct<x: int>"


@pytest.fixture
def nested(spark):
    return spark.createDataFrame([(1, (2, (3, "g")), (4,))], NESTED)


def test_flatten_keeps_paths_of_repeated_names(nested):
    flat = project.flatten(nested)
    assert flat.columns == ["id", "a_x", "y", "group", "c_x"]
    assert tuple(flat.first()) == (1, 2, 3, "g", 4)


def test_pick_and_siblings(nested):
    assert tuple(project.pick(nested, {"g": "a.b.group"}, keep=["id"]).first()) == (1, "g")
    sides = project.expand_siblings(nested, {"a": "a_", "c": "c_"}, keep=["id"])
    assert sides.columns == ["id", "a_x", "a_b", "c_x"]
    with pytest.raises(ValueError, match="share a name: x"):
        project.expand_siblings(nested, {"a": "", "c": ""})


def test_explode(spark):
    rows = spark.createDataFrame([(1, [7, None]), (2, []), (3, None)], "id int, xs array<int>")
    assert tuples(project.explode_rows(rows, "xs", "x", position="n").drop("xs")) == [(1, 0, 7), (1, 1, None)]
    outer = project.explode_rows(rows, "xs", "x", outer=True)
    assert tuples(outer.drop("xs")) == [(1, 7), (1, None), (2, None), (3, None)]


def test_element_columns_and_parallel_arrays(spark):
    rows = spark.createDataFrame([(1, [(1, "a"), (2, "b")])], "id int, es array<struct<n: int, s: string>>")
    elements = project.element_columns(project.explode_rows(rows, "es").drop("es"))
    assert tuples(elements) == [(1, 1, "a"), (1, 2, "b")]
    assert tuple(project.parallel_arrays(rows, "es", {"ns": "n", "ss": "s"}).first()) == (1, [1, 2], ["a", "b"])


def test_names(spark):
    rows = spark.createDataFrame([(1, 2)], "aB int, C int")
    assert project.lower_names(rows).columns == ["ab", "c"]
    assert project.rename(rows, {"aB": "x"}).columns == ["x", "C"]
    with pytest.raises(ValueError, match="no such columns"):
        project.rename(rows, {"nope": "x"})
    assert project.rename(rows, {"nope": "x"}, strict=False).columns == ["aB", "C"]
    with pytest.raises(ValueError, match="share a name"):
        project.rename(rows, {"aB": "c"})


def test_drop_reaches_into_structs(nested):
    dropped = project.drop(nested, "a.x", "c", "id")
    assert dropped.schema.simpleString() == "struct<a:struct<b:struct<y:int,group:string>>>"
    assert project.drop(nested, "a.b.y").schema["a"].dataType["b"].dataType.names == ["group"]


def test_require_and_split_change(spark):
    schema = "t int, previous struct<s: string>, current struct<s: string>"
    rows = spark.createDataFrame([(1, None, ("a",)), (2, ("b",), ("c",))], schema)
    assert project.require(rows, "previous").count() == 1
    split = project.split_change(rows, {"status": "s"}, keep=["t"])
    assert tuples(split) == [(1, None, "a"), (2, "b", "c")]


CONTRACT = Table("t", "k string, n int, d double, at timestamp", partition=("k",))


def test_conform_fits_types_and_order(spark):
    rows = spark.createDataFrame([("1.5", "x", "7"), ("z", None, None)], "d string, k string, n string")
    fitted = conform(rows, CONTRACT)
    assert fitted.schema.simpleString() == "struct<k:string,n:int,d:double,at:timestamp>"
    assert tuples(fitted) == [("x", 7, 1.5, None), (None, None, None, None)]
    errors = {row.k: row["_error"] for row in conform(rows, CONTRACT, errors=True).collect()}
    assert errors == {"x": None, None: "d is not double"}


def test_contract_violations_are_found_before_any_query(spark):
    with pytest.raises(ValueError, match="key columns missing from the frame: lastreceivetime"):
        check_contract(spark.createDataFrame([("a", 1)], "device string, lasttelemetry int"), C.TELEMETRY.table)
    with pytest.raises(ValueError, match="unknown to the table: extra"):
        check_contract(spark.createDataFrame([("a", 1)], "k string, extra int"), CONTRACT)


def skewed(spark, n=3000):
    """One key holds a third of all rows, another third is spread thin; some values are null."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}" if i % 3 == 1 else f"u{i}"
        rows.append((key, rng.randrange(50), i, rng.choice([None, rng.randrange(9)]), rng.choice([None, "s", "t"])))
    return rows, spark.createDataFrame(rows, "k string, at int, seq int, v int, s string").repartition(6)


def test_latest_against_brute_force(spark):
    rows, frame = skewed(spark)
    whole, present = {}, {}
    for key, at, seq, v, s in sorted(rows, key=lambda r: (r[1], r[2])):
        whole[key] = (key, at, seq, v, s)
        old = present.get(key, (key, at, seq, None, None))
        present[key] = (key, at, seq, old[3] if v is None else v, old[4] if s is None else s)
    assert tuples(keyed.latest(frame, ["k"], ["at", "seq"], C.OVERWRITE)) == sorted(whole.values(), key=repr)
    assert tuples(keyed.latest(frame, ["k"], ["at", "seq"], C.KEEP)) == sorted(present.values(), key=repr)


def test_latest_reduces_before_the_shuffle(spark):
    _, frame = skewed(spark, 30)
    for nulls in (C.KEEP, C.OVERWRITE):
        plan = executed(keyed.latest(frame, ["k"], ["at", "seq"], nulls))
        assert plan.count("partial_max") >= 1 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_top_newest_against_brute_force(spark, n):
    rows, frame = skewed(spark, 6000)
    expected = []
    for key in {row[0] for row in rows}:
        newest = sorted((row for row in rows if row[0] == key), key=lambda r: (r[1], r[2]), reverse=True)
        expected += newest[:n]
    top = keyed.top_newest(frame, ["k"], ["at", "seq"], n, salts=4)
    assert tuples(top) == sorted(expected, key=repr)
    assert optimized(top).count("Window [row_number") == 2  # one plan for every n


def test_newest_first_order(spark):
    _, frame = skewed(spark, 300)
    rows = [(row.k, -row.at) for row in keyed.newest_first(frame, ["k"], ["at"]).collect()]
    assert rows == sorted(rows)


def test_slice_prunes_directories(spark, scratch):
    frame = spark.range(100).select("id", F.expr("date'2024-01-01' + cast(id % 5 as int)").alias("d"))
    frame.write.partitionBy("d").parquet(f"{scratch}/t")
    day = keyed.slice_by(spark.read.parquet(f"{scratch}/t"), d=dt.date(2024, 1, 2))
    assert day.count() == 20
    assert "PartitionFilters: [isnotnull(d" in executed(day)


def test_filters_reach_the_scan(spark, scratch):
    spark.createDataFrame([("a", 1)], "device string, Value int").write.parquet(f"{scratch}/t")
    rows = project.lower_names(spark.read.parquet(f"{scratch}/t")).filter("device = 'a'").select("device")
    assert "EqualTo(device,a)" in executed(rows) and "ReadSchema: struct<device:string>" in executed(rows)


def test_key_collisions(spark):
    rows, frame = skewed(spark)
    counted = audit.key_collisions(frame, {"k": ["k"], "ks": ["s", "k"]})
    report = {row.table: tuple(row)[1:] for row in counted.collect()}
    for name, pick in (("k", lambda r: r[0]), ("ks", lambda r: (r[0], r[4]))):
        counts = {}
        for row in rows:
            counts[pick(row)] = counts.get(pick(row), 0) + 1
        kept = len(counts)
        assert report[name] == (len(rows), kept, len(rows) - kept, max(counts.values()))
    empty = audit.key_collisions(frame.filter("seq < 0"), {"k": ["k"]})
    assert tuple(empty.first()) == ("k", 0, 0, 0, 0)


def test_readings_of_one_message_collide_and_every_message_is_counted(messages):
    points = [{"register": f"r{n}", "value": n} for n in range(5)]
    time = "2031-08-09T10:11:12.5Z"
    payloads = [
        {"device": "meter 1", "receiveTime": time, "dataPoints": points},
        "{bad",
        {"device": "meter 2", "receiveTime": time},
        {"device": "meter 2", "receiveTime": time, "dataPoints": {"register": "r0"}},
        {"device": "meter 3", "receiveTime": time, "dataPoints": []},
        {"device": "meter 4", "receiveTime": time, "dataPoints": [None, {"register": "r1", "value": "low"}, points[1]]},
    ]
    report = audit.reconcile(C.MEASUREMENT, messages(*payloads)).first().asDict()
    assert report == {
        "feed": "device-measurement", "messages": 6, "dead_letters": 3, "messages_without_rows": 1,
        "messages_with_rows": 2, "rows_out": 8, "rows_rejected": 2, "rows_writable": 6, "rows_kept_by_key": 1,
    }


def test_what_a_table_lacks_is_counted_by_date(spark, messages):
    from wattline import feeds

    payloads = [
        {"device": d, "event": "e", "receiveTime": f"2031-01-0{n}T00:00:00Z", "persistTime": f"2031-01-0{n}T01:00:00Z"}
        for n in (1, 2) for d in "abc"
    ]
    source = messages(*payloads, *payloads[:2], "{bad")
    written = feeds.events(source).where("not (device = 'b' and current_date = date'2031-01-02')")
    key = C.EVENT.history_key
    assert tuples(audit.reconcile_written(C.EVENT, source, written, key)) == [
        (dt.date(2031, 1, 1), 3, 3, 0), (dt.date(2031, 1, 2), 3, 2, 1),
    ]


def test_joins_emit_every_pair_and_no_null_keys(spark):
    versions = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "device string, v int")
    readings = spark.createDataFrame([("a", i) for i in range(90)] + [("c", 1), (None, 2)], "device string, r int")
    plain = joins.join_versions(versions, readings, "device")
    assert plain.count() == 180
    assert tuples(joins.join_versions(versions, readings, "device", salts=7)) == tuples(plain)
    state = joins.join_state(readings, versions.filter("v <> 2"), "device", how="left")
    assert state.count() == 92 and state.filter("v is not null").count() == 90


def test_full_outer_equals_sparks_own(spark):
    rng = random.Random(3)

    def side(name):
        keys = [rng.choice([None, "hot", f"k{rng.randrange(30)}"]) for _ in range(60)]
        rows = [(key, rng.randrange(2), i) for i, key in enumerate(keys)]
        return spark.createDataFrame(rows, f"k string, j int, {name} int")

    left, right = side("l"), side("r")
    for on, other in ((["k"], right.drop("j")), (["k", "j"], right)):
        mine = joins.full_outer(left, other, on, hot_keys=True)
        theirs = joins.full_outer(left, other, on).select(*mine.columns)
        assert tuples(mine) == tuples(theirs)
        assert optimized(mine).count("Join ") == 2


def test_bounded_join_condition(spark):
    t = dt.datetime
    versions = spark.createDataFrame([("a", t(2024, 1, 1)), ("a", t(2024, 1, 5))], "device string, p timestamp")
    readings = spark.createDataFrame([("a", t(2024, 1, d)) for d in (1, 2, 3, 7)], "device string, r timestamp")
    joined = joins.join_versions_within(
        versions, readings, "device", version_time="p", reading_time="r", within="2 days", lateness="1 hour", salts=3
    )
    assert [(row.p.day, row.r.day) for row in joined.orderBy("p", "r").collect()] == [(1, 1), (1, 2), (1, 3), (5, 7)]
    assert joined.columns == ["device", "p", "r"]
