"""Documents of changing shape, distinct counts from stored bitmaps, typed graph files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wheelhouse.operators.distinct import bitmaps, counted, merged
from wheelhouse.plans import graph
from wheelhouse.sinks.graph import write_graph
from wheelhouse.sources.variants import WEATHER_FIELDS, Field, parted, typed_documents

FIELDS = {"a": Field(("$.a", "$.old.a"), "int"), "b": Field(("$.b",), "string", required=False)}


def found(spark, *texts, fields=FIELDS):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, value string")
    return [tuple(r)[2:] for r in sorted(typed_documents(df, "value", fields).collect(), key=lambda r: r.i)]


def test_shapes_and_faults(spark):
    got = found(
        spark,
        '{"a": 1, "b": "x"}', '{"old": {"a": "2"}}', '{"a": null, "old": {"a": 3}}', '{"a": "one"}', '{"b": "x"}', "{", None, "[1, 2]", "7", '{"a": 3000000000}', "",
    )
    assert got == [
        (1, "x", []), (2, None, []), (3, None, []), (None, None, ["a: not a int"]), (None, "x", ["a: missing"]),
        (None, None, ["unreadable"]), (None, None, ["unreadable"]), (None, None, ["a: missing"]), (None, None, ["a: missing"]), (None, None, ["a: not a int"]), (None, None, ["unreadable"]),
    ]


def test_every_document_is_in_one_part(spark):
    df = spark.createDataFrame([('{"a": 1}', 9), ("x", 9), (None, 9)], "value string, a int")  # a column named like a field
    good, bad = parted(typed_documents(df, "value", FIELDS))
    assert [r.a for r in good.collect()] == [1] and "faults" not in good.columns
    assert sorted(r.faults[0] for r in bad.collect()) == ["unreadable", "unreadable"]
    assert typed_documents(df.limit(0), "value", FIELDS).count() == 0


def test_weather_paths(spark):
    new = '{"place": {"zip": "2000"}, "observed": "17", "sky": "Rain", "temperature": {"kelvin": 280}, "humidity": 3}'
    old = '{"zipCode": "2000", "dt": 17, "weather": [{"main": "Rain"}], "main": {"temp": 280.0}}'
    assert found(spark, new, old, fields=WEATHER_FIELDS) == [("2000", 17, "Rain", 280.0, 3, []), ("2000", 17, "Rain", 280.0, None, [])]


def test_merged_days_equal_a_recount(spark, rows):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int"))
    users = F.when(F.col("id") % 11 > 0, (F.col("id") * F.col("id")) % 100_003)
    events = spark.range(20_000).select(day.alias("day"), users.alias("user"), F.lit("x").alias("kind"))
    stored = bitmaps(events, ["day", "kind"], "user")
    for by in (["day"], ["kind"], ["day", "kind"]):
        wanted = events.groupBy(*by).agg(F.count_distinct("user").alias("distinct"))
        assert rows(counted(stored, by)) == rows(wanted)
    whole = merged(stored, ["kind"])
    assert whole.count() <= 4 and rows(counted(whole, ["kind"])) == rows(counted(stored, ["kind"]))


def test_bitmaps_of_odd_values(spark, rows):
    df = spark.createDataFrame([("a", 0), ("a", 32768), ("a", 32769), ("a", None), ("a", 2**40), ("a", 0), ("a", -5), ("b", None)], "k string, v long")
    assert rows(counted(bitmaps(df, ["k"], "v"), ["k"])) == [("a", 5)]


def test_graph_files_keep_types(spark, tmp_path):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5)
    base = spark.createDataFrame(
        [(1, start, end, 7, "S7", 3, "a@b", "Ghent", 11, 12), (2, start, None, 7, "S7", 3, "a@b", "Ghent", 11, None)],
        "ride_id long, start_time timestamp_ntz, end_time timestamp_ntz, vehicle_id int, serial_number string, user_id long, email string, city string, start_station_id int, end_station_id int",
    )
    stations = spark.createDataFrame([(11, "Road", "North", "5", "9000"), (12, "Lane", "North", None, "9001")], "station_id int, street string, district string, number string, zipcode string")
    written = write_graph(graph.nodes(base, stations), graph.edges(base, stations), str(tmp_path / "g"))
    nodes = {r.id: r.p for r in spark.read.schema("id string, properties variant").json(written["nodes"]).select("id", F.to_json("properties").alias("p")).collect()}
    assert nodes == {
        "d-North": '{"name":"North"}',
        "s-11": '{"name":"Road 5","stationId":11,"zipcode":"9000"}',
        "s-12": '{"name":"Lane","stationId":12,"zipcode":"9001"}',
        "u-3": '{"city":"Ghent","email":"a@b","userId":3}',
        "v-7": '{"serialNumber":"S7","vehicleId":7}',
        "r-1": '{"duration":300,"endTime":"2024-01-01 00:05:00","rideId":1,"startTime":"2024-01-01 00:00:00"}',
        "r-2": '{"duration":null,"endTime":null,"rideId":2,"startTime":"2024-01-01 00:00:00"}',
    }
    kinds = spark.read.schema("id string, properties variant").json(written["nodes"]).where("id in ('s-11', 'r-1')")
    assert {r[0] for r in kinds.select(F.schema_of_variant("properties")).collect()} >= {"OBJECT<name: STRING, stationId: BIGINT, zipcode: STRING>"}
    edges = spark.read.schema("id string, type string, startNode string, endNode string, properties variant").json(written["relationships"])
    assert edges.count() == 9 and {r[0] for r in edges.select(F.to_json("properties")).collect()} == {"{}"}
