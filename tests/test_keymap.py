"""Ids that outlast the builds of the table they number."""

import re

from pyspark.sql import functions as F

from orelode.operators.keymap import persistent_ids
from orelode.sources import versions

SCHEMA = "a int, b string, day string"


def order():
    return [F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()]


def build(spark, tmp_path, data, number):
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    found = persistent_ids(frame, ["a", "b"], order(), str(tmp_path / "map"), str(tmp_path / f"s{number}"), 4, "id", ["day"])
    assert found.columns == ["a", "b", "day", "id"]
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[3])


def test_known_lines_keep_their_ids(spark, tmp_path):
    first = build(spark, tmp_path, [(2, "x", "d1"), (1, "y", "d1"), (None, None, "d1")], 0)
    assert first == [(1, "y", "d1", 1), (2, "x", "d1", 2), (None, None, "d1", 3)]
    # a line before all others, one delivered again, one gone
    second = build(spark, tmp_path, [(0, "z", "d2"), (2, "x", "d2"), (None, None, "d1"), (9, None, "d2")], 1)
    assert second == [(2, "x", "d2", 2), (None, None, "d1", 3), (0, "z", "d2", 4), (9, None, "d2", 5)]
    # it comes back, and nothing is new
    third = build(spark, tmp_path, [(1, "y", "d3"), (0, "z", "d2")], 2)
    assert third == [(1, "y", "d3", 1), (0, "z", "d2", 4)]
    assert versions.recorded_rows(spark, str(tmp_path / "map")) == 5


def test_equal_lines_have_an_id_each(spark, tmp_path):
    first = build(spark, tmp_path, [(1, "x", "d1"), (1, "x", "d2")], 0)
    assert first == [(1, "x", "d1", 1), (1, "x", "d2", 2)]
    second = build(spark, tmp_path, [(1, "x", "d2"), (1, "x", "d1"), (1, "x", "d3"), (0, "w", "d3")], 1)
    assert second == [(1, "x", "d1", 1), (1, "x", "d2", 2), (0, "w", "d3", 3), (1, "x", "d3", 4)]
    assert build(spark, tmp_path, [], 2) == []


def test_the_map_does_not_travel(spark, tmp_path):
    build(spark, tmp_path, [(i, "x", "d1") for i in range(50)], 0)
    frame = spark.createDataFrame([(i, "x", "d2") for i in range(60)], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = persistent_ids(frame, ["a", "b"], order(), str(tmp_path / "map"), str(tmp_path / "t"), 4, "id")
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = text[text.index("SortMergeJoin") :]
    right = side[side.rindex("SelectedBucketsCount") - 2000 :]
    assert "SelectedBucketsCount: 4 out of 4" in right
    # the lines are placed by hash once; no exchange stands above the scan of the map
    assert len(re.findall(r"Exchange hashpartitioning\(key_hash[^,]*, 4\)", text)) == 1


def test_lines_travel_once_for_their_number_and_their_id(spark, tmp_path):
    """The buckets of the map hold the rows of a key together: telling its copies apart moves none again."""
    data = [(i % 30, "x", f"d{i}") for i in range(90)]
    build(spark, tmp_path, data, 0)
    frame = spark.createDataFrame(data, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = persistent_ids(frame, ["a", "b"], order(), str(tmp_path / "map"), str(tmp_path / "t"), 4, "id", ["day"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    expected = {(a, day): 3 * a + copy + 1 for a in range(30) for copy, day in enumerate(sorted(f"d{i}" for i in range(a, 90, 30)))}
    assert {(r["a"], r["day"]): r["id"] for r in found.collect()} == expected
