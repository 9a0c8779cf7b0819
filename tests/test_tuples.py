"""Distinct rows in buckets, and deliveries that are added to them."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from orelode.operators import tuples
from orelode.sources import versions
from support import rows

NAMES = ["a", "b"]
SCHEMA = "a string, b string, ingestion_date string"


def expected(*deliveries):
    found = {}
    for a, b, date in [row for rows_ in deliveries for row in rows_]:
        copies, last = found.get((a, b), (0, None))
        found[a, b] = (copies + 1, max((d for d in (last, date) if d is not None), default=None))
    return sorted(((*key, *value) for key, value in found.items()), key=repr)


FIRST = [("1", "x", "d1"), ("1", "x", "d1"), ("2", None, "d1"), (None, None, None), ("3", "", "d0")]
SECOND = [("1", "x", "d2"), ("2", None, "d0"), (None, None, "d2"), ("4", "y", "d2"), ("4", "y", "d2")]


def test_deliveries_add_up(spark, tmp_path):
    path = str(tmp_path / "t")
    table = tuples.write_tuples(spark.createDataFrame(FIRST, SCHEMA), path, 4, NAMES)
    assert rows(table.drop("tuple_hash")) == expected(FIRST)
    after = tuples.add_delivery(path, spark.createDataFrame(SECOND, SCHEMA), NAMES)
    assert rows(after.drop("tuple_hash")) == expected(FIRST, SECOND)
    third = tuples.add_delivery(path, spark.createDataFrame([], SCHEMA), NAMES)
    assert rows(third.drop("tuple_hash")) == expected(FIRST, SECOND)
    assert versions.recorded_rows(spark, path) == 5


def test_only_the_delivery_travels(spark, tmp_path):
    path = str(tmp_path / "t")
    table = tuples.write_tuples(spark.createDataFrame(FIRST * 100, SCHEMA), path, 4, NAMES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = tuples.merged_tuples(table, spark.createDataFrame(SECOND, SCHEMA), 4, NAMES)
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the delivery is reduced and placed; the table is read in its buckets
    assert "SelectedBucketsCount: 4 out of 4" in text
    above = text[: text.index("SelectedBucketsCount")].splitlines()
    left = above[max(i for i, line in enumerate(above) if "SortMergeJoin" in line) :]
    assert not any("Exchange" in line for line in left)


def test_equal_hashes_of_different_rows_stay_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tuples, "tuple_hash", lambda columns: F.lit(7).cast("bigint").alias(tuples.HASH))
    path = str(tmp_path / "t")
    tuples.write_tuples(spark.createDataFrame(FIRST, SCHEMA), path, 2, NAMES)
    after = tuples.add_delivery(path, spark.createDataFrame(SECOND, SCHEMA), NAMES)
    assert rows(after.drop("tuple_hash")) == expected(FIRST, SECOND)


def test_a_hot_row_is_reduced_before_it_travels(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.lit("b").alias("b"), F.concat(F.lit("d"), F.col("id") % 4).alias("ingestion_date"),
    )
    found = tuples.tuples_of(frame.repartition(6), NAMES)
    assert found.filter("a = 'hot'").collect()[0][2:] == (10_000, "d3")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(a.*\n.*partial_count", text) and "SortAggregate" not in text


def test_buckets_are_found_by_a_session_without_the_entry(spark, tmp_path):
    path = str(tmp_path / "it's")
    tuples.write_tuples(spark.createDataFrame(FIRST, SCHEMA), path, 3, NAMES)
    folder = versions.last_commit(spark, path).parts[0].folder
    spark.sql(f"DROP TABLE {versions._entry(folder)}")
    again = versions.read_table(spark, path)
    assert rows(again.drop("tuple_hash")) == expected(FIRST)
    assert "Exchange" not in again.groupBy("tuple_hash").count()._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path + "-none")


def test_rows_travel_to_their_buckets_once_and_hot_ones_are_added_up_before(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.lit("b").alias("b"), F.concat(F.lit("d"), F.col("id") % 4).alias("ingestion_date"),
    )
    placed = tuples.placed_tuples(frame.repartition(6), 4, NAMES)
    assert rows(placed.drop("tuple_hash")) == rows(tuples.tuples_of(frame, NAMES))
    again = placed.repartition(4, "tuple_hash").sortWithinPartitions("tuple_hash")
    text = again._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(tuple_hash") == 1
    # the hot ones alone are added up before
    assert len(re.findall(r"Exchange hashpartitioning\(a", text)) == 1


def test_buckets_are_more_where_they_would_be_large():
    assert tuples.bucket_count(None, 8) == tuples.bucket_count(1000, 8) == 8
    assert tuples.bucket_count(216_000_001, 8) == 433


@pytest.mark.parametrize("query, table", [("merged_tuples", "merged_tuples"), ("fact_persistent_id", "sale_ids")])
def test_queries_take_more_buckets_for_more_rows(lake, monkeypatch, query, table):
    monkeypatch.setattr(tuples, "BUCKET_ROWS", 500)
    assert registry.OPERATORS[query](lake).count() > 5_000
    assert versions.last_commit(lake.spark, lake.scratch(table)).buckets > 8


@pytest.mark.parametrize("words", [tuples.MARK_WORDS, 1])
def test_rows_that_no_other_repeats_stay_where_they_are(spark, monkeypatch, words):
    monkeypatch.setattr(tuples, "MARK_WORDS", words)  # with one word, many share a bit by chance
    many = [(str(i), "x" if i % 3 else None, "d1") for i in range(300)]
    given = FIRST + SECOND + many
    found = tuples.distinct_tuples(spark.createDataFrame(given, SCHEMA), NAMES)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == expected(given)
    # the rows that may be repeated are the only ones to be shuffled, after the marks were asked
    assert text.count("Exchange hashpartitioning(a") == 1
    assert "getbit" in text[text.index("Exchange hashpartitioning(a") :]
    assert rows(tuples.distinct_tuples(spark.createDataFrame([], SCHEMA), NAMES)) == []
