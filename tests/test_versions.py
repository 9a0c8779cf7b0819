"""Tables with versions: what readers see while, before and after a table changes."""

import os

import pytest
from pyspark.sql import functions as F

from orelode.sources import sinks, versions
from support import rows


def parts(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v int, year string, month string")


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "table")


def test_a_failed_write_leaves_the_table_as_it_was(spark, path):
    before = versions.write_table(parts(spark, (1, "2026", "04")), path, ["year", "month"])
    # the third of four tasks fails, when others have written files
    broken = spark.range(0, 40, 1, 4).select(
        F.when(F.col("id") < 30, F.col("id")).otherwise(F.raise_error(F.lit("killed midway"))).cast("int").alias("v"),
        F.lit("2026").alias("year"), F.lit("04").alias("month"),
    )
    with pytest.raises(Exception, match="killed midway"):
        versions.write_table(broken, path, ["year", "month"], clustered=True)
    with pytest.raises(Exception, match="killed midway"):
        versions.refresh_partitions(broken, path, clustered=True)
    assert rows(versions.read_table(spark, path)) == rows(before) == [(1, "2026", "04")]
    assert versions.last_commit(spark, path).number == 1


def test_a_write_killed_before_its_commit_is_not_seen(spark, path, monkeypatch):
    versions.write_table(spark.range(3), path)

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        versions.write_table(spark.range(5), path)
    monkeypatch.undo()
    assert versions.read_table(spark, path).count() == 3
    # its files go after the grace period, not before
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 2
    versions.vacuum(spark, path)
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 2
    versions.vacuum(spark, path, grace_seconds=-1)
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 1
    assert versions.write_table(spark.range(5), path).count() == 5


def test_half_a_commit_file_does_not_count(spark, path):
    versions.write_table(spark.range(3), path)
    with open(f"{path}/_commits/{2:012d}", "w") as file:
        file.write('{"number": 2, "sch')
    assert versions.read_table(spark, path).count() == 3
    assert versions.write_table(spark.range(4), path).count() == 4
    assert versions.last_commit(spark, path).number == 3


def test_two_writers_cannot_both_commit(spark, path, monkeypatch):
    versions.write_table(spark.range(1), path)
    write = versions._write_version

    def overtaken(*args):
        monkeypatch.setattr(versions, "_write_version", write)
        versions.write_table(spark.range(2), path)
        return write(*args)

    monkeypatch.setattr(versions, "_write_version", overtaken)
    with pytest.raises(versions.CommitConflict):
        versions.write_table(spark.range(9), path)
    assert versions.read_table(spark, path).count() == 2


def test_a_table_can_be_written_from_itself_and_old_readers_go_on(spark, path):
    old = versions.write_table(spark.range(4), path)
    new = versions.write_table(old.withColumn("id", F.col("id") * 10), path)
    assert rows(new) == [(0,), (10,), (20,), (30,)]
    assert rows(old) == [(0,), (1,), (2,), (3,)]
    versions.write_table(spark.range(1), path)
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 2


def test_refreshing_partitions_over_several_versions(spark, path):
    versions.write_table(parts(spark, (1, "2026", "04"), (2, "2026", "05"), (3, "2026", "06")), path, ["year", "month"])
    versions.refresh_partitions(parts(spark, (9, "2026", "05")), path)
    found = versions.refresh_partitions(parts(spark, (7, "2026", "07"), (8, "2026", "04")), path)
    assert rows(found) == [(3, "2026", "06"), (7, "2026", "07"), (8, "2026", "04"), (9, "2026", "05")]
    assert dict(found.dtypes)["month"] == "string"
    text = found.filter("month = '05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text
    with pytest.raises(ValueError):
        versions.version_folder(spark, path)
    # nothing to refresh, then everything in one version again
    assert rows(versions.refresh_partitions(parts(spark, (1, "2026", "04")).limit(0), path)) == rows(found)
    whole = versions.write_table(versions.read_table(spark, path), path, ["year", "month"])
    assert rows(whole) == rows(found) and versions.version_folder(spark, path)


def test_refresh_needs_a_partitioned_table(spark, path):
    with pytest.raises(ValueError):
        versions.refresh_partitions(spark.range(1), path)
    versions.write_table(spark.range(1), path)
    with pytest.raises(ValueError):
        versions.refresh_partitions(spark.range(1), path)
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, f"{path}-none")


def test_files_from_before_the_first_commit_go(spark, path):
    spark.range(7).write.parquet(path)
    assert versions.write_table(spark.range(2), path).count() == 2
    assert {n for n in os.listdir(path) if not n.startswith("v-")} == {"_commits"}


def test_rows_and_bytes_are_observed_while_writing(spark, path):
    frame = spark.createDataFrame([(1, "abc", None), (2, "é", ["x"])], "a int, b string, c array<string>")
    versions.write_table(frame, path)
    commit = versions.last_commit(spark, path)
    assert (commit.rows, commit.wide_bytes) == (2, 3 + 2 + len("[x]"))
    versions.write_table(frame.limit(0), path)
    assert versions.recorded_rows(spark, path) == 0
    assert versions.read_table(spark, path).count() == 0
    by = versions.write_table(spark.range(1000).withColumn("p", F.col("id") % 3), path, ["p"])
    assert versions.recorded_rows(spark, path) == 1000 == by.count()
    assert versions.recorded_rows(spark, f"{path}-none") is None


def test_a_rebuilt_zone_is_a_table_with_versions(spark, path):
    sinks.rebuild_zone(spark.range(3), path)
    assert sinks.rebuild_zone(spark.range(1), path).count() == 1
    assert versions.last_commit(spark, path).number == 2


def test_rows_of_many_partitions_in_any_order_are_written_side_by_side(spark, path, monkeypatch):
    """More partitions than are open at once; the others are sorted, and the session stays as it was."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    enter = versions._open_partitions

    def watched(session, number):
        seen.append(number)
        return enter(session, number)

    monkeypatch.setattr(versions, "_open_partitions", watched)
    monkeypatch.setattr(versions, "OPEN_PARTITIONS", 3)
    before = spark.conf.get(name)
    data = spark.range(0, 200, 1, 2).selectExpr("id", "lpad(string(id % 10), 2, '0') AS month")
    table = versions.write_table(data, path, ["month"], clustered=True, ordered=False)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, data.collect()))
    assert seen == [3] and spark.conf.get(name) == before
