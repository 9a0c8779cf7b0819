"""Writers of layer tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from orelode.session import application_folder
from orelode.sources import versions


def write_parquet(rows: DataFrame, path: str) -> DataFrame:
    """Snappy Parquet table, replaced as a whole; returns the table read back."""
    return versions.write_table(rows, path)


def write_partitioned_parquet(
    rows: DataFrame,
    path: str,
    by: Sequence[str] = ("year", "month"),
    refresh_only: bool = False,
    clustered: bool = False,
) -> DataFrame:
    """Snappy Parquet table in one folder per value of ``by``.

    ``clustered`` is for rows that already lie in partition order, which need no rebalancing.
    ``refresh_only`` replaces only the partitions present in ``rows``.
    """
    if refresh_only:
        return versions.refresh_partitions(rows, path, clustered)
    return versions.write_table(rows, path, by, clustered)


def rebuild_zone(
    rows: DataFrame, path: str, by: Sequence[str] = (), clustered: bool = False, ordered: bool = True
) -> DataFrame:
    """Full rebuild of a table: once it is written, whatever was read before is not read again.
    ``ordered`` is off for rows that lie by partition, but not in order inside a task.

    Until then, and for ever if the rebuild fails, readers see the table as it was.
    """
    return versions.write_table(rows, path, by, clustered, ordered=ordered)


def write_plain(
    rows: DataFrame, folder: str, by: Sequence[str] = (), clustered: bool = False, ordered: bool = True
) -> DataFrame:
    """Intermediate files without versions, read back with the written schema; they are written and
    read once or twice, so they are packed tighter than tables."""
    versions.write_files(rows, folder, by, clustered, compression="zstd", ordered=ordered)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Intermediate rows that several plans read, written once to a folder of their own.

    The folder lies in this application's part of the shared folder. Plans made from the rows
    read them when they run, so it stays until ``remove_folder`` or the end of the application.
    """
    folder = f"{application_folder(rows.sparkSession)}/staging/{label}-{uuid.uuid4().hex}"
    return write_plain(rows, folder)


def _folder(spark: SparkSession, path: str):
    """A folder and the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that nothing reads any more."""
    place, system = _folder(spark, path)
    system.delete(place, True)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Replaces a folder by a copy of another one, file by file; meant for small results."""
    place, system = _folder(spark, source)
    copy, target_system = _folder(spark, target)
    target_system.delete(copy, True)
    target_system.mkdirs(copy.getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        system, place, target_system, copy, False, True, spark.sparkContext._jsc.hadoopConfiguration()
    )


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another one; a source that is not there leaves an empty one."""
    place, system = _folder(spark, source)
    goal, _ = _folder(spark, target)
    system.delete(goal, True)
    if system.exists(place):
        system.mkdirs(goal.getParent())
        if not system.rename(place, goal):
            raise OSError(f"cannot move {source} to {target}")
    else:
        system.mkdirs(goal)
