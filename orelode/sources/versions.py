"""Tables that change by commits: a reader sees the last whole version, never a part of one.

A table is a folder. Every write goes to a version folder of its own inside it; a commit file, made
when all files are written, names the versions that make up the table. A write that is killed, at
whatever moment, leaves the table as it was, and two writers cannot both make the next commit.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"
VERSION = "v-"
# Types whose values take a known number of bytes; the others are measured.
FIXED_WIDTH = ("int", "bigint", "double", "date", "boolean", "smallint", "tinyint", "float", "decimal", "timestamp")

# Partitions that a task writes side by side; only the rows of further ones are sorted by partition.
OPEN_PARTITIONS = 32


class CommitConflict(RuntimeError):
    """Another writer has committed since this one looked."""


@dataclass(frozen=True)
class Part:
    """A version folder and the partitions of it that count; None stands for all."""

    folder: str
    partitions: list[str] | None = None


@dataclass(frozen=True)
class Commit:
    """What a table consists of. ``rows`` and ``wide_bytes``, those of columns without a fixed
    width, were observed while the rows were written; None where they are not known."""

    number: int
    schema: str
    by: list[str]
    parts: list[Part]
    rows: int | None
    wide_bytes: int | None
    buckets: int | None = None
    bucket_column: str | None = None


# --- files ------------------------------------------------------------------------------


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list:
    place, system = _place(spark, path)
    return list(system.listStatus(place)) if system.exists(place) else []


def _read(spark: SparkSession, path: str) -> str:
    place, system = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file; it is an error if there is one of this name."""
    place, system = _place(spark, path)
    stream = system.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders below a version, as paths relative to it."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{above}/{child.getPath().getName()}".lstrip("/")
            for above in found
            for child in _children(spark, f"{folder}/{above}")
            if child.isDirectory() and "=" in child.getPath().getName()
        ]
    return found


# --- commits ----------------------------------------------------------------------------


def commit_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all commit files, whole or not, rising."""
    names = [child.getPath().getName() for child in _children(spark, f"{path}/{COMMITS}")]
    return sorted(int(name) for name in names if name.isdigit())


def _commit_file(path: str, number: int) -> str:
    return f"{path}/{COMMITS}/{number:012d}"


def read_commit(spark: SparkSession, path: str, number: int) -> Commit | None:
    """A commit, or None if its file was not finished."""
    try:
        values = json.loads(_read(spark, _commit_file(path, number)))
        return Commit(**{**values, "parts": [Part(**part) for part in values["parts"]]})
    except (ValueError, TypeError, KeyError):
        return None


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    for number in reversed(commit_numbers(spark, path)):
        found = read_commit(spark, path, number)
        if found is not None:
            return found
    return None


def _commit(spark: SparkSession, path: str, base: int, **content) -> Commit:
    """The next commit after ``base``. The file of its number can be made once only."""
    made = Commit(number=base + 1, **content)
    try:
        _create(spark, _commit_file(path, made.number), json.dumps(asdict(made)))
    except Exception as error:
        if made.number in commit_numbers(spark, path):
            raise CommitConflict(f"commit {made.number} of {path} was made by another writer") from error
        raise
    return made


def _last_number(spark: SparkSession, path: str) -> int:
    return max(commit_numbers(spark, path), default=0)


# --- writing ----------------------------------------------------------------------------


@contextmanager
def _open_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """So many partitions are written side by side; 0 sorts rows by partition unless they are in order."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(number))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_files(
    rows: DataFrame,
    folder: str,
    by: Sequence[str] = (),
    clustered: bool = False,
    compression: str = "snappy",
    ordered: bool = True,
) -> None:
    """Parquet files, Snappy unless told otherwise, one folder per value of ``by``.

    Rows are rebalanced on the partition columns first, so that a partition gets a few files of a
    good size instead of one per task, and a partition that holds a third of the rows is split
    between tasks. ``clustered`` skips this for rows that already lie in partition order; if these
    are not ``ordered`` inside a task, it writes its few partitions side by side instead of sorting rows.
    """
    placed = rows.hint("rebalance", *by) if by and not clustered else rows
    writer = placed.write.mode("overwrite").option("compression", compression)
    with _open_partitions(rows.sparkSession, 0 if ordered else OPEN_PARTITIONS):
        (writer.partitionBy(*by) if by else writer).parquet(folder)


def _wide_bytes(rows: DataFrame) -> Column:
    wide = [name for name, kind in rows.dtypes if not kind.startswith(FIXED_WIDTH)]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in wide]
    total = F.lit(0).cast("long")
    for size in sizes:
        total = total + size
    return F.coalesce(F.sum(total), F.lit(0))


def _write_version(
    rows: DataFrame, path: str, by: Sequence[str], clustered: bool, ordered: bool = True
) -> tuple[str, dict]:
    """A new version folder and what was observed of its rows while they were written."""
    folder = f"{VERSION}{uuid.uuid4().hex}"
    seen = Observation()
    placed = rows.hint("rebalance", *by) if by and not clustered else rows
    # observed behind the shuffle, in the tasks that write
    placed = placed.observe(seen, F.count(F.lit(1)).alias("rows"), _wide_bytes(rows).alias("wide_bytes"))
    write_files(placed, f"{path}/{folder}", by, clustered=True, ordered=ordered or not clustered)
    return folder, seen.get


def write_table(
    rows: DataFrame, path: str, by: Sequence[str] = (), clustered: bool = False, keep: int = 2, ordered: bool = True
) -> DataFrame:
    """Replaces a table as a whole and returns it; ``clustered`` and ``ordered`` as in ``write_files``.

    The rows may come from the table itself. Of the earlier versions the last ``keep`` - 1 stay, for
    queries that are reading them.
    """
    spark = rows.sparkSession
    base = _last_number(spark, path)
    folder, seen = _write_version(rows, path, by, clustered, ordered)
    _commit(
        spark, path, base, schema=rows.schema.json(), by=list(by), parts=[Part(folder)],
        rows=seen["rows"], wide_bytes=seen["wide_bytes"],
    )
    vacuum(spark, path, keep)
    return read_table(spark, path)


def write_buckets(rows: DataFrame, path: str, column: str, buckets: int, keep: int = 2) -> DataFrame:
    """Replaces a table by one whose rows lie in buckets of a column's hash, sorted by it.

    Plans that group or join by this column find the rows where they need them and shuffle none.
    Spark keeps such a layout in its catalog, so the version has an entry there, made anew by
    ``read_table`` in a session that does not have it.
    """
    spark = rows.sparkSession
    base = _last_number(spark, path)
    folder = f"{VERSION}{uuid.uuid4().hex}"
    seen = Observation()
    # the writer of buckets sorts their rows by itself
    placed = rows.repartition(buckets, column).observe(seen, F.count(F.lit(1)).alias("rows"), _wide_bytes(rows).alias("wide_bytes"))
    writer = placed.write.format("parquet").option("compression", "snappy").option("path", f"{path}/{folder}")
    writer.bucketBy(buckets, column).sortBy(column).saveAsTable(_entry(folder))
    _commit(
        spark, path, base, schema=rows.schema.json(), by=[], parts=[Part(folder)], rows=seen.get["rows"],
        wide_bytes=seen.get["wide_bytes"], buckets=buckets, bucket_column=column,
    )
    vacuum(spark, path, keep)
    return read_table(spark, path)


def _entry(folder: str) -> str:
    """Name of a version in the catalog; versions have names of their own wherever they lie."""
    return "bucketed_" + folder.removeprefix(VERSION)


def _bucketed(spark: SparkSession, path: str, commit: Commit) -> DataFrame:
    folder = commit.parts[0].folder
    fields = StructType.fromJson(json.loads(commit.schema)).fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    place = f"{path}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_entry(folder)} ({columns}) USING parquet CLUSTERED BY "
        f"(`{commit.bucket_column}`) SORTED BY (`{commit.bucket_column}`) INTO {commit.buckets} BUCKETS "
        f"LOCATION '{place}'"
    )
    return spark.table(_entry(folder))


def refresh_partitions(rows: DataFrame, path: str, clustered: bool = False, keep: int = 2) -> DataFrame:
    """Replaces the partitions that occur in ``rows``; the others stay where they are.

    The new commit names the new version and what is left of the earlier ones. Rows are matched to
    the table's columns by name.
    """
    spark = rows.sparkSession
    base = last_commit(spark, path)
    if base is None or not base.by:
        raise ValueError(f"{path} is no partitioned table")
    number = _last_number(spark, path)
    rows = rows.select(*[f"`{name}`" for name in StructType.fromJson(json.loads(base.schema)).names])
    folder, _ = _write_version(rows, path, base.by, clustered)
    fresh = _partitions(spark, f"{path}/{folder}", len(base.by))
    parts = [Part(folder, fresh)] if fresh else []
    for part in base.parts:
        held = part.partitions
        if held is None:
            held = _partitions(spark, f"{path}/{part.folder}", len(base.by))
        left = sorted(set(held) - set(fresh))
        if left:
            parts.append(Part(part.folder, left))
    _commit(
        spark, path, number, schema=base.schema, by=base.by, parts=parts or [Part(folder)], rows=None, wide_bytes=None
    )
    vacuum(spark, path, keep)
    return read_table(spark, path)


def vacuum(spark: SparkSession, path: str, keep: int = 2, grace_seconds: float = 86_400) -> None:
    """Removes what no reader needs: commits but the last ``keep``, versions that only these name,
    and, after ``grace_seconds``, versions that no commit names, whose writers have failed."""
    whole = [commit for n in commit_numbers(spark, path) if (commit := read_commit(spark, path, n))]
    kept, gone = whole[-keep:], whole[:-keep]
    named = {part.folder for commit in kept for part in commit.parts}
    once = {part.folder for commit in gone for part in commit.parts}
    now = time.time() * 1000
    for child in _children(spark, path):
        name = child.getPath().getName()
        if name == COMMITS or name in named:
            continue
        old = now - child.getModificationTime() > grace_seconds * 1000
        if name in once or old or not name.startswith(VERSION):
            spark.sql(f"DROP TABLE IF EXISTS `{_entry(name)}`")
            place, system = _place(spark, f"{path}/{name}")
            system.delete(place, True)
    for commit in gone:
        place, system = _place(spark, _commit_file(path, commit.number))
        system.delete(place, False)


# --- reading ----------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last commit, with the schema that was written ('04' stays a text)."""
    commit = last_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"{path} holds no committed table")
    if commit.buckets:
        return _bucketed(spark, path, commit)
    schema = StructType.fromJson(json.loads(commit.schema))
    whole = None
    for part in commit.parts:
        folder = f"{path}/{part.folder}"
        reader = spark.read.schema(schema).option("basePath", folder)
        places = [folder] if part.partitions is None else [f"{folder}/{p}" for p in part.partitions]
        rows = reader.parquet(*places).select(*[f"`{name}`" for name in schema.names])
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


def version_folder(spark: SparkSession, path: str) -> str:
    """The folder of the files where a commit names a single whole version, for readers by path."""
    commit = last_commit(spark, path)
    if commit is None:
        return path
    if len(commit.parts) != 1 or commit.parts[0].partitions is not None:
        raise ValueError(f"{path} consists of several versions; rewrite it first")
    return f"{path}/{commit.parts[0].folder}"


def recorded_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of the table as they were counted while it was written; no job."""
    commit = last_commit(spark, path)
    return commit.rows if commit else None
