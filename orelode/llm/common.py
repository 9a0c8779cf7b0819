"""Helpers that several operators share: staged tables, words and Arrow batches."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.session import application_folder

#: White space that separates words; everything else belongs to a word. ``bytes.split()``
#: separates at exactly these characters.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Characters that the driver keeps of the description of a write's plan. It keeps one for each of
#: the last thousand queries, and makes a new one after every stage: without a bound those of a
#: long chain of steps fill its memory.
PLAN_SETTING = "spark.sql.maxPlanStringLength"
PLAN_LENGTH = 2_048

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_048

#: Rows that are decoded at once inside a task.
SLICE_ROWS = 256


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder of this application."""
    return f"{application_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, written to the shared folder and read back.

    The lineage ends at files that every executor can read, so a lost executor costs one
    task. The shuffle files of the finished write are freed at once, and the driver keeps a short
    description of its plan. Both settings are put back.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    wanted = {CLEANUP: "true", PLAN_SETTING: str(PLAN_LENGTH)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(rows.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``staged`` which nothing reads any more."""
    for rows in tables:
        spark = rows.sparkSession
        for path in {file.rpartition("/")[0] for file in rows.inputFiles()}:
            if "/llm/" in path:
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(rows: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_ROWS``, which bound the memory of a worker
    and of the JVM beside it: texts are long. The session keeps the lower setting."""
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return rows.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces, which bound the Python objects alive at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


class Cache(dict):
    """Values by key, made when first asked for; starts anew beyond a number of keys."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make = make
        self.most = most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def once_in_worker(name: str, make):
    """What ``make`` gives, made once in each Python worker and kept for its later tasks.

    Only for what any task would make alike, as a loaded file or remembered results of a pure
    function. It hangs on the interpreter, as a module of this package would be anew in every
    task.
    """
    kept = sys.__dict__.setdefault("_orelode_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(30))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values = values ^ (values >> np.uint64(27))
        values = values * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for every run of ``width`` consecutive word hashes."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = words[:count].copy()
        for shift in range(1, width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[shift : shift + count]
    return mixed(total)


def n_words(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def covered(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """For each of ``length`` places, whether a run of ``width`` begun at a start covers it."""
    edges = np.zeros(length + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, length), -1)
    return np.cumsum(edges[:-1]) > 0


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of consecutive rows with equal values in the first columns.

    Only one group is held at a time; its size is what the caller has bounded. Single rows
    between others, which have nothing to be compared with, are left out.
    """
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts = [0, *edges.tolist()]
        for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
            if stop - start == 1 and 0 < start and stop < batch.num_rows:
                continue
            here = tuple(keys[:, start].tolist())
            if here != key and parts:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = here
            parts.append(batch.slice(start, stop - start))
    if parts:
        yield key, pa.Table.from_batches(parts)


class Forest:
    """Disjoint sets over places 0..n-1."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, place: int) -> int:
        up = self.up
        while up[place] != place:
            up[place] = up[up[place]]
            place = up[place]
        return place

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b
