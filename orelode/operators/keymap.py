"""Surrogate ids that stay as they are when the table they number is built again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orelode.operators.numbering import number_rows
from orelode.sources import versions
from orelode.sources.sinks import remove_folder, write_plain

HASH = "key_hash"
COPY = "key_copy"


def keyed(rows: DataFrame, key: Sequence[str], first: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the hash of their key and, as rows may share a key, their number within it. They lie
    in the buckets of the hash, where rows of one key meet, so that nothing moves them again."""
    order = [F.col(name).asc_nulls_last() for name in [*first, *key]]
    placed = rows.withColumn(HASH, F.xxhash64(*key)).repartition(buckets, HASH)
    return placed.withColumn(COPY, F.row_number().over(Window.partitionBy(HASH, *key).orderBy(*order)))


def persistent_ids(
    rows: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    path: str,
    staging: str,
    buckets: int,
    out: str = "sale_id",
    first: Sequence[str] = (),
) -> DataFrame:
    """Rows with an id that belongs to their key from the first build on.

    The map at ``path`` holds an id for every key that has ever been seen, in buckets of the key's
    hash. A row whose key is there takes its id; the other rows are numbered in ``order`` behind the
    greatest id so far, and the map grows by them. Keys that are gone keep their ids for their
    return. Rows with equal keys take the ids of the key in the order of the columns ``first``.
    ``order`` may use the key alone. Without a map the ids are the dense numbers of this order, and
    the copies of a key are told apart by them: rows travel once to be numbered, once to the map.
    """
    spark = rows.sparkSession
    columns = [*key, HASH, COPY]
    if versions.last_commit(spark, path) is None:
        copies = [F.col(name).asc_nulls_last() for name in first]
        named = rows.select(*dict.fromkeys([*key, *first]))
        numbered = number_rows(named, [*order, *copies], out, staging)
        entries = keyed(numbered, key, [out], buckets).select(*columns, out)
    else:
        table = versions.read_table(spark, path)
        most = table.agg(F.coalesce(F.max(out), F.lit(0))).scalar()
        lines = keyed(rows, key, first, buckets).select(*columns)
        unknown = with_ids(lines, table, [*key, COPY], out).filter(F.col(out).isNull())
        # written first: numbering reads its rows twice, and should not look all lines up again
        unknown = write_plain(unknown.drop(out), f"{staging}_unknown")
        fresh = number_rows(unknown, [*order, F.col(COPY)], out, staging)
        remove_folder(spark, f"{staging}_unknown")
        entries = table.unionByName(fresh.select(*columns, (F.col(out) + most).alias(out)))
    table = versions.write_buckets(entries, path, HASH, buckets)
    return with_ids(keyed(rows, key, first, buckets), table, [*key, COPY], out).select(*rows.columns, out)


def with_ids(lines: DataFrame, table: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Lines that lie in the buckets of the map with their ids, NULL where the map has none. Rows with
    one hash meet there, and by all columns of the key within it."""
    there = table.select(*[F.col(name).alias(f"_map_{name}") for name in table.columns])
    # a sum, as equalities would become keys of the join, by which the buckets do not lie
    equal = [F.col(name).eqNullSafe(F.col(f"_map_{name}")).cast("int") for name in key]
    same = reduce(lambda a, b: a + b, equal) >= len(equal)
    found = lines.join(there, (F.col(HASH) == F.col(f"_map_{HASH}")) & same, "left")
    return found.select(*lines.columns, F.col(f"_map_{out}").alias(out))
