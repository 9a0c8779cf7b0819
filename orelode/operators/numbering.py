"""Global row numbers and ranks without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orelode.sources.sinks import write_plain

# monotonically_increasing_id() is (partition << 33) + row within the partition.
ROW_BITS = 33


def number_rows(rows: DataFrame, order: Sequence[Column], out: str, staging: str) -> DataFrame:
    """Dense row number 1..n in the global order of ``order``.

    Rows are range-partitioned and sorted, given their place, and written to ``staging``
    once: the sampled range bounds may differ between two runs of the same plan, so the
    places have to be fixed before they are counted. The number is the place within the
    range plus the sizes of the ranges before it. ``order`` should end in tie-breaking
    columns; they also let a range split where many rows share the first columns.
    """
    place = F.col("_place")
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = write_plain(placed, staging)
    ranges = placed.groupBy(F.shiftright(place, ROW_BITS).alias("_range")).agg(
        F.count("*").alias("_rows")
    )
    # One row per range, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    numbered = placed.join(
        F.broadcast(offsets), F.shiftright(place, ROW_BITS) == F.col("_range")
    )
    within = place.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return numbered.withColumn(out, F.col("_before") + within + 1).drop(
        "_place", "_range", "_before"
    )


def number_in_files(table: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """The numbers of ``number_rows`` for a table whose files hold its rows in ascending ``order``,
    nulls last: each file in itself, and no file with rows between those of another.

    No row travels: the number is the place in its file plus the rows of the files before it. Files
    are put in order by their first and last rows, which are the same row where a whole file ties.
    """
    placed = table.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    sizes = placed.groupBy(F.col("_file").alias("_sized")).agg(F.count("*").alias("_rows"))
    key = F.struct(*[c for name in order for c in (F.col(name).isNull(), F.col(name))])
    ends = placed.join(F.broadcast(sizes), F.col("_file") == F.col("_sized"))
    ends = ends.filter((F.col("_row") == 0) | (F.col("_row") == F.col("_rows") - 1)).select("_sized", "_rows", key.alias("_key"))
    files = ends.groupBy("_sized", "_rows").agg(F.min("_key").alias("_first"), F.max("_key").alias("_last"))
    # One row per file.
    before = Window.orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_sized", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), F.col("_file") == F.col("_sized"))
    return numbered.withColumn(out, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_sized", "_before")


def ranks(numbered: DataFrame, value: str, number: str, out: str) -> DataFrame:
    """RANK of every distinct value, given row numbers in the order of that value."""
    return numbered.groupBy(value).agg(F.min(number).alias(out))
