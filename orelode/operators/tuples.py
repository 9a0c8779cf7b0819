"""The distinct business rows of all deliveries, kept where the next delivery finds them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orelode.operators.lookup import hot_keys
from orelode.schemas import INGESTION, ORDERS_COLUMNS
from orelode.sources import versions
from orelode.sources.sinks import staged

HASH = "tuple_hash"
# A bucket is read, sorted and joined by one task, so its rows are bounded whatever the table's size.
BUCKET_ROWS = 500_000
# Words of 64 bits in which the hashes of repeated rows are marked: a small broadcast at any size.
MARK_WORDS = 1 << 20


def delivery_order(orders: DataFrame) -> DataFrame:
    """``date, place``: the ingestion dates in the order of their texts, from 1.

    One row for each delivery: as few as the folders that were listed to read them.
    """
    dates = orders.filter(F.col(INGESTION).isNotNull()).select(F.col(INGESTION).alias("date")).distinct()
    return dates.withColumn("place", F.row_number().over(Window.orderBy("date")))


def tuples_of(
    orders: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS, dates: DataFrame | None = None
) -> DataFrame:
    """``columns, copies, source_ingestion_date``: each distinct business row once, with the number
    of rows that repeat it and the latest date it was delivered, which is the greatest text.

    An aggregate over text would need a sort of all rows before the shuffle, so the place of a date
    among all dates stands for it; a tuple with very many copies is added up on the map side. ``dates``
    gives the places where they are known of more rows than these.
    """
    dates = delivery_order(orders) if dates is None else dates
    placed = orders.join(F.broadcast(dates), F.col(INGESTION) == F.col("date"), "left")
    counted = placed.groupBy(*columns).agg(F.count("*").alias("copies"), F.max("place").alias("_last"))
    found = counted.join(F.broadcast(dates), F.col("_last") == F.col("place"), "left")
    return found.select(*columns, "copies", F.col("date").alias("source_ingestion_date"))


def repeat_marks(orders: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    """``_word, _bits``: a bit for every hash that more than one row has.

    Only hashes travel. 40 bits of them tell rows apart well enough: those that share one by chance are
    taken for repeated ones here and compared later, as are those that share a bit.
    """
    counts = orders.groupBy(_short_hash(columns).alias("_short")).agg(F.count("*").alias("_n")).filter("_n > 1")
    bit = F.expr("shiftleft(1L, cast(_short & 63 AS int))")
    return counts.groupBy(_mark_word().alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _short_hash(columns: Sequence[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 24)


def _mark_word() -> Column:
    return F.pmod(F.shiftright("_short", 6), F.lit(MARK_WORDS))


def distinct_tuples(orders: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    """``tuples_of``, where a row that shares its hash with no other stays where it is: it is a tuple of
    one copy. Rows that may be repeated, which the marks tell, are the only ones to travel."""
    marks = staged(repeat_marks(orders, columns), "repeats")
    rows = orders.select(*columns, INGESTION, _short_hash(columns).alias("_short"))
    rows = rows.join(F.broadcast(marks), _mark_word() == F.col("_word"), "left")
    marked = F.coalesce(F.getbit("_bits", F.expr("cast(_short & 63 AS int)")) == 1, F.lit(False))
    single = rows.filter(~marked).select(
        *columns, F.lit(1).cast("long").alias("copies"), F.col(INGESTION).alias("source_ingestion_date")
    )
    return single.unionByName(tuples_of(rows.filter(marked).select(*columns, INGESTION), columns, delivery_order(orders)))


def tuple_hash(columns: Sequence[str] = ORDERS_COLUMNS):
    return F.xxhash64(*columns).alias(HASH)


def bucket_count(rows: int | None, least: int) -> int:
    """Buckets for a table of so many rows: more than ``least`` where these would be large."""
    return max(least, -(-(rows or 0) // BUCKET_ROWS))


def placed_tuples(orders: DataFrame, buckets: int, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    """``tuples_of`` with their hash, in the buckets of it: a row travels once, to its bucket.

    Nearly all rows are different, so adding them up on the map side would fill its memory and spare
    no row. Only the copies of hot tuples are added up there, of which there are few.
    """
    dates = delivery_order(orders)
    placed = orders.join(F.broadcast(dates), F.col(INGESTION) == F.col("date"), "left")
    placed = placed.select(*columns, tuple_hash(columns), F.col("place").alias("_last"))
    hot = hot_keys(placed, HASH)
    marked = placed.join(F.broadcast(hot), F.col(HASH) == F.col("_hot_key"), "left")
    cold = marked.filter("_hot_key IS NULL").select(*columns, HASH, "_last", F.lit(1).cast("long").alias("_copies"))
    many = marked.filter("_hot_key IS NOT NULL").groupBy(*columns, HASH)
    many = many.agg(F.max("_last").alias("_last"), F.count("*").alias("_copies"))
    rows = cold.unionByName(many).repartition(buckets, HASH)
    counted = rows.groupBy(HASH, *columns).agg(F.sum("_copies").alias("copies"), F.max("_last").alias("_last"))
    found = counted.join(F.broadcast(dates), F.col("_last") == F.col("place"), "left")
    return found.select(*columns, "copies", F.col("date").alias("source_ingestion_date"), HASH)


def write_tuples(
    orders: DataFrame, path: str, buckets: int, columns: Sequence[str] = ORDERS_COLUMNS
) -> DataFrame:
    """The tuples of all rows as a table in buckets of their hash; replaces what was there."""
    return versions.write_buckets(placed_tuples(orders, buckets, columns), path, HASH, buckets)


def merged_tuples(
    table: DataFrame, delivery: DataFrame, buckets: int, columns: Sequence[str] = ORDERS_COLUMNS
) -> DataFrame:
    """The tuples of a table and of one more delivery.

    Only the delivery's tuples travel, to the buckets that hold their equals. They meet by hash,
    and by all columns within it, so that tuples which share a hash stay apart.
    """
    fresh = tuples_of(delivery, columns).select("*", tuple_hash(columns)).repartition(buckets, HASH)
    fresh = fresh.select(*[F.col(name).alias(f"_new_{name}") for name in fresh.columns])
    # A sum, as equalities would become keys of the join, by which the buckets do not lie.
    equal = [F.col(name).eqNullSafe(F.col(f"_new_{name}")).cast("int") for name in columns]
    same = reduce(lambda a, b: a + b, equal) >= len(equal)
    both = table.join(fresh, (F.col(HASH) == F.col(f"_new_{HASH}")) & same, "full")
    new = F.col(HASH).isNull()
    nothing = F.lit(0).cast("bigint")
    return both.select(
        *[F.when(new, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name) for name in columns],
        (F.coalesce("copies", nothing) + F.coalesce("_new_copies", nothing)).alias("copies"),
        F.greatest("source_ingestion_date", "_new_source_ingestion_date").alias("source_ingestion_date"),
        F.coalesce(HASH, f"_new_{HASH}").alias(HASH),
    )


def add_delivery(path: str, delivery: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    """Adds one more delivery to the table at ``path``: the rows must not have been added before."""
    spark = delivery.sparkSession
    buckets = versions.last_commit(spark, path).buckets
    table = versions.read_table(spark, path)
    return versions.write_buckets(merged_tuples(table, delivery, buckets, columns), path, HASH, buckets)
