"""Left lookups that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.sources.sinks import staged

# Largest side that is broadcast: rows, and bytes of its texts and other columns of no fixed
# width. A row takes a few tens of bytes beside these, so a broadcast stays under 100 MB.
BROADCAST_ROWS = 1_000_000
BROADCAST_TEXT = 64_000_000
# A key is hot when it has more than one part in HOT_PARTS of all rows, so that there are
# fewer than HOT_PARTS hot keys whatever the data.
HOT_PARTS = 1_000
# Keys that the sketch of frequent keys follows at once.
TRACKED = 16_384
# Number of join keys over which the rows of one hot key are spread.
SPREAD = 1_024


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    right_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    key_source: DataFrame | None = None,
    right_bytes: int | None = None,
) -> DataFrame:
    """Left join to ``right``, which has one row per key; every left row stays once.

    The size of ``right`` decides: its rows, which are counted unless an upper bound is given as
    ``right_rows``, and the bytes of its texts, if it has any, which ``right_bytes`` may bound. (The count of a whole written
    table comes from the file footers, that of a filtered one from a scan.) Up to
    ``broadcast_rows`` it is broadcast and ``left`` is not shuffled. Beyond that both sides are shuffled on
    the key, except that the left rows of hot keys take their values from a broadcast of
    the hot keys alone, and travel spread over SPREAD join keys that match nothing.

    Hot keys are found in ``key_source``, a frame with the same key column, when ``left`` is
    the outcome of a costly plan. Which keys count as hot changes the work, not the result.
    """
    bound = right.count() if right_rows is None else right_rows
    if bound <= broadcast_rows and (text_bytes(right) if right_bytes is None else right_bytes) <= BROADCAST_TEXT:
        joined = left.join(F.broadcast(right), left[left_key] == right[right_key], "left")
        return joined.drop(right[right_key])

    values = [name for name in right.columns if name != right_key]
    counted = left if key_source is None else key_source
    hot = hot_keys(counted, left_key)
    hot = hot.join(right, F.col("_hot_key") == F.col(right_key), "left").select(
        "_hot_key", F.struct(*values).alias("_hot")
    )

    # A NULL key matches nothing, but would gather in one task like any hot key.
    spread = F.col("_hot_key").isNotNull() | F.col(left_key).isNull()
    slot = F.lit(1) + F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD))
    placed = left.join(F.broadcast(hot), F.col(left_key) == F.col("_hot_key"), "left")
    placed = placed.withColumn("_slot", F.when(spread, slot).otherwise(F.lit(0).cast("bigint")))
    # Always 0, but not a literal: a literal would be folded out of the join keys.
    zero = F.pmod(F.xxhash64(right_key), F.lit(1))
    cold = right.select(
        F.col(right_key).alias("_cold_key"), zero.alias("_zero"), F.struct(*values).alias("_cold")
    )
    joined = placed.join(
        cold,
        (F.col(left_key) == F.col("_cold_key")) & (F.col("_slot") == F.col("_zero")),
        "left",
    )
    return joined.select(
        *left.columns, *[F.coalesce(f"_hot.{name}", f"_cold.{name}").alias(name) for name in values]
    )


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """``_hot_key``: every key with more than one part in HOT_PARTS of the rows.

    A sketch of frequent keys is filled where the rows lie and merged, so no row travels. It keeps
    TRACKED keys, and its error is at most some three parts in TRACKED of the rows; keys are taken
    from half the wanted share on, so none is missed and a key a little too cold may be among them.
    """
    bare = rows.schema[key].dataType.typeName() == "binary"  # a type that the sketch does not take
    shown = F.hex(key) if bare else F.col(key)
    known = rows.filter(F.col(key).isNotNull()).select(shown.alias("_key"))
    sketch = F.expr(f"approx_top_k(_key, {HOT_PARTS * 2}, {TRACKED})").alias("_top")
    found = known.agg(sketch, F.count("*").alias("_rows")).select("_rows", F.inline("_top"))
    item = F.unhex("item") if bare else F.col("item")
    return found.filter(F.col("count") > F.col("_rows") / (HOT_PARTS * 2)).select(item.alias("_hot_key"))


def text_bytes(rows: DataFrame) -> int:
    """Bytes of the columns without a fixed width; no job where there is none."""
    fixed = ("int", "bigint", "double", "date", "boolean", "smallint", "tinyint", "float")
    wide = [name for name, kind in rows.dtypes if not kind.startswith(("decimal", *fixed))]
    if not wide:
        return 0
    sizes = [F.sum(F.octet_length(F.col(name).cast("string"))) for name in wide]
    return sum(size or 0 for size in rows.agg(*sizes).first())


def with_matches(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    out: str,
    broadcast_rows: int = BROADCAST_ROWS,
    right_rows: int | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Add the number of ``right`` rows that carry the key of each left row (0 if none).

    This says what any join to ``right`` would do (drop, keep or repeat the row) without
    repeating a row, so a key that is duplicated in ``right`` cannot blow up the result.

    Most keys match once. Where ``right`` is too large to broadcast, the distinct keys of
    ``key_source`` are matched first, and only those that do not match once are handed to the rows:
    as a broadcast, unless these are many too. Rows travel in that last case alone.
    """
    keys = left if key_source is None else key_source
    return matcher(keys, right, left_key, right_key, out, broadcast_rows, right_rows)(left, key_source)


def matcher(
    keys: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    out: str,
    broadcast_rows: int = BROADCAST_ROWS,
    right_rows: int | None = None,
) -> Callable[..., DataFrame]:
    """``with_matches`` for any number of frames whose keys are among those of ``keys``, which meet
    ``right`` once for all of them; each frame may come with a source of its hot keys."""
    matches = (
        right.filter(F.col(right_key).isNotNull())
        .groupBy(F.col(right_key).alias("_match_key"))
        .agg(F.count("*").alias(out))
    )
    bound = right.count() if right_rows is None else right_rows
    if bound <= broadcast_rows:

        def by_value(left: DataFrame, key_source: DataFrame | None = None) -> DataFrame:
            found = lookup(left, matches, left_key, "_match_key", bound, broadcast_rows, key_source)
            return found.withColumn(out, F.coalesce(F.col(out), F.lit(0)))

        return by_value
    distinct = keys.select(F.col(left_key).alias("_left_key")).distinct()
    met = distinct.filter("_left_key IS NOT NULL").join(matches, F.col("_left_key") == F.col("_match_key"), "left")
    others = met.select(F.col("_left_key").alias("_other_key"), F.coalesce(out, F.lit(0)).alias(out))
    others = staged(others.filter(F.col(out) != 1), "matches")
    other_rows = others.count()

    def by_exception(left: DataFrame, key_source: DataFrame | None = None) -> DataFrame:
        found = lookup(left, others, left_key, "_other_key", other_rows, broadcast_rows, key_source)
        usual = F.when(F.col(left_key).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
        return found.withColumn(out, F.coalesce(F.col(out), usual))

    return by_exception
