"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelode.llm.common import n_words, scratch_path, staged
from orelode.operators.numbering import number_rows

# Fixed values of the mix: weights that repeat over the sources in order, and bounds.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2.0

#: Bins of the Pareto rank within a source; only one bin of a source is put in exact order.
BINS = 1 << 12


def source_targets(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """``source, source_size, weight, target``: shares of ``SHARE`` times all sizes by weight,
    none above ``MOST_COPIES`` times its source, the excess shared again by weight.

    Only sums come to the driver: with the capped sources known, one number says what a unit
    of weight is worth to the others. Each pass caps at least one more source.
    """
    rows = staged(sizes.join(weights, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "mix")
    cap = MOST_COPIES * F.col("source_size")
    total = SHARE * (rows.agg(F.sum("source_size")).first()[0] or 0)
    unit, capped = 0.0, -1
    while True:
        over = cap <= unit * F.col("weight") if capped >= 0 else F.lit(False)
        found = rows.agg(
            F.count(F.when(over, 1)).alias("capped"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if found["capped"] == capped or not found["weight"]:
            break
        capped, unit = found["capped"], (total - found["held"]) / found["weight"]
    return rows.withColumn("target", F.least(cap, F.lit(float(unit)) * F.col("weight")))


def source_weights(sizes: DataFrame) -> DataFrame:
    """``_source, weight``: the weights repeat over the sources by code point, null last."""
    ordered = sizes.select(F.col("source").alias("_source"), F.col("source").isNull().alias("_null"))
    path = scratch_path(sizes.sparkSession, "numbering")
    numbered = number_rows(ordered, [F.col("_null"), F.col("_source")], "_number", path)
    values = F.array(*map(F.lit, WEIGHTS))
    place = ((F.col("_number") - 1) % len(WEIGHTS)).cast("int")
    return numbered.select("_source", F.element_at(values, place + 1).alias("weight"))


def uniform(*columns: Column, seed: int = 0) -> Column:
    """A number in (0, 1) that depends on the values alone."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def pareto_rank(chance: Column, inclusion: Column) -> Column:
    """Odds of a uniform number divided by the odds of inclusion; small ranks are chosen. What is
    certain comes first."""
    odds = F.try_divide(chance / (1 - chance), F.try_divide(inclusion, 1 - inclusion))
    return F.when(inclusion >= 1, F.lit(0.0)).otherwise(odds)


def inclusion_scales(wanted: DataFrame) -> DataFrame:
    """``_source, _scale``: the inclusion probability of a document is its size times the scale of
    its source, and 1 where that is more, such that the sizes included are the wanted ones.

    ``wanted`` has ``source, size, _rows, _wanted``. Sizes are counted first. Documents that reach 1
    are certain, what they hold is taken off, and the scale of the others rises; each pass finds
    more of these, or is the last. Only a count comes to the driver.
    """
    sizes = staged(
        wanted.filter((F.col("_wanted") > 0) & (F.col("size") > 0))
        .groupBy("source", "size")
        .agg(F.sum("_rows").alias("_rows"), F.max("_wanted").alias("_wanted")),
        "counts",
    )
    size, rows = F.col("size").cast("double"), F.col("_rows")
    scaled, certain = sizes.withColumn("_scale", F.lit(0.0)), -1
    while True:
        full = F.col("_scale") * size >= 1
        scales = scaled.groupBy(F.col("source").alias("_source")).agg(
            F.try_divide(
                F.max("_wanted") - F.coalesce(F.sum(F.when(full, size * rows)), F.lit(0.0)),
                F.sum(F.when(~full, size * size * rows)),
            ).alias("_new"),
            F.count_if(full).alias("_full"),
            F.max("_scale").alias("_before"),
        )
        scales = staged(scales, "scales")
        found = scales.agg(F.coalesce(F.sum("_full"), F.lit(0))).first()[0]
        # all documents certain: any scale that makes them so
        scale = F.coalesce(F.greatest("_new", "_before"), "_before")
        scales = scales.select("_source", scale.alias("_scale"))
        if found == certain:
            return scales
        certain = found
        scaled = sizes.join(scales, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """All columns of ``docs`` with ``size, source_size, target, copies, taken``.

    A source's target over its size is the number of times its documents are wanted. The whole
    part of it is certain: every document is taken so often. One more copy of a document is drawn
    with a probability in proportion to its size, as the words still wanted are a share of all;
    documents that come to 1 are certain too. Documents are ranked by random odds over inclusion
    odds, and the smallest ranks are taken until the source's target is reached; where the next
    document is too large for the room left, the room goes to the next ones, until none fits.
    ``taken`` is ``copies`` times ``size``: documents are taken whole.

    Sums along the ranks are taken over bins first, so only the bin in which a source reaches
    its target is put in order, whatever the size of the source. At the end, one document more is
    taken where a source comes nearer to its target with it. The numbers depend on key and
    text alone, so reruns agree. Null text has size 0 and is taken 0 words (its certain copies
    count); a null source is a source of its own, the last. Rows with equal key and text share a
    number and a rank, and whole rows are told apart by their place among the equal ones. An
    empty table gives no rows; sources without words have target 0. Columns with the names of
    new ones give way to them.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c not in new]
    base = docs.select(*kept).withColumn("size", n_words(F.col(text)))
    code = F.xxhash64(F.col(text))
    # text stays behind: keys, sizes and sources are enough to draw
    drawn = base.select(
        F.col(key).alias("_key"), F.col(source).alias("source"), "size", code.alias("_code")
    )
    drawn = staged(drawn, "sizes")
    sizes = staged(drawn.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "sources")
    targets = staged(source_targets(sizes, source_weights(sizes)), "targets")

    # equal rows make one row with a count, so that a rank has one owner
    groups = drawn.groupBy("source", "_key", "_code", "size").agg(F.count("*").alias("_rows"))
    ranked = (
        groups.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source", "weight")
        .withColumn("_certain", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
        .withColumn("_wanted", F.col("target") - F.col("_certain") * F.col("source_size"))
    )
    scales = inclusion_scales(ranked)
    chance = F.least(F.coalesce(F.col("size") * F.col("_scale"), F.lit(0.0)), F.lit(1.0))
    ranked = (
        ranked.join(scales.withColumnRenamed("_source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
        .withColumn("_chance", chance)
        .drop("_s", "_scale")
        .withColumn("_rank", pareto_rank(uniform("_key", "_code"), F.col("_chance")))
    )
    # ranks lie in (0, inf); x / (1 + x) keeps their order and fits bins
    place = F.col("_rank") / (1 + F.col("_rank"))
    ranked = ranked.withColumn("_bin", F.least(F.floor(place * BINS), F.lit(BINS - 1)).cast("int"))
    ranked = staged(ranked, "ranks")
    extra = chosen(ranked)
    result = (
        base.withColumn("_code", code)
        .join(
            extra.select(
                F.col("source").alias("_s"), F.col("_key").alias("_k"), F.col("_code").alias("_c"),
                "source_size", "target", "_certain", "_rows", "_more",
            ),
            F.col(source).eqNullSafe(F.col("_s")) & F.col(key).eqNullSafe(F.col("_k"))
            & F.col("_code").eqNullSafe(F.col("_c")),
        )
    )
    copies = F.col("_certain") + F.col("_more")
    return result.select(
        *[F.col(c) for c in kept],
        "size",
        "source_size",
        "target",
        copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def chosen(ranked: DataFrame) -> DataFrame:
    """``ranked`` with ``_more``: 1 for documents with one more copy than the certain ones.

    Equal rows are taken together or not at all. A round takes, in the order of ranks, what
    lies before the place where the room of a source is used up; the next one offers the room
    left to documents that fit in it.
    """
    open_rows = ranked.filter((F.col("_wanted") > 0) & (F.col("size") > 0))
    open_rows = open_rows.withColumn("_weight", F.col("size") * F.col("_rows"))
    room = open_rows.groupBy("source").agg(F.max("_wanted").alias("_room"))
    taken, left = None, open_rows
    while True:
        room = staged(room, "room")
        fit = left.join(room.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        fit = fit.filter(F.col("_weight") <= F.col("_room") + 0.5)
        won = staged(first_fitting(fit), "won")
        if won.isEmpty():
            break
        used = won.groupBy("source").agg(F.sum("_weight").alias("_used"))
        room = (
            room.join(used.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("source", (F.col("_room") - F.coalesce("_used", F.lit(0))).alias("_room"))
            .filter(F.col("_room") >= 1)
        )
        keys = won.select("source", "_key", "_code")
        # one table of what is taken, so that plans do not grow with the rounds
        taken = keys if taken is None else staged(taken.unionByName(keys), "taken")
        left = without(open_rows, taken)
    last = closest(left, room)
    taken = last if taken is None else taken.unionByName(last)
    marks = taken.toDF("_s", "_k", "_c").withColumn("_won", F.lit(1))
    return ranked.join(marks, same("_s", "_k", "_c"), "left").withColumn(
        "_more", F.coalesce("_won", F.lit(0))
    )


def closest(left: DataFrame, room: DataFrame) -> DataFrame:
    """One document for each source that comes nearer to its target with it than without."""
    over = left.join(room.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    over = over.filter(F.col("_weight") < 2 * F.col("_room"))
    gap = F.struct(F.abs(F.col("_weight") - F.col("_room")), "_rank", "_key", "_code")
    return (
        over.groupBy("source")
        .agg(F.min_by(F.struct("_key", "_code"), gap).alias("_best"))
        .select("source", "_best._key", "_best._code")
    )


def same(source: str, key: str, code: str) -> Column:
    return (
        F.col("source").eqNullSafe(F.col(source))
        & F.col("_key").eqNullSafe(F.col(key))
        & F.col("_code").eqNullSafe(F.col(code))
    )


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return rows.join(keys.toDF("_s", "_k", "_c"), same("_s", "_k", "_c"), "left_anti")


def first_fitting(fit: DataFrame) -> DataFrame:
    """Rows before the place in rank order where a source's room is used up.

    Sums of the bins, at most ``BINS`` to a source, say in which bin that is; rows in earlier
    bins are taken without a sort, and the rows of that one bin get running sums.
    """
    along = Window.partitionBy("source").orderBy("_bin")
    bins = (
        fit.groupBy("source", "_bin")
        .agg(F.sum("_weight").alias("_in_bin"))
        .withColumn("_until", F.sum("_in_bin").over(along))
        .select(F.col("source").alias("_s"), F.col("_bin").alias("_b"), "_in_bin", "_until")
    )
    near = fit.join(bins, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    near = near.drop("_s", "_b").filter(F.col("_until") - F.col("_in_bin") < F.col("_room") + 0.5)
    whole = near.filter(F.col("_until") <= F.col("_room") + 0.5)
    edge = near.filter(F.col("_until") > F.col("_room") + 0.5)
    order = Window.partitionBy("source", "_bin").orderBy("_rank", "_key", "_code")
    edge = edge.withColumn("_sum", F.col("_until") - F.col("_in_bin") + F.sum("_weight").over(order))
    edge = edge.filter(F.col("_sum") <= F.col("_room") + 0.5).drop("_sum")
    return whole.unionByName(edge).select("source", "_key", "_code", "_weight")
