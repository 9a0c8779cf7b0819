"""Turns of conversations in their order, without a task that holds a whole conversation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import mapped, staged

#: The null conversation sorts first; this stands for its key next to the flag that it is null.
NO_KEY = 0


def placed_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, index, last, role, text``: every row with its place in its conversation, from 0.

    Rows are ordered by turn (null first), then role, then text; a null role or text becomes empty.
    Rows without a conversation are one conversation of their own. Repeated rows are turns like any
    other. Other columns are left out; an empty table gives no rows.

    Rows are dealt by ranges of this order, so that a conversation of any length, or a row repeated
    any number of times, spreads over tasks. Each range is numbered where it lies; a row for each
    range, which tells how much of the conversation came before it, is all the driver sees.
    """
    order = ["_null", "conv_id", "turn", "role", "text", "_spread"]
    plain = rows.select(
        F.col(conv).isNotNull().alias("_null"),
        F.coalesce(F.col(conv).cast("long"), F.lit(NO_KEY)).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("_spread"),
    )
    ranges = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = ranges.select(F.spark_partition_id().alias("part"), F.col("_null").alias("known"), "conv_id", "role", "text")
    numbered = mapped(
        ranges, number_rows, "part int, known boolean, conv_id long, role string, text string, place long, index long, last boolean"
    )
    numbered = staged(numbered, "turns")

    first = F.struct("known", "conv_id")
    edges = numbered.groupBy("part").agg(
        F.min_by(first, "place").alias("first"),
        F.max_by(first, "place").alias("final"),
        F.max_by("index", "place").alias("tail"),
        F.count_if(F.col("index") == F.col("place")).alias("head"),
        F.count("*").alias("rows"),
    )
    joints = joined_ranges(edges.orderBy("part").collect())
    joints = rows.sparkSession.createDataFrame(joints, "p int, before long, end long")
    placed = numbered.join(F.broadcast(joints), F.col("part") == F.col("p"))
    in_first = F.col("index") == F.col("place")
    return placed.select(
        F.when(F.col("known"), F.col("conv_id")).alias("conv_id"),
        (F.col("index") + F.when(in_first, F.col("before")).otherwise(0)).alias("index"),
        (F.col("last") & (F.col("place") != F.col("end"))).alias("last"),
        "role",
        "text",
    )


def joined_ranges(edges: list) -> list[tuple[int, int, int]]:
    """For each range: the turns of its first conversation in earlier ranges, and the place of its
    last row if that conversation goes on in the next one (-1 if not)."""
    found = []
    conversation, count = None, 0
    for edge in edges:
        goes_on = conversation == edge["first"]
        if goes_on:
            found[-1][2] = edges[len(found) - 1]["rows"] - 1
        before = count if goes_on else 0
        found.append([edge["part"], before, -1])
        alone = edge["head"] == edge["rows"]
        conversation, count = edge["final"], (before + edge["rows"] if alone else edge["tail"] + 1)
    return [tuple(row) for row in found]


def number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range with their place in it, their place in the conversation as far as it lies
    here, and whether another conversation follows. A batch waits for the one after it."""
    place, index, before, waiting = 0, 0, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(2).to_numpy()])
        starts = np.ones(batch.num_rows, bool)
        starts[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        starts[0] = before is None or (keys[:, 0] != before).any()
        if waiting is not None:
            yield with_last(*waiting, starts[0])
        places = np.arange(batch.num_rows)
        begun = np.maximum.accumulate(np.where(starts, places, -1))
        indexes = np.where(begun < 0, index + places, places - begun)
        waiting = (batch, starts, place + places, indexes)
        place, index, before = place + batch.num_rows, int(indexes[-1]) + 1, keys[:, -1]
    if waiting is not None:
        yield with_last(*waiting, True)


def with_last(batch, starts, places, indexes, ends) -> pa.RecordBatch:
    last = np.append(starts[1:], ends)
    columns = [*batch.columns, pa.array(places, pa.int64()), pa.array(indexes, pa.int64()), pa.array(last)]
    return pa.record_batch(columns, [*batch.schema.names, "place", "index", "last"])
