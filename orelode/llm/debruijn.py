"""Passages that repeat across documents, by compaction of a De Bruijn graph of words.

Runs of 12 words are the nodes and windows of 13 words the edges. Each window belongs to its
anchor, the run of ``ANCHOR`` words in it with the least hash, wherever the window occurs. The
consecutive windows of a document with one anchor make a path. Where all documents with an
anchor have the same path, nothing branches, and the path stands for all its edges in one row;
only where paths differ around an anchor are they taken apart into edges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import Cache, discard, mapped, mixed, slices, staged, utf8, window_hashes

#: Words of a window that counts as repeated, and of its anchor.
WINDOW = 13
ANCHOR = 4

ODD = 0x9E3779B97F4A7C15
EVEN_OUT = pow(ODD, -1, 1 << 64)


def word_hashes(words: list[bytes], hashes: Cache) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value in every run of ``width``: the leftmost of equal ones, so
    that the choice depends on the run alone. Runs of doubled width are made of two halves."""
    best, reach = np.arange(len(values)), 1
    while reach < width:
        shift = min(reach, width - reach)
        left, right = best[:-shift], best[shift:]
        best = np.where(values[right] < values[left], right, left)
        reach += shift
    return best


def paths(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, path hash, first window and number of windows of every path of a document."""
    count = len(words) - WINDOW + 1
    if count <= 0:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    runs = window_hashes(words, ANCHOR)
    anchor = leftmost_least(runs, WINDOW - ANCHOR + 1)
    starts = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
    lengths = np.diff(np.append(starts, count))
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(words * powers(ODD, len(words))))
        ends = starts + lengths + WINDOW - 1
        content = (sums[ends] - sums[starts]) * powers(EVEN_OUT, len(words))[starts]
        content = mixed(content ^ mixed(lengths.astype(np.uint64)))
    return runs[anchor[starts]], content, starts, lengths


def path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Cache(xxhash.xxh3_64_intdigest)
    for part in slices(batches):
        found, sizes, digests = [], [], []
        for raw in utf8(part.column(2)):
            words = raw.split()
            sizes.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            found.append(paths(word_hashes(words, hashes)))
        anchors, contents, starts, lengths = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
             pa.array([x.view(np.int64) for x in anchors], pa.list_(pa.int64())),
             pa.array([x.view(np.int64) for x in contents], pa.list_(pa.int64())),
             pa.array([x.astype(np.int32) for x in starts], pa.list_(pa.int32())),
             pa.array([x.astype(np.int32) for x in lengths], pa.list_(pa.int32()))],
            ["doc", "code", "n_words", "digest", "anchor", "path", "start", "count"],
        )


def listed(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Where the entries of each row begin and end, and the fields of all entries."""
    if column.null_count:
        column = column.fill_null([])
    fields = {f.name: column.values.field(f.name).to_numpy() for f in column.type.value_type}
    return column.offsets.to_numpy(), fields


def edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of paths that meet others around their anchor."""
    hashes = Cache(xxhash.xxh3_64_intdigest)
    for part in slices(batches):
        offsets, taken = listed(part.column(3))
        starts, counts = taken["start"].astype(np.int64), taken["count"].astype(np.int64)
        edges, places, anchors, sizes = [], [], [], []
        for row, raw in enumerate(utf8(part.column(2))):
            own = slice(offsets[row], offsets[row + 1])
            times = counts[own]
            at = np.arange(times.sum()) + np.repeat(starts[own] - np.cumsum(times) + times, times)
            edges.append(window_hashes(word_hashes(raw.split(), hashes), WINDOW)[at])
            places.append(at)
            anchors.append(np.repeat(taken["anchor"][own], times))
            sizes.append(len(at))
        rows = pa.array(np.repeat(np.arange(part.num_rows), sizes))
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(rows), part.column(1).take(rows), pa.array(np.concatenate(anchors), pa.int64()),
             pa.array(np.concatenate(edges).view(np.int64)), pa.array(np.concatenate(places).astype(np.int32))],
            ["doc", "code", "anchor", "edge", "start"],
        )


def merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of removed words from runs of removed windows."""
    for part in slices(batches, 1_024):
        offsets, windows = listed(part.column(4))
        ranges, removed, digests = [], [], []
        sizes, known = part.column(2).to_pylist(), part.column(3).to_pylist()
        for row, (n_words, digest) in enumerate(zip(sizes, known)):
            own = slice(offsets[row], offsets[row + 1])
            found = word_ranges(windows["start"][own], windows["count"][own], n_words)
            ranges.append([{"start": a, "stop": b} for a, b in found])
            removed.append(sum(b - a for a, b in found))
            digests.append(digest if not found else EMPTY if removed[-1] == n_words else None)
        yield pa.RecordBatch.from_arrays(
            [*part.columns[:3], pa.array(digests, pa.string()), pa.array(removed, pa.int64()),
             pa.array(ranges, RANGES)],
            ["doc", "code", "n_words", "digest", "n_removed", "removed"],
        )


EMPTY = hashlib.sha256(b"").hexdigest()
RANGES = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def word_ranges(starts: np.ndarray, counts: np.ndarray, n_words: int) -> list[tuple[int, int]]:
    """Disjoint runs of words that runs of windows cover."""
    if not len(starts):
        return []
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + counts + WINDOW - 1, -1)
    inside = (np.cumsum(edges[:-1]) > 0).astype(np.int8)
    turns = np.flatnonzero(np.diff(inside, prepend=0, append=0))
    return [(int(a), int(b)) for a, b in zip(turns[::2], turns[1::2])]


def kept_words(raw: bytes, removed: list[dict]) -> bytes:
    """The words outside the removed runs, joined by one space."""
    words, kept, at = raw.split(), [], 0
    for run in removed:
        kept += words[at : run["start"]]
        at = run["stop"]
    return b" ".join(kept + words[at:])


def kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        digests = [
            hashlib.sha256(kept_words(raw, removed)).hexdigest()
            for raw, removed in zip(utf8(part.column(5)), part.column(4).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [*part.columns[:5], pa.array(digests, pa.string())],
            ["doc", "code", "n_words", "n_removed", "removed", "digest"],
        )


def remove_repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_removed, kept_sha256, removed`` for every row.

    A word goes when a window of ``WINDOW`` words covers it whose words also begin somewhere in a
    document with a smaller key. ``removed`` has the runs of such words as ``start, stop``.

    Anchors that occur in one document only are dropped after a count that is reduced before
    its shuffle, so unique text leaves no rows behind. Paths that a smaller document has too are
    removed whole; the first holder of each path around a branching anchor has its windows
    compared one by one. Rows of a hot anchor are joined to one row each and may be split.

    A null or empty text has no words. A null key takes no part: nothing is removed and nothing
    is a repeat of it. Rows with one key never remove from each other. Texts of under
    ``WINDOW`` words stay whole. An empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("code"), F.col(text).alias("text")
    )
    found = staged(
        mapped(
            rows,
            path_rows,
            "doc long, code long, n_words long, digest string, anchor array<long>, "
            "path array<long>, start array<int>, count array<int>",
        ),
        "paths",
    )
    windows, steps = repeated_windows(rows, found)
    gathered = windows.groupBy("doc", "code").agg(F.collect_list(F.struct("start", "count")).alias("windows"))
    sizes = found.select("doc", "code", "n_words", "digest")
    near = same_text("d", "c")
    merged = sizes.join(gathered.withColumnsRenamed({"doc": "d", "code": "c"}), near, "left").drop("d", "c")
    merged = staged(
        merged.mapInArrow(
            merged_rows,
            "doc long, code long, n_words long, digest string, n_removed long, "
            "removed array<struct<start:int,stop:int>>",
        ),
        "merged",
    )
    discard(found, *steps)
    whole = merged.filter(F.col("digest").isNotNull())
    part = merged.filter(F.col("digest").isNull())
    texts = rows.withColumnsRenamed({"doc": "d", "code": "c"})
    # equal rows have equal results: each text meets one of them, so their number stays
    wanted = part.dropDuplicates(["doc", "code"])
    cut = texts.join(wanted, near).select("doc", "code", "n_words", "n_removed", "removed", "text")
    cut = cut.mapInArrow(
        kept_rows,
        "doc long, code long, n_words long, n_removed long, "
        "removed array<struct<start:int,stop:int>>, digest string",
    )
    result = whole.select("doc", "n_words", "n_removed", "digest", "removed").unionByName(
        cut.select("doc", "n_words", "n_removed", "digest", "removed")
    )
    return result.select(
        F.col("doc").cast(kind).alias(key),
        "n_words",
        "n_removed",
        F.col("digest").alias("kept_sha256"),
        "removed",
    )


def same_text(doc: str, code: str):
    return F.col("doc").eqNullSafe(F.col(doc)) & (F.col("code") == F.col(code))


def repeated_windows(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``doc, code, start, count``: runs of windows that a smaller document has too; and the
    tables which that reads."""
    known = found.filter(F.col("doc").isNotNull())
    anchors = known.select("doc", F.explode("anchor").alias("anchor"))
    repeated = anchors.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    repeated = staged(repeated.filter("lo < hi").select("anchor"), "anchors")

    each = known.select(
        "doc", "code", F.explode(F.arrays_zip("anchor", "path", "start", "count")).alias("p")
    ).select("doc", "code", "p.anchor", "p.path", "p.start", "p.count")
    each = staged(each.join(repeated, "anchor"), "occurrences")

    firsts = staged(each.groupBy("anchor", "path").agg(F.min("doc").alias("first")), "firsts")
    several = firsts.groupBy("anchor").agg(F.count("*").alias("paths"))
    judged = staged(
        each.join(firsts.join(several, "anchor"), ["anchor", "path"]).select(
            "doc", "code", "anchor", "path", "start", "count", "first", (F.col("paths") > 1).alias("branches")
        ),
        "judged",
    )
    discard(repeated, each, firsts)
    whole = judged.filter("first < doc").select("doc", "code", "start", "count")

    open_paths = judged.filter("first = doc and branches")
    # a path that its first document has twice: both places have to be judged
    taken = open_paths.groupBy("doc", "code").agg(
        F.collect_list(F.struct("anchor", "start", "count")).alias("taken")
    )
    joined = rows.join(taken.withColumnsRenamed({"doc": "d", "code": "c"}), same_text("d", "c"))
    edges = staged(
        joined.select("doc", "code", "text", "taken").mapInArrow(
            edge_rows, "doc long, code long, anchor long, edge long, start int"
        ),
        "edges",
    )
    least = edges.groupBy("anchor", "edge").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    least = least.filter("first < last").select("anchor", "edge", "first")
    single = edges.join(least, ["anchor", "edge"]).filter("first < doc")
    single = single.select("doc", "code", "start", F.lit(1).alias("count"))
    return whole.unionByName(single), [judged, edges]
