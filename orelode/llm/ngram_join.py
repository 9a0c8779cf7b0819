"""Near-duplicate documents by the Jaccard similarity of their word shingles.

A set of shingles becomes a parity sketch: every shingle flips one bit, so the bits in which
two sketches differ are at most the shingles in which the sets differ. Sets within the
threshold differ in no more shingles than their sizes allow. Split into one block more than
that, their sketches agree in at least one block, which makes an equi-join of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import Cache, Forest, discard, mapped, mixed, runs, slices, staged, utf8, window_hashes
from orelode.llm.components import connected_components

#: Growth of sizes within a band; links reach from a band to itself and the next one.
BAND = 1.25
#: Least and most 64-bit words of the short sketch that candidates are compared by before their
#: sets are. It has about a bit for each shingle, so that unrelated sets differ in half of them.
LEAST_SKETCH = 4
MOST_SKETCH = 64
#: Most documents, and most shingles, of one chunk of a group. Groups beyond that are compared
#: chunk by chunk, in as many tasks as there are pairs of chunks.
CHUNK = 512
CHUNK_SHINGLES = 400_000


class Similarity:
    """A threshold of ``percent`` in a hundred on the Jaccard similarity, in whole numbers."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        if not 50 < percent <= 100:
            raise ValueError("similarity has to be over 50 and at most 100 percent")
        self.percent = percent
        starts = [1]
        while starts[-1] < largest:
            starts.append(max(starts[-1] + 1, int(starts[-1] * max(BAND, 110 / percent))))
        self.starts = np.array(starts)

    def apart(self, total):
        """Most shingles in which sets with ``total`` shingles between them may differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def links(self, common: int, union: int) -> bool:
        return 100 * common >= self.percent * union

    def bands(self, size: int) -> list[tuple[int, int, int]]:
        """Bands in which a set of this size seeks partners, each with its number of blocks and
        the least number of them that agree with a partner's.

        A pair meets in the band of its smaller set, whose largest pairs decide on the blocks.
        """
        own = int(np.searchsorted(self.starts, size, side="right")) - 1
        found = []
        for band in (own - 1, own):
            if band < 0:
                continue
            smallest_most = int(self.starts[band + 1]) - 1
            largest = 100 * smallest_most // self.percent
            most = self.apart(smallest_most + largest)
            # with no difference allowed, partners are equal sets, which are found as copies
            if size <= largest and most > 0:
                partner = 100 * size // self.percent if band == own else smallest_most
                found.append((band, most + 1, most + 1 - self.apart(size + partner)))
        return found


def shingles(raw: bytes, width: int, hashes: Cache) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one shingle."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words) + 1)], np.uint64)
    found = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return np.unique(window_hashes(found, width))


def block_keys(found: np.ndarray, band: int, blocks: int, agree: int) -> np.ndarray:
    """Keys of the blocks of the parity sketch, equal where the blocks are.

    The upper half of a shingle's hash chooses the block, so blocks are runs of the sorted
    hashes; the lower bits choose the bit that it flips. The exclusive or of the whole hashes,
    a second parity code, keeps blocks apart that have few bits. Keys of 48 bits are enough:
    where two blocks share one by chance, the sketches are compared in vain.

    At least ``agree`` blocks are equal in two linked sets, so one fewer may be left out of each:
    those with the fewest shingles, which unrelated sets share, in an order that depends on the
    blocks alone. The last in that order of the equal blocks stays in both sets.
    """
    place = ((found >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    cuts = np.searchsorted(place, np.arange(blocks + 1, dtype=np.uint64))
    keys = mixed(np.arange(blocks, dtype=np.uint64) + np.uint64((band + 1) << 40))
    for codes in (np.uint64(1) << (found & np.uint64(63)), mixed(found)):
        parity = np.append(np.uint64(0), np.bitwise_xor.accumulate(codes))
        keys = mixed(keys ^ mixed(parity[cuts[1:]] ^ parity[cuts[:-1]]))
    keys = keys >> np.uint64(16)
    return keys[np.lexsort((keys, np.diff(cuts)))[agree - 1 :]]


def short_sketch(found: np.ndarray) -> np.ndarray:
    """One flipped bit for each shingle, in a power of two of words."""
    words = LEAST_SKETCH
    while words < MOST_SKETCH and 64 * words < len(found):
        words *= 2
    sketch = np.zeros(words, np.uint64)
    place = ((found >> np.uint64(8)) & np.uint64(words - 1)).astype(np.int64)
    np.bitwise_xor.at(sketch, place, np.uint64(1) << (found & np.uint64(63)))
    return sketch


def level(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketches folded to the length of the shortest: halves laid on each other by exclusive or
    are the sketch of half the length."""
    words = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(s.reshape(-1, words), axis=0) for s in sketches])


def sketch_rows(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    near, hashes = Similarity(percent), Cache(xxhash.xxh3_64_intdigest)
    for part in slices(batches):
        sizes, firsts, seconds, keys, sketches = [], [], [], [], []
        for raw in utf8(part.column(1)):
            found = shingles(raw, width, hashes)
            sizes.append(len(found))
            with np.errstate(over="ignore"):
                firsts.append(mixed(np.bitwise_xor.reduce(mixed(found), keepdims=True)).view(np.int64)[0])
                seconds.append(np.add.reduce(found, dtype=np.uint64).view(np.int64))
            own = [block_keys(found, *band) for band in near.bands(len(found))] if len(found) else []
            keys.append(np.concatenate(own).view(np.int64) if own else np.empty(0, np.int64))
            sketches.append(short_sketch(found).tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(sizes, pa.int64()), pa.array(firsts, pa.int64()),
             pa.array(seconds, pa.int64()), pa.array(sketches, pa.binary()),
             pa.array(keys, pa.list_(pa.int64()))],
            ["doc", "n", "node", "check", "sketch", "keys"],
        )


def chunked(rows: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Rows once for every task in which their chunk meets another, as ``group, i, j, side``.

    ``sizes`` says into how many ``chunks`` each group falls; it has one row per group.
    """
    near = rows.join(sizes.withColumnRenamed(group, "_group"), F.col(group) == F.col("_group")).drop("_group")
    near = near.withColumn("_own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")))
    near = near.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return near.select(
        F.col(group),
        F.least("_own", "_other").alias("i"),
        F.greatest("_own", "_other").alias("j"),
        # 0: the first chunk, 1: the second one; a chunk meets itself as 0 and 0
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
        *[c for c in rows.columns if c != group],
    )


def tasks(rows: DataFrame, group: str) -> DataFrame:
    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def near_pairs(sketches: np.ndarray, sizes: np.ndarray, sides: np.ndarray, near: Similarity):
    """Places of pairs whose sketches do not rule a link out, nearest first."""
    first, second = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    alone = not len(second)
    second = first if alone else second
    differ = np.zeros((len(first), len(second)), np.int32)
    for word in range(sketches.shape[1]):
        differ += np.bitwise_count(sketches[first, None, word] ^ sketches[None, second, word])
    total = sizes[first, None] + sizes[None, second]
    good = differ <= near.apart(total)
    if alone:
        good &= np.triu(np.ones(good.shape, bool), 1)
    a, b = np.nonzero(good)
    order = np.argsort(differ[a, b], kind="stable")
    return first[a[order]], second[b[order]]


def pair_batch(pairs: list) -> pa.RecordBatch:
    columns = list(zip(*pairs)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def candidate_rows(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From the rows of each block key stars of the nodes that pairs allowed by the short
    sketches connect."""
    near = Similarity(percent)
    found: set = set()
    for (_, i, j), rows in runs(batches, 3):
        if rows.num_rows < 2:
            continue
        sides = rows.column("side").to_numpy()
        if i != j and not (sides.any() and not sides.all()):
            continue
        rows = rows.sort_by("node")
        nodes, sides = rows.column("node").to_numpy(), rows.column("side").to_numpy()
        sketches = level([np.frombuffer(raw, np.uint64) for raw in rows.column("sketch").to_pylist()])
        forest = Forest(len(nodes))
        for a, b in zip(*near_pairs(sketches, rows.column("n").to_numpy(), sides, near)):
            forest.join(int(a), int(b))
        # stars around the smallest node are alike for many keys, and count once
        for a in range(len(nodes)):
            if (root := forest.root(a)) != a and nodes[root] != nodes[a]:
                found.add((int(nodes[root]), int(nodes[a])))
        if len(found) > 50_000:
            yield pair_batch(list(found))
            found = set()
    if found:
        yield pair_batch(list(found))


def verified_rows(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """From the texts of each class a forest of the links between them."""
    near, hashes = Similarity(percent), Cache(xxhash.xxh3_64_intdigest)
    for (_, i, j), rows in runs(batches, 3):
        sides = rows.column("side").to_numpy()
        if rows.num_rows < 2 or (i != j and not (sides.any() and not sides.all())):
            continue
        docs = rows.column("node").to_numpy()
        sets = [shingles(raw, width, hashes) for raw in utf8(rows.column("text").combine_chunks())]
        sizes = np.array([len(s) for s in sets])
        sketches = level([short_sketch(s) for s in sets])
        forest, links = Forest(len(docs)), []
        for a, b in zip(*near_pairs(sketches, sizes, sides, near)):
            a, b = int(a), int(b)
            if forest.root(a) == forest.root(b):
                continue
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if near.links(common, int(sizes[a] + sizes[b]) - common):
                forest.join(a, b)
                links.append((docs[a], docs[b]))
        if links:
            yield pair_batch(links)


def ngram_components(
    docs: DataFrame, width: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_shingles, component_id`` for every row: the smallest key that links reach.

    Two documents link when their sets of distinct shingles of ``width`` words (A-Z lowered)
    have at least ``percent`` in a hundred of their union in common. No link between different
    texts is lost, so components are those of all links.

    1. Every text becomes a set, a fingerprint and the keys of its sketch's blocks.
    2. Equal sets are one node from here on, however many copies there are.
    3. Nodes that share a block key are compared by a short sketch; a forest of the pairs that
       may link joins them into classes. 4. Within a class, sets are compared exactly; a forest
       of the links gives the components.

    Groups of nodes are compared in chunks of bounded size, one pair of chunks to a task, and
    a task writes at most one row per node, not one per pair.

    Null and empty texts have an empty set, which links with nothing: they are components of
    their own. Rows with a null key have a size, a null component and link nothing. Rows with
    one key are one document: their sets share its component. An empty table gives no rows;
    other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    found = staged(
        mapped(
            rows,
            partial(sketch_rows, width=width, percent=percent),
            "doc long, n long, node long, check long, sketch binary, keys array<long>",
        ),
        "sketches",
    )
    sets = (
        found.filter((F.col("n") > 0) & F.col("doc").isNotNull())
        .groupBy("node", "check", "n")
        .agg(F.min("doc").alias("rep"), F.first("sketch").alias("sketch"))
    )
    sets = staged(sets, "sets")
    classes = candidate_classes(found, sets, percent)
    # sizes and fingerprints are all that is read from here on
    slim = staged(found.select("doc", "n", "node", "check"), "sizes")
    discard(found)
    found = slim
    verified = staged(class_links(rows, sets, classes, width, percent), "verified")
    discard(classes)
    # a document with several sets joins them
    again = found.filter(F.col("n") > 0).select("doc", "node", "check", "n")
    again = again.join(sets.drop("sketch"), ["node", "check", "n"]).select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    several = found.filter(F.col("doc").isNotNull()).groupBy("doc").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi")
    )
    several = several.filter("lo < hi").select(F.col("doc").alias("a"))
    components = connected_components(verified.unionByName(again.join(several, "a", "left_semi")))
    discard(verified)
    result = (
        found.select("doc", "n", "node", "check")
        .join(sets.select("node", "check", "n", "rep"), ["node", "check", "n"], "left")
        .withColumn("rep", F.when(F.col("doc").isNotNull(), F.coalesce("rep", "doc")))
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
    )
    return result.select(
        F.col("doc").cast(kind).alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep").cast(kind).alias("component_id"),
    )


def candidate_classes(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, component``: classes outside of which no set can have a link."""
    blocks = found.filter(F.col("doc").isNotNull()).select(F.explode("keys").alias("key"), "node")
    shared = blocks.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = staged(shared.filter("lo < hi").select("key"), "shared")
    members = staged(blocks.join(shared.hint("merge"), "key", "left_semi").distinct(), "members")
    discard(shared)
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    # one fingerprint, one sketch: equal nodes have equal sets but for a collision, and then
    # either sketch only decides which class they are compared in
    nodes = sets.groupBy("node").agg(F.max("n").alias("n"), F.first("sketch").alias("sketch"))
    # sketches come last, so that they are shuffled once
    rows = chunked(members, "key", sizes).join(nodes, "node")
    rows = tasks(rows.select("key", "i", "j", "side", "node", "n", "sketch"), "key")
    classes = connected_components(
        rows.mapInArrow(partial(candidate_rows, percent=percent), "a long, b long")
    )
    discard(members)
    return classes


def class_links(
    rows: DataFrame, sets: DataFrame, classes: DataFrame, width: int, percent: int
) -> DataFrame:
    """``a, b``: a forest of links between the smallest documents of the sets."""
    members = sets.join(classes, "node").select(
        F.col("component").alias("class"), F.col("rep").alias("node"), "n"
    )
    members = staged(members, "class-members")
    sizes = members.groupBy("class").agg(
        F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).alias("chunks")
    )
    placed = chunked(members.select("class", "node"), "class", sizes)
    # neither side is bounded, so neither is ever broadcast
    texts = placed.hint("merge").join(rows, F.col("node") == F.col("doc"))
    return tasks(texts.select("class", "i", "j", "side", "node", "text"), "class").mapInArrow(
        partial(verified_rows, width=width, percent=percent), "a long, b long"
    )
