"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import Forest, discard, runs, staged
from orelode.llm.components import connected_components

#: Bits of a code, bits of a table's key, and rotations, which are learned apart. Vectors at a
#: cosine of 0.98 differ in about 6% of the bits of a code, so they agree in a table with
#: probability 0.35 and in one of the twelve with 0.994; nearer ones do so more surely.
BITS = 64
KEY_BITS = 16
ROTATIONS = 3
ROUNDS = 30
#: Share of the sample, turned as far as a link allows, that has to agree in a table.
LEAST_RECALL = 0.97
#: Bound of the sample that rotations are learned from, in rows and in numbers.
SAMPLE_ROWS = 8_192
SAMPLE_NUMBERS = 4_000_000
#: Most vectors of a chunk; fuller buckets are compared chunk by chunk.
CHUNK = 1_024

NODE = "node long, count long, embedding array<double>, label_code long"


def usable(embedding: Column, label: Column) -> Column:
    """Neither null, nor zero, nor with a null or non-finite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(embedding, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & embedding.isNotNull() & ~bad & some, F.lit(False))


def learn_rotation(vectors: np.ndarray, seed: int, centred: bool) -> tuple[np.ndarray, np.ndarray]:
    """A projection onto rotated principal directions, and where each bit changes.

    The rotation alternates with the codes: for given codes it is the orthogonal map that brings
    the projections closest to them, which settles in codes with little quantisation error.
    Centred codes are balanced: each bit changes at the median of the sample.
    """
    bits = min(BITS, vectors.shape[1])
    shifted = vectors - vectors.mean(axis=0) if centred else vectors
    _, directions = np.linalg.eigh(shifted.T @ shifted)
    directions = directions[:, ::-1][:, :bits]
    flat = shifted @ directions
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(ROUNDS):
        codes = np.where(flat @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ flat)
        rotation = (left @ right).T
    projection = directions @ rotation
    return projection, np.median(vectors @ projection, axis=0) if centred else np.zeros(bits)


def learn_rotations(vectors: np.ndarray, least: float) -> list:
    """Centred rotations, or, where these would part near vectors, others through the origin.

    Which to take is measured: each vector of the sample is turned in a random direction until
    its cosine is ``least``, and has to agree with itself in a table. Planes through the origin
    part two vectors in proportion to their angle, however crowded the sample is.
    """
    tried = vectors[:2_000]
    turned = np.random.default_rng(9).normal(size=tried.shape)
    turned -= (turned * tried).sum(axis=1, keepdims=True) * tried
    turned /= np.maximum(np.sqrt((turned * turned).sum(axis=1, keepdims=True)), 1e-12)
    turned = least * tried + np.sqrt(1 - least * least) * turned
    for centred in (True, False):
        rotations = [learn_rotation(vectors, seed, centred) for seed in range(ROTATIONS)]
        met = (table_keys(tried, rotations) == table_keys(turned, rotations)).any(axis=1).mean()
        if met >= LEAST_RECALL:
            break
    return rotations


def table_keys(vectors: np.ndarray, rotations: list) -> np.ndarray:
    """The key of every vector in every table; columns are tables."""
    keys = []
    for projection, middle in rotations:
        bits = (vectors @ projection > middle).astype(np.int64)
        for start in range(0, bits.shape[1], KEY_BITS):
            part = bits[:, start : start + KEY_BITS]
            keys.append(part @ (1 << np.arange(part.shape[1])))
    return np.stack(keys, axis=1)


def unit(column: pa.Array, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(values.flatten(), dtype=np.float64).reshape(len(values), width)
    # dividing by the largest component first keeps squares of huge or tiny numbers in range
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def key_rows(batches: Iterator[pa.RecordBatch], rotations: list, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = table_keys(unit(batch.column(2), width), rotations)
        flat = pa.ListArray.from_arrays(
            pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel(), pa.int64())
        )
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, flat], ["node", "count", "embedding", "label_code", "codes"]
        )


def rerank_rows(batches: Iterator[pa.RecordBatch], width: int, least: float) -> Iterator[pa.RecordBatch]:
    """Of each bucket: how many links it adds to every vector, and a forest of the links.

    A pair counts in the first table in which the two meet, and nowhere else.
    """
    for (_, i, j), rows in runs(batches, 3):
        sides = rows.column("side").to_numpy()
        first, second = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        if i == j:
            second = first
        if not len(first) or not len(second) or rows.num_rows < 2:
            continue
        nodes, counts = rows.column("node").to_numpy(), rows.column("count").to_numpy()
        vectors = unit(rows.column("embedding"), width)
        good = vectors[first] @ vectors[second].T >= least
        labels = rows.column("label_code").to_numpy()
        good &= labels[first, None] == labels[None, second]
        good &= nodes[first, None] != nodes[None, second]
        number = rows.column("table")[0].as_py()
        codes = np.stack(rows.column("codes").to_pylist())
        for earlier in range(number):
            good &= codes[first, None, earlier] != codes[None, second, earlier]
        if i == j:
            good &= np.triu(np.ones(good.shape, bool), 1)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, first, good @ counts[second])
        np.add.at(links, second, good.T @ counts[first])
        forest, edges = Forest(len(nodes)), []
        for a, b in zip(*np.nonzero(good)):
            if forest.join(int(first[a]), int(second[b])):
                edges.append((nodes[first[a]], nodes[second[b]]))
        met = np.flatnonzero(links)
        a = [*nodes[met], *(e[0] for e in edges)]
        b = [None] * len(met) + [e[1] for e in edges]
        n = [*links[met], *[None] * len(edges)]
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"]
            )


def near_vectors(
    rows: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Rows link when their labels are equal and their cosine, in double precision, is at least
    ``least``; pairs are looked for among vectors that agree in a table of the codes, so a link
    may be missed (see ``BITS``) but none is made up. Every row is in every table; only the
    rotations come from a bounded sample. Equal vectors are one node with a count, and a bucket
    is compared in chunks, each pair of chunks in a task that returns counts and a forest, so no
    group makes rows for its pairs.

    Rows with a null label, or a vector that is null, empty, zero or holds a null or non-finite
    component, link with nothing and are kept. Vectors of different lengths have no cosine: those
    of each length are compared among themselves, with rotations of their own. Rows with a null key link with nothing and have a null component; rows with one
    key and different vectors share a component. An empty table gives no rows; other columns
    are not read.
    """
    kind = rows.schema[key].dataType.simpleString()
    base = rows.select(
        F.col(key).cast("long").alias("key"),
        F.col(vector).cast("array<double>").alias("embedding"),
        F.xxhash64(label).alias("label_code"),
        usable(F.col(vector), F.col(label)).alias("usable"),
    )
    base = base.withColumn("usable", F.col("usable") & F.col("key").isNotNull())
    base = base.withColumn("mark", F.xxhash64("embedding")).withColumn("check", F.xxhash64("embedding", F.lit(1)))
    good = base.filter("usable")
    widths = good.groupBy(F.size("embedding").alias("width")).count().orderBy("width").collect()
    copies = staged(
        good.groupBy("label_code", "mark", "check").agg(
            F.min("key").alias("node"), F.count("*").alias("count"), F.first("embedding").alias("embedding")
        ),
        "copies",
    )
    nodes = copies.select("node", "count", "embedding", "label_code")
    found = compared(nodes, 0, 0, least)
    for row in widths:  # as a rule one
        some = nodes.filter(F.size("embedding") == row["width"])
        found = found.unionByName(compared(some, row["width"], row["count"], least))
    links = found.filter(F.col("n").isNotNull()).groupBy("a").agg(F.sum("n").alias("n"))
    several = good.join(copies, ["label_code", "mark", "check"]).filter("key != node").select(
        F.col("key").alias("a"), F.col("node").alias("b")
    )
    edges = found.filter(F.col("b").isNotNull()).select("a", "b").unionByName(several)
    components = connected_components(edges)

    own = base.select("key", "label_code", "mark", "check", F.col("usable").alias("ok"))
    groups = copies.select(
        F.col("label_code").alias("l"), F.col("mark").alias("m"), F.col("check").alias("c"), "node", "count"
    )
    same = (F.col("label_code") == F.col("l")) & (F.col("mark") == F.col("m")) & (F.col("check") == F.col("c"))
    result = (
        own.join(groups, same & F.col("ok"), "left")
        .join(links.withColumnsRenamed({"a": "x"}), F.col("node") == F.col("x"), "left")
        .join(components.withColumnsRenamed({"node": "y"}), F.col("key") == F.col("y"), "left")
    )
    component = F.coalesce("component", "key")
    return result.select(
        F.col("key").cast(kind).alias(key),
        F.when(F.col("node").isNotNull(), F.col("count") - 1 + F.coalesce("n", F.lit(0))).otherwise(0)
        .cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"),
    )


def compared(nodes: DataFrame, width: int, total: int, least: float) -> DataFrame:
    """``a, b, n``: link counts of nodes (with ``n``) and forest edges (with ``b``)."""
    spark = nodes.sparkSession
    if not total:
        return spark.createDataFrame([], "a long, b long, n long")
    most = max(64, min(SAMPLE_ROWS, SAMPLE_NUMBERS // width))
    place = F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = nodes.filter(place * total < most).select("embedding").limit(2 * most).toArrow()
    sample = unit(sample.column(0), width) if sample.num_rows else np.eye(1, width)
    if len(sample) < 2:
        sample = np.concatenate([sample, -sample])
    rotations = learn_rotations(sample, least)

    coded = nodes.mapInArrow(partial(key_rows, rotations=rotations, width=width), f"{NODE}, codes array<long>")
    coded = staged(coded, "codes")
    bucket = F.xxhash64("label_code", "table", "code").alias("bucket")
    placed = coded.select("node", "label_code", F.posexplode("codes").alias("table", "code"))
    placed = placed.select("node", "table", bucket)
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1")
    chunks = sizes.select(F.col("bucket").alias("b"), F.ceil(F.col("rows") / CHUNK).alias("chunks"))
    placed = placed.join(chunks, F.col("bucket") == F.col("b")).drop("b")
    placed = placed.withColumn("_own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    placed = placed.select(
        "bucket", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"), "node", "table",
    )
    full = placed.join(coded, "node").select(
        "bucket", "i", "j", "side", "node", "table", "count", "embedding", "label_code", "codes"
    )
    full = full.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    links = staged(
        full.mapInArrow(partial(rerank_rows, width=width, least=least), "a long, b long, n long"), "links"
    )
    discard(coded)
    return links
