"""Whitened leading components of vectors, from a covariance that is summed where the rows lie."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import mapped, staged

COMPONENTS = 8
#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE = 1024
SHIFT = 100_000
#: Whole numbers beyond this are set to it: up to here doubles hold them exactly, and a batch of
#: 2,048 of them adds up in 64 bits.
LARGEST = 1 << 52
EPSILON = np.finfo(float).eps
#: Eigenvalues closer than this share of the matrix norm count as one cluster.
CLUSTER = 1e-3
#: A component without variance, but for rounding, has no whitened value.
NO_VARIANCE = 1e-13

OUTPUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for every vector that
    is not null and holds neither null nor non-finite entries, and its first components.

    Entries become whole numbers x, their sums S are exact, and the covariance is that of x - S/n,
    with divisor n. Vectors of one length are fitted together; where lengths differ, each length is
    a fit of its own. Components are numbered by falling variance; there are as many as entries
    where these are fewer, so an empty vector has no row. A component without variance has a null
    ``whitened``. ``deviation`` is null beyond 64 bits; x is held within 2^52. Rows with equal or
    null keys are rows like any other, other columns are ignored, an empty table gives no rows.

    The vectors are written once and read four times. What comes to the driver, and what is
    broadcast, is a matrix of vector length by vector length, however many rows there are.
    """
    vectors = rows.select(F.col(key).alias("key"), F.col(vector).alias("embedding")).filter(usable())
    vectors = staged(vectors, "vectors").withColumn("embedding", F.col("embedding").cast("array<double>"))
    sums = mapped(vectors.select("embedding"), sum_rows, "width int, place int, n long, total decimal(38,0)")
    sums = sums.groupBy("width", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    counts = {row["width"]: row["n"] for row in sums}
    totals = {width: [0] * width for width in counts}
    for row in sums:
        totals[row["width"]][row["place"]] = int(row["total"])
    fits = {width: Fit(counts[width], totals[width]) for width in counts}

    for width, matrix in gathered(vectors, partial(covariance_rows, fits=plain(fits))).items():
        fits[width].solve(matrix / fits[width].n, components)
    for width, matrix in gathered(vectors, partial(whitened_rows, fits=plain(fits))).items():
        fits[width].check(matrix / fits[width].n)

    kind = rows.schema[key].dataType
    found = mapped(vectors, partial(project_rows, fits=plain(fits)), f"key {kind.simpleString()}, {OUTPUT}")
    return found.withColumnRenamed("key", key)


def usable():
    """Vectors of finite entries. NaN counts as above infinity, so it does not lie between."""
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    finite = F.forall("embedding", lambda x: F.coalesce((x > low) & (x < high), F.lit(False)))
    return F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite


class Fit:
    """Sums, components and figures of the vectors of one length."""

    def __init__(self, n: int, totals: list[int]):
        self.n, self.totals = n, totals
        self.directions = np.empty((len(totals), 0))
        self.scales = np.empty(0)
        self.explained = np.empty(0)
        self.error = 0.0

    def solve(self, covariance: np.ndarray, components: int) -> None:
        values, vectors = leading_components(covariance, components)
        trace = float(np.trace(covariance))
        values = np.where(values > NO_VARIANCE * max(trace, 0.0), values, 0.0)
        self.explained = values / trace if trace > 0 else values
        with np.errstate(divide="ignore"):
            self.scales = np.where(values > 0, 1 / np.sqrt(values), np.nan)
        self.directions = vectors

    def check(self, covariance: np.ndarray) -> None:
        shown = np.flatnonzero(~np.isnan(self.scales))
        part = covariance[np.ix_(shown, shown)]
        self.error = float(np.abs(part - np.eye(len(shown))).max()) if len(shown) else 0.0


def plain(fits: dict[int, Fit]) -> dict[int, tuple]:
    """The fits as numbers and arrays, which a worker reads without this library."""
    return {w: (f.n, f.totals, f.directions, f.scales, f.explained, f.error) for w, f in fits.items()}


def gathered(vectors: DataFrame, function) -> dict[int, np.ndarray]:
    """The symmetric matrix of each vector length, added up over all tasks."""
    parts = mapped(vectors.select("embedding"), function, "width int, i int, upper array<double>")
    cells = parts.select("width", "i", F.posexplode("upper").alias("j", "value"))
    table = cells.groupBy("width", "i", "j").agg(F.sum("value").alias("value")).toArrow()
    width, i, j, value = (table.column(c).to_numpy() for c in ("width", "i", "j", "value"))
    found = {}
    for w in np.unique(width):
        here = width == w
        size = int(i[here].max()) + 1
        matrix = np.zeros((size, size))
        # row i of the upper triangle begins at its diagonal
        matrix[i[here], i[here] + j[here]] = value[here]
        found[int(w)] = matrix + np.triu(matrix, 1).T
    return found


# --- inside tasks -----------------------------------------------------------------------


def whole_numbers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each vector length of a batch, its rows and their entries as whole numbers."""
    offsets = column.offsets.to_numpy()
    entries = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        values = entries[offsets[rows][:, None] + np.arange(width)]
        values = np.clip(np.floor(SCALE * values) + SHIFT, -LARGEST, LARGEST)
        yield rows, values.astype(np.int64)


def sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, totals = {}, {}
    for batch in batches:
        for _, x in whole_numbers(batch.column(0)):
            width = x.shape[1]
            before = totals.get(width, [0] * width)
            totals[width] = [a + b for a, b in zip(before, x.sum(axis=0).tolist())]
            counts[width] = counts.get(width, 0) + len(x)
    for width, sums in totals.items():
        yield pa.record_batch(
            [
                pa.array([width] * width, pa.int32()),
                pa.array(range(width), pa.int32()),
                pa.array([counts[width]] * width, pa.int64()),
                pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
            ],
            ["width", "place", "n", "total"],
        )


def centred(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off exactly, then the rest of it."""
    whole = np.array([s // n for s in totals], np.int64)
    rest = np.array([(s % n) / n for s in totals])
    return (x - whole) - rest


def triangle(width: int, matrix: np.ndarray) -> pa.RecordBatch:
    size = len(matrix)
    return pa.record_batch(
        [
            pa.array([width] * size, pa.int32()),
            pa.array(range(size), pa.int32()),
            pa.array([matrix[i, i:] for i in range(size)], pa.list_(pa.float64())),
        ],
        ["width", "i", "upper"],
    )


def covariance_rows(batches: Iterator[pa.RecordBatch], fits: dict) -> Iterator[pa.RecordBatch]:
    """Sums of products of centred entries, one matrix for each length and task."""
    sums = {}
    for batch in batches:
        for _, x in whole_numbers(batch.column(0)):
            width = x.shape[1]
            y = centred(x, *fits[width][:2])
            sums[width] = sums.get(width, 0) + y.T @ y
    for width, matrix in sums.items():
        yield triangle(width, matrix)


def whitened_rows(batches: Iterator[pa.RecordBatch], fits: dict) -> Iterator[pa.RecordBatch]:
    """Sums of products of whitened values, whose mean is 0."""
    sums = {}
    for batch in batches:
        for _, x in whole_numbers(batch.column(0)):
            width = x.shape[1]
            n, totals, directions, scales = fits[width][:4]
            z = centred(x, n, totals) @ directions * np.nan_to_num(scales)
            sums[width] = sums.get(width, 0) + z.T @ z
    for width, matrix in sums.items():
        yield triangle(width, matrix)


def deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """Sums of (n x - S)^2, exact; in Python's whole numbers where 64 bits might not do."""
    whole = np.array([s // n for s in totals], np.int64)
    gaps = x - whole
    most = n * (int(np.abs(gaps).max(initial=0)) + 1)
    if most * most * len(totals) < 1 << 63:
        scaled = n * gaps - np.array([s % n for s in totals], np.int64)
        return (scaled * scaled).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, totals)) for row in x.tolist()]
    return [value if value < 1 << 63 else None for value in exact]


def project_rows(batches: Iterator[pa.RecordBatch], fits: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in whole_numbers(batch.column(1)):
            n, totals, directions, scales, explained, error = fits[x.shape[1]]
            count = len(scales)
            z = centred(x, n, totals) @ directions * scales
            places = np.repeat(rows, count)
            numbers = np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))
            spread = pa.array(deviations(x, n, totals), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), count)))
            size = len(places)
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(places)),
                    pa.array(numbers),
                    pa.array(np.full(size, n, np.int64)),
                    spread,
                    pa.array(z.ravel(), mask=np.isnan(z.ravel())),
                    pa.array(np.tile(explained, len(rows))),
                    pa.array(np.full(size, error)),
                ],
                ["key", *[field.split()[0] for field in OUTPUT.split(", ")]],
            )


# --- the leading part of a symmetric eigenproblem ----------------------------------------


def leading_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns.

    The matrix becomes tridiagonal by Householder reflections; bisection on Sturm counts finds the
    eigenvalues, inverse iteration the vectors, made orthogonal within clusters of close values;
    the reflections carry them back. The largest entry of each vector is positive.
    """
    most = min(most, len(matrix))
    size = np.abs(matrix).max(initial=0.0)
    if size == 0:
        return np.zeros(most), np.eye(len(matrix), most)
    matrix = matrix / size
    diagonal, beside, reflections = tridiagonal(matrix)
    values = bisected(diagonal, beside, most)
    vectors = inverse_iterated(diagonal, beside, values)
    for place, u in reversed(reflections):
        part = vectors[place:]
        part -= 2 * np.outer(u, u @ part)
    vectors /= np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(most)])
    return values * size, vectors * signs


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal, neighbours and the reflections ``(first row, unit vector)`` that lead there."""
    a = matrix.copy()
    reflections = []
    for k in range(len(a) - 2):
        column = a[k + 1 :, k]
        length = np.linalg.norm(column)
        if np.linalg.norm(column[1:]) <= EPSILON * EPSILON * length or length == 0:
            continue
        u = column.copy()
        u[0] += np.copysign(length, u[0])
        u /= np.linalg.norm(u)
        block = a[k + 1 :, k + 1 :]
        p = block @ u
        q = p - (u @ p) * u
        block -= 2 * (np.outer(u, q) + np.outer(q, u))
        a[k + 1 :, k] = a[k, k + 1 :] = column - 2 * u * (u @ column)
        reflections.append((k + 1, u))
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def counts_below(diagonal: np.ndarray, squares: np.ndarray, shifts: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues lie below each shift: the negative pivots of T - shift."""
    below = np.zeros(len(shifts), np.int64)
    pivot = np.full(len(shifts), np.inf)
    for value, square in zip(diagonal, np.concatenate([[0.0], squares])):
        pivot = value - shifts - square / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def bisected(diagonal: np.ndarray, beside: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, each to the last bits of the matrix norm."""
    size = len(diagonal)
    radius = np.abs(np.concatenate([beside, [0]])) + np.abs(np.concatenate([[0], beside]))
    low = np.full(most, (diagonal - radius).min())
    high = np.full(most, (diagonal + radius).max())
    norm = max(np.abs(low[0]), np.abs(high[0]), np.finfo(float).tiny)
    low, high = low - 2 * EPSILON * norm, high + 2 * EPSILON * norm
    squares = beside * beside
    least = np.finfo(float).tiny * max(1.0, float(squares.max(initial=0)))
    # the one numbered i from the top has size - i - 1 eigenvalues below it
    wanted = size - 1 - np.arange(most)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= EPSILON * EPSILON * norm)).all():
            return middle
        above = counts_below(diagonal, squares, middle, least) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def inverse_iterated(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, orthogonal within clusters of close values."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0), np.finfo(float).tiny)
    vectors = np.empty((size, len(values)))
    dice = np.random.default_rng(1)
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first, shift = k, np.inf
        # equal values are moved apart, so that each solve has a matrix of its own
        shift = min(value, shift - 10 * EPSILON * norm)
        factors = factored(diagonal - shift, beside, EPSILON * norm)
        z = dice.standard_normal(size)
        for _ in range(rounds):
            z = solved(factors, z / np.linalg.norm(z))
            for _ in range(2):
                z = z - vectors[:, first:k] @ (vectors[:, first:k].T @ z)
        vectors[:, k] = z / np.linalg.norm(z)
    return vectors


def factored(diagonal: np.ndarray, beside: np.ndarray, least: float) -> list[tuple]:
    """Elimination with row exchanges: ``(exchanged, factor, pivot, next, next but one)`` a row."""
    d, size = diagonal.tolist(), len(diagonal)
    off = [*beside.tolist(), 0.0]
    rows, here, right = [], d[0], off[0]
    for i in range(size - 1):
        under, pivot_below, beyond = off[i], d[i + 1], off[i + 1]
        if abs(here) >= abs(under):
            pivot = here if here else least
            factor = under / pivot
            rows.append((False, factor, pivot, right, 0.0))
            here, right = pivot_below - factor * right, beyond
        else:
            factor = here / under
            rows.append((True, factor, under, pivot_below, beyond))
            here, right = right - factor * pivot_below, -factor * beyond
    rows.append((False, 0.0, here if abs(here) > least else least, 0.0, 0.0))
    return rows


def solved(rows: list[tuple], b: np.ndarray) -> np.ndarray:
    z = b.tolist()
    for i, (exchanged, factor, _, _, _) in enumerate(rows[:-1]):
        if exchanged:
            z[i], z[i + 1] = z[i + 1], z[i]
        z[i + 1] -= factor * z[i]
    z.extend((0.0, 0.0))
    for i in range(len(rows) - 1, -1, -1):
        _, _, pivot, right, beyond = rows[i]
        z[i] = (z[i] - right * z[i + 1] - beyond * z[i + 2]) / pivot
    return np.array(z[:-2])
