"""Whitening against a direct computation on the whole table."""

import math

import numpy as np
import pytest

from orelode.llm import whitening
from orelode.llm.queries import op13_embedding_whitening
from orelode.llm.whitening import leading_components, whiten

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label string, n long"


def expected(vectors, most=8):
    """Exact deviations, eigenvalues, explained shares and whitened values of equally long vectors."""
    x = [[min(max(math.floor(1024 * c) + 100000, -(2**52)), 2**52) for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    covariance = y.T @ y / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    return deviation, values, values / np.trace(covariance), y @ directions / np.sqrt(np.maximum(values, 1e-300))


def compared(frame, vectors, keys):
    deviation, values, explained, whitened = expected(vectors)
    found = {}
    for row in frame.collect():
        found.setdefault(row["vec_id"], {})[row["component"]] = row
    assert sorted(found) == sorted(keys)
    for place, key in enumerate(keys):
        assert sorted(found[key]) == list(range(1, len(values) + 1))
        for row in found[key].values():
            assert (row["n"], row["deviation"]) == (len(vectors), deviation[place])
            assert row["explained"] == pytest.approx(explained[row["component"] - 1], rel=1e-9)
            assert row["identity_error"] < 1e-9
    table = np.array([[found[key][k + 1]["whitened"] for k in range(len(values))] for key in keys])
    signs = np.sign((table * whitened).sum(axis=0))
    assert np.allclose(table * signs, whitened, atol=1e-7)


def test_the_query_over_its_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    found = op13_embedding_whitening(spark, SF_DIR)
    assert found.columns == "vec_id component n deviation whitened explained identity_error".split()
    compared(found, [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_bad_vectors_go_and_clashing_columns_do_not_matter(spark):
    dice = np.random.default_rng(5)
    good = [[float(np.float32(c)) for c in v] for v in dice.normal(size=(40, 3)) * [3, 2, 1]]
    bad = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0], [float("-inf")] * 3, []]
    rows = [(i, v, None, 7) for i, v in enumerate(good)] + [(100 + i, v, "x", 7) for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    compared(whiten(frame), good, range(40))


def test_repeated_rows_and_null_keys_are_rows(spark):
    frame = spark.createDataFrame([(1, [0.0, 1.0], None, 0)] * 2 + [(None, [1.0, 0.0], None, 0)] * 2, SCHEMA)
    found = whiten(frame).collect()
    assert len(found) == 8 and {r["n"] for r in found} == {4}
    assert {r["vec_id"] for r in found} == {1, None}
    # both entries move together, so all variance lies in one component
    second = [r for r in found if r["component"] == 2]
    assert all(r["whitened"] is None and r["explained"] == 0 for r in second)
    assert [abs(r["whitened"]) for r in found if r["component"] == 1] == pytest.approx([1.0] * 4)


def test_each_length_is_a_fit_of_its_own(spark):
    dice = np.random.default_rng(6)
    short, long = dice.normal(size=(30, 2)).tolist(), dice.normal(size=(20, 12)).tolist()
    rows = [(i, v) for i, v in enumerate(short + long)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = whiten(frame)
    compared(found.filter("vec_id < 30"), short, range(30))
    compared(found.filter("vec_id >= 30"), long, range(30, 50))


def test_no_vectors_give_no_rows(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, None, 0)], SCHEMA)).collect() == []


def test_huge_entries_are_held_and_their_deviation_may_not_fit(spark):
    rows = [(i, [v]) for i, v in enumerate([1e300, 0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whiten(frame).collect()
    assert len(found) == 3 and all(r["deviation"] is None for r in found)
    assert whitening.deviations(np.array([[3], [4]]), 2, [7]) == [1, 1]


def test_a_pivot_of_zero_counts_as_below():
    values, _ = leading_components(np.array([[1.0, -1.0], [-1.0, 1.0]]), 2)
    assert values == pytest.approx([2.0, 0.0], abs=1e-15)


@pytest.mark.parametrize("size", [1, 2, 3, 9, 40])
def test_leading_components_are_those_of_the_matrix(size):
    dice = np.random.default_rng(size)
    basis, _ = np.linalg.qr(dice.normal(size=(size, size)))
    for spectrum in (dice.exponential(size=size), np.ones(size), np.repeat([4.0, 1.0], size)[:size], np.zeros(size)):
        matrix = (basis * spectrum) @ basis.T
        values, vectors = leading_components((matrix + matrix.T) / 2, 8)
        count = min(8, size)
        assert values == pytest.approx(np.sort(spectrum)[::-1][:count], abs=1e-12)
        assert np.allclose(vectors.T @ vectors, np.eye(count), atol=1e-12)
        assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12)
