"""Whitening against numpy's own eigenvectors and exact sums."""

import numpy as np
import pytest

from tallymart.llm.whitening import deviations, fit_whitening, leading_components, whitened_rows, whole_vectors

ROTATION = np.linalg.qr(np.random.default_rng(3).standard_normal((40, 40)))[0]


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 4, 2] + [1] * 36,
        [5, 5, 5, 5] + [1] * 36,
        [5, 5 - 1e-13, 5 - 2e-13, 5 - 1e-9] + [1] * 36,
        [3] * 40,
        [1, 0.5, 0.25, 1e-6] + [1e-9] * 36,
        [1e12, 1, 1e-20] + [0] * 37,
        [2, 1] + [0] * 38,
    ],
)
def test_components_of_known_matrices(values):
    matrix = (ROTATION * np.array(values, dtype=float)) @ ROTATION.T
    found, vectors = leading_components((matrix + matrix.T) / 2, 4)
    count = sum(v > 1e-11 * values[0] for v in values[:4])
    assert len(found) == count
    assert np.allclose(found, values[:count], rtol=0, atol=1e-13 * values[0])
    assert np.abs(vectors @ vectors.T - np.eye(count)).max() < 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-13 * values[0]


@pytest.mark.parametrize("matrix", [np.diag([4.0, 3, 2, 1, 0.5]), np.eye(5), np.ones((5, 5)), np.array([[2.0]]), np.zeros((3, 3))])
def test_components_of_small_matrices(matrix):
    found, vectors = leading_components(matrix, 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    assert np.allclose(found, want[want > 1e-9])
    assert np.allclose(vectors @ matrix, found[:, None] * vectors)


def exact(rows, count=4):
    """vec_id and component to n, deviation, whitened, explained, from numpy and Python's whole numbers."""
    kept = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    matrix = np.cov(np.array(distinct, dtype=float).T, bias=True)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        whitened = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
        out += [(i, k + 1, n, deviation, whitened[k], values[k] / np.trace(matrix)) for k in range(count)]
    return out


def agree(got, want):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], abs(r[4]))
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose(np.abs([r[4] for r in got]), np.abs([r[4] for r in want]), atol=1e-8)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-10)
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9
    by_component = {}
    for a, b in zip(got, want, strict=True):
        if abs(b[4]) > 1e-6:
            by_component.setdefault(a[1], set()).add(np.sign(a[4]) == np.sign(b[4]))
    assert all(len(signs) == 1 for signs in by_component.values())  # one sign for all rows


def test_whole_table(spark, sf_dir):
    from tallymart.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    agree(QUERIES["op12_whitening"](spark, sf_dir).collect(), exact([tuple(r) for r in rows]))


def frame(spark, rows, kind="double"):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return made.selectExpr("vec_id", f"CAST(embedding AS array<{kind}>) AS embedding", "1 AS x", "2 AS n", "3 AS width")


def test_unusable_vectors_are_dropped(spark):
    random = np.random.default_rng(5)
    good = [(k, (random.standard_normal(6) * [1, 2, 3, 4, 5, 6]).tolist()) for k in range(60)]
    good += [good[0], (None, good[1][1]), (70, good[2][1]), (71, [-0.001, 100.0, -100.0, 0.0, -0.0, 127.99609375])]
    nan, inf = float("nan"), float("inf")
    bad = [(80, None), (81, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (82, [nan] * 6), (83, [1.0] * 5 + [-inf]), (84, [])]
    bad += [(85, [1e300] + [0.0] * 5), (86, [1.0, 2.0])]
    agree(whitened_rows(frame(spark, good + bad).repartition(7)).collect(), exact(good))


def test_nothing_varies(spark):
    assert whitened_rows(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitened_rows(frame(spark, [(1, None)])).count() == 0
    assert whitened_rows(frame(spark, [(1, [1.0])]).limit(0)).count() == 0


def test_a_line_has_one_component(spark):
    rows = [(k, [float(k), 2.0 * k, 0.5]) for k in range(9)]
    agree(whitened_rows(frame(spark, rows, "float")).collect(), exact(rows, count=1))


def test_deviations_beyond_64_bits_are_null():
    x = np.array([[1 << 40, 0], [3, 5]])
    assert deviations(x, 2, ((1 << 40) + 3, 5)) == [None, None]
    assert deviations(x[1:], 1 << 33, (0, 0)) == [None]
    assert deviations(np.array([[1 << 31]]), 1, (0,)) == [1 << 62]


def test_vectors_of_several_widths_have_no_fit(spark):
    vectors = whole_vectors(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(ValueError, match="1 to 2 entries"):
        fit_whitening(vectors)
