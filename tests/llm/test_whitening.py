from fractions import Fraction

import numpy as np
import pytest

from asterism.llm import whitening
from asterism.llm.whitening import cross_products, fit_whitening, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string"


@pytest.fixture
def table(spark):
    def make(vectors, ids=None):
        ids = range(len(vectors)) if ids is None else ids
        return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in zip(ids, vectors)], SCHEMA)

    return make


def brute(vectors):
    """Whole numbers, their exact covariance and deviations, from plain Python numbers."""
    x = [[int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dims)]
    cov = [
        [Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(dims)] for i in range(dims)
    ]
    return x, s, cov, [sum((n * r[d] - s[d]) ** 2 for d in range(dims)) for r in x]


@pytest.mark.parametrize("low, high, rows", [(-9, 9, 1), (-300, 300, 130), (0, 1, 65), (-(1 << 62), 1 << 62, 20), (7, 7, 5)])
def test_products_of_bit_planes_are_exact(low, high, rows):
    x = np.random.default_rng(1).integers(low, high, (rows, 5), endpoint=True)
    sums, products = cross_products(x)
    plain = x.astype(object)
    assert sums.tolist() == plain.sum(axis=0).tolist()
    assert products.tolist() == (plain.T @ plain).tolist()


def test_equals_brute_force(spark, table):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(150, 6)) @ rng.normal(size=(6, 6))).astype(np.float32).tolist()
    x, s, cov, deviations = brute(vectors)
    n = len(x)
    got = whiten(table(vectors).repartition(5), components=4).collect()
    assert len(got) == n * 4
    values, vecs = np.linalg.eigh(np.array(cov, float))
    order = np.argsort(-values)[:4]
    centred = np.array([[n * a - b for a, b in zip(r, s)] for r in x], float) / n
    want = centred @ vecs[:, order] / np.sqrt(values[order])
    found = np.full((n, 4), np.nan)
    for r in got:
        assert r["n"] == n and r["deviation"] == deviations[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[order][r["component"] - 1] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.abs(found) - np.abs(want)).max() < 1e-8
    # a sign is one for all rows
    assert np.allclose(found * np.sign(found[0] * want[0]), want, atol=1e-8)
    assert np.abs(np.cov(found.T, bias=True) - np.eye(4)).max() < 1e-8


def test_tasks_and_blocks_do_not_matter(spark, table, monkeypatch):
    vectors = np.random.default_rng(3).normal(size=(300, 4)).tolist()
    one = fit_whitening(table(vectors).coalesce(1))
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1)
    many = fit_whitening(table(vectors).repartition(7))
    assert one.n == many.n == 300 and one.sums == many.sums
    assert np.array_equal(one.values, many.values)


def test_rows_that_go_and_rows_that_stay(spark, table):
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [3.0, -1.0]]
    bad = [None, [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [], [1.0, 2.0, 3.0]]
    ids = [1, 1, None, None, 5, 6, 7, 8, 9, 10]
    got = whiten(table([*good, *bad], ids)).collect()
    assert sorted([r["vec_id"] for r in got if r["component"] == 1], key=str) == [1, 1, None, None]
    assert {r["n"] for r in got} == {4} and {r["component"] for r in got} == {1, 2}


def test_large_entries_are_exact(spark, table):
    vectors = [[2.0**50, 1.0], [-(2.0**50), 2.0], [3.0, 5.0]]
    _, _, _, deviations = brute(vectors)
    got = {r["vec_id"]: r for r in whiten(table(vectors)).collect()}
    for i, want in enumerate(deviations):
        assert got[i]["deviation_digits"] == str(want)
        assert got[i]["deviation"] == (want if want < 1 << 63 else None)
    whiten(table([[3e38, 1.0], [-3e38, 0.0]])).collect()


def test_nothing_varies(spark, table):
    got = whiten(table([[1.0, 2.0]] * 3)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in got} == {(0.0, 0.0, 0.0, 0)}
    flat = whiten(table([[float(i), 2.0 * i] for i in range(9)])).collect()  # one direction only
    assert {r["whitened"] for r in flat if r["component"] == 2} == {0.0}
    assert max(r["identity_error"] for r in flat) < 1e-9


def test_empty_tables(spark, table):
    for vectors in ([], [None, []]):
        got = whiten(table(vectors))
        assert got.count() == 0 and got.columns[:3] == ["vec_id", "component", "n"]


def test_too_wide_vectors_are_refused(spark, table, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_DIMS", 2)
    with pytest.raises(ValueError, match="3 entries"):
        whiten(table([[1.0, 2.0, 3.0]]))
