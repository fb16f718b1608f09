"""Whitening against exact sums and a dense eigenvalue problem."""

import math

import numpy as np

from wayfold.llm import whitening


def plain(rows, most=16):
    """Exact deviation and dense whitening of usable rows, given as (vec_id, list)."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in usable]
    distinct = sorted({tuple(v) for _, v in x})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    mean = np.array([s / n for s in sums])
    a = np.array(distinct, float) - mean
    e, w = np.linalg.eigh(a.T @ a / n)
    e, w = e[::-1][:most], w[:, ::-1][:, :most]
    return n, {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x}, e, w, np.trace(a.T @ a / n), {i: (np.array(v) - mean) @ w / np.sqrt(e) for i, v in x}


def check(found, rows, most=16):
    n, deviation, e, w, trace, coordinates = plain(rows, most)
    by = {}
    for r in found:
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]] and r["identity_error"] < 1e-9
        assert abs(r["explained"] / (e[r["component"] - 1] / trace) - 1) < 1e-9
        by.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    assert sorted(by) == list(range(1, len(e) + 1))
    for k, own in by.items():
        ids = sorted(own)
        got, want = np.array([own[i] for i in ids]), np.array([coordinates[i][k - 1] for i in ids])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
    return n


def test_whitening_of_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r[0], r[1]) for r in table.select("vec_id", "embedding").collect()]
    assert check(whitening.whiten(table).collect(), rows) == 500


def test_whitening_leaves_unusable_rows_out_and_fits_equal_rows_once(spark):
    rng = np.random.default_rng(4)
    good = [(k, [float(c) for c in row]) for k, row in enumerate(rng.normal(size=(60, 3)) * [5, 1, 0.1])]
    rows = good + [(100 + k, good[0][1]) for k in range(200)]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, math.nan, 2.0]), (904, [math.inf, 0.0, 0.0]), (905, [1e300, 0.0, 0.0]), (906, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "n", 7) for i, v in rows + bad + [(7, good[7][1])]], "vec_id int, embedding array<double>, n string, x int")
    found = whitening.whiten(table).collect()
    assert check(found, rows) == 60
    assert len(found) == 3 * 261 and not {r["vec_id"] for r in found} & {900, 901, 902, 903, 904, 905, 906}


def test_whitening_of_dependent_and_single_rows(spark):
    rng = np.random.default_rng(5)
    flat = [(k, [float(a), 3.0, float(a), float(b)]) for k, (a, b) in enumerate(rng.normal(size=(80, 2)))]
    found = whitening.whiten(spark.createDataFrame(flat, "vec_id long, embedding array<double>")).collect()
    by = {}
    for r in found:
        by.setdefault(r["component"], []).append(r)
    assert all(r["whitened"] is None and r["explained"] == 0 for k in (3, 4) for r in by[k])
    coordinates = np.array([[r["whitened"] for r in sorted(by[k], key=lambda r: r["vec_id"])] for k in (1, 2)])
    assert np.abs(coordinates @ coordinates.T / 80 - np.eye(2)).max() < 1e-9
    one = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0])], "vec_id long, embedding array<double>")).collect()
    assert len(one) == 4 and all(r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in one)
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_factors_need_passes_where_rows_are_nearly_dependent(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-(10**9), 10**9, size=(400, 1))
    x = np.concatenate([base + 5, base + rng.integers(-2, 3, size=(400, 1)), rng.integers(-3, 4, size=(400, 1))], 1)
    table = spark.createDataFrame([(row.tolist(),) for row in np.unique(x, axis=0)], "x array<long>")
    model = whitening.fit(table, 3)
    a = np.unique(x, axis=0).astype(float)
    a -= a.mean(0)
    singular = np.linalg.svd(a)[1] ** 2 / len(a)
    assert model.passes > 1 and model.identity_error < 1e-4
    assert np.abs(model.eigenvalues / singular - 1).max() < 1e-4


def test_whole_numbers_stay_exact_beyond_64_bits():
    m = np.array([[1 << 60, -5], [3, 1 << 61]], np.int64)
    difference = whitening.scaled_difference(m, 10, [7, -(1 << 62)])
    assert difference.tolist() == [[10 * (1 << 60) - 7, -50 + (1 << 62)], [23, 10 * (1 << 61) + (1 << 62)]]
    assert whitening._exact_squares(difference) == [None, None]
    assert whitening._exact_squares(np.array([[3_037_000_499, 0]])) == [3_037_000_499**2]
