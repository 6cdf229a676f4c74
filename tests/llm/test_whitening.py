"""Whitening against numpy's own decomposition of the covariance."""

import math

import numpy as np
import pytest

from docroute.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def plain(vectors):
    """(rows, components) of whitening, with numpy on the whole table."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    off = x * n - sums
    centred = off.astype(float) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    return (off * off).sum(axis=1), centred, values, found


def compare(rows, ids, vectors, most=8):
    deviation, centred, values, found = plain(vectors)
    k = min(most, len(values))
    assert len(rows) == len(vectors) * k
    by = {}
    for r in rows:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for c in range(1, k + 1):
        want = centred @ found[:, c - 1]
        live = values[c - 1] > 1e-12 * values[0]
        got = {i: sorted(by[c][i], key=lambda r: (r.deviation, r.whitened or 0)) for i in by[c]}
        assert sorted(by[c], key=repr) == sorted(set(ids), key=repr)
        first = np.array([got[i][0].whitened if got[i][0].whitened is not None else np.nan for i in ids])
        for i, d in zip(ids, deviation):
            assert int(d) in [int(r.deviation) for r in got[i]]
            assert all(r.n == len(vectors) for r in got[i])
            assert math.isclose(got[i][0].explained, max(values[c - 1], 0) / values.sum() if values.any() else 0, rel_tol=1e-6, abs_tol=1e-12)
        if not live:
            assert np.isnan(first).all()
            continue
        single = [j for j, i in enumerate(ids) if ids.count(i) == 1]
        white = want / np.sqrt(values[c - 1])
        sign = np.sign(white[single] @ first[single])
        gaps = np.abs(np.delete(values, c - 1) - values[c - 1]).min() if len(values) > 1 else 1
        if gaps > 1e-6 * values[0]:
            np.testing.assert_allclose(first[single] * sign, white[single], rtol=1e-6, atol=1e-7)
    errors = {r.identity_error for r in rows}
    assert len(errors) == 1
    return errors.pop()


def table(spark, rows, kind="array<double>"):
    schema = f"vec_id long, embedding {kind}, n long, component string, i int, part string, row string, length int"
    return spark.createDataFrame([(i, v, 5, "x", 1, "p", "r", 3) for i, v in rows], schema).repartition(3)


def test_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = queries.op11_embedding_whitening(spark, SF).collect()
    assert compare(got, [r.vec_id for r in rows], [r.embedding for r in rows]) < 1e-9


def test_scales_that_differ_by_ten_orders(spark):
    """The covariance itself would lose the small directions."""
    r = np.random.default_rng(1)
    mixed = r.normal(size=(300, 6)) * [1e6, 1e4, 1e3, 1, 0.1, 0.01]
    vectors = (mixed @ np.linalg.qr(r.normal(size=(6, 6)))[0]).tolist()
    got = whitening.whiten(table(spark, list(enumerate(vectors)))).collect()
    assert max(r.identity_error for r in got) < 1e-6


def test_awkward_rows(spark):
    r = np.random.default_rng(2)
    vectors = r.normal(size=(40, 5)).tolist()
    rows = list(enumerate(vectors)) + [(0, vectors[0]), (None, vectors[1])]
    odd = [(90, None), (91, [1.0, None, 2.0, 3.0, 4.0]), (92, [math.nan] * 5), (93, [math.inf, 0.0, 0.0, 0.0, 0.0]), (94, [1.0, 2.0]), (95, [])]
    got = whitening.whiten(table(spark, rows + odd)).collect()
    assert compare(got, [i for i, _ in rows], [v for _, v in rows]) < 1e-9


@pytest.mark.parametrize("vectors", [[[1.0, 2.0, 3.0]] * 4, [[1.0, 2.0, 3.0]], [[1.0, 2.0, 5.0], [0.5, 2.0, 4.5]]])
def test_directions_without_variance(spark, vectors):
    got = whitening.whiten(table(spark, list(enumerate(vectors)))).collect()
    error = compare(got, list(range(len(vectors))), vectors)
    assert error is None or error < 1e-9


def test_dependent_columns(spark):
    r = np.random.default_rng(3)
    base = np.floor(r.normal(size=(200, 3)) * 100)
    vectors = np.hstack([base, base[:, :1] + base[:, 1:2], np.full((200, 1), 7.0), base[:, 2:] * 2]).tolist()
    got = whitening.whiten(table(spark, list(enumerate(vectors)))).collect()
    assert compare(got, list(range(200)), vectors) < 1e-9
    assert all((r.whitened is None) == (r.component > 3) for r in got)


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**51, 1.0], [-(2.0**50), 5.5], [3.0, 2.0**40]]
    got = whitening.whiten(table(spark, list(enumerate(vectors)))).collect()
    compare(got, [0, 1, 2], vectors)


def test_empty_table(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []


def test_float_vectors(spark):
    vectors = np.random.default_rng(4).normal(size=(30, 10)).astype(np.float32).tolist()
    got = whitening.whiten(table(spark, list(enumerate(vectors)), "array<float>"), most=3).collect()
    assert compare(got, list(range(30)), vectors, 3) < 1e-9
