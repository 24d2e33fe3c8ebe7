import math

import numpy as np
import pytest

from skyledger.llm.whitening import _squares, bidiagonalise, whiten_vectors, whitened_rows

SCHEMA = "vec_id long, embedding array<double>, label int, x string, component string, n string, deviation int, whitened string, at string, total int"
CLASH = (1, "x", "c", "n", 3, "w", "a", 5)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(4)


def plain(rows):
    """n, eigenvalues and vectors (falling), deviations and centred rows by numpy's dense methods."""
    sound = [(i, x) for i, x in rows if x and all(v is not None and math.isfinite(v) for v in x)]
    length = max(len(x) for _, x in sound)
    kept = [(i, [math.floor(v * 1024) + 100_000 for v in x]) for i, x in sound if len(x) == length]
    n, sums = len(kept), [sum(c) for c in zip(*[x for _, x in kept])]
    deviations = [sum((n * v - s) ** 2 for v, s in zip(x, sums)) for _, x in kept]
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for _, x in kept])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in kept], n, values[::-1], basis[:, ::-1], deviations, centred


def same(spark, rows, components=8):
    ids, n, values, basis, deviations, centred = plain(rows)
    table = whitened_rows(frame(spark, rows)).collect()
    components = min(components, len(values))
    assert len(table) == len(ids) * components
    expected = centred @ (basis / np.sqrt(values.clip(1e-30)))[:, :components]
    by_component = {c: sorted((r for r in table if r.component == c), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation, abs(r.whitened))) for c in range(1, components + 1)}
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, deviations[k], abs(expected[k, 0])))
    for c, own in by_component.items():
        assert [(r.vec_id, r.n, r.deviation) for r in own] == [(ids[k], n, deviations[k]) for k in order]
        assert {r.explained for r in own} == {own[0].explained}
        assert own[0].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        got, want = np.array([r.whitened for r in own]), expected[order, c - 1]
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-8
    assert {r.identity_error for r in table} == {table[0].identity_error} and table[0].identity_error < 1e-9


def test_against_dense_methods(spark):
    r = np.random.default_rng(0)
    data = r.normal(size=(400, 12)) @ np.diag(np.linspace(3, 0.1, 12)) + r.normal(size=12) * 5
    same(spark, [(i, x.tolist()) for i, x in enumerate(data)])


def test_fewer_components_than_eight(spark):
    r = np.random.default_rng(1)
    same(spark, [(i, x.tolist()) for i, x in enumerate(r.normal(size=(50, 3)))])


def test_awkward(spark):
    r = np.random.default_rng(2)
    rows = [(i, x.tolist()) for i, x in enumerate(r.normal(size=(40, 4)))]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, [0.0] * 4)]
    odd = [(50, None), (51, []), (52, [None] * 4), (53, [math.nan] + [0.0] * 3), (54, [-math.inf] * 4), (55, [1.0] * 3)]
    same(spark, rows + odd)
    assert whitened_rows(frame(spark, odd[:5])).collect() == whitened_rows(frame(spark, [])).collect() == []
    assert whitened_rows(frame(spark, rows[:1])).collect() == whitened_rows(frame(spark, [(1, [2.0, 3.0])] * 9)).collect() == []
    with pytest.raises(Exception, match="don't fit"):
        whitened_rows(frame(spark, [(1, [1e30, 1.0])])).collect()


def test_flat_and_equal_directions(spark):
    """Constant components have no variance and no row; equal eigenvalues give some orthonormal basis of their space."""
    corners = [(a, b, c) for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    made, model = whiten_vectors(frame(spark, [(i, [*c, 5.0, 5.0]) for i, c in enumerate(corners)]))
    assert model["eigenvalues"] == pytest.approx([1024.0**2] * 3) and model["identity_error"] < 1e-9
    assert all(len(r.whitened) == 3 for r in made.collect())
    assert model["explained"].sum() == pytest.approx(1)


@pytest.mark.parametrize("shape, spectrum", [((300, 90), "steep"), ((200, 200), "even"), ((50, 120), "even"), ((80, 30), "repeated")])
def test_bidiagonalisation(shape, spectrum):
    """Beside LAPACK, with fewer steps than components where the spectrum lets it end early."""
    r = np.random.default_rng(3)
    u, _ = np.linalg.qr(r.normal(size=(shape[0], min(shape))))
    v, _ = np.linalg.qr(r.normal(size=(shape[1], min(shape))))
    values = {"steep": 100 * 0.5 ** np.arange(min(shape)), "even": np.linspace(2, 1, min(shape)), "repeated": np.repeat([3.0, 2, 1], min(shape) // 3)}[spectrum]
    x, passes = u * values @ v.T, []

    def product(z):
        passes.append(1)
        return float((x @ z) @ (x @ z)), x.T @ (x @ z)

    found, basis = bidiagonalise(product, shape[1], 8)
    assert found == pytest.approx(values[:8], rel=1e-12)
    assert np.abs(basis.T @ basis - np.eye(8)).max() < 1e-12
    assert np.abs(x.T @ (x @ basis) - basis * found**2).max() < 1e-10 * values[0] ** 2
    assert len(passes) <= shape[1] + 15 and (spectrum != "steep" or len(passes) < 80)


def test_large_squares():
    r = np.random.default_rng(4)
    rows = r.integers(-(2**59), 2**59, (5, 64))
    assert [int(d) for d in _squares(rows).to_pylist()] == [sum(int(v) ** 2 for v in row) for row in rows]
