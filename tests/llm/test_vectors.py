"""Exact search and whitening against brute force on small tables with odd rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from postmill.llm import exact_search
from postmill.llm.exact_search import Tile, best_of_cell
from postmill.llm.vectors import scaled
from postmill.llm.whitening import RESIDUAL, leading, whiten

SCHEMA = "vec_id long, embedding array<double>, size int, cell string, rank string"
rng = np.random.default_rng(11)
ODD = [(7000, None), (7050, []), (7100, [float("nan")] * 6), (7150, [None] * 6), (7200, [1.0]), (7250, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0])]


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, "clash", "clash") for i, v in rows], SCHEMA.replace("double", kind))


def nearest(rows, k, factor=256, every=50):
    """Brute force in whole numbers over distinct rows."""
    whole = sorted({(i, tuple(math.floor(Fraction(factor) * Fraction(x)) for x in v)) for i, v in rows})
    out = []
    for i, v in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def found(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("tile, dims", [(64, 2), (7, 1), (999, 5)])
def test_tiles_find_the_best(monkeypatch, tile, dims):
    monkeypatch.setattr(exact_search, "TILE", tile)
    monkeypatch.setattr(exact_search, "DIMS", dims)
    x = (rng.normal(size=(500, 9)) * rng.uniform(0, 90, (500, 1))).astype(np.int64)
    x[90:160] = x[7]
    order = rng.permutation(9)
    tiles = [Tile(np.arange(a, min(a + tile, 500)), x[a : a + tile], order) for a in range(0, 500, tile)]
    q, ids, score = best_of_cell(tiles, Tile(np.arange(0, 500, 10), x[::10], order), np.full(50, exact_search.NONE), 5)
    got = [(10 * int(a), int(b), int(s)) for a, b, s in zip(q, ids, score, strict=True)]
    assert got == [(i, j, s) for i, _, j, s in nearest(list(enumerate(x.tolist())), 5, 1, 10)]


def test_exact_search(spark):
    vectors = rng.normal(size=(700, 6)) * rng.uniform(0.2, 3, (700, 1)) * [4, 1, 1, 0.5, 0.1, 0.1]
    vectors[200:330] = vectors[40]  # a frequent vector, with ties
    vectors[350] = 0  # a zero vector takes part
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(50, vectors[3].tolist()), rows[100], rows[7]]  # one id with two vectors, repeated rows
    given = table(spark, rows + ODD + [(None, [1.0] * 6)])
    got = exact_search.search(given, given.where("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(got) == nearest(rows, 5)


def test_exact_search_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [3.0, 0.0])]
    given = table(spark, rows)
    assert found(exact_search.search(given, given.where("vec_id = 0"))) == nearest(rows, 5)
    assert exact_search.search(given.limit(0), given.limit(0)).count() == 0
    assert exact_search.search(given, given.limit(0)).count() == 0
    assert exact_search.search(given.where("vec_id = 0"), given).where("query_id = 0").count() == 0


def test_exact_search_large_numbers(spark):
    rows = [(k, v) for k, v in enumerate((rng.integers(-(2**30), 2**30, (60, 3)) / 256.0).tolist())]
    given = table(spark, rows)
    assert found(exact_search.search(given, given.where("vec_id % 50 = 0"))) == nearest(rows, 5)


def test_bounds_skip_work():
    """With mass in the first dimensions, few pairs are left for the last ones."""
    x = (rng.normal(size=(2000, 64)) * (200 * 0.85 ** np.arange(64))).astype(np.int64)
    order = np.arange(64)
    tile, asked = Tile(np.arange(2000), x, order), Tile(np.arange(20), x[:20], order)
    seen = []
    reach = np.einsum
    exact_search.np.einsum = lambda how, a, b: seen.append(a.shape[1]) or reach(how, a, b)
    try:
        q, ids, _ = best_of_cell([tile], asked, np.sort(x[:20] @ x.T, axis=1)[:, -9], 5)
    finally:
        exact_search.np.einsum = reach
    assert len(ids) == 100 and sum(seen) < 20 * 2000 / 10


@pytest.mark.parametrize("spread", [np.ones(70), np.linspace(1, 2, 70), 0.7 ** np.arange(70), np.repeat([5.0, 1.0], [10, 60])])
def test_leading_components(spread):
    turn = np.linalg.qr(rng.normal(size=(70, 70)))[0]
    matrix = (turn * spread) @ turn.T
    value, vector = leading(lambda q: matrix @ q, 70, 8, 20)
    assert np.allclose(value, np.sort(spread)[::-1][:8], rtol=1e-12)
    assert np.linalg.norm(matrix @ vector - vector * value, axis=0).max() <= 100 * RESIDUAL * value[0]
    assert np.allclose(vector.T @ vector, np.eye(8), atol=1e-12)


def test_whitening(spark):
    vectors = (rng.normal(size=(400, 6)) * [1, 0.9, 0.5, 0.3, 0.2, 0.1] + rng.normal(size=6)).tolist()
    rows = list(enumerate(vectors)) + [(3, vectors[3]), (None, vectors[9])]  # a repeated row and a null id
    got = whiten(table(spark, rows + ODD, "float")).collect()
    x = scaled(np.array([v for _, v in rows]).astype(np.float32).astype(np.float64), 1024, 100000)
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    value, vector = np.linalg.eigh((off / n).T @ (off / n) / n)
    value, vector = value[::-1], vector[:, ::-1]
    expected = off / n @ vector / np.sqrt(value)
    assert len(got) == 6 * n and {r.n for r in got} == {n}
    key = [-1 if i is None else i for i, _ in rows]
    for c in range(6):
        mine = sorted((-1 if r.vec_id is None else r.vec_id, r.whitened, int(r.deviation), r.explained) for r in got if r.component == c + 1)
        sign = np.sign(mine[0][1] * expected[key.index(-1), c])
        theirs = sorted((k, sign * w, int((o**2).sum()), value[c] / value.sum()) for k, w, o in zip(key, expected[:, c], off, strict=True))
        assert [m[::2] for m in mine] == [t[::2] for t in theirs]
        assert np.allclose([m[1::2] for m in mine], [t[1::2] for t in theirs], rtol=1e-9, atol=1e-9)
    assert max(r.identity_error for r in got) < 1e-10


def test_whitening_odd_tables(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    nothing = whiten(table(spark, ODD).where("vec_id <> 7200"))
    assert nothing.columns == columns and nothing.count() == 0
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(k, [0.5, 0.25]) for k in range(5)])).count() == 0  # equal vectors: no variance
    line = whiten(table(spark, [(k, [0.5 * k, 1.0, -0.5 * k]) for k in range(5)])).collect()
    assert len(line) == 5 and all(r.component == 1 and abs(r.explained - 1) < 1e-12 for r in line)
    far = whiten(table(spark, [(k, [1e30 * (-1) ** k, float(k)]) for k in range(4)]))  # beyond 64 bits
    assert far.where("deviation is null or whitened is null").count() == 0 and far.count() >= 4
