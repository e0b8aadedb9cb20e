"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration.

The covariance V is never formed. A pass over the table gives V Q for a block Q of a few columns, from rows
centred before they are multiplied. A Chebyshev polynomial of V, by its three-term recurrence, damps the
spectrum below the block's least Ritz value; QR and Rayleigh-Ritz follow, until the residuals certify the
leading components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import settle
from .vectors import integer_rows, unpacked, usual_size

# Residual, as a share of the greatest eigenvalue, at which a component is certified.
RESIDUAL = 1e-13
# Growth of the wanted over the unwanted part that a filter aims at, and its greatest degree.
GROWTH, DEGREE = 1e6, 24
# Eigenvalues at or below this share of the greatest are numerically zero.
ZERO = 1e-10
_DECIMAL = pa.decimal128(38, 0)
_MOST = 10**38 - 1


def _decimals(values) -> pa.Array:
    """Whole numbers of any size, saturating at 38 digits."""
    return pa.array([Decimal(max(-_MOST, min(_MOST, int(v)))) for v in values], _DECIMAL)


def total(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], length: int, size: int) -> np.ndarray:
    """Sum of `part(rows of a batch)`, an array of `length` doubles, over the table.

    Tasks add up their batches and Spark adds up the tasks, so `length` numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                out += part(unpacked(batch.column("vec"), size)).ravel()
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(length, dtype=np.int32)), "value": pa.array(out)})

    found = rows.select("vec").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(length)
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out


def exact_sums(rows: DataFrame, size: int) -> list[int]:
    """Sum of every entry of the vectors, in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [0] * size
        for batch in batches:
            x = unpacked(batch.column("vec"), size)
            if len(x):
                wide = int(np.abs(x).max()) * len(x) >= 1 << 62
                out = [a + int(b) for a, b in zip(out, (x.astype(object) if wide else x).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(size, dtype=np.int32)), "value": _decimals(out)})

    found = rows.select("vec").mapInArrow(run, "place int, value decimal(38,0)").groupBy("place").agg(F.sum("value").alias("value")).collect()
    return [int(r.value) for r in sorted(found, key=lambda r: r.place)]


class Centre:
    """Rows less their mean, rounded once."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of (n * entry - sum)**2 of each row, exactly."""
        most = max(abs(int(x.min())), abs(int(x.max()))) * self.n + max(map(abs, self.sums)) if x.size else 0
        if most < 1 << 62:
            off = x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        else:
            off = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        if off.dtype == object or int(np.abs(off).max(initial=0)) ** 2 * x.shape[1] >= 1 << 63:
            return _decimals((off.astype(object) ** 2).sum(axis=1))
        return pa.array((off * off).sum(axis=1)).cast(_DECIMAL)


def leading(apply: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, block: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` greatest eigenvalues of a positive semidefinite matrix and unit eigenvectors (columns).

    `apply(Q)` is the matrix times Q. A cycle damps all below the least Ritz value of the block, then takes QR
    and Rayleigh-Ritz. A cycle that gains too little doubles the block; a block of full size is exact.
    """
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(size, min(size, block))))[0]
    before = np.inf
    while True:
        z = apply(q)
        inner = q.T @ z
        value, turn = np.linalg.eigh((inner + inner.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        x, z = q @ turn, z @ turn
        top = max(value[0], 0.0)
        residual = np.linalg.norm(z - x * value, axis=0)[:wanted].max()
        if residual <= RESIDUAL * top or x.shape[1] == size or (residual <= 100 * RESIDUAL * top and residual > before / 2):
            return np.maximum(value[:wanted], 0.0), x[:, :wanted]
        if residual > before / 10:
            more = rng.normal(size=(size, min(size, 2 * x.shape[1]) - x.shape[1]))
            q, before = np.linalg.qr(np.column_stack([x, more]))[0], np.inf
            continue
        before = residual
        # the unwanted spectrum lies in [0, high]; there the polynomial stays below one
        high = max(value[-1], ZERO * top)
        middle = half = high / 2
        gain = np.arccosh(max(1.0, (value[wanted - 1] - middle) / half))
        degree = int(np.clip(np.ceil(np.log(2 * GROWTH) / max(gain, 1e-9)), 2, DEGREE))
        sigma = half / (top - middle)
        scale = 2 / sigma
        x, y = x, (z - middle * x) * (sigma / half)
        for _ in range(degree - 1):
            new = 1 / (scale - sigma)
            x, y = y, (apply(y) - middle * y) * (2 * new / half) - sigma * new * x
            sigma = new
        q = np.linalg.qr(y)[0]


def whiten(
    vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding", factor: int = 1024, shift: int = 100000, block: int = 48
) -> DataFrame:
    """Every row's whitened coordinates: `id_col`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`.

    Entries become x = floor(factor * entry) + shift. All vectors are fitted: n of them with sums S. Components are
    unit eigenvectors of the covariance of x (divisor n), numbered from 1 by falling eigenvalue e; the sign is any.
    `deviation` (decimal) is the sum of (n * x - S)**2, `whitened` the projection of x - S / n over sqrt(e),
    `explained` e over the trace, `identity_error` the greatest entry of the whitened rows' covariance less identity.

    A pass reads the table once and returns a block of `block` columns; the driver holds that and nothing that
    grows with the rows. Equal eigenvalues give any basis of their space. Components with an eigenvalue of at most
    1e-10 of the greatest (constant or dependent entries, fewer rows than components) are left out, so that a table
    of equal vectors has no result rows. Vectors that are null, empty or hold null or non-finite entries are left
    out, as are vectors of another length than the most frequent one. A null id stays null; repeated rows count,
    and are returned, as often as they stand. Entries saturate at 2**61 and deviations at 38 digits.
    """
    spark = vectors.sparkSession
    rows = settle(integer_rows(vectors, id_col, vec_col, factor, shift, ids=False), "integer-vectors")
    size, n = usual_size(rows)
    schema = f"{id_col} long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.col("size") == size)
    centre = Centre(n, exact_sums(rows, size))

    def apply(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ q)

        return total(rows, part, q.size, size).reshape(q.shape) / n

    value, vector = leading(apply, size, min(components, size), block)
    real = value > ZERO * value[0]
    value, vector = value[real], vector[:, real]
    if not len(value):
        return spark.createDataFrame([], schema)
    turn = vector / np.sqrt(value)
    k = len(value)

    def sums(x: np.ndarray) -> np.ndarray:
        c = centre(x)
        return np.append((c @ turn).sum(axis=0), (c * c).sum())

    first = total(rows, sums, k + 1, size) / n
    mean, trace = first[:k], first[k]

    def products(x: np.ndarray) -> np.ndarray:
        w = centre(x) @ turn - mean
        return w.T @ w

    error = float(np.abs(total(rows, products, k * k, size).reshape(k, k) / n - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("vec"), size)
            own = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column("id").take(own),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(own), n)),
                    "deviation": centre.deviations(x).take(own),
                    "whitened": pa.array((centre(x) @ turn).ravel()),
                    "explained": pa.array(np.tile(value / trace, len(x))),
                    "identity_error": pa.array(np.full(len(own), error)),
                }
            )

    return rows.select("id", "vec").mapInArrow(project, schema)
