"""Vectors of Arrow batches as integer rows, packed row by row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries saturate here, so that sums of a few stay in 64 bits.
LIMIT = 1 << 61


def rows_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length above 0: the length, the rows that have it and their matrix; only whole, finite vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ok = np.asarray(column.is_valid())
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = column.values
    numbers = np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64)
    bad = ~np.isfinite(numbers) | ~np.asarray(values.is_valid())
    before = np.concatenate([[0], np.cumsum(bad)])
    length = np.diff(offsets)
    ok &= (before[offsets[1:]] == before[offsets[:-1]]) & (length > 0)
    for size in np.unique(length[ok]):
        own = np.flatnonzero(ok & (length == size))
        yield int(size), own, numbers[offsets[own][:, None] + np.arange(size)]


def scaled(x: np.ndarray, factor: int, shift: int = 0) -> np.ndarray:
    """floor(factor * x) + shift as int64, saturating at `LIMIT`."""
    with np.errstate(over="ignore"):
        whole = np.floor(np.float64(factor) * x)
    return np.clip(whole, -LIMIT, LIMIT).astype(np.int64) + shift


def packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes: 4 a number if all of a row fit, else 8, so that equal rows have equal bytes."""
    narrow = (np.abs(x) < 1 << 31).all(axis=1)
    return [(row.astype("<i4") if small else row.astype("<i8")).tobytes() for row, small in zip(x, narrow, strict=True)]


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    """Rows of `packed` as an int64 matrix."""
    body = column.to_pylist()
    out = np.empty((len(body), size), dtype=np.int64)
    narrow = np.array([len(b) == 4 * size for b in body], dtype=bool)
    for wide, kind in ((False, "<i4"), (True, "<i8")):
        own = np.flatnonzero(narrow != wide)
        if len(own):
            out[own] = np.frombuffer(b"".join(body[k] for k in own), dtype=kind).reshape(-1, size)
    return out


def integer_rows(table: DataFrame, id_col: str, vec_col: str, factor: int, shift: int = 0, ids: bool = True) -> DataFrame:
    """`id`, `size`, `vec` (see `packed`) of rows with a whole, finite vector of at least one entry.

    With `ids`, rows with a null id are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, own, x in rows_of(batch.column("vec")):
                body = packed(scaled(x, factor, shift))
                yield pa.RecordBatch.from_pydict(
                    {"id": batch.column("id").take(pa.array(own)), "size": pa.array(np.full(len(own), size, np.int32)), "vec": pa.array(body, pa.binary())}
                )

    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("vec is not null")
    return (rows.where("id is not null") if ids else rows).mapInArrow(run, "id long, size int, vec binary")


def usual_size(rows: DataFrame) -> tuple[int, int]:
    """The most frequent length (the least of several) and the number of rows that have it; 0, 0 for none."""
    found = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
    return (found[0]["size"], found[0]["count"]) if found else (0, 0)
