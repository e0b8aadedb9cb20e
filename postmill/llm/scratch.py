"""Tables written to the shared folder and removed again, and the number of shards."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path, scratch_path

_scopes: list[list[str]] = []


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths of the tables settled within, for `remove_all` once nothing reads them."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)


def remove_all(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables of the shared folder."""
    while paths:
        remove_path(spark, paths.pop())


def shards(spark: SparkSession, size: float = 0, each: float = 1) -> int:
    """Shuffle partitions, or more of them if each would hold over `each` of `size`."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // each) + 1)
