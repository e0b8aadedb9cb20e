"""Positions inside an organisation, computed without handing one organisation to one task.

Rows are split into chunks that follow the order. Windows run inside (organisation, chunk); one small
row per chunk carries what the later chunks need.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from postmill import constants as C
from postmill.session import settle


def chunk_of(position: Column, rows: int = C.CHUNK_ROWS) -> Column:
    """Chunk of an integer position; positions are distinct inside an organisation."""
    return F.floor(position / F.lit(rows)).cast("bigint")


def range_chunks(df: DataFrame, key: str, order: Sequence[str], chunk: str = "chunk") -> DataFrame:
    """Chunks for any sort order: range partitions of (key, order), written once to stay fixed."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, key, *order)
    return settle(ranged.withColumn(chunk, F.spark_partition_id().cast("bigint")), "ranged")


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    chunk: Column,
    index: str = "job_index",
    total: str | None = None,
) -> DataFrame:
    """1-based position per key, and the number of rows of the key if `total` is named."""
    df = df.withColumn("_chunk", chunk)
    sizes = df.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    by_chunk = W.partitionBy(key).orderBy("_chunk")
    offsets = sizes.select(
        key,
        "_chunk",
        (F.sum("_rows").over(by_chunk) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(W.partitionBy(key)).alias("_all"),
    )
    local = F.row_number().over(W.partitionBy(key, "_chunk").orderBy(*order))
    numbered = (
        df.withColumn("_local", local)
        .join(offsets, [key, "_chunk"])
        .withColumn(index, F.col("_local") + F.col("_before"))
    )
    if total:
        numbered = numbered.withColumn(total, F.col("_all"))
    return numbered.drop("_chunk", "_local", "_before", "_all")


def first_n(df: DataFrame, limit: int | None, index: str = "job_index") -> DataFrame:
    """Postings up to the given position; no limit when it is null or not positive."""
    return df.filter(F.col(index) <= limit) if limit and limit > 0 else df
