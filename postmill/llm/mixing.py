"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import settle, shards

WORD = r"[^\x20\x09-\x0D]+"


def _numbered(rows: DataFrame, order: list[str], key: list[str], name: str, parts: int) -> DataFrame:
    """Rows with `name`, their place (from 1) within `key` by `order`; no task holds a whole key.

    Rows are range-partitioned by key and order, numbered within each partition, and moved on by the number
    of rows that earlier partitions hold of the key.
    """
    by = [*key, *order]
    # the name of a partition is its number: it is written, so that it stays
    ranged = rows.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id())
    local = Window.partitionBy("_part", *key).orderBy(*order)
    ranged = settle(ranged.withColumn("_local", F.row_number().over(local)), "numbered")
    counts = ranged.groupBy("_part", *key).agg(F.count("*").alias("_n"))  # a row per partition and key
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = settle(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "offsets")
    match = [ranged[k].eqNullSafe(counts[k]) for k in ["_part", *key]]
    joined = ranged.join(counts, match)
    return joined.select(*(ranged[c] for c in rows.columns), (F.col("_local") + F.col("_before")).alias(name))


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`source`, `source_size`, `target` from `source`, `source_size`.

    Sources by code point, null last, take the weights in turn and share `share` of all sizes; a target stops at
    `most` times its source's size, and the excess goes to the others by weight until none is above.
    """
    spark = sizes.sparkSession
    ordered = sizes.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_all", F.lit(0))
    ordered = _numbered(ordered, ["_null", "source"], ["_all"], "_place", shards(spark))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = settle(ordered.select("source", "source_size", weight.cast("double").alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("cap")), "sources")
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level, before = 0.0, None
    # each step caps at least one more source; `level` is words per weight
    while level != before:
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
        fixed, open_weight = rows.agg(F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~capped, F.col("weight")))).first()
        before, level = level, (total - fixed) / open_weight if open_weight else level
    target = F.when(F.col("cap") <= F.lit(level) * F.col("weight"), F.col("cap")).otherwise(F.lit(level) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7, keep: list[str] | None = None
) -> DataFrame:
    """Every document with `size` (words), `source_size`, `target`, `copies` and `taken` (copies * size).

    Within a source each document is expected `target / source_size` times. Documents stand by size, id and
    text; the running sum of expected copies plus one random offset per source is taken down to whole numbers,
    and a document is emitted once for each whole number it crosses. By size, because a sample at even steps of
    that order has the source's mean size. The offset is a hash of the seed and the source, so reruns agree.

    A null text has no words, a null source is a source, an id may be null. Documents equal in all of these stand
    next to each other in any order. Sources without words have target 0. Other columns are kept (`keep`), but
    a result column replaces one of its name. An empty table gives an empty table.
    """
    results = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in results]
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = settle(docs.select(F.struct(*keep).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("twin"), F.col(source_col).alias("source"), size.alias("size")), "sized")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = settle(targets(sources, weights, share, most), "targets")
    placed = _numbered(rows, ["size", "id", "twin"], ["source"], "place", shards(docs.sparkSession))
    placed = placed.join(goals, placed["source"].eqNullSafe(goals["source"])).drop("source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # 13 hex digits of the digest are 52 bits, which a double holds
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("row").getField(source_col).cast("string")), F.lit("null")))
    offset = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    crossed = lambda place: F.floor(place * expected + offset)
    copies = (crossed(F.col("place")) - crossed(F.col("place") - 1)).cast("long")
    return placed.withColumn("copies", copies).select("row.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
