"""Rate-limit breaker: after three rate-limited outcomes in a row an organisation stays closed.

Rows are summarised per chunk, the small summaries are scanned per organisation, and only the opening
position goes back to the rows. No task sees a whole organisation.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from postmill import constants as C


def chunk_summaries(
    rows: DataFrame, key: str, pos: str, limited: Column, chunk: Column, threshold: int = C.BREAKER_THRESHOLD
) -> DataFrame:
    """Per chunk: size, whether a reset occurs, the run at its end, its own first opening, and the
    positions of the first hits before any reset (they matter when a run comes in from earlier)."""
    marked = rows.select(
        F.col(key).alias(key), F.col(pos).alias("_pos"), limited.alias("_hit"), chunk.alias("_chunk")
    )
    order = W.partitionBy(key, "_chunk").orderBy("_pos")
    marked = marked.withColumn("_nth", F.row_number().over(order))
    last_reset = F.max(F.when(~F.col("_hit"), F.col("_nth"))).over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    marked = marked.withColumn("_reset", F.coalesce(last_reset, F.lit(0)))
    streak = F.col("_nth") - F.col("_reset")
    is_lead = F.col("_reset") == 0
    leads = [F.min(F.when(is_lead & (F.col("_nth") == k), F.col("_pos"))) for k in range(1, threshold)]
    return marked.groupBy(key, "_chunk").agg(
        F.max("_nth").cast("bigint").alias("rows"),
        (F.max("_reset") > 0).cast("int").alias("resets"),
        (F.max("_nth") - F.max("_reset")).cast("bigint").alias("trail"),
        F.min(F.when(streak >= threshold, F.col("_pos"))).alias("opened"),
        F.array(*leads).alias("lead"),
    )


def opening_in_chunk(carried: Column, threshold: int = C.BREAKER_THRESHOLD) -> Column:
    """First opening of a chunk, given the run length that comes in."""
    missing = (F.lit(threshold) - carried).cast("int")
    early = F.when(missing.between(1, threshold - 1), F.get("lead", missing - 1))
    return F.least(early, F.col("opened"))


def _scanned(summary: DataFrame, key: str, carry: DataFrame | None, threshold: int) -> DataFrame:
    """Chunk rows with the run at their end (`_streak`) and the opening of their key (`open_at`)."""
    if carry is None:
        runs = summary.withColumns(
            {"_streak_in": F.lit(0).cast("bigint"), "_open_in": F.lit(None).cast("bigint")}
        )
    else:
        earlier = carry.select(key, F.col("streak").alias("_streak_in"), F.col("open_at").alias("_open_in"))
        runs = summary.join(earlier, key, "left")
        runs = runs.withColumn("_streak_in", F.coalesce("_streak_in", F.lit(0)))
    so_far = W.partitionBy(key).orderBy("_chunk")
    runs = runs.withColumn("_run", F.sum("resets").over(so_far))
    in_run = W.partitionBy(key, "_run").orderBy("_chunk")
    brought = F.when(F.col("_run") == 0, F.col("_streak_in")).otherwise(0)
    runs = runs.withColumn("_streak", F.sum("trail").over(in_run) + brought)
    runs = runs.withColumn("_carried", F.coalesce(F.lag("_streak").over(so_far), F.col("_streak_in")))
    first = F.min(opening_in_chunk(F.col("_carried"), threshold)).over(W.partitionBy(key))
    return runs.withColumn("open_at", F.coalesce(F.col("_open_in"), first))


def fold_summaries(
    summary: DataFrame, key: str, carry: DataFrame | None = None, threshold: int = C.BREAKER_THRESHOLD
) -> DataFrame:
    """Scan the chunk summaries of every key: `open_at` (null while closed) and the run at the end.

    `carry(key, streak, open_at)` continues from an earlier scan.
    """
    scanned = _scanned(summary, key, carry, threshold)
    return scanned.groupBy(key).agg(
        F.min("open_at").alias("open_at"), F.max_by("_streak", "_chunk").alias("streak")
    )


def opening_positions(
    rows: DataFrame, key: str, pos: str, limited: Column, chunk: Column, threshold: int = C.BREAKER_THRESHOLD
) -> DataFrame:
    """One row per key whose breaker opens: `open_at`, the position of the deciding outcome."""
    summary = chunk_summaries(rows, key, pos, limited, chunk, threshold)
    folded = fold_summaries(summary, key, threshold=threshold)
    return folded.filter(F.col("open_at").isNotNull()).select(key, "open_at")


def with_breaker(
    rows: DataFrame,
    key: str,
    pos: str,
    limited: Column,
    chunk: Column,
    transparent: Column | None = None,
    threshold: int = C.BREAKER_THRESHOLD,
) -> DataFrame:
    """Add `open_at` and `is_skipped`. Transparent (reused) rows neither count, reset nor skip."""
    passed = F.lit(False) if transparent is None else transparent
    summary = chunk_summaries(rows.filter(~passed), key, pos, limited, chunk, threshold)
    scanned = _scanned(summary, key, None, threshold).select(key, "_chunk", "open_at")
    # Joined by chunk, not by key alone, so that a hot key stays spread.
    joined = rows.withColumn("_chunk", chunk).join(scanned, [key, "_chunk"], "left").drop("_chunk")
    skipped = F.coalesce(~passed & (F.col(pos) > F.col("open_at")), F.lit(False))
    return joined.withColumn("is_skipped", skipped)
