"""Streams over landed logs. Every writer ends when the landed input is used up (`availableNow`)."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postmill.functions.text import blank_if_null, strip
from postmill.operators.dedupe import first_row, last_row
from postmill.operators.reuse import finished_addresses
from postmill.schemas import EVENT
from postmill.session import remove_path, settle
from postmill.sources.artifacts import read_landed

COUNTERS = T.StructType(
    [
        T.StructField("org_abbrev", T.StringType()),
        T.StructField("enrich_status", T.StringType()),
        T.StructField("jobs", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The event log as a stream of typed rows."""
    return spark.readStream.schema(EVENT).json(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str, form: str = "parquet") -> None:
    """Append a stream to files, once over everything that has landed."""
    writer = stream.writeStream.format(form).outputMode("append")
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def org_counters(events: DataFrame) -> DataFrame:
    """Postings, words and seconds per organisation and status, from result and error events."""
    results = events.filter(F.col("event").isin("job_result", "job_error"))
    return results.groupBy("org_abbrev", "enrich_status").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum(F.coalesce("word_count", F.lit(0))).alias("words"),
        F.round(F.sum(F.coalesce("duration_seconds", F.lit(0.0))), 3).alias("seconds"),
    )


def write_counters(counters: DataFrame, path: str, checkpoint: str, keep: int = 16) -> None:
    """Keep the counters that each micro-batch changed under `path/changes/batch=N`.

    Every `keep` batches the newest value of each key is folded into `path/whole/batch=N`, and what it replaces
    is removed, so a reader meets one whole table and fewer than `keep` changes. A batch that is repeated writes the same files.
    """
    spark = counters.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id:012d}")
        if batch_id % keep != keep - 1:
            return
        latest_counters(spark, path, counters.schema).write.mode("overwrite").parquet(f"{path}/whole/batch={batch_id:012d}")
        for earlier in range(batch_id - keep + 1, batch_id + 1):
            remove_path(spark, f"{path}/changes/batch={earlier:012d}")
        remove_path(spark, f"{path}/whole/batch={batch_id - keep:012d}")

    writer = counters.writeStream.outputMode("update").foreachBatch(save)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_counters(spark: SparkSession, path: str, schema: T.StructType = COUNTERS) -> DataFrame:
    """The newest counters of each organisation and status: the last whole table and the changes after it."""
    layout = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    parts = [read_landed(spark.read.schema(layout).parquet, f"{path}/{kind}") for kind in ("whole", "changes")]
    rows = [p for p in parts if p is not None]
    if not rows:
        return spark.createDataFrame([], schema)
    return last_row(reduce(DataFrame.unionByName, rows), ["org_abbrev", "enrich_status"], ["batch"]).drop("batch")


def new_listings(listings: DataFrame, prior: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Stream of listings not enriched before, first per address within the delay.

    The watermark bounds the remembered addresses, and a listing older than it is dropped: `late_listings` finds
    those afterwards. Listings without an address all pass.
    """
    named = _fresh(listings.withWatermark(event_time, delay), prior)
    return named.dropDuplicatesWithinWatermark(["org_abbrev", "url", "_blank"]).drop("_blank")


def _fresh(listings: DataFrame, prior: DataFrame) -> DataFrame:
    named = listings.withColumn("url", strip(blank_if_null(F.col("url"))))
    fresh = named.join(finished_addresses(prior), ["org_abbrev", "url"], "left_anti")
    return fresh.withColumn("_blank", F.when(F.col("url") == "", F.col("job_index")))


def late_listings(landed: DataFrame, prior: DataFrame, passed: DataFrame, event_time: str) -> DataFrame:
    """Listings that have landed, were not enriched before and never passed the stream: they came too late.

    One row for each address, the earliest; one for each listing without an address. `passed` is what the stream
    of `new_listings` wrote over the same listings. Run it when the stream has read all that has landed.
    """
    fresh = _fresh(landed, prior)
    key = ["org_abbrev", "url", "_blank"]
    seen = passed.select("org_abbrev", "url", F.when(F.col("url") == "", F.col("job_index")).alias("_blank")).distinct()
    seen = settle(seen, "passed")
    same = [fresh[k].eqNullSafe(seen[k]) for k in key]
    missing = fresh.join(seen, reduce(lambda a, b: a & b, same), "left_anti")
    return first_row(missing, key, [event_time, "job_index"]).drop("_blank")
