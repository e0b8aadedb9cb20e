"""Finished results by organisation and address, stored in buckets, so that reuse shuffles the new listings only.

The index is an append-only bucketed table. A run appends the results of its organisations, last one per address,
and marks the addresses they no longer have; the newest entry of an address counts. Entries of an address share a
bucket, so neither choosing the newest nor the join with listings moves them.
"""

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from postmill.functions.text import blank_if_null, strip
from postmill.functions.urls import spread_blank
from postmill.operators.reuse import reusable
from postmill.schemas import STATE
from postmill.session import settle
from postmill.sources.artifacts import read_landed

BUCKETS = 64
_ENTRY = f"org_abbrev string, url string, run bigint, prior {STATE.simpleString()}"


def _layout(spark: SparkSession, index_dir: str) -> int | None:
    """Number of buckets, stored beside the entries."""
    found = read_landed(spark.read.schema("buckets int").json, f"{index_dir}/layout")
    return found.first()["buckets"] if found is not None else None


def _entries(spark: SparkSession, index_dir: str, buckets: int) -> str:
    """Name of the bucketed table over the folder, registered in this session's catalog."""
    name = f"reuse_{hashlib.sha256(index_dir.encode()).hexdigest()[:20]}"
    keys = "(org_abbrev, url)"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ENTRY}) USING parquet "
        f"CLUSTERED BY {keys} SORTED BY {keys} INTO {buckets} BUCKETS LOCATION '{index_dir}/entries'"
    )
    return name


def read_reuse(spark: SparkSession, index_dir: str) -> DataFrame:
    """`org_abbrev, url, prior`: the newest result of every address; no exchange."""
    buckets = _layout(spark, index_dir)
    if buckets is None:
        return spark.createDataFrame([], _ENTRY).drop("run")
    rows = spark.table(_entries(spark, index_dir, buckets))
    # the struct around it keeps an address that is gone (a null result) apart from no entry
    newest = F.max_by(F.struct("prior"), "run").alias("_entry")
    chosen = rows.groupBy("org_abbrev", "url").agg(newest).filter("_entry.prior is not null")
    return chosen.select("org_abbrev", "url", F.col("_entry.prior").alias("prior"))


def append_reuse(state: DataFrame, ran: DataFrame, index_dir: str, buckets: int = BUCKETS) -> None:
    """Append the finished rows of `state` and forget what organisations that ran (`org_abbrev`) no longer have.

    The number of buckets is that of the first run. Rows with a null organisation are never reused.
    """
    spark = state.sparkSession
    stored = _layout(spark, index_dir)
    if stored is None:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(f"{index_dir}/layout")
    buckets = stored or buckets
    name = _entries(spark, index_dir, buckets)
    done = reusable(state.select(*STATE.fieldNames())).filter("org_abbrev is not null")
    new = done.select("org_abbrev", "url", F.struct(*STATE.fieldNames()).alias("prior"))
    known = read_reuse(spark, index_dir).select("org_abbrev", "url")
    orgs = settle(ran.select("org_abbrev").distinct(), "ran")
    keys = settle(new, "reusable")
    gone = known.join(orgs, "org_abbrev", "left_semi").join(keys.select("org_abbrev", "url"), ["org_abbrev", "url"], "left_anti")
    nothing = F.lit(None).cast(keys.schema["prior"].dataType).alias("prior")
    entries = keys.unionByName(gone.select("org_abbrev", "url", nothing))
    entries = settle(entries.withColumn("run", F.lit(time.time_ns())).select("org_abbrev", "url", "run", "prior"), "entries")
    # one task, and so one file, for each bucket
    entries.repartition(buckets, "org_abbrev", "url").sortWithinPartitions("org_abbrev", "url").write.insertInto(name)


def with_stored_prior(listings: DataFrame, index_dir: str, how: str = "left") -> DataFrame:
    """`with_prior` against the stored index: only the listings are shuffled."""
    listings = listings.withColumn("url", strip(blank_if_null(F.col("url"))))
    build = read_reuse(listings.sparkSession, index_dir).withColumnRenamed("url", "_key")
    keyed = listings.withColumn("_key", spread_blank(F.col("url"), "org_abbrev", "job_index"))
    return keyed.join(build, ["org_abbrev", "_key"], how).drop("_key")
