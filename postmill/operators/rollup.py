"""Organisation-level roll-ups. All are plain aggregates with map-side combine."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill import constants as C
from postmill.functions.predicates import is_successful
from postmill.functions.text import blank_if_null, strip, word_count
from postmill.schemas import ORG_FIELDS, POSTING_FIELDS


def has_pdf(content_type: Column, pdf_path: Column) -> Column:
    return (F.lower(strip(blank_if_null(content_type))) == "pdf") | (strip(blank_if_null(pdf_path)) != "")


def org_report(orgs: DataFrame, postings: DataFrame) -> DataFrame:
    """One report row per organisation, also for those without postings."""
    error = blank_if_null(F.col("error"))
    narrow = postings.select(
        "org_abbrev",
        "index",
        blank_if_null(F.col("enrich_status")).alias("status"),
        F.length(blank_if_null(F.col("description"))).alias("size"),
        error.alias("error"),
    )
    rolled = narrow.groupBy("org_abbrev").agg(
        F.bool_or(F.col("status") == "ok").alias("any_ok"),
        F.min_by("status", "index").alias("first_status"),
        F.max("size").alias("longest"),
        F.min_by("error", F.when(F.col("error") != "", F.col("index"))).alias("first_error"),
    )
    joined = orgs.select("org_abbrev", blank_if_null(F.col("scraper_error")).alias("scraper_error")).join(
        rolled, "org_abbrev", "left"
    )
    failed = F.col("scraper_error") != ""
    empty = F.col("longest").isNull()
    skipped = failed | empty
    return joined.select(
        F.col("org_abbrev").alias("org"),
        F.when(failed, "error").when(empty, "empty").otherwise("ok").alias("scraper_status"),
        F.when(skipped, "skipped").when(F.col("any_ok"), "ok").otherwise(F.col("first_status")).alias("enrich_status"),
        F.when(skipped, 0).otherwise(F.col("longest")).cast("bigint").alias("desc_len"),
        F.col("scraper_error"),
        F.when(skipped, "").otherwise(F.coalesce("first_error", F.lit(""))).alias("enrich_error"),
    )


def org_measures(postings: DataFrame) -> DataFrame:
    """Counts per organisation that the gates need."""
    ok = is_successful(F.col("enrich_status"), F.col("description"))
    rows = postings.select(
        "org_abbrev",
        has_pdf(F.col("content_type"), F.col("pdf_path")).alias("pdf"),
        F.when(ok, word_count(F.col("description"))).alias("words"),
        "index",
    )
    return rows.groupBy("org_abbrev").agg(
        F.max("index").alias("last_index"),
        F.count(F.lit(1)).alias("job_count"),
        F.bool_or("pdf").alias("has_pdf"),
        F.count("words").alias("successes"),
        F.min("words").alias("least_words"),
        F.max("words").alias("most_words"),
    )


def job_counts(orgs: DataFrame, postings: DataFrame) -> DataFrame:
    """Postings per organisation, zero where there are none."""
    counted = postings.groupBy("org_abbrev").agg(F.count(F.lit(1)).alias("job_count"))
    joined = orgs.join(counted, "org_abbrev", "left")
    return joined.withColumn("job_count", F.coalesce("job_count", F.lit(0)).cast("bigint"))


def org_blocks(orgs: DataFrame, postings: DataFrame, rows: int = C.BLOCK_ROWS) -> DataFrame:
    """Nest postings into organisation blocks of at most `rows` jobs; block 0 always exists."""
    job = F.struct(*POSTING_FIELDS)
    blocks = (
        postings.withColumn("block", F.floor((F.col("index") - 1) / F.lit(rows)).cast("bigint"))
        .groupBy("org_abbrev", "block")
        .agg(F.array_sort(F.collect_list(job)).alias("jobs"))
    )
    joined = orgs.select(*ORG_FIELDS).join(blocks, "org_abbrev", "left")
    return joined.withColumns(
        {
            "block": F.coalesce("block", F.lit(0)).cast("bigint"),
            "jobs": F.coalesce("jobs", F.array().cast(blocks.schema["jobs"].dataType)),
        }
    )


def flatten_blocks(blocks: DataFrame) -> DataFrame:
    """Postings of the blocks; organisations without any keep one row with null fields."""
    rows = blocks.select(*ORG_FIELDS, F.explode_outer("jobs").alias("job"))
    return rows.select(*ORG_FIELDS, "job.*")
