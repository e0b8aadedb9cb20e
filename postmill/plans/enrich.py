"""Incremental enrichment: reuse, read the rest, apply the breaker, write the new state rows."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.text import blank_if_null, iso_utc
from postmill.operators.positions import first_n
from postmill.operators.reuse import with_prior, work_list
from postmill.plans.collect import CACHED, collect_outcomes
from postmill.schemas import RESULT_FIELDS, STATE, STATE_FIELDS


def tag_listing(listings: DataFrame) -> DataFrame:
    """Fill the enrichment fields a listing lacks with empty text; given values stay."""
    for name in STATE_FIELDS:
        value = blank_if_null(F.col(name)) if name in listings.columns else F.lit("")
        listings = listings.withColumn(name, value)
    return listings


def apply_result(rows: DataFrame, now: Column) -> DataFrame:
    """Write the outcome into the row. A failure keeps earlier description and PDF path."""
    failed = F.col("error") != ""
    res = F.col("res")
    return rows.withColumns(
        {
            "content_type": F.when(failed, "error").otherwise(res["content_type"]),
            "description": F.when(failed, F.col("description")).otherwise(res["description"]),
            "pdf_path": F.when(failed, F.col("pdf_path")).otherwise(res["pdf_path"]),
            "enrich_status": res["enrich_status"],
            "status_reason": res["status_reason"],
            "fetch_method": res["fetch_method"],
            "enriched_at": iso_utc(now),
            "enrich_error": F.when(failed, F.col("error")).otherwise(""),
        }
    )


def enrich_outcomes(
    listings: DataFrame,
    prior: DataFrame,
    rules: DataFrame,
    read_pages,
    force: bool = False,
    max_jobs: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Outcomes of numbered listings, earlier results included (`origin` tells which).

    The anti-join comes first, so reused rows reach neither `read_pages(rows)` nor the breaker, for
    which they do not count. Their earlier row comes along as struct `prior`.
    """
    listed = first_n(listings, max_jobs)
    fresh = collect_outcomes(work_list(listed, prior, force), rules, read_pages, chunk=chunk)
    known = with_prior(listed, prior, force, how="inner")
    kind = known.schema["prior"].dataType
    p = F.col("prior")
    reused = known.withColumns(
        {
            "res": F.struct(*[p[name].alias(name) for name in RESULT_FIELDS]),
            "fetch_seconds": F.lit(0.0),
            "error": F.lit(""),
            "origin": F.lit(CACHED),
            "opens_breaker": F.lit(False),
        }
    )
    fresh = fresh.withColumn("prior", F.lit(None).cast(kind))
    return fresh.unionByName(reused.select(*fresh.columns))


def new_state(outcomes: DataFrame, now: Column) -> DataFrame:
    """State rows: a reused row comes back whole, a new one is its listing with the result applied."""
    names = STATE.fieldNames()
    reused = outcomes.filter(F.col("origin") == CACHED)
    kept = reused.select(
        F.col("job_index").cast("bigint").alias("index"),
        *[F.col("prior")[n].alias(n) for n in names if n != "index"],
    )
    fresh = apply_result(tag_listing(outcomes.filter(F.col("origin") != CACHED)), now)
    if "extras" not in fresh.columns:
        fresh = fresh.withColumn("extras", F.map_from_arrays(F.array(), F.array()).cast(STATE["extras"].dataType))
    fresh = fresh.withColumn("index", F.col("job_index").cast("bigint"))
    return kept.unionByName(fresh.select(*names)).select(*names)
