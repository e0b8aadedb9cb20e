"""Collect run: outcomes, breaker and the eleven posting fields for all organisations in one plan."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.predicates import looks_blocked
from postmill.operators.breaker import with_breaker
from postmill.operators.positions import chunk_of, first_n
from postmill.plans.resolution import listing_detail, result
from postmill.session import settle

# Where a row's result came from; events differ by it.
CACHED, SKIPPED, DETAIL, FETCHED = "cached", "skipped", "detail", "fetched"


def rate_limited(res: Column) -> Column:
    return (res["enrich_status"] == "blocked_source") & (res["status_reason"] == "http_429")


def settle_outcomes(
    rows: DataFrame, chunk: Column | None = None, transparent: Column | None = None
) -> DataFrame:
    """Apply listing details and the breaker. The rows are written once, so that the breaker's second
    look at them does not read and parse their pages again.

    Needs `org_abbrev, job_index, res, fetch_seconds, error` and `detail` (struct or null). Adds
    `origin` and `opens_breaker`, and replaces the three outcome columns.
    """
    passed = F.lit(False) if transparent is None else transparent
    has_detail = F.col("detail").isNotNull()
    rows = settle(rows.withColumn("_limited", ~has_detail & rate_limited(F.col("res"))), "outcomes")
    chunk = chunk_of(F.col("job_index")) if chunk is None else chunk
    rows = with_breaker(rows, "org_abbrev", "job_index", F.col("_limited"), chunk, transparent)
    skip = result("error", "", "", "blocked_source", "org_rate_limited_skip", "http")
    skipped = F.col("is_skipped")
    quiet = skipped | has_detail
    return rows.withColumns(
        {
            "res": F.when(passed, F.col("res")).when(skipped, skip).when(has_detail, F.col("detail")).otherwise(F.col("res")),
            "fetch_seconds": F.when(quiet & ~passed, F.lit(0.0)).otherwise(F.col("fetch_seconds")),
            "error": F.when(quiet & ~passed, F.lit("")).otherwise(F.col("error")),
            "origin": F.when(passed, CACHED).when(skipped, SKIPPED).when(has_detail, DETAIL).otherwise(FETCHED),
            "opens_breaker": F.coalesce(F.col("job_index") == F.col("open_at"), F.lit(False)) & ~passed,
        }
    ).drop("_limited", "open_at", "is_skipped", "detail")


def postings_of(outcomes: DataFrame) -> DataFrame:
    """The fixed posting fields with their organisation."""
    return outcomes.select(
        "org_abbrev",
        F.col("job_index").cast("bigint").alias("index"),
        "title",
        "url",
        "res.content_type",
        "res.enrich_status",
        "res.status_reason",
        "res.fetch_method",
        "res.description",
        "res.pdf_path",
        "fetch_seconds",
        "error",
    )


def collect_outcomes(
    listings: DataFrame,
    rules: DataFrame,
    read_pages,
    max_jobs: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Outcomes of numbered listings. `read_pages(rows)` adds `res`, `fetch_seconds` and `error`.

    Only rows without a usable listing detail are read; the rest already carry their posting.
    """
    rows = listing_detail(first_n(listings, max_jobs), rules)
    ready = rows.filter(F.col("detail").isNotNull())
    todo = read_pages(rows.filter(F.col("detail").isNull()))
    blank = F.lit(None).cast(todo.schema["res"].dataType)
    ready = ready.withColumns({"res": blank, "fetch_seconds": F.lit(0.0), "error": F.lit("")})
    together = todo.unionByName(ready.select(*todo.columns))
    return settle_outcomes(together, chunk)


def org_rows(registry: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Organisation header rows; `failures(org_abbrev, scraper_error)` marks sources that failed."""
    base = registry.select(
        "org_abbrev",
        "org_name",
        "scraper_file",
        F.col("is_playwright").alias("is_playwright_scraper"),
    )
    if failures is None:
        return base.withColumn("scraper_error", F.lit(""))
    joined = base.join(failures.select("org_abbrev", "scraper_error"), "org_abbrev", "left")
    return joined.withColumn("scraper_error", F.coalesce("scraper_error", F.lit("")))


def failed_orgs(failures: DataFrame) -> DataFrame:
    """Failures of search pages, `(source_id, page_no, reason)`, as `org_rows` and `drop_failed` take them.

    `source_id` is the organisation; the first failing page of each is named.
    """
    first = failures.groupBy("source_id").agg(F.min(F.struct("page_no", "reason")).alias("_first"))
    error = F.concat(F.lit("page "), F.col("_first.page_no").cast("string"), F.lit(": "), F.col("_first.reason"))
    return first.select(F.col("source_id").alias("org_abbrev"), error.alias("scraper_error"))


def drop_failed(listings: DataFrame, orgs: DataFrame) -> DataFrame:
    """Listings of organisations whose source did not fail."""
    failed = orgs.filter(F.col("scraper_error") != "").select("org_abbrev")
    return listings.join(failed, "org_abbrev", "left_anti")


def blocked_sources(pages: DataFrame, listings: DataFrame) -> DataFrame:
    """Status per landed listing page: a blocked page without listings is empty, not an error.

    `pages(org_abbrev, html, status_code)`, `listings(org_abbrev, ...)`.
    """
    seen = pages.groupBy("org_abbrev").agg(
        F.bool_or(looks_blocked(F.col("html"), F.col("status_code"))).alias("is_blocked")
    )
    counted = listings.groupBy("org_abbrev").agg(F.count(F.lit(1)).alias("job_count"))
    joined = seen.join(counted, "org_abbrev", "left")
    count = F.coalesce("job_count", F.lit(0)).cast("bigint")
    return joined.select(
        "org_abbrev",
        "is_blocked",
        count.alias("job_count"),
        F.when(count == 0, "empty").otherwise("ok").alias("scraper_status"),
    )
