"""From a listing and the facts of its page to a posting result, and from an attempt to a result."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill import constants as C
from postmill.functions.predicates import classify_error, has_js_marker, has_listing_detail, is_short
from postmill.functions.text import blank_if_null, slug, strip
from postmill.functions.urls import content_kind, run_path, spread_blank, table_row_index, url_host
from postmill.operators.dedupe import first_row, last_row
from postmill.operators.pdf_links import with_pdf_link
from postmill.operators.rules import flag_equal, flag_inside
from postmill.schemas import RESULT_FIELDS
from postmill.session import settle


def result(content_type: str, description, pdf_path, status, reason, method: str) -> Column:
    """A result struct; plain strings become literals."""
    values = (content_type, description, pdf_path, status, reason, method)
    return F.struct(
        *[
            (F.lit(v) if isinstance(v, str) else v).alias(name)
            for name, v in zip(RESULT_FIELDS, values)
        ]
    )


def pdf_path(run_id: str, day: str, org: Column, title: Column) -> Column:
    """Where the PDF of a posting goes."""
    name = F.concat(slug(title), F.lit(f"-{day}.pdf"))
    return run_path("ops/runs", run_id, "pdfs", org, name)


def resolve(
    listings: DataFrame,
    facts: DataFrame,
    rules: DataFrame,
    run_id: str,
    day: str,
    headers: DataFrame | None = None,
    rendered: DataFrame | None = None,
) -> DataFrame:
    """Add `res`, the result of reading a listing's page.

    `listings(org_abbrev, job_index, title, url, [use_browser])` has trimmed text. Optional tables:
    `headers(url, content_type_header)` and `rendered(url, rendered_text)`.
    """
    url = F.col("url")
    rows = listings.withColumn("_row", F.struct("org_abbrev", "job_index"))
    if "use_browser" not in rows.columns:
        rows = rows.withColumn("use_browser", F.lit(False))
    rows = flag_inside(rows, url_host(url), rules, "table_domains", "_table_host")
    rows = flag_equal(rows, F.upper("org_abbrev"), rules, "prefer_pdf_orgs", "_prefers_pdf")
    rows = rows.withColumn("_title", F.when(F.col("title") != "", F.col("title")).otherwise(
        F.concat(F.lit("job-"), F.col("job_index").cast("string"))
    ))
    # Written first: both join sides are then plain shuffles, which AQE can split at a hot address.
    one_per_url = settle(first_row(facts, ["url"], ["page_id"]), "facts")
    rows = rows.withColumn("_page_url", spread_blank(url, "org_abbrev", "job_index"))
    rows = rows.join(one_per_url.drop("page_id").withColumnRenamed("url", "_page_url"), "_page_url", "left")
    rows = with_pdf_link(rows, F.col("_title"), F.col("_prefers_pdf"), "_row", headers)
    header = None
    if headers is not None:
        known = headers.groupBy(F.col("url").alias("_page_url")).agg(F.max("content_type_header").alias("_header"))
        rows, header = rows.join(known, "_page_url", "left"), F.col("_header")
    if rendered is not None:
        shown_pages = rendered.groupBy(F.col("url").alias("_page_url"))
        rows = rows.join(shown_pages.agg(F.max("rendered_text").alias("rendered_text")), "_page_url", "left")
    else:
        rows = rows.withColumn("rendered_text", F.lit(None).cast("string"))
    page_text, shown = blank_if_null(F.col("description")), blank_if_null(F.col("rendered_text"))
    fuller = F.coalesce(F.col("needs_browser"), F.lit(False)) & (F.length(shown) > F.length(page_text))
    text = F.when(F.col("use_browser") | fuller, shown).otherwise(page_text)
    rows = rows.withColumn("_text", text).withColumns(
        {"_short": is_short(F.col("_text")), "_path": pdf_path(run_id, day, F.col("org_abbrev"), F.col("_title"))}
    )
    has_link = F.col("pdf_link") != ""
    is_table_row = F.col("_table_host") & table_row_index(url).isNotNull()
    path, body = F.col("_path"), F.col("_text")
    res = (
        F.when(url == "", result("error", "", "", "no_detail_url", "missing_url", "none"))
        .when(is_table_row, result("pdf", "", path, "pdf", "table_download_button", "playwright"))
        .when(content_kind(url, header) == "pdf", result("pdf", "", path, "pdf", "", "http"))
        .when(has_link & F.col("_prefers_pdf"), result("pdf", "", path, "pdf", "embedded_pdf_preferred", "http"))
        .when(has_link & F.col("_short"), result("pdf", "", path, "pdf", "embedded_pdf", "http"))
        .when(F.col("_short") & has_js_marker(body), result("html", body, "", "js_required", "js_required", "http"))
        .when(F.col("_short"), result("html", body, "", "short_content", "short_description", "http"))
        .otherwise(result("html", body, "", "ok", "", "http"))
    )
    return rows.select(*listings.columns, "rendered_text", res.alias("res"))


def with_attempts(listings: DataFrame, attempts: DataFrame) -> DataFrame:
    """Add the logged fetch of each listing, before any page text is in the rows.

    `attempts(org_abbrev, job_index, error, fetch_seconds, [rendered_seconds], [attempt])`; with several
    attempts of a listing the last one counts.
    """
    keys = ["org_abbrev", "job_index"]
    if "attempt" in attempts.columns:
        attempts = last_row(attempts, keys, ["attempt"])
    rendered = "rendered_seconds" if "rendered_seconds" in attempts.columns else F.lit(0.0)
    logged = attempts.select(
        *keys,
        F.col("error").alias("_error"),
        F.round(F.coalesce("fetch_seconds", F.lit(0.0)), 3).alias("_seconds"),
        F.round(F.coalesce(rendered, F.lit(0.0)), 3).alias("_rendered_seconds"),
    )
    return listings.join(logged, keys, "left")


def with_outcome(rows: DataFrame) -> DataFrame:
    """Turn resolved rows that carry their attempt into results with seconds and error.

    A failed attempt keeps its failure class unless a browser organisation has a rendered text.
    """
    use_browser = F.col("use_browser") if "use_browser" in rows.columns else F.lit(False)
    failed = (blank_if_null(F.col("_error")) != "") & (F.col("url") != "")
    shown = blank_if_null(F.col("rendered_text"))
    rescued = failed & use_browser & (F.length(shown) > C.MIN_RENDERED_CHARS)
    kind = classify_error(F.col("_error"))
    res = (
        F.when(rescued, result("html", shown, "", "ok", "playwright_fallback", "playwright"))
        .when(failed, result("error", "", "", kind["status"], kind["reason"], "http"))
        .otherwise(F.col("res"))
    )
    seconds = F.when(F.col("url") == "", F.lit(0.0)).when(rescued, F.col("_rendered_seconds")).otherwise(
        F.coalesce("_seconds", F.lit(0.0))
    )
    given = ("res", "rendered_text", "error", "fetch_seconds", "_error", "_seconds", "_rendered_seconds")
    return rows.select(
        *[c for c in rows.columns if c not in given],
        res.alias("res"),
        seconds.alias("fetch_seconds"),
        F.when(failed & ~rescued, F.col("_error")).otherwise("").alias("error"),
    )


def listing_detail(listings: DataFrame, rules: DataFrame) -> DataFrame:
    """Add `detail`, the result a trusted organisation's listing carries itself, else null."""
    rows = flag_equal(listings, F.upper("org_abbrev"), rules, "trusted_detail_orgs", "_trusted")
    usable = has_listing_detail(F.col("_trusted"), F.col("description"))
    text = strip(blank_if_null(F.col("description")))
    path = strip(blank_if_null(F.col("pdf_path"))) if "pdf_path" in listings.columns else ""
    detail = F.when(usable, result("html", text, path, "ok", "scraper_detail", "scraper"))
    return rows.withColumn("detail", detail).drop("_trusted")
