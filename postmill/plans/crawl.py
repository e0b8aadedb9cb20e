"""Crawl plan: what a separate crawler has to fetch, and how."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.predicates import retry_delay
from postmill.functions.urls import content_kind, url_host
from postmill.operators.reuse import work_list
from postmill.operators.rules import flag_equal, flag_inside


def crawl_plan(
    listings: DataFrame,
    prior: DataFrame,
    rules: DataFrame,
    now: Column,
    failures: DataFrame | None = None,
    force: bool = False,
) -> DataFrame:
    """Remaining addresses per organisation, in order, with kind, TLS and browser flags and due time.

    `failures(org_abbrev, job_index, attempt, status_code, retry_after)` delays failed addresses; one
    that may not be repeated is left out.
    """
    todo = work_list(listings, prior, force).filter(F.col("url") != "")
    host = url_host(F.col("url"))
    todo = flag_equal(todo, host, rules, "tls_exempt_domains", "_exempt")
    todo = flag_inside(todo, host, rules, "browser_domains", "_browser_host")
    todo = flag_equal(todo, F.col("org_abbrev"), rules, "browser_orgs", "_browser_org")
    if failures is not None:
        delay = retry_delay(F.col("attempt"), F.col("status_code"), F.col("retry_after"), now)
        last = failures.groupBy("org_abbrev", "job_index").agg(
            F.max_by(F.struct("attempt", "status_code", "retry_after"), "attempt").alias("f")
        )
        waits = last.select("org_abbrev", "job_index", "f.*").withColumn("delay_seconds", delay)
        waits = waits.select("org_abbrev", "job_index", "delay_seconds", F.lit(True).alias("_failed"))
        todo = todo.join(waits, ["org_abbrev", "job_index"], "left")
        todo = todo.filter(F.col("_failed").isNull() | F.col("delay_seconds").isNotNull())
        todo = todo.withColumn("delay_seconds", F.coalesce("delay_seconds", F.lit(0.0)))
    else:
        todo = todo.withColumn("delay_seconds", F.lit(0.0))
    browser = F.col("_browser_host") | F.col("_browser_org") | F.contains(host, F.lit("oraclecloud"))
    return todo.select(
        "org_abbrev",
        "job_index",
        "url",
        content_kind(F.col("url")).alias("kind"),
        (~F.col("_exempt")).alias("verify_tls"),
        browser.alias("needs_browser"),
        "delay_seconds",
    )
