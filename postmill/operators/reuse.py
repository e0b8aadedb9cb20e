"""Reuse of earlier results by organisation and address."""

from pyspark.sql import DataFrame, functions as F

from postmill.functions.predicates import is_enriched
from postmill.functions.text import blank_if_null, strip
from postmill.functions.urls import spread_blank
from postmill.operators.dedupe import last_row
from postmill.session import settle


def _finished(prior: DataFrame) -> DataFrame:
    status, kind = blank_if_null(F.col("enrich_status")), blank_if_null(F.col("content_type"))
    return prior.filter((F.col("url") != "") & is_enriched(status, kind))


def reusable(prior: DataFrame, order: str = "index") -> DataFrame:
    """Finished earlier rows with an address, last one per organisation and address."""
    return last_row(_finished(prior), ["org_abbrev", "url"], [order])


def finished_addresses(prior: DataFrame) -> DataFrame:
    """Distinct addresses per organisation that have a finished earlier row."""
    return _finished(prior).select("org_abbrev", "url").distinct()


def with_prior(listings: DataFrame, prior: DataFrame, force: bool = False, how: str = "left") -> DataFrame:
    """Add the reusable earlier row as struct `prior`; null, or no row with an inner join, without one."""
    listings = listings.withColumn("url", strip(blank_if_null(F.col("url"))))
    # Written first: both join sides are then plain shuffles, which AQE can split at a hot address.
    done = settle(reusable(prior.limit(0) if force else prior), "prior")
    build = done.select("org_abbrev", F.col("url").alias("_key"), F.struct(*done.columns).alias("prior"))
    keyed = listings.withColumn("_key", spread_blank(F.col("url"), "org_abbrev", "job_index"))
    return keyed.join(build, ["org_abbrev", "_key"], how).drop("_key")


def work_list(listings: DataFrame, prior: DataFrame, force: bool = False) -> DataFrame:
    """Listings that still have to be fetched."""
    listings = listings.withColumn("url", strip(blank_if_null(F.col("url"))))
    if force:
        return listings
    build = settle(finished_addresses(prior).withColumnRenamed("url", "_key"), "known")
    keyed = listings.withColumn("_key", spread_blank(F.col("url"), "org_abbrev", "job_index"))
    return keyed.join(build, ["org_abbrev", "_key"], "left_anti").drop("_key")
