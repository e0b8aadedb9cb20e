"""Landed raw pages, rendered pages, frames and fetch attempts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from postmill.session import read_parquet


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages `(page_id, url, html)`; a missing body is an empty one."""
    pages = read_parquet(spark, path).select("page_id", "url", "html")
    return pages.withColumn("html", F.coalesce("html", F.lit("")))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses `(api_url, body)`."""
    return read_parquet(spark, path).select("api_url", "body")
