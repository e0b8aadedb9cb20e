"""Listing extractors by name: each turns landed pages of its sources into listing rows."""

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from postmill.operators.dedupe import dedupe_listings
from postmill.operators.listings import frame_links, keyword_links, strict_links
from postmill.sources.search_pages import facet_listings

Extractor = Callable[[DataFrame], DataFrame]


def html_example(pages: DataFrame) -> DataFrame:
    """Links holding `/jobs/`, without archived ones."""
    return strict_links(pages, "/jobs/", "https://example.com", 5, ["archive", "closed"])


def helper_example(pages: DataFrame) -> DataFrame:
    """Facet-style search pages of one site."""
    base = F.lit("https://careers.example.com")
    return facet_listings(pages, base, F.lit("https://careers.example.com/api/jobs"))


def simple_example(pages: DataFrame) -> DataFrame:
    """Keyword links of rendered pages."""
    links = keyword_links(
        pages,
        "https://example.com",
        ["job", "career", "position", "vacancy"],
        ["archive", "closed", "expired"],
    )
    return dedupe_listings(links, ["page_id"], ["pos"])


def interactive_example(pages: DataFrame) -> DataFrame:
    """Keyword links with longer titles."""
    links = keyword_links(pages, "https://example.com", ["job", "career"], ["privacy", "terms"], 5)
    return dedupe_listings(links, ["page_id"], ["pos"])


def iframe_example(frames: DataFrame) -> DataFrame:
    """Keyword links inside job-board frames."""
    return frame_links(
        frames,
        ["talentreef", "jobboard", "careers"],
        "https://example.com",
        ["job", "position"],
        ["login", "apply"],
    )


SHIPPED: dict[str, Extractor] = {
    "html_example": html_example,
    "helper_example": helper_example,
    "simple_example": simple_example,
    "interactive_example": interactive_example,
    "iframe_example": iframe_example,
}


def extract_listings(pages: DataFrame, extractors: Mapping[str, Extractor]) -> DataFrame:
    """Run each extractor on the pages that name it in column `extractor`, as one table."""
    parts = [
        extract(pages.filter(F.col("extractor") == name)).withColumn("extractor", F.lit(name))
        for name, extract in extractors.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
