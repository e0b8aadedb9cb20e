"""Links of landed listing pages as listing rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.html import anchors, html_outline, node_text
from postmill.functions.text import collapse_space, contains_any, strip
from postmill.functions.urls import join_urls, prefix_url
from postmill.operators.dedupe import dedupe_listings, first_in_array
from postmill.operators.rows import unnest


def with_outline(pages: DataFrame) -> DataFrame:
    """Parse the pages once; a table that already has outlines stays as it is."""
    return pages if "outline" in pages.columns else pages.withColumn("outline", html_outline("html"))


def _exploded(df: DataFrame, keep: Sequence[str], *fields: Column) -> DataFrame:
    rows = unnest(df, *keep, array="_links", item="_link")
    return rows.select(*keep, F.col("_link.pos").alias("pos"), *fields)


def strict_links(
    pages: DataFrame,
    href_pattern: str,
    base_url: Column | str,
    min_title_len: int = 5,
    exclude_patterns: Sequence[str] = (),
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """Anchors whose raw href contains a pattern, first per href; addresses are prefixed."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    pages = with_outline(pages).withColumn("_base", base)
    outline = F.col("outline")
    wanted = F.filter(
        anchors(outline),
        lambda n: (n["href"] != "")
        & F.contains(n["href"], F.lit(href_pattern))
        & ~contains_any(n["href"], exclude_patterns),
    )
    titled = F.transform(
        wanted,
        lambda n: F.struct(n["pos"], n["href"], node_text(outline, n, "").alias("title")),
    )
    long_enough = F.filter(titled, lambda x: (x["title"] != "") & (F.length(x["title"]) >= min_title_len))
    found = pages.select(*keep, "_base", long_enough.alias("_links"))
    unique = first_in_array(found, "_links", "href")
    link = F.col("_link")
    rows = _exploded(unique, [*keep, "_base"], link["title"].alias("title"), link["href"].alias("_href"))
    return rows.withColumn("url", prefix_url(F.col("_href"), F.col("_base"))).drop("_base", "_href")


def keyword_links(
    pages: DataFrame,
    base_url: Column | str,
    include_patterns: Sequence[str],
    exclude_patterns: Sequence[str] = (),
    min_title_len: int = 4,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """Anchors whose title or href holds a keyword, first per resolved address."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    include = [p.lower() for p in include_patterns]
    exclude = [p.lower() for p in exclude_patterns]
    pages = with_outline(pages).withColumn("_base", base)
    outline = F.col("outline")
    trimmed = F.transform(
        anchors(outline),
        lambda n: F.struct(
            n["pos"],
            strip(n["href"]).alias("href"),
            collapse_space(node_text(outline, n, " ")).alias("title"),
        ),
    )

    def wanted(x: Column) -> Column:
        href, title = x["href"], x["title"]
        haystack = F.lower(F.concat(title, F.lit(" "), href))
        included = contains_any(haystack, include) if include else F.lit(True)
        return (
            (href != "")
            & ~href.startswith("javascript:")
            & ~href.startswith("mailto:")
            & (F.length(title) >= min_title_len)
            & included
            & ~contains_any(haystack, exclude)
        )

    found = pages.select(*keep, "_base", F.filter(trimmed, wanted).alias("_hits"))
    urls = join_urls(F.col("_base"), F.transform("_hits", lambda x: x["href"]))
    resolved = F.zip_with(
        "_hits", urls, lambda x, url: F.struct(x["pos"], x["title"], url.alias("url"))
    )
    unique = first_in_array(found.select(*keep, resolved.alias("_links")), "_links", "url")
    link = F.col("_link")
    return _exploded(unique, keep, link["title"].alias("title"), link["url"].alias("url"))


def frame_links(
    frames: DataFrame,
    frame_patterns: Sequence[str],
    base_url: Column | str,
    include_patterns: Sequence[str],
    exclude_patterns: Sequence[str] = (),
) -> DataFrame:
    """Keyword links of the matching frames of each page, first per page and address."""
    markers = [m.lower() for m in frame_patterns]
    chosen = frames.filter(F.col("html").isNotNull())
    if markers:
        chosen = chosen.filter(contains_any(F.lower(F.coalesce("frame_url", F.lit(""))), markers))
    links = keyword_links(
        chosen, base_url, include_patterns, exclude_patterns, keep=("page_id", "frame_pos")
    )
    return dedupe_listings(links, ["page_id"], ["frame_pos", "pos"])
