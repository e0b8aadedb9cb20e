"""PDF links of a page: candidates, the first one, and the best one for a posting."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill import constants as C
from postmill.functions.html import anchors, node_text, outer_text
from postmill.functions.scoring import pdf_score
from postmill.functions.text import keywords
from postmill.functions.urls import content_kind, join_url, join_urls
from postmill.operators.dedupe import first_in_array
from postmill.operators.rows import unnest
from postmill.session import settle


def first_pdf_href(outline: Column) -> Column:
    """Raw href of the first PDF link, else of the first `download … pdf` anchor, else null."""
    links = anchors(outline)
    by_href = F.filter(links, lambda n: F.contains(F.lower(n["href"]), F.lit(".pdf")))

    def offers_pdf(n: Column) -> Column:
        text = F.lower(node_text(outline, n, " "))
        return F.contains(text, F.lit("pdf")) & F.contains(text, F.lit("download"))

    by_text = F.filter(links, offers_pdf)
    return F.coalesce(F.get(by_href, F.lit(0))["href"], F.get(by_text, F.lit(0))["href"])


def first_pdf_link(outline: Column, page_url: Column) -> Column:
    return F.coalesce(join_url(page_url, first_pdf_href(outline)), F.lit(""))


def with_pdf_mentions(pages: DataFrame) -> DataFrame:
    """Add the anchors and raw addresses that may be PDFs. Afterwards `html` and `outline` can go."""
    outline = F.col("outline")
    texts = F.transform(
        F.filter(anchors(outline), lambda n: n["href"] != ""),
        lambda n: F.struct(
            n["href"],
            node_text(outline, n, " ").alias("text"),
            n["outer_first"],
            n["outer_last"],
        ),
    )

    def mentions_pdf(x: Column) -> Column:
        both = F.lower(F.concat_ws(" ", x["text"], x["href"]))
        return (
            F.contains(F.lower(x["href"]), F.lit(".pdf"))
            | F.contains(F.lower(x["text"]), F.lit("pdf"))
            | F.contains(both, F.lit("download pdf"))
        )

    described = F.transform(
        F.filter(texts, mentions_pdf),
        lambda x: F.struct(
            x["href"].alias("href"),
            x["text"].alias("text"),
            F.substring(outer_text(outline, x, " "), 1, C.CONTEXT_CHARS).alias("context"),
        ),
    )
    plain = F.replace(F.col("html"), F.lit("\\/"), F.lit("/"))

    def found(pattern: str) -> Column:
        has_any = F.contains(F.lower(F.col("html")), F.lit(".pdf"))
        every = F.regexp_extract_all(plain, F.lit(pattern), F.lit(0))
        return F.when(has_any, every).otherwise(F.array().cast("array<string>"))

    return pages.withColumns(
        {
            "_anchors": described,
            "_absolute": found(C.RAW_PDF_URL),
            "_rooted": found(C.RAW_PDF_PATH),
        }
    )


def with_pdf_candidates(pages: DataFrame) -> DataFrame:
    """Add `pdf_candidates`: anchors first, then addresses in raw text, first per address.

    Needs `url` and the mentions, or `html` and `outline` to find them in.
    """
    found = pages if "_anchors" in pages.columns else with_pdf_mentions(pages)
    hrefs = F.concat(F.transform("_anchors", lambda x: x["href"]), F.col("_rooted"))
    found = found.withColumn("_urls", join_urls(F.col("url"), hrefs))
    split = F.size("_anchors")
    from_anchors = F.zip_with(
        F.col("_anchors"),
        F.slice("_urls", F.lit(1), split),
        lambda x, url: F.struct(
            url.alias("url"), x["text"].alias("text"), x["context"].alias("context")
        ),
    )
    raw = F.concat(F.col("_absolute"), F.slice("_urls", split + 1, F.size("_rooted")))
    from_text = F.transform(
        raw,
        lambda url: F.struct(
            url.alias("url"), F.lit("").alias("text"), F.lit("").alias("context")
        ),
    )
    placed = F.transform(
        F.concat(from_anchors, from_text),
        lambda x, i: F.struct(
            i.alias("pos"), x["url"].alias("url"), x["text"].alias("text"), x["context"].alias("context")
        ),
    )
    found = found.withColumn("pdf_candidates", placed)
    unique = first_in_array(found, "pdf_candidates", "url")
    return unique.drop("_anchors", "_absolute", "_rooted", "_urls")


def scored_candidates(candidates: Column, title_words: Column) -> Column:
    """Array of (score, -pos, url) per candidate."""
    return F.transform(
        candidates,
        lambda c: F.struct(
            pdf_score(c["url"], c["text"], c["context"], title_words).alias("score"),
            (-c["pos"]).alias("rank"),
            c["url"].alias("url"),
        ),
    )


def with_pdf_link(
    df: DataFrame, title: Column, prefers_pdf: Column, row_key: str, headers: DataFrame | None = None
) -> DataFrame:
    """Add `pdf_link`: the best-scored candidate that is a PDF, else empty.

    Kind comes from the address; with `headers(url, content_type_header)` also from landed headers.
    """
    threshold = F.when(prefers_pdf, C.PDF_THRESHOLD_PREFERRED).otherwise(C.PDF_THRESHOLD)
    df = df.withColumns({"_words": keywords(title), "_threshold": threshold})
    scored = scored_candidates(F.col("pdf_candidates"), F.col("_words"))
    fit = F.filter(scored, lambda c: (c["score"] >= F.col("_threshold")) & (c["url"] != ""))
    if headers is None:
        pdfs = F.filter(fit, lambda c: content_kind(c["url"]) == "pdf")
        best = F.coalesce(F.array_max(pdfs)["url"], F.lit(""))
        return df.withColumn("pdf_link", best).drop("_words", "_threshold")
    # Read twice below, so the candidates are written once.
    df = settle(df.withColumn("_fit", fit), "candidates")
    known = headers.groupBy("url").agg(F.max("content_type_header").alias("_header"))
    chosen = (
        unnest(df, row_key, array="_fit", item="_c")
        .select(row_key, "_c", F.col("_c.url").alias("url"))
        .join(known, "url", "left")
        .filter(content_kind(F.col("url"), F.col("_header")) == "pdf")
        .groupBy(row_key)
        .agg(F.max("_c").alias("_best"))
        .select(row_key, F.col("_best.url").alias("pdf_link"))
    )
    joined = df.join(chosen, row_key, "left").drop("_words", "_threshold", "_fit")
    return joined.withColumn("pdf_link", F.coalesce("pdf_link", F.lit("")))
