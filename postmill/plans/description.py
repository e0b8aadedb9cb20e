"""Facts of landed pages: description text, PDF candidates and a rendering flag, one parse per page."""

from pyspark.sql import DataFrame, functions as F

from postmill.functions.predicates import asks_for_js, is_short, needs_rendering
from postmill.functions.text import null_if_blank
from postmill.functions.urls import is_legacy_ats, url_host
from postmill.operators.listings import with_outline
from postmill.operators.page_text import with_leaf_text, with_legacy_text, with_main_text
from postmill.operators.payloads import with_payload_text
from postmill.operators.pdf_links import first_pdf_href, with_pdf_candidates, with_pdf_mentions
from postmill.operators.rules import flag_hosts, has_rule

_HOST_RULES = {
    "app_json_domains": "_is_app",
    "browser_domains": "_is_browser",
    "detail_api_domains": "is_detail_api",
    "vacancy_list_domains": "is_vacancy_list",
    "vacancy_item_domains": "is_vacancy_item",
}


def page_facts(
    pages: DataFrame,
    rules: DataFrame,
    payloads: DataFrame | None = None,
    legacy: bool = True,
    candidates: bool = True,
) -> DataFrame:
    """One row per page `(page_id, url)` with `description`, `needs_browser` and `pdf_candidates`.

    The HTML and its outline stay in the task that read them; only the facts go on, and meet the rules.
    """
    url = F.col("url")
    landed = pages
    # Percent-coded pages come first, while a row is only its address and its HTML.
    pages = (
        with_legacy_text(pages, is_legacy_ats(url)) if legacy else pages.withColumn("legacy_text", F.lit(""))
    )
    pages = with_outline(pages)
    pages = pages.withColumn("_asks_js", asks_for_js(F.col("html")))
    pages = pages.withColumn("has_pdf_link", first_pdf_href(F.col("outline")).isNotNull())
    pages = with_main_text(pages)
    if has_rule(rules, "app_json_domains"):
        pages = with_leaf_text(pages, F.lit(True))
    else:
        pages = pages.withColumn("leaf_text", F.lit(""))
    if candidates:
        pages = with_pdf_candidates(with_pdf_mentions(pages).drop("html", "outline"))
    else:
        pages = pages.withColumn("pdf_candidates", F.lit(None)).drop("html", "outline")
    pages = flag_hosts(pages, url_host(url), rules, _HOST_RULES, keys=landed)
    main = F.col("main_text")
    pages = pages.withColumn("_weak", is_short(main))
    weak = F.col("_weak")
    shown = F.when(weak & F.col("has_pdf_link"), "").otherwise(main)
    leaf = F.when(F.col("_is_app"), null_if_blank(F.col("leaf_text")))
    special = F.coalesce(leaf, null_if_blank(F.col("legacy_text")))
    wants_browser = needs_rendering(url, main, F.col("_asks_js"), F.col("_is_browser"))
    facts = pages.select(
        "page_id",
        "url",
        "is_detail_api",
        "is_vacancy_list",
        "is_vacancy_item",
        F.coalesce(special, shown).alias("_from_page"),
        (special.isNull() & weak & ~F.col("has_pdf_link") & wants_browser).alias("needs_browser"),
        "has_pdf_link",
        "pdf_candidates",
    )
    if payloads is not None:
        facts = with_payload_text(facts, payloads, ["page_id"])
    else:
        facts = facts.withColumn("payload_text", F.lit(""))
    has_payload = F.col("payload_text") != ""
    return facts.select(
        "page_id",
        "url",
        F.when(has_payload, F.col("payload_text")).otherwise(F.col("_from_page")).alias("description"),
        (F.col("needs_browser") & ~has_payload).alias("needs_browser"),
        "has_pdf_link",
        "pdf_candidates",
    )
