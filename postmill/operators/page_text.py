"""Description text of a landed page."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill import constants as C
from postmill.functions.html import css_token, html_outline, html_texts, json_leaves, node_text, pieces
from postmill.functions.scoring import fragment_score, leaf_score
from postmill.functions.text import bind, cap_description, clean_text, null_if_blank, strip, unescape_marks
from postmill.functions.urls import percent_decode


def _has(value: Column, part: str) -> Column:
    return F.coalesce(F.contains(value, F.lit(part)), F.lit(False))


def _is(value: Column, wanted: str) -> Column:
    return F.coalesce(value == wanted, F.lit(False))


def _selector_groups(n: Column) -> list[Column]:
    """Which of the ranked selectors a node matches, best first."""
    is_div = n["tag"] == "div"
    return [
        _is(n["itemprop"], "description"),
        _is(n["propertyid"], "description"),
        css_token(n, "jobdescription"),
        is_div & css_token(n, "gestmax-container"),
        is_div & css_token(n, "gestmax-template-container"),
        is_div & _is(n["id"], "requisitionDescription"),
        is_div & _is(n["id"], "requisitionDescriptionInterface"),
        n["tag"] == "article",
        n["tag"] == "main",
        _has(n["css"], "job-description"),
        _has(n["id"], "job-description"),
        _has(n["css"], "description"),
        _has(n["id"], "description"),
        n["tag"] == "body",
    ]


def with_main_text(pages: DataFrame, out: str = "main_text") -> DataFrame:
    """Add the longest text over the ranked selectors up to the first rank that is long enough."""
    nodes, segments = F.col("outline.nodes"), F.col("outline.segments")
    cleaned = F.transform(segments, lambda s: F.when(s["noise"], "").otherwise(clean_text(s["text"])))
    pages = pages.withColumn("_cleaned", cleaned)

    def below(n: Column) -> Column:
        return F.slice("_cleaned", n["first"] + 1, n["last"] - n["first"])

    def length_below(n: Column) -> Column:
        total = F.aggregate(
            below(n), F.lit(0), lambda sum_, t: sum_ + F.when(t == "", 0).otherwise(F.length(t) + 1)
        )
        return F.greatest(total - 1, F.lit(0))

    def candidates(n: Column) -> Column:
        ranks = F.array_compact(
            F.array(*[F.when(hit, F.lit(i)) for i, hit in enumerate(_selector_groups(n))])
        )
        return F.transform(
            ranks, lambda g: F.struct(g.alias("rank"), n["pos"], n["first"], n["last"])
        )

    quiet = F.filter(nodes, lambda n: ~n["noise"])
    ranked = F.array_sort(F.flatten(F.transform(quiet, candidates)))
    measured = F.transform(ranked, lambda c: c.withField("size", length_below(c)))
    pages = pages.withColumn("_ranked", measured)
    start = F.struct(
        F.lit(0).alias("size"), F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(0).alias("rank")
    )

    def better(best: Column, c: Column) -> Column:
        settled = (best["size"] >= C.MIN_MAIN_TEXT) & (c["rank"] > best["rank"])
        return F.when(settled | (c["size"] <= best["size"]), best).otherwise(
            F.struct(c["size"], c["first"], c["last"], c["rank"])
        )

    text = bind(
        F.aggregate("_ranked", start, better),
        lambda pick: F.array_join(F.filter(below(pick), lambda t: t != ""), "\n"),
    )
    return pages.withColumn(out, cap_description(text)).drop("_cleaned", "_ranked")


def with_leaf_text(pages: DataFrame, wanted: Column, out: str = "leaf_text") -> DataFrame:
    """Add the best string leaf of the embedded app JSON for the wanted pages, else empty."""
    leaves = json_leaves(F.when(wanted, F.col("outline.app_json")))
    cleaned = F.transform(
        "_leaves", lambda x: F.struct(x["path"].alias("path"), clean_text(x["text"]).alias("text"))
    )
    long_enough = F.filter(cleaned, lambda x: F.length(x["text"]) >= C.MIN_LEAF_CHARS)
    scored = F.transform(
        long_enough,
        lambda x, i: F.struct(
            leaf_score(x["path"], x["text"]).alias("score"), (-i).alias("rank"), x["text"].alias("text")
        ),
    )
    best = F.array_max(F.filter(scored, lambda x: x["score"] >= C.MIN_LEAF_SCORE))
    text = F.coalesce(cap_description(best["text"]), F.lit(""))
    return pages.withColumn("_leaves", leaves).withColumn(out, text).drop("_leaves")


def _fewer_breaks(text: Column) -> Column:
    return unescape_marks(F.regexp_replace(text, "\n{3,}", "\n\n"))


def payload_fragments(decoded: Column) -> Column:
    """HTML of the marked fragments in a decoded page."""
    parts = F.split(decoded, r"!\|!!\*!")
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(rest, lambda p: F.regexp_replace(p, C.FRAGMENT_END, ""))


def best_fragment(texts: Column) -> Column:
    """The best-scored fragment text, else null."""
    tidy = F.filter(F.transform(texts, lambda t: strip(_fewer_breaks(t))), lambda t: t != "")
    scored = F.transform(
        tidy,
        lambda t, i: F.struct(fragment_score(t).alias("score"), (-i).alias("rank"), t.alias("text")),
    )
    return F.array_max(F.filter(scored, lambda x: x["score"] >= 0))["text"]


def with_legacy_text(pages: DataFrame, wanted: Column, out: str = "legacy_text") -> DataFrame:
    """Add the text of percent-encoded detail pages for the wanted rows, else empty."""
    pages = pages.withColumn("_decoded", percent_decode(F.when(wanted, F.col("html"))))
    pages = pages.withColumns(
        {
            "_inner": html_outline("_decoded"),
            "_fragments": html_texts(payload_fragments(F.col("_decoded"))),
        }
    )
    inner = F.col("_inner")
    boxes = F.filter(inner["nodes"], lambda n: (n["tag"] == "div") & css_token(n, "singleview"))
    wanted_ids = F.filter(inner["nodes"], lambda n: _has(F.lower(n["id"]), "requisitiondescription"))
    pages = pages.withColumns(
        {"_box": F.get(boxes, F.lit(0)), "_section": F.get(wanted_ids, F.lit(0))}
    )
    box, section = F.col("_box"), F.col("_section")

    def is_paragraph(n: Column) -> Column:
        inside = (n["pos"] > section["pos"]) & (n["first"] >= section["first"]) & (n["last"] <= section["last"])
        return inside & _has(F.lower(n["css"]), "msonormal")

    lines = F.filter(
        F.transform(F.filter(inner["nodes"], is_paragraph), lambda n: node_text(inner, n, " ")),
        lambda t: F.length(t) > 15,
    )
    whole = F.array_join(pieces(inner, section), "\n")
    in_section = F.coalesce(
        F.when(section.isNotNull(), null_if_blank(_fewer_breaks(F.array_join(lines, "\n")))),
        F.when(F.length(whole) > 200, unescape_marks(whole)),
    )
    text = F.when(box.isNotNull(), _fewer_breaks(F.array_join(pieces(inner, box), "\n"))).otherwise(
        F.coalesce(in_section, best_fragment(F.col("_fragments")))
    )
    return pages.withColumn(out, F.coalesce(cap_description(text), F.lit(""))).drop(
        "_decoded", "_inner", "_fragments", "_box", "_section"
    )
