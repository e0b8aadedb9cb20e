"""Page queries: listings, PDF links and description texts."""

from pyspark.sql import Column, functions as F

from postmill import constants as C
from postmill.functions.html import html_outline, html_text
from postmill.functions.text import collapse_space
from postmill.operators.listings import frame_links, keyword_links, strict_links
from postmill.operators.page_text import with_leaf_text, with_legacy_text, with_main_text
from postmill.operators.pdf_links import first_pdf_link, with_pdf_candidates, with_pdf_link
from postmill.plans.description import page_facts
from postmill.plans.extractors import SHIPPED, extract_listings
from postmill.sources.pages import read_pages
from postmill.sources.rules import rules_frame
from postmill.suite.base import (
    query, sql_any, sql_clean, sql_hits, sql_keywords, sql_short, sql_strip, sql_words, table,
)

# --- the landed pages ----------------------------------------------------------


def _sql_unescape(x: str) -> str:
    named = f"replace(replace(replace({x}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"')"
    return f"regexp_replace({named}, '&amp;?', '&', 'g')"


_ANCHORS_SQL = rf"""
anchors AS (
  SELECT page_id, url AS page_url, i, hrefs[i] AS href, {_sql_unescape('titles[i]')} AS title
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
               regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS titles,
               unnest(range(1, 1 + len(regexp_extract_all(html, '<a href=')))) AS i FROM pages) p)"""


@query(
    "strict_links",
    f"""WITH {_ANCHORS_SQL}
        SELECT page_id, arg_min(title, i) AS title, 'https://board.example' || href AS url FROM anchors
        WHERE contains(href, '/') AND NOT contains(href, 'th') AND length(title) >= 5 GROUP BY page_id, href""",
)
def strict_link_rows(spark, folder):
    pages = read_pages(spark, f"{folder}/pages.parquet")
    links = strict_links(pages, "/", "https://board.example", 5, ["th"])
    return links.select("page_id", "title", "url")


_ROOT = "regexp_extract(page_url, '^[a-z]+://[^/?#]*')"


@query(
    "keyword_links",
    f"""WITH {_ANCHORS_SQL}
        SELECT page_id, arg_min(title, i) AS title, {_ROOT} || href AS url FROM anchors
        WHERE length(title) >= 4 AND {sql_any("lower(title || ' ' || href)", ('en', 'ou'))}
          AND NOT contains(lower(title || ' ' || href), 'aux')
        GROUP BY page_id, page_url, href""",
)
def keyword_link_rows(spark, folder):
    pages = read_pages(spark, f"{folder}/pages.parquet")
    links = keyword_links(pages, F.col("url"), ["EN", "ou"], ["aux"])
    return links.select("page_id", "title", "url")


@query(
    "frame_links",
    f"""WITH {_ANCHORS_SQL}
        SELECT page_id, arg_min(title, i) AS title, 'https://example.com' || href AS url FROM anchors
        WHERE length(title) >= 4 AND contains(lower(title || ' ' || href), 'e') GROUP BY page_id, href
        UNION ALL SELECT page_id, 'Extra job', 'https://example.com/e/' || page_id FROM pages""",
)
def frame_link_rows(spark, folder):
    html = F.col("html")
    extra = F.concat(html, F.lit('<a href="../e/'), F.col("page_id").cast("string"), F.lit('">Extra  job</a>'))
    hidden = F.lit('<a href="/never">never seen</a>')

    def frame(pos: int, url: str, body: Column) -> Column:
        return F.struct(F.lit(pos).alias("frame_pos"), F.lit(url).alias("frame_url"), body.alias("html"))

    frames = F.array(
        frame(0, "https://x.example/Careers", html),
        frame(1, "https://x.example/news", hidden),
        frame(2, "https://x.example/jobboard", extra),
        frame(3, "https://x.example/careers/2", F.lit(None).cast("string")),
    )
    landed = table(spark, folder, "pages").select("page_id", F.explode(frames).alias("f")).select("page_id", "f.*")
    links = frame_links(landed, ["careers", "JobBoard"], "https://example.com", ["e"])
    return links.select("page_id", "title", "url")


@query(
    "extractor_rows",
    f"""WITH {_ANCHORS_SQL}
        SELECT 'board' AS extractor, page_id, arg_min(title, i) AS title, 'https://board.example' || href AS url
        FROM anchors WHERE page_id % 2 = 0 AND length(title) >= 5 GROUP BY page_id, href
        UNION ALL
        SELECT 'keywords', page_id, arg_min(title, i), {_ROOT} || href
        FROM anchors WHERE page_id % 2 = 1 AND length(title) >= 4 GROUP BY page_id, page_url, href""",
)
def extractor_rows(spark, folder):
    name = F.when(F.col("page_id") % 2 == 0, "board").otherwise("keywords")
    pages = read_pages(spark, f"{folder}/pages.parquet").withColumn("extractor", name)
    own = {
        "board": lambda rows: strict_links(rows, "/", "https://board.example"),
        "keywords": lambda rows: keyword_links(rows, F.col("url"), []),
    }
    return extract_listings(pages, own).select("extractor", "page_id", "title", "url")


@query(
    "example_extractors",
    """SELECT 'html_example' AS extractor, page_id, 'Job  number ' || page_id AS title, 'https://example.com/jobs/' || page_id AS url FROM pages WHERE page_id % 4 = 0
       UNION ALL SELECT 'simple_example', page_id, 'Job number ' || page_id, 'https://example.com/jobs/' || page_id FROM pages WHERE page_id % 4 = 1
       UNION ALL SELECT 'interactive_example', page_id, 'Job number ' || page_id, 'https://example.com/jobs/' || page_id FROM pages WHERE page_id % 4 = 2
       UNION ALL SELECT 'interactive_example', page_id, 'Closed job', 'https://example.com/jobs/closed' FROM pages WHERE page_id % 4 = 2
       UNION ALL SELECT 'iframe_example', page_id, 'Job number ' || page_id, 'https://example.com/jobs/' || page_id FROM pages WHERE page_id % 4 = 3
       UNION ALL SELECT 'iframe_example', page_id, 'Closed job', 'https://example.com/jobs/closed' FROM pages WHERE page_id % 4 = 3""",
)
def example_extractors(spark, folder):
    page = F.col("page_id").cast("string")
    html = F.concat(
        F.lit('<p><a href="/jobs/'), page, F.lit('">Job  number '), page,
        F.lit('</a> <a href="/jobs/closed">Closed job</a></p>'),
    )
    names = F.array(*[F.lit(n) for n in ("html_example", "simple_example", "interactive_example", "iframe_example")])
    pages = table(spark, folder, "pages").select(
        "page_id",
        html.alias("html"),
        F.lit(0).alias("frame_pos"),
        F.lit("https://jobboard.example").alias("frame_url"),
        F.get(names, (F.col("page_id") % 4).cast("int")).alias("extractor"),
    )
    used = {n: SHIPPED[n] for n in ("html_example", "simple_example", "interactive_example", "iframe_example")}
    return extract_listings(pages, used).select("extractor", "page_id", "title", "url")


_ARTICLE = r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
_BODY = r"regexp_replace(regexp_extract(html, '(?s)<body>(.*)$', 1), '(?s)<nav>.*?</nav>|<footer>.*?</footer>|<!--.*?-->', '', 'g')"


def _sql_page_text(x: str) -> str:
    return sql_clean(_sql_unescape(rf"regexp_replace({x}, '<[^>]*>', chr(10), 'g')"))


@query(
    "main_texts",
    f"""SELECT page_id, substr(CASE WHEN length(article) >= {C.MIN_MAIN_TEXT} OR length(body) <= length(article) THEN article
               ELSE body END, 1, {C.MAX_DESCRIPTION_CHARS}) AS main_text
        FROM (SELECT page_id, {_sql_page_text(_ARTICLE)} AS article, {_sql_page_text(_BODY)} AS body FROM pages) p""",
)
def main_texts(spark, folder):
    pages = read_pages(spark, f"{folder}/pages.parquet")
    parsed = pages.select("page_id", html_outline("html").alias("outline"))
    return with_main_text(parsed).select("page_id", "main_text")


_PLAIN = r"regexp_replace(regexp_replace(html, '(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g')"

_SPACED = rf"regexp_replace({_sql_unescape(_PLAIN)}, '\s+', ' ', 'g')"


@query(
    "plain_texts",
    f"SELECT page_id, {sql_strip(_SPACED)} AS plain FROM pages",
)
def plain_texts(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", collapse_space(html_text("html")).alias("plain"))


# --- pages built from the documents ----------------------------------------------


def _escaped(text: Column) -> Column:
    return F.replace(text, F.lit("&"), F.lit("&amp;"))


def _paragraphs(text: Column, tag: str = "p", attrs: str = "") -> Column:
    lines = F.split(_escaped(text), "\n")
    return F.array_join(F.transform(lines, lambda x: F.concat(F.lit(f"<{tag}{attrs}>"), x, F.lit(f"</{tag}>"))), "")


def built_pages(spark, folder):
    """A posting page per document: an article, and one of three kinds of PDF reference or none."""
    docs = table(spark, folder, "documents")
    doc = F.col("doc_id").cast("string")
    linked = F.concat(
        F.lit('<div>Notice: <a href="files/vacancy-notice-'), doc, F.lit('.pdf">Download vacancy notice</a></div>')
    )
    offered = F.concat(
        F.lit('<div><a href="/get?id='), doc,
        F.lit('">Download PDF</a> <a href="/privacy.pdf">Privacy notice GDPR</a></div>'),
    )
    hidden = F.concat(
        F.lit('<script>{"file":"https:\\/\\/cdn.example.org\\/docs\\/position-'), doc, F.lit('.pdf"}</script>')
    )
    kind = F.col("doc_id") % 4
    extra = F.when(kind == 1, linked).when(kind == 2, offered).when(kind == 3, hidden).otherwise("")
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body>'),
        F.lit('<nav><a href="/home">Home page</a></nav><article>'),
        _paragraphs(F.col("text")),
        F.lit("</article>"),
        extra,
        F.lit("<footer>Impressum</footer></body></html>"),
    )
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/job/"), doc)
    return docs.select(
        F.col("doc_id").alias("page_id"),
        url.alias("url"),
        html.alias("html"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.upper("source").alias("org_abbrev"),
    )


_CANDIDATES_SQL = r"""
built AS (SELECT doc_id AS page_id, doc_id % 4 AS kind, source, text, split_part(text, chr(10), 1) AS title,
                 'https://' || source || '.example.org' AS site FROM documents),
candidates AS (
  SELECT page_id, 0 AS pos, site || '/job/files/vacancy-notice-' || page_id || '.pdf' AS url,
         'Download vacancy notice' AS text, 'Notice: Download vacancy notice' AS context FROM built WHERE kind = 1
  UNION ALL SELECT page_id, 1, site || '/vacancy-notice-' || page_id || '.pdf', '', '' FROM built WHERE kind = 1
  UNION ALL SELECT page_id, 0, site || '/get?id=' || page_id, 'Download PDF', 'Download PDF Privacy notice GDPR' FROM built WHERE kind = 2
  UNION ALL SELECT page_id, 1, site || '/privacy.pdf', 'Privacy notice GDPR', 'Download PDF Privacy notice GDPR' FROM built WHERE kind = 2
  UNION ALL SELECT page_id, 0, 'https://cdn.example.org/docs/position-' || page_id || '.pdf', '', '' FROM built WHERE kind = 3)"""
_BLOB = "lower(c.url || ' ' || c.text || ' ' || c.context)"
SCORES_SQL = f"""{_CANDIDATES_SQL},
scores AS (
  SELECT c.page_id, c.pos, c.url,
         CAST(60 * CAST(contains(lower(c.url), '.pdf') AS INTEGER) + 15 * CAST(contains({_BLOB}, 'download') AS INTEGER)
         + 45 * {sql_hits(_BLOB, C.PDF_POSITIVE_MARKERS)} - 120 * {sql_hits(_BLOB, C.PDF_NEGATIVE_MARKERS)}
         - 200 * CAST(contains(lower(c.url), '.doc') AS INTEGER) - 120 * CAST(contains({_BLOB}, 'application form') AS INTEGER)
         + least(120, 20 * len(list_intersect({sql_keywords('b.title')}, {sql_keywords(_BLOB)}))) AS BIGINT) AS score
  FROM candidates c JOIN built b USING (page_id))"""


@query(
    "pdf_candidates",
    f"WITH {_CANDIDATES_SQL} SELECT page_id, url, text, context FROM candidates",
)
def pdf_candidate_rows(spark, folder):
    pages = built_pages(spark, folder).withColumn("outline", html_outline("html"))
    rows = with_pdf_candidates(pages).select("page_id", F.explode("pdf_candidates").alias("c"))
    return rows.select("page_id", "c.url", "c.text", "c.context")


@query(
    "first_pdf_links",
    """SELECT doc_id AS page_id, CASE doc_id % 4 WHEN 1 THEN 'https://' || source || '.example.org/job/files/vacancy-notice-' || doc_id || '.pdf'
              WHEN 2 THEN 'https://' || source || '.example.org/privacy.pdf' ELSE '' END AS pdf_link FROM documents""",
)
def first_pdf_links(spark, folder):
    pages = built_pages(spark, folder).select("page_id", "url", html_outline("html").alias("outline"))
    return pages.select("page_id", first_pdf_link(F.col("outline"), F.col("url")).alias("pdf_link"))


_PREFERS = "upper(b.source) IN ('SRC1', 'SRC2')"
BEST_SQL = f"""{SCORES_SQL},
best AS (
  SELECT s.page_id, arg_max(s.url, (s.score, -s.pos)) AS pdf_link FROM scores s JOIN built b USING (page_id)
  WHERE s.score >= CASE WHEN {_PREFERS} THEN {C.PDF_THRESHOLD_PREFERRED} ELSE {C.PDF_THRESHOLD} END
    AND lower(s.url) LIKE '%.pdf' GROUP BY s.page_id)"""


@query(
    "best_pdf_links",
    f"""WITH {BEST_SQL}
        SELECT b.page_id, coalesce(best.pdf_link, '') AS pdf_link FROM built b LEFT JOIN best USING (page_id)""",
)
def best_pdf_links(spark, folder):
    pages = built_pages(spark, folder).withColumn("outline", html_outline("html"))
    rows = with_pdf_candidates(pages).select("page_id", "title", "org_abbrev", "pdf_candidates")
    prefers = F.col("org_abbrev").isin("SRC1", "SRC2")
    return with_pdf_link(rows, F.col("title"), prefers, "page_id").select("page_id", "pdf_link")


@query(
    "served_pdf_links",
    f"""WITH {SCORES_SQL},
        best AS (SELECT s.page_id, arg_max(s.url, (s.score, -s.pos)) AS pdf_link FROM scores s
                 WHERE s.score >= {C.PDF_THRESHOLD} AND (lower(s.url) LIKE '%.pdf' OR s.url LIKE '%/get?id=%') GROUP BY s.page_id)
        SELECT b.page_id, coalesce(best.pdf_link, '') AS pdf_link FROM built b LEFT JOIN best USING (page_id)""",
)
def served_pdf_links(spark, folder):
    """The landed Content-Type header decides for addresses without the suffix."""
    pages = built_pages(spark, folder).withColumn("outline", html_outline("html"))
    rows = with_pdf_candidates(pages).select("page_id", "title", "pdf_candidates")
    doc = F.col("doc_id").cast("string")
    served = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/get?id="), doc)
    headers = table(spark, folder, "documents").select(
        served.alias("url"), F.lit("application/pdf").alias("content_type_header")
    )
    linked = with_pdf_link(rows, F.col("title"), F.lit(False), "page_id", headers)
    return linked.select("page_id", "pdf_link")


_EXTRA_LINES = """CASE doc_id % 4 WHEN 1 THEN chr(10) || 'Notice:' || chr(10) || 'Download vacancy notice'
                  WHEN 2 THEN chr(10) || 'Download PDF' || chr(10) || 'Privacy notice GDPR' ELSE '' END"""
FACTS_SQL = f"""
mains AS (
  SELECT doc_id, source, substr(CASE WHEN length(article) >= {C.MIN_MAIN_TEXT} OR length(body) <= length(article)
         THEN article ELSE body END, 1, {C.MAX_DESCRIPTION_CHARS}) AS main_text
  FROM (SELECT doc_id, source, {sql_clean('text')} AS article, {sql_clean(f'(text || {_EXTRA_LINES})')} AS body FROM documents) d),
facts AS (
  SELECT doc_id AS page_id, CASE WHEN {sql_short('main_text')} AND doc_id % 4 IN (1, 2) THEN '' ELSE main_text END AS description,
         doc_id % 4 IN (1, 2) AS has_pdf_link,
         {sql_short('main_text')} AND doc_id % 4 NOT IN (1, 2) AND source IN ('src1', 'src4') AS needs_browser
  FROM mains)"""


@query(
    "page_descriptions",
    f"WITH {FACTS_SQL} SELECT page_id, description, has_pdf_link, needs_browser FROM facts",
)
def page_descriptions(spark, folder):
    rules = rules_frame(spark, {"browser_domains": ["src1.", "src4."]})
    facts = page_facts(built_pages(spark, folder), rules)
    return facts.select("page_id", "description", "has_pdf_link", "needs_browser")


# --- embedded application JSON ------------------------------------------------------

_HALF = "substr(text, 1, CAST(length(text) // 2 AS BIGINT))"


def leaf_score(x: str, marked: bool) -> str:
    bonus = 250 if marked else 0
    return f"""{sql_words(x)} + {bonus} - 500 * CAST({sql_any(f'lower({x})', C.LEAF_NOISE)} AS INTEGER)
               - 500 * CAST(contains(lower({x}), 'job list') AND contains(lower({x}), 'confirm') AS INTEGER)"""


@query(
    "app_json_texts",
    f"""WITH cleaned AS (SELECT doc_id, source, {sql_clean('text')} AS whole, {sql_clean(_HALF)} AS half FROM documents),
        leaves AS (SELECT doc_id, 0 AS pos, whole AS leaf, {leaf_score('whole', False)} AS score FROM cleaned
                   UNION ALL SELECT doc_id, 1, half, {leaf_score('half', True)} FROM cleaned),
        best AS (SELECT doc_id, arg_max(leaf, (score, -pos)) AS leaf FROM leaves
                 WHERE length(leaf) >= {C.MIN_LEAF_CHARS} AND score >= {C.MIN_LEAF_SCORE} GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN d.source = 'src2' THEN '' ELSE substr(coalesce(b.leaf, ''), 1, {C.MAX_DESCRIPTION_CHARS}) END AS leaf_text
        FROM documents d LEFT JOIN best b USING (doc_id)""",
)
def app_json_texts(spark, folder):
    text = F.col("text")
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    props = F.struct(
        F.struct(_escaped(text).alias("body"), F.lit(1).alias("n")).alias("page"),
        F.array(F.struct(_paragraphs(half).alias("Job_Description"))).alias("items"),
    )
    body = F.to_json(F.struct(props.alias("props"), F.lit("/jobs").alias("page")))
    html = F.concat(
        F.lit('<html><body><script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script></body></html>")
    )
    pages = table(spark, folder, "documents").select("doc_id", "source", html_outline(html).alias("outline"))
    return with_leaf_text(pages, F.col("source") != "src2").select("doc_id", "leaf_text")


# --- percent-coded detail pages -------------------------------------------------------

PIECES_SQL = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {sql_strip('l')}), lambda l: l <> '')"
_JOINED = "coalesce(array_to_string(pieces, chr(10)), '')"
_LONG = "list_filter(pieces, lambda l: length(l) > 15)"


@query(
    "legacy_texts",
    f"""WITH p AS (SELECT doc_id, {PIECES_SQL} AS pieces FROM documents),
        t AS (SELECT doc_id, {_JOINED} AS whole, coalesce(array_to_string({_LONG}, chr(10)), '') AS long_lines FROM p)
        SELECT doc_id, substr(CASE doc_id % 3 WHEN 0 THEN whole
               WHEN 1 THEN CASE WHEN long_lines <> '' THEN long_lines WHEN length(whole) > 200 THEN whole ELSE '' END
               ELSE CASE WHEN {sql_words('whole')} + 400 * {sql_hits('lower(whole)', C.SECTION_MARKERS)}
                    - 120 * {sql_hits('lower(whole)', C.SECTION_NOISE)} > -1 THEN whole ELSE '' END END,
               1, {C.MAX_DESCRIPTION_CHARS}) AS legacy_text FROM t""",
)
def legacy_texts(spark, folder):
    text = F.col("text")
    box = F.concat(F.lit('<div class="x singleview"><script>no</script>'), _paragraphs(text), F.lit("</div>"))
    section = F.concat(
        F.lit('<div id="ctl_requisitiondescriptionA">'),
        _paragraphs(text, attrs=' class="MsoNormal x"'),
        F.lit("</div><p class='MsoNormal'>after the section ends</p>"),
    )
    parts = F.concat(
        F.lit("head !|!!*!<p>Important notice</p>!|!!*!"),
        _paragraphs(text),
        F.lit("!|!1234567!|!<p>tail of another posting</p>!|!!*!<p>How to apply</p>"),
    )
    kind = F.col("doc_id") % 3
    body = F.when(kind == 0, box).when(kind == 1, section).otherwise(parts)
    lead = F.when(F.col("doc_id") % 2 == 0, "<html><body>100%").otherwise("<html><body>a+b")
    coded = F.concat(lead, F.replace(F.url_encode(body), F.lit("+"), F.lit("%20")))
    pages = table(spark, folder, "documents").select("doc_id", coded.alias("html"))
    return with_legacy_text(pages, F.lit(True)).select("doc_id", "legacy_text")
