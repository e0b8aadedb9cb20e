"""Text, address and status expressions over whole tables."""

from pyspark.sql import functions as F

from postmill import constants as C
from postmill.functions import predicates as P, text as T, urls as U
from postmill.functions.scoring import fragment_score
from postmill.operators.rules import flag_equal, flag_hosts, flag_inside
from postmill.operators.rollup import has_pdf
from postmill.sources.rules import rules_frame
from postmill.suite.base import (
    LISTINGS_SQL, RESULTS_SQL, RUN_ID, as_long, listings, now, postings, query, sql_any,
    sql_clean, sql_error, sql_hits, sql_keywords, sql_short, sql_slug, sql_strip, sql_words,
    table,
)


@query("word_counts", f"SELECT doc_id, {sql_words('text')} AS words FROM documents")
def word_counts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.word_count(F.col("text")).alias("words"))


@query("title_slugs", f"SELECT doc_id, {sql_slug('text')} AS slug FROM documents")
def title_slugs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.slug(F.col("text")).alias("slug"))


@query(
    "keyword_sets",
    f"""SELECT doc_id, CAST(len(k) AS BIGINT) AS n_keywords, array_to_string(list_sort(k), ' ') AS keywords
        FROM (SELECT doc_id, {sql_keywords('text')} AS k FROM documents) t""",
)
def keyword_sets(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", T.keywords(F.col("text")).alias("k"))
    return rows.select(
        "doc_id",
        as_long(F.size("k")).alias("n_keywords"),
        F.array_join(F.array_sort("k"), " ").alias("keywords"),
    )


# Marks and noise lines are put around each document, so that cleaning has work to do.
_DIRTY = r"'Language' || chr(10) || text || chr(10) || chr(10) || chr(10) || '  a\:b\; c  ' || chr(10) || 'View Profile'"


@query("cleaned_texts", f"SELECT doc_id, {sql_clean(_DIRTY)} AS cleaned FROM documents")
def cleaned_texts(spark, folder):
    dirty = F.concat(F.lit("Language\n"), F.col("text"), F.lit("\n\n\n  a\\:b\\; c  \nView Profile"))
    return table(spark, folder, "documents").select("doc_id", T.clean_text(dirty).alias("cleaned"))


_COLLAPSED = r"regexp_replace(text, '\s+', ' ', 'g')"


@query(
    "collapsed_texts",
    f"SELECT doc_id, {sql_strip(_COLLAPSED)} AS collapsed FROM documents",
)
def collapsed_texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.collapse_space(F.col("text")).alias("collapsed"))


@query(
    "capped_texts",
    f"""SELECT doc_id, substr(text, 1, {C.CONTEXT_CHARS}) AS context,
               length(substr(text, 1, {C.MAX_DESCRIPTION_CHARS})) AS kept FROM documents""",
)
def capped_texts(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.substring(text, 1, C.CONTEXT_CHARS).alias("context"),
        as_long(F.length(T.cap_description(text))).alias("kept"),
    )


@query(
    "marker_scores",
    f"""SELECT doc_id, {sql_words('text')} + 400 * {sql_hits('lower(text)', C.SECTION_MARKERS)}
               - 120 * {sql_hits('lower(text)', C.SECTION_NOISE)} AS score,
               {sql_hits("lower(text)", C.PDF_POSITIVE_MARKERS)} AS positive_hits,
               {sql_hits("lower(text)", C.PDF_NEGATIVE_MARKERS)} AS negative_hits
        FROM documents""",
)
def marker_scores(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        as_long(fragment_score(text)).alias("score"),
        as_long(T.marker_hits(F.lower(text), C.PDF_POSITIVE_MARKERS)).alias("positive_hits"),
        as_long(T.marker_hits(F.lower(text), C.PDF_NEGATIVE_MARKERS)).alias("negative_hits"),
    )


@query("short_texts", f"SELECT doc_id, {sql_short('text')} AS is_short FROM documents")
def short_texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", P.is_short(F.col("text")).alias("is_short"))


# Every document is followed by a percent-coded copy; + and a broken escape stay as they are.
@query("decoded_texts", "SELECT doc_id, 'a+b ' || text AS plain, '100% ' || text AS loose FROM documents")
def decoded_texts(spark, folder):
    coded = F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20"))
    return table(spark, folder, "documents").select(
        "doc_id",
        U.percent_decode(F.concat(F.lit("a+b%20"), coded)).alias("plain"),
        U.percent_decode(F.concat(F.lit("100%%20"), coded)).alias("loose"),
    )


@query(
    "org_abbreviations",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE upper(split_part(c_name, '#', 1)) END AS abbrev
       FROM customer""",
)
def org_abbreviations(spark, folder):
    name = F.replace(F.col("c_name"), F.lit("#"), F.lit(" no "))
    bracketed = F.concat(name, F.lit(" ["), F.col("c_mktsegment"), F.lit("] [second]"))
    given = F.when(F.col("c_custkey") % 2 == 0, bracketed).otherwise(name)
    return table(spark, folder, "customer").select("c_custkey", T.org_abbrev(given).alias("abbrev"))


@query(
    "page_hosts",
    r"SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages",
)
def page_hosts(spark, folder):
    return table(spark, folder, "pages").select("page_id", U.url_host(F.col("url")).alias("host"))


@query(
    "error_classes",
    f"""SELECT doc_id, {sql_error('message', 0)} AS status, {sql_error('message', 1)} AS reason
        FROM (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '429 Client Error for url: https://x/' WHEN 1 THEN 'FORBIDDEN for '
              WHEN 2 THEN 'Not Found: ' WHEN 3 THEN 'bad Certificate at ' WHEN 4 THEN 'Invalid URL: ' WHEN 5 THEN 'timed out '
              ELSE 'no scheme supplied: ' END || text AS message FROM documents) m""",
)
def error_classes(spark, folder):
    heads = (
        "429 Client Error for url: https://x/", "FORBIDDEN for ", "Not Found: ", "bad Certificate at ",
        "Invalid URL: ", "timed out ", "no scheme supplied: ",
    )
    head = F.get(F.array(*[F.lit(h) for h in heads]), (F.col("doc_id") % 7).cast("int"))
    kind = P.classify_error(F.concat(head, F.col("text")))
    return table(spark, folder, "documents").select("doc_id", kind.alias("kind")).select("doc_id", "kind.*")


@query(
    "retry_delays",
    """SELECT event_id, CASE WHEN attempt > 1 THEN NULL WHEN status <> 429 OR header = '' THEN pow(2.0, attempt)
              WHEN header LIKE '%GMT' THEN greatest(0.0, CAST(date_diff('second', TIMESTAMP '2024-01-15 00:00:00', second) AS DOUBLE))
              WHEN header = 'soon' THEN pow(2.0, attempt) ELSE greatest(0.0, CAST(header AS DOUBLE)) END AS delay_seconds
       FROM (SELECT event_id, CAST(event_id % 3 AS INTEGER) AS attempt, CASE WHEN event_type = 'error' THEN 429 ELSE 500 END AS status,
                    date_trunc('second', ts) AS second,
                    CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN CAST(user_id - 20 AS VARCHAR) WHEN 2 THEN 'soon'
                    ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') END AS header FROM events) e""",
)
def retry_delays(spark, folder):
    form = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    header = (
        F.when(F.col("event_id") % 4 == 0, "")
        .when(F.col("event_id") % 4 == 1, (F.col("user_id") - 20).cast("string"))
        .when(F.col("event_id") % 4 == 2, "soon")
        .otherwise(F.concat(form, F.lit(" GMT")))
    )
    status = F.when(F.col("event_type") == "error", 429).otherwise(500)
    now = F.to_timestamp(F.lit("2024-01-15 00:00:00"))
    delay = P.retry_delay((F.col("event_id") % 3).cast("int"), status, header, now)
    return table(spark, folder, "events").select("event_id", delay.alias("delay_seconds"))


@query(
    "content_kinds",
    r"""SELECT page_id, CASE WHEN page_id % 5 = 0 OR page_id % 7 = 0 THEN 'pdf' ELSE 'html' END AS kind FROM pages""",
)
def content_kinds(spark, folder):
    page = F.col("page_id")
    url = F.when(page % 5 == 0, F.concat("url", F.lit("/file.PDF"))).otherwise(F.concat("url", F.lit("/page")))
    header = F.when(page % 7 == 0, "Application/PDF; charset=x").when(page % 3 == 0, "text/html")
    return table(spark, folder, "pages").select("page_id", U.content_kind(url, header).alias("kind"))


@query(
    "table_rows",
    """SELECT page_id, page_id AS row_index FROM pages WHERE contains(lower(url), 'example.net')""",
)
def table_rows(spark, folder):
    rules = rules_frame(spark, {"table_domains": ["example.net"]})
    base = F.concat(F.substring_index("url", "#", 1), F.lit("#list-row-"), F.col("page_id").cast("string"))
    pages = table(spark, folder, "pages").select("page_id", base.alias("url"))
    pages = flag_inside(pages, U.url_host(F.col("url")), rules, "table_domains", "is_table")
    index = U.table_row_index(F.col("url"))
    return pages.filter(F.col("is_table") & index.isNotNull()).select("page_id", index.alias("row_index"))


@query(
    "detail_addresses",
    r"""SELECT doc_id, 'https://' || source || '.Jobs.example.org/wday/cxs/' || source || '/External/job/Paris/R_' || doc_id AS nested,
              doc_id AS vacancy_number,
              lpad(printf('%x', doc_id), 16, '0') AS vacancy_key,
              'https://x.example.org/External/job/R_' || doc_id AS facet
        FROM documents""",
)
def detail_addresses(spark, folder):
    doc = F.col("doc_id").cast("string")
    host = F.concat(F.lit("https://"), F.col("source"), F.lit(".Jobs.example.org"))
    locale = F.when(F.col("doc_id") % 2 == 0, F.lit("/External/en-US/job/Paris/R_")).otherwise(
        F.lit("/a/External/job/Paris/R_")
    )
    posting = F.concat(host, locale, doc, F.when(F.col("doc_id") % 3 == 0, F.lit("/apply/")).otherwise(F.lit("?q=1")))
    key = F.lpad(F.lower(F.hex("doc_id")), 16, "0")
    facet_path = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("job/R_"), doc)).otherwise(
        F.concat(F.lit("/External/job/R_"), doc)
    )
    api = F.lit("https://x.example.org/wday/cxs/x/External/jobs/")
    return table(spark, folder, "documents").select(
        "doc_id",
        U.detail_api_url(posting).alias("nested"),
        U.vacancy_number(F.concat(host, F.lit("/en/vacancies/"), doc, F.lit("/x"))).alias("vacancy_number"),
        U.vacancy_key(F.concat(host, F.lit("/Vacancy/"), key)).alias("vacancy_key"),
        U.facet_detail_url(F.lit("https://x.example.org"), api, facet_path).alias("facet"),
    )


@query(
    "legacy_addresses",
    "SELECT page_id, page_id % 2 = 0 AS is_legacy FROM pages",
)
def legacy_addresses(spark, folder):
    tail = F.when(F.col("page_id") % 2 == 0, "/CareerSection/2/jobDetail.ftl?job=1").otherwise("/careersection/2/x")
    return table(spark, folder, "pages").select(
        "page_id", U.is_legacy_ats(F.concat("url", tail)).alias("is_legacy")
    )


_ASK = "Please enable JavaScript"
_WALL = "<h1>Access Denied</h1>"


@query(
    "page_signals",
    f"""SELECT page_id, page_id % 3 = 0 OR contains(lower(url), 'example.net') OR contains(lower(html), 'please wait') AS needs_browser,
               page_id % 4 = 0 OR page_id % 6 = 1 AS is_blocked FROM pages""",
)
def page_signals(spark, folder):
    rules = rules_frame(spark, {"browser_domains": ["example.net"]})
    page = F.col("page_id")
    html = F.concat(
        F.col("html"),
        F.when(page % 3 == 0, _ASK).otherwise(""),
        F.when(page % 4 == 0, _WALL).otherwise(""),
    )
    code = F.when(page % 6 == 1, 503).when(page % 6 == 2, 200)
    pages = flag_inside(
        table(spark, folder, "pages"), U.url_host(F.col("url")), rules, "browser_domains", "listed"
    )
    return pages.select(
        "page_id",
        P.needs_rendering(F.col("url"), F.col("html"), P.asks_for_js(html), F.col("listed")).alias("needs_browser"),
        P.looks_blocked(html, code).alias("is_blocked"),
    )


_HOST = r"lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"


@query(
    "rule_flags",
    f"""SELECT page_id, {_HOST} NOT IN ('m.ththth.example.net', 'thther.example.org') AS verify_tls,
               {sql_any(_HOST, ('casino', 'blog.', 'example.org'))} AS in_domain, contains({_HOST}, '') AS in_blank FROM pages""",
)
def rule_flags(spark, folder):
    rules = rules_frame(
        spark,
        {
            "tls_exempt_domains": ["m.ththth.example.net", "thther.example.org"],
            "detail_api_domains": ["casino", "blog.", "example.org"],
            "vacancy_list_domains": ["", "casino"],
        },
    )
    host = U.url_host(F.col("url"))
    pages = table(spark, folder, "pages").select("page_id", "url")
    pages = flag_equal(pages, host, rules, "tls_exempt_domains", "exempt")
    pages = flag_hosts(pages, host, rules, {"detail_api_domains": "in_domain", "vacancy_list_domains": "in_blank"})
    return pages.select("page_id", (~F.col("exempt")).alias("verify_tls"), "in_domain", "in_blank")


@query(
    "long_rule_flags",
    """WITH rule AS (SELECT DISTINCT lower(p_brand) || '.example' AS value FROM part
                     UNION SELECT DISTINCT substr(lower(source), 4) || '.example' FROM documents)
       SELECT doc_id, EXISTS (SELECT 1 FROM rule WHERE contains(lower(source) || '.example.org', value)) AS in_domain
       FROM documents""",
)
def long_rule_flags(spark, folder):
    """Rules that come from tables."""
    brands = table(spark, folder, "part").select(F.concat(F.lower("p_brand"), F.lit(".example")).alias("value"))
    docs = table(spark, folder, "documents").select("doc_id", "source")
    sources = docs.select(F.concat(F.substring(F.lower("source"), 4, 99), F.lit(".example")).alias("value"))
    rules = brands.unionByName(sources).select(F.lit("detail_api_domains").alias("rule"), "value")
    host = F.concat(F.lower("source"), F.lit(".example.org"))
    flagged = flag_inside(docs, host, rules, "detail_api_domains", "in_domain")
    return flagged.select("doc_id", "in_domain")


@query(
    "org_rule_flags",
    """SELECT doc_id, upper(source) IN ('SRC1', 'SRC4') AS prefers_pdf, source = 'src2' AS is_browser_org FROM documents""",
)
def org_rule_flags(spark, folder):
    rules = rules_frame(spark, {"prefer_pdf_orgs": ["SRC1", "SRC4"], "browser_orgs": ["src2", "SRC5"]})
    docs = table(spark, folder, "documents").select("doc_id", "source")
    docs = flag_equal(docs, F.upper("source"), rules, "prefer_pdf_orgs", "prefers_pdf")
    docs = flag_equal(docs, F.col("source"), rules, "browser_orgs", "is_browser_org")
    return docs.select("doc_id", "prefers_pdf", "is_browser_org")


@query(
    "posting_flags",
    f"""WITH {RESULTS_SQL}
        SELECT doc_id, CASE WHEN known <> '' THEN known IN ('ok', 'pdf') ELSE content_type IN ('html', 'pdf') END AS is_enriched,
               {sql_strip('description')} <> '' AND enrich_status IN ('ok', 'short_content') AS is_successful,
               content_type = 'pdf' OR pdf_path <> '' AS has_pdf
        FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '' ELSE enrich_status END AS known FROM results) r""",
)
def posting_flags(spark, folder):
    rows = postings(spark, folder)
    known = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("enrich_status"))
    shouted = F.upper(F.concat(F.lit(" "), F.col("enrich_status"), F.lit(" ")))
    return rows.select(
        "doc_id",
        P.is_enriched(known, F.col("content_type")).alias("is_enriched"),
        P.is_successful(shouted, F.col("description")).alias("is_successful"),
        has_pdf(F.upper("content_type"), F.col("pdf_path")).alias("has_pdf"),
    )


@query(
    "listing_details",
    f"""SELECT doc_id, upper(source) IN ('SRC11', 'SRC12') AND length({sql_strip('text')}) >= {C.MIN_CHARS}
               AND {sql_words('text')} >= {C.MIN_WORDS} AS has_detail FROM documents""",
)
def listing_details(spark, folder):
    rules = rules_frame(spark, {"trusted_detail_orgs": ["SRC11", "SRC12"]})
    docs = flag_equal(
        table(spark, folder, "documents"), F.upper("source"), rules, "trusted_detail_orgs", "trusted"
    )
    padded = F.concat(F.lit(" \n"), F.col("text"), F.lit("\t"))
    return docs.select("doc_id", P.has_listing_detail(F.col("trusted"), padded).alias("has_detail"))


@query(
    "usable_rows",
    f"""WITH {LISTINGS_SQL} SELECT doc_id, url <> '' AND title <> '' AS is_usable FROM listings""",
)
def usable_rows(spark, folder):
    padded = F.concat(F.lit(" "), F.col("url"), F.lit("\n"))
    return listings(spark, folder).select(
        "doc_id", P.is_usable_row(padded, F.col("title")).alias("is_usable")
    )


@query(
    "run_paths",
    f"""SELECT doc_id, 'ops/runs/{RUN_ID}/postings/' || upper(source) || '.json' AS artifact,
               'ops/runs/{RUN_ID}/logs.ndjson' AS log, 'ops/runs/output/' || upper(source) || '.json' AS state,
               '2026-01-02T03:04:05.000000+00:00' AS stamp FROM documents""",
)
def run_paths(spark, folder):
    org = F.upper("source")
    return table(spark, folder, "documents").select(
        "doc_id",
        U.run_path("ops/runs", RUN_ID, "postings", F.concat(org, F.lit(".json"))).alias("artifact"),
        U.run_path("ops/runs", RUN_ID, "logs.ndjson").alias("log"),
        U.run_path("ops/runs/output", F.concat(org, F.lit(".json"))).alias("state"),
        T.iso_utc(now()).alias("stamp"),
    )
