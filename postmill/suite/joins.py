"""Landed payloads, registry, reuse, dedupe, windows and roll-ups."""

from pyspark.sql import functions as F

from postmill import constants as C

from postmill.operators.breaker import opening_positions, with_breaker
from postmill.operators.dedupe import dedupe_listings
from postmill.operators.payloads import item_texts, nested_texts, vacancy_texts, with_payload_text
from postmill.operators.positions import first_n
from postmill.operators.reuse import with_prior, work_list
from postmill.operators.rollup import flatten_blocks, job_counts, org_blocks, org_measures, org_report
from postmill.plans.collect import blocked_sources
from postmill.plans.report import table_lines
from postmill.schemas import STATE
from postmill.session import scratch_path
from postmill.sinks.artifacts import pdf_manifest, state_headers
from postmill.sinks.reuse_index import append_reuse, with_stored_prior
from postmill.sources.registry import all_orgs, find_orgs, merge_registries, unknown_orgs
from postmill.sources.search_pages import facet_listings, simple_listings, table_listings
from postmill.suite.base import (
    BREAKER_SQL, DAY, LISTINGS_SQL, NOW_TEXT, ORGS_SQL, RESULTS_SQL, RUN_ID, as_long, attempts, listings,
    orgs_of, postings, query, sql_clean, sql_slug, sql_strip, sql_words, table,
)
from postmill.suite.links import _escaped, _paragraphs

# --- landed search pages: twenty documents of a source per page ------------------


def _search_pages(spark, folder, item, wrap):
    docs = table(spark, folder, "documents")
    page = (F.floor(F.col("doc_id") / 400) + 1).cast("bigint")
    rows = docs.select("source", page.alias("page_no"), "doc_id", item.alias("item"))
    grouped = rows.groupBy("source", "page_no").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda x: x["item"]
        ).alias("items")
    )
    broken = (F.col("source") == "src4") & (F.col("page_no") == 2)
    body = F.when(broken, "<html>maintenance</html>").otherwise(F.to_json(wrap(F.col("items"))))
    return grouped.select(F.col("source").alias("source_id"), "page_no", body.alias("body"))


_PAGED_SQL = """
paged AS (SELECT source AS source_id, doc_id, doc_id // 400 + 1 AS page_no, split_part(text, chr(10), 1) AS title, lang
          FROM documents WHERE source <> 'src4' OR doc_id < 400)"""


@query(
    "facet_listings",
    f"""WITH {_PAGED_SQL}
        SELECT source_id, page_no, title, 'https://' || source_id || '.example.org/External/job/' || doc_id AS url,
               lang AS location FROM paged""",
)
def facet_rows(spark, folder):
    doc = F.col("doc_id").cast("string")
    path = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("job/"), doc))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("/job/"), doc))
        .otherwise(F.concat(F.lit("/External/job/"), doc))
    )
    item = F.struct(
        F.substring_index("text", "\n", 1).alias("title"),
        path.alias("externalPath"),
        F.col("lang").alias("locationsText"),
        F.lit(True).alias("unused"),
    )
    pages = _search_pages(
        spark, folder, item, lambda x: F.struct(F.lit(10**9).alias("total"), x.alias("jobPostings"))
    )
    base = F.concat(F.lit("https://"), F.col("source_id"), F.lit(".example.org"))
    api = F.concat(base, F.lit("/wday/cxs/"), F.col("source_id"), F.lit("/External/jobs"))
    return facet_listings(pages, base, api).drop("pos")


@query(
    "table_listings",
    f"""WITH {_PAGED_SQL.strip()},
        numbered AS (SELECT *, 'N' || CAST(doc_id // 40 AS VARCHAR) AS number FROM paged),
        firsts AS (SELECT source_id, number, min(page_no) AS page_no FROM numbered GROUP BY ALL),
        sizes AS (SELECT p.source_id, p.page_no, count(f.number) AS fresh FROM (SELECT DISTINCT source_id, page_no FROM numbered) p
                  LEFT JOIN firsts f USING (source_id, page_no) GROUP BY ALL),
        running AS (SELECT *, sum(fresh) OVER (PARTITION BY source_id ORDER BY page_no) AS kept FROM sizes),
        ends AS (SELECT source_id, min(page_no) AS last FROM running
                 WHERE fresh = 0 OR kept >= CASE source_id WHEN 'src2' THEN 15 WHEN 'src3' THEN 0 ELSE 1000000000 END GROUP BY ALL)
        SELECT source_id, arg_min(page_no, (page_no, doc_id)) AS page_no, arg_min(title, (page_no, doc_id)) AS title,
               'Paris, Rome' AS location, '' AS grade, number AS job_number,
               'https://' || source_id || '.example.org/careersection/ext/jobdetail.ftl?job=' || number AS url
        FROM numbered LEFT JOIN ends USING (source_id) WHERE last IS NULL OR page_no <= last GROUP BY source_id, number""",
)
def table_rows(spark, folder):
    number = F.concat(F.lit("N"), F.floor(F.col("doc_id") / 40).cast("string"))
    item = F.struct(
        number.alias("contestNo"),
        F.array(F.substring_index("text", "\n", 1), F.lit('["Paris, Rome"]')).alias("column"),
    )
    # one source reaches its total early, one gives no total
    total = F.when(F.col("source") == "src2", 15).when(F.col("source") != "src3", 10**9).cast("bigint")
    paging = F.struct(total.alias("totalCount")).alias("pagingData")
    pages = _search_pages(spark, folder, item, lambda x: F.struct(x.alias("requisitionList"), paging))
    base = F.concat(F.lit("https://"), F.col("source_id"), F.lit(".example.org"))
    fields = {0: "title", 1: "location", 5: "grade"}
    return table_listings(pages, base, F.lit("ext"), fields, {1}, True).drop("pos")


@query(
    "simple_listings",
    f"""WITH {_PAGED_SQL}
        SELECT source_id, page_no, title, 'https://' || source_id || '.example.org/jobs/' || doc_id AS url, lang AS location,
               '' AS department FROM paged""",
)
def simple_rows(spark, folder):
    item = F.struct(
        F.substring_index("text", "\n", 1).alias("title"), F.col("doc_id").alias("id"), F.col("lang").alias("location")
    )
    pages = _search_pages(spark, folder, item, lambda x: F.struct(x.alias("results")))
    site = F.concat(F.lit("https://"), F.col("source_id"), F.lit(".example.org"))
    return simple_listings(pages, site).drop("pos")


# --- landed posting payloads --------------------------------------------------------


def _nested_payloads(spark, folder):
    text = F.col("text")
    info = F.struct(
        F.when(F.col("doc_id") % 2 == 0, _paragraphs(text)).otherwise("").alias("jobDescription"),
        _escaped(text).alias("description"),
    )
    body = F.when(F.col("doc_id") % 10 == 7, "not json").otherwise(F.to_json(F.struct(info.alias("jobPostingInfo"))))
    api = F.concat(
        F.lit("https://nested.example.org/wday/cxs/nested/External/job/"), F.col("doc_id").cast("string")
    )
    return table(spark, folder, "documents").select("doc_id", api.alias("api_url"), body.alias("body"))


_CAPPED = f"substr({sql_clean('text')}, 1, {C.MAX_DESCRIPTION_CHARS})"


@query(
    "nested_payload_texts",
    f"""SELECT 'https://nested.example.org/wday/cxs/nested/External/job/' || doc_id AS api_url,
               CASE WHEN doc_id % 10 = 7 THEN '' ELSE {_CAPPED} END AS text FROM documents""",
)
def nested_payload_texts(spark, folder):
    return nested_texts(_nested_payloads(spark, folder))


def _vacancy_payloads(spark, folder):
    """Vacancy lists per source, cut into bodies of twenty; every id comes twice, the first counts."""
    fields = {
        "jobDescription": _escaped(F.col("text")),
        "purposeforthepost": F.lit("  "),
        "requiredcompetencies": F.lit("<b>Required &amp; kept</b>"),
        "maindutiesandresponsibilities": F.when(F.col("doc_id") % 2 == 0, "Duties"),
    }
    first = F.struct(F.col("doc_id").alias("jobVacancyId"), *[v.alias(k) for k, v in fields.items()])
    second = F.struct(F.col("doc_id").alias("jobVacancyId"), *[F.lit("later").alias(k) for k in fields])
    docs = table(spark, folder, "documents")
    rows = docs.select(
        "source", F.floor(F.col("doc_id") / 400).alias("part"), "doc_id", F.array(first, second).alias("pair")
    )
    bodies = rows.groupBy("source", "part").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "pair"))), lambda x: x["pair"])
        ).alias("items")
    )
    api = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/api/CurrentJobVacancies"))
    return bodies.select(api.alias("api_url"), F.to_json("items").alias("body"))


_VACANCY = "(text || chr(10) || 'Required & kept' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'Duties' ELSE '' END)"


@query(
    "vacancy_list_texts",
    f"""SELECT 'https://' || source || '.example.org/api/CurrentJobVacancies' AS api_url, doc_id AS vacancy_id,
               substr({sql_clean(_VACANCY)}, 1, {C.MAX_DESCRIPTION_CHARS}) AS text FROM documents""",
)
def vacancy_list_texts(spark, folder):
    return vacancy_texts(_vacancy_payloads(spark, folder))


def _item_payloads(spark, folder):
    item = F.struct(
        F.concat(F.lit(" Role "), F.col("source"), F.lit(" ")).alias("title"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("REF-"), F.col("doc_id").cast("string"))).alias("reference"),
        F.when(F.col("doc_id") % 5 != 0, _paragraphs(F.col("text"))).alias("description"),
        F.lit("<p> </p>").alias("qualifications"),
        F.when(F.col("doc_id") % 5 != 0, "<ul><li>one<li>two</ul>").alias("skills"),
        F.lit("").alias("conditions"),
    )
    key = F.lpad(F.lower(F.hex("doc_id")), 16, "0")
    api = F.concat(F.lit("https://item.example.org/api/Vacancy/"), key)
    return table(spark, folder, "documents").select(
        "doc_id", api.alias("api_url"), F.to_json(item).alias("body")
    )


_ITEM_BODY = f"""substr('Role ' || source || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'REF-' || doc_id ELSE '' END
      || CASE WHEN {sql_clean('text')} <> '' THEN chr(10) || chr(10) || 'Description' || chr(10) || {sql_clean('text')} ELSE '' END
      || chr(10) || chr(10) || 'Skills' || chr(10) || 'one' || chr(10) || 'two', 1, {C.MAX_DESCRIPTION_CHARS})"""


@query(
    "vacancy_item_texts",
    f"""SELECT 'https://item.example.org/api/Vacancy/' || lpad(printf('%x', doc_id), 16, '0') AS api_url,
               CASE WHEN doc_id % 5 = 0 THEN '' ELSE {_ITEM_BODY} END AS text FROM documents""",
)
def vacancy_item_texts(spark, folder):
    return item_texts(_item_payloads(spark, folder))


@query(
    "payload_joins",
    f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 5 = 0 THEN '' ELSE {_ITEM_BODY} END
               WHEN 1 THEN CASE WHEN doc_id % 10 = 7 THEN '' ELSE {_CAPPED} END
               WHEN 2 THEN substr({sql_clean(_VACANCY)}, 1, {C.MAX_DESCRIPTION_CHARS}) ELSE '' END AS payload_text
        FROM documents""",
)
def payload_joins(spark, folder):
    """Postings of three API families meet their landed payload by the derived address."""
    doc = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 4
    key = F.lpad(F.lower(F.hex("doc_id")), 16, "0")
    url = (
        F.when(kind == 0, F.concat(F.lit("https://item.example.org/vacancy/"), key, F.lit("/view")))
        .when(kind == 1, F.concat(F.lit("https://nested.example.org/en-us/External/job/"), doc, F.lit("/apply")))
        .when(kind == 2, F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/vacancies/"), doc))
        .otherwise(F.concat(F.lit("https://plain.example.org/"), doc))
    )
    rows = table(spark, folder, "documents").select(
        "doc_id",
        F.when(kind == 1, F.replace(url, F.lit("/en-us/External"), F.lit("/External/en-us"))).otherwise(url).alias("url"),
        (kind == 1).alias("is_detail_api"),
        (kind == 2).alias("is_vacancy_list"),
        (kind == 0).alias("is_vacancy_item"),
    )
    payloads = (
        _nested_payloads(spark, folder).drop("doc_id")
        .unionByName(_vacancy_payloads(spark, folder))
        .unionByName(_item_payloads(spark, folder).drop("doc_id"))
    )
    return with_payload_text(rows, payloads, ["doc_id"]).select("doc_id", "payload_text")


# --- registry -------------------------------------------------------------------------


def _registries(spark, folder):
    """Every supplier is a standard entry; some also have a browser entry under the same file name."""
    key = F.col("s_suppkey").cast("string")
    suppliers = table(spark, folder, "supplier")

    def entries(suffix: str):
        bracket = F.concat(F.lit("Supplier House "), key, F.lit(f"{suffix} [S"), key, F.lit("]"))
        bare = F.concat(F.lit("Plain"), key, F.lit(" house"))
        return suppliers.select(
            "s_suppkey",
            F.concat(F.lit("scrape_"), key, F.lit(".py")).alias("scraper_file"),
            F.when(F.col("s_suppkey") % 4 == 1, bare).otherwise(bracket).alias("org_name"),
            F.concat(F.lit("https://"), F.lower(F.lit(suffix)), F.lit("s"), key, F.lit(".example")).alias("listing_url"),
            F.col("s_suppkey").cast("int").alias("reg_pos"),
        )

    browser = entries("B").filter(F.col("s_suppkey") % 3 == 0)
    return entries("").drop("s_suppkey"), browser.drop("s_suppkey")


@query(
    "registry_entries",
    """SELECT 'scrape_' || s_suppkey || '.py' AS scraper_file, s_suppkey % 3 = 0 AS is_playwright,
              CASE WHEN s_suppkey % 4 = 1 THEN 'PLAIN' || s_suppkey ELSE 'S' || s_suppkey END AS org_abbrev,
              CASE WHEN s_suppkey % 3 = 0 THEN 'https://bs' ELSE 'https://s' END || s_suppkey || '.example' AS listing_url
       FROM supplier""",
)
def registry_entries(spark, folder):
    merged = merge_registries(*_registries(spark, folder))
    return merged.select("scraper_file", "is_playwright", "org_abbrev", "listing_url")


_ASKED = """asked AS (SELECT s_suppkey AS org_pos, CASE s_suppkey % 4 WHEN 0 THEN 'S' || s_suppkey
                      WHEN 1 THEN 'PLAIN' || s_suppkey || ' HOUSE' WHEN 2 THEN 'NONE' || s_suppkey
                      ELSE 'SUPPLIER HOUSE ' || s_suppkey || 'B [S' || s_suppkey || ']' END AS org FROM supplier)"""


def _asked(spark, folder):
    key = F.col("s_suppkey").cast("string")
    kind = F.col("s_suppkey") % 4
    org = (
        F.when(kind == 0, F.concat(F.lit(" s"), key))
        .when(kind == 1, F.concat(F.lit("Plain"), key, F.lit(" house ")))
        .when(kind == 2, F.concat(F.lit("none"), key))
        .otherwise(F.concat(F.lit("Supplier House "), key, F.lit("B [S"), key, F.lit("]")))
    )
    return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("org_pos"), org.alias("org"))


@query(
    "org_lookups",
    f"""WITH {_ASKED}
        SELECT org_pos, org, org_pos % 4 IN (0, 1) OR (org_pos % 4 = 3 AND org_pos % 3 = 0) AS is_known,
               CASE WHEN org_pos % 4 IN (0, 1) THEN 'https://s' || org_pos || '.example'
                    WHEN org_pos % 4 = 3 AND org_pos % 3 = 0 THEN 'https://bs' || org_pos || '.example' END AS listing_url
        FROM asked""",
)
def org_lookups(spark, folder):
    found = find_orgs(_asked(spark, folder), *_registries(spark, folder))
    return found.select("org_pos", "org", "is_known", "listing_url")


@query(
    "unknown_orgs",
    f"""WITH {_ASKED} SELECT org_pos, org FROM asked WHERE org_pos % 4 = 2 OR (org_pos % 4 = 3 AND org_pos % 3 <> 0)""",
)
def unknown_org_rows(spark, folder):
    return unknown_orgs(find_orgs(_asked(spark, folder), *_registries(spark, folder)))


@query(
    "all_orgs",
    "SELECT CASE WHEN s_suppkey % 4 = 1 THEN 'PLAIN' || s_suppkey ELSE 'S' || s_suppkey END AS org FROM supplier",
)
def all_org_rows(spark, folder):
    standard, browser = _registries(spark, folder)
    return all_orgs(standard.unionByName(browser))


# --- dedupe and reuse --------------------------------------------------------------------


@query(
    "deduped_listings",
    f"""WITH {LISTINGS_SQL}
        SELECT org_abbrev, url, arg_min(title, doc_id) AS title, min(doc_id) AS doc_id
        FROM (SELECT org_abbrev, doc_id, title, 'https://x.example/' || (doc_id // 20) % 7 AS url FROM listings
              WHERE url <> '' AND title <> '') l GROUP BY org_abbrev, url""",
)
def deduped_listings(spark, folder):
    rows = listings(spark, folder)
    shared = F.concat(F.lit(" https://x.example/"), (F.floor(F.col("doc_id") / 20) % 7).cast("string"), F.lit("\n"))
    rows = rows.withColumn("url", F.when(F.col("url") == "", " ").otherwise(shared))
    unique = dedupe_listings(rows, ["org_abbrev"], ["doc_id"])
    return unique.select("org_abbrev", "url", "title", "doc_id")


# Earlier state: even documents, each address twice; the row with the higher position counts.
PRIOR_SQL = f"""{RESULTS_SQL},
prior AS (SELECT org_abbrev, url, arg_max(enrich_status, p) AS prior_status, arg_max(version, p) AS prior_version
          FROM (SELECT *, job_index * 2 AS p, 'old' AS version FROM results WHERE doc_id % 2 = 0
                UNION ALL SELECT *, job_index * 2 + 1, 'new' FROM results WHERE doc_id % 6 = 0) r
          WHERE url <> '' AND enrich_status IN ('ok', 'pdf') GROUP BY org_abbrev, url)"""


def prior_state(spark, folder):
    """Earlier state rows in the state layout."""
    rows = postings(spark, folder)
    base = rows.select(
        "org_abbrev",
        F.concat(F.lit("Organisation "), F.col("org_abbrev")).alias("org_name"),
        (F.col("index") * 2).alias("index"),
        "doc_id",
        F.concat(F.lit("old: "), F.col("title")).alias("title"),
        "url",
        "content_type",
        "description",
        "pdf_path",
        F.lit("2025-12-01T00:00:00.000000+00:00").alias("enriched_at"),
        F.col("error").alias("enrich_error"),
        "enrich_status",
        "status_reason",
        "fetch_method",
        "fetch_seconds",
        F.create_map(F.lit("version"), F.lit("old")).alias("extras"),
    )
    again = base.filter(F.col("doc_id") % 6 == 0).withColumns(
        {"index": F.col("index") + 1, "extras": F.create_map(F.lit("version"), F.lit("new"))}
    )
    return base.filter(F.col("doc_id") % 2 == 0).unionByName(again).drop("doc_id")


def current_listings(spark, folder):
    """This run's listings: a fifth of the earlier ones is gone."""
    return listings(spark, folder).filter(F.col("doc_id") % 5 != 0)


@query(
    "reused_results",
    f"""WITH {PRIOR_SQL}
        SELECT l.doc_id, l.url, p.prior_status, p.prior_version, p.url IS NOT NULL AS is_cached
        FROM results l LEFT JOIN prior p USING (org_abbrev, url) WHERE l.doc_id % 5 <> 0""",
)
def reused_results(spark, folder):
    rows = with_prior(current_listings(spark, folder), prior_state(spark, folder))
    return rows.select(
        "doc_id",
        "url",
        F.col("prior.enrich_status").alias("prior_status"),
        F.col("prior.extras")["version"].alias("prior_version"),
        F.col("prior").isNotNull().alias("is_cached"),
    )


@query(
    "stored_reuse",
    f"""WITH {PRIOR_SQL},
        newest AS (SELECT * FROM prior WHERE org_abbrev <> 'SRC2'
                   UNION ALL SELECT org_abbrev, url, enrich_status, 'second' FROM results
                   WHERE org_abbrev = 'SRC2' AND doc_id % 3 = 0 AND url <> '' AND enrich_status IN ('ok', 'pdf'))
        SELECT l.doc_id, l.url, p.prior_status, p.prior_version, p.url IS NOT NULL AS is_cached
        FROM results l LEFT JOIN newest p USING (org_abbrev, url) WHERE l.doc_id % 5 <> 0""",
)
def stored_reuse(spark, folder):
    """Reuse from the bucketed index of two runs; one organisation was in both, and some of its addresses are gone."""
    home = scratch_path(spark, "reuse-index")
    first = prior_state(spark, folder)
    append_reuse(first, first.select("org_abbrev"), home)
    rows = postings(spark, folder).filter((F.col("org_abbrev") == "SRC2") & (F.col("doc_id") % 3 == 0))
    second = {"extras": F.create_map(F.lit("version"), F.lit("second"))}
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in STATE.fields if f.name not in rows.columns and f.name != "extras"]
    rows = rows.select("*", *blank).withColumns(second).select(*STATE.fieldNames())
    append_reuse(rows, spark.createDataFrame([("SRC2",)], "org_abbrev string"), home)
    found = with_stored_prior(current_listings(spark, folder), home)
    return found.select(
        "doc_id",
        "url",
        F.col("prior.enrich_status").alias("prior_status"),
        F.col("prior.extras")["version"].alias("prior_version"),
        F.col("prior").isNotNull().alias("is_cached"),
    )


@query(
    "work_list",
    f"""WITH {PRIOR_SQL}
        SELECT l.doc_id, l.url FROM results l WHERE l.doc_id % 5 <> 0
        AND NOT EXISTS (SELECT 1 FROM prior p WHERE p.org_abbrev = l.org_abbrev AND p.url = l.url)""",
)
def work_list_rows(spark, folder):
    return work_list(current_listings(spark, folder), prior_state(spark, folder)).select("doc_id", "url")


@query(
    "forced_work_list",
    f"WITH {LISTINGS_SQL} SELECT doc_id, url FROM listings",
)
def forced_work_list(spark, folder):
    rows = work_list(listings(spark, folder), prior_state(spark, folder), force=True)
    return rows.select("doc_id", "url")


# --- positions and breaker -------------------------------------------------------------------


@query("posting_index", f"WITH {LISTINGS_SQL} SELECT doc_id, org_abbrev, job_index, total_jobs FROM listings")
def posting_index(spark, folder):
    return listings(spark, folder).select("doc_id", "org_abbrev", "job_index", "total_jobs")


# abs() keeps this DuckDB version from a top-n rewrite that loses the upper() of the organisation.
@query(
    "first_postings",
    f"WITH {LISTINGS_SQL} SELECT doc_id, org_abbrev, job_index FROM listings WHERE abs(job_index) <= 7",
)
def first_postings(spark, folder):
    return first_n(listings(spark, folder), 7).select("doc_id", "org_abbrev", "job_index")


@query(
    "breaker_labels",
    f"""WITH {BREAKER_SQL}
        SELECT org_id, event_id, job_index, NOT is_cached AND open_at IS NOT NULL AND job_index > open_at AS is_skipped
        FROM attempts LEFT JOIN openings USING (org_id)""",
)
def breaker_labels(spark, folder):
    rows = attempts(spark, folder)
    labelled = with_breaker(
        rows, "org_id", "job_index", F.col("is_limited"), F.col("chunk"), F.col("is_cached")
    )
    return labelled.select("org_id", "event_id", "job_index", "is_skipped")


@query("breaker_openings", f"WITH {BREAKER_SQL} SELECT org_id, open_at FROM openings")
def breaker_openings(spark, folder):
    live = attempts(spark, folder).filter(~F.col("is_cached"))
    return opening_positions(live, "org_id", "job_index", F.col("is_limited"), F.col("chunk"))


# --- roll-ups ------------------------------------------------------------------------------------

REPORT_SQL = f"""{RESULTS_SQL}, {ORGS_SQL},
rolled AS (
  SELECT org_abbrev, CASE WHEN bool_or(enrich_status = 'ok') THEN 'ok' ELSE arg_min(enrich_status, job_index) END AS status,
         max(length(description)) AS longest,
         coalesce(arg_min(shown_error, job_index) FILTER (WHERE shown_error <> ''), '') AS first_error
  FROM results GROUP BY org_abbrev),
report AS (
  SELECT org_abbrev AS org, CASE WHEN scraper_error <> '' THEN 'error' ELSE 'ok' END AS scraper_status,
         CASE WHEN scraper_error <> '' THEN 'skipped' ELSE status END AS enrich_status,
         CASE WHEN scraper_error <> '' THEN 0 ELSE longest END AS desc_len, scraper_error,
         CASE WHEN scraper_error <> '' THEN '' ELSE first_error END AS enrich_error
  FROM orgs LEFT JOIN rolled USING (org_abbrev)
  UNION ALL SELECT 'EMPTY', 'empty', 'skipped', 0, '', '')"""


def report_orgs(rows):
    """The organisations of the rows and one without postings."""
    spark = rows.sparkSession
    extra = spark.createDataFrame(
        [("EMPTY", "Organisation EMPTY", "scrape_empty.py", False, "")], orgs_of(rows).schema
    )
    return orgs_of(rows).unionByName(extra)


@query("org_report", f"WITH {REPORT_SQL} SELECT * FROM report")
def org_report_rows(spark, folder):
    rows = postings(spark, folder)
    return org_report(report_orgs(table_orgs(spark, folder)), rows)


def table_orgs(spark, folder):
    return table(spark, folder, "documents").select(F.upper("source").alias("org_abbrev"))


@query(
    "report_lines",
    f"""WITH {REPORT_SQL}
        SELECT org, '| ' || org || ' | ' || scraper_status || ' | ' || enrich_status || ' | ' || desc_len || ' | '
               || substr(replace(CASE WHEN scraper_error <> '' THEN scraper_error ELSE enrich_error END, '|', '/'), 1, 120) || ' |' AS line
        FROM report""",
)
def report_lines(spark, folder):
    return table_lines(org_report_rows(spark, folder))


@query(
    "org_measures",
    f"""WITH {RESULTS_SQL}
        SELECT org_abbrev, count(*) AS job_count, bool_or(content_type = 'pdf' OR pdf_path <> '') AS has_pdf,
               count(*) FILTER (WHERE ok) AS successes, min({sql_words('description')}) FILTER (WHERE ok) AS least_words,
               max({sql_words('description')}) FILTER (WHERE ok) AS most_words
        FROM (SELECT *, {sql_strip('description')} <> '' AND enrich_status IN ('ok', 'short_content') AS ok FROM results) r
        GROUP BY org_abbrev""",
)
def org_measure_rows(spark, folder):
    return org_measures(postings(spark, folder)).drop("last_index")


@query(
    "job_counts",
    f"""SELECT upper(source) AS org_abbrev, count(*) AS job_count FROM documents GROUP BY source
        UNION ALL SELECT 'EMPTY', 0""",
)
def job_count_rows(spark, folder):
    orgs = report_orgs(table_orgs(spark, folder)).select("org_abbrev")
    return job_counts(orgs, postings(spark, folder))


@query(
    "state_headers",
    f"""SELECT 'Organisation ' || upper(source) AS org_name, upper(source) AS org_abbrev, '{NOW_TEXT}' AS enriched_at,
               count(*) FILTER (WHERE doc_id % 2 = 0) + count(*) FILTER (WHERE doc_id % 6 = 0) AS job_count
        FROM documents GROUP BY source""",
)
def state_header_rows(spark, folder):
    return state_headers(orgs_of(table_orgs(spark, folder)), prior_state(spark, folder), NOW_TEXT)


@query(
    "org_blocks",
    f"""WITH {RESULTS_SQL}
        SELECT org_abbrev, (job_index - 1) // 16 AS block, count(*) AS jobs,
               string_agg(job_index || ':' || url || ':' || enrich_status, ',' ORDER BY job_index) AS listed
        FROM results GROUP BY org_abbrev, block
        UNION ALL SELECT 'EMPTY', 0, 0, ''""",
)
def org_block_rows(spark, folder):
    blocks = org_blocks(report_orgs(table_orgs(spark, folder)), postings(spark, folder), rows=16)
    parts = F.transform(
        "jobs", lambda j: F.concat_ws(":", j["index"].cast("string"), j["url"], j["enrich_status"])
    )
    return blocks.select(
        "org_abbrev", "block", as_long(F.size("jobs")).alias("jobs"), F.array_join(parts, ",").alias("listed")
    )


@query(
    "flattened_blocks",
    f"""WITH {RESULTS_SQL}
        SELECT org_abbrev, job_index, url, enrich_status, shown_error AS error FROM results
        UNION ALL SELECT 'EMPTY', NULL, NULL, NULL, NULL""",
)
def flattened_blocks(spark, folder):
    blocks = org_blocks(report_orgs(table_orgs(spark, folder)), postings(spark, folder), rows=16)
    return flatten_blocks(blocks).select(
        "org_abbrev", F.col("index").alias("job_index"), "url", "enrich_status", "error"
    )


@query(
    "blocked_sources",
    f"""SELECT upper(source) AS org_abbrev, bool_or(doc_id % 50 = 8 OR doc_id % 60 = 9) AS is_blocked,
               CASE WHEN source IN ('src8', 'src10') THEN 0 ELSE count(*) END AS job_count,
               CASE WHEN source IN ('src8', 'src10') THEN 'empty' ELSE 'ok' END AS scraper_status
        FROM documents GROUP BY source""",
)
def blocked_source_rows(spark, folder):
    doc = F.col("doc_id")
    wall = F.when(doc % 50 == 8, "<p>Verify you are HUMAN</p>").otherwise("")
    pages = table(spark, folder, "documents").select(
        F.upper("source").alias("org_abbrev"),
        F.concat("text", wall).alias("html"),
        F.when(doc % 60 == 9, 403).alias("status_code"),
    )
    found = listings(spark, folder).filter(~F.col("org_abbrev").isin("SRC8", "SRC10"))
    return blocked_sources(pages, found)


_PATH = f"'ops/runs/{RUN_ID}/pdfs/' || org_abbrev || '/' || {sql_slug('title')} || '-{DAY}.pdf'"


@query(
    "pdf_manifest",
    f"""WITH {LISTINGS_SQL}
        SELECT org_abbrev, job_index, path, count(*) OVER (PARTITION BY path) AS same_path
        FROM (SELECT org_abbrev, job_index, {_PATH} AS path FROM listings) p""",
)
def pdf_manifest_rows(spark, folder):
    """Copies of a document in one source share their title and so their path."""
    return pdf_manifest(postings(spark, folder), RUN_ID, DAY).select(
        "org_abbrev", F.col("index").alias("job_index"), "path", "same_path"
    )
