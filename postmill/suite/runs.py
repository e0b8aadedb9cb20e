"""Whole runs: resolution, collection, enrichment, events, gates, artifacts and streams."""

from pyspark.sql import functions as F, types as T

from postmill import constants as C
from postmill.functions.text import iso_utc
from postmill.operators.positions import number_rows, range_chunks
from postmill.operators.rollup import flatten_blocks
from postmill.plans.artifact_check import bad_fields
from postmill.plans.collect import collect_outcomes, drop_failed, failed_orgs, org_rows, postings_of
from postmill.plans.crawl import crawl_plan
from postmill.plans.description import page_facts
from postmill.plans.enrich import enrich_outcomes, new_state
from postmill.plans.events import run_events
from postmill.plans.plugins import first_orgs
from postmill.plans.quality import rendered, violations
from postmill.plans.resolution import resolve, with_attempts, with_outcome
from postmill.schemas import EVENT, STATE
from postmill.session import scratch_path, settle
from postmill.sinks.artifacts import append_events, write_postings, write_state
from postmill.sinks.run import write_run
from postmill.sources.artifacts import read_org_blocks, read_state
from postmill.sources.gates import overrides_frame
from postmill.sources.rules import rules_frame
from postmill.streaming.breaker import OPENING, run_breaker, with_openings
from postmill.streaming.jobs import (
    append_stream, event_stream, late_listings, latest_counters, new_listings, org_counters, write_counters,
)
from postmill.suite.base import (
    BREAKER_SQL, DAY, NOW_TEXT, ORGS_SQL, RESULTS_SQL, RUN_ID, attempts, listings, now, orgs_of,
    outcomes_of, postings, query, sql_any, sql_clean, sql_error, sql_short, sql_slug, sql_strip, sql_words, table,
)
from postmill.suite.joins import PRIOR_SQL, _nested_payloads, current_listings, prior_state, report_orgs, table_orgs
from postmill.suite.links import BEST_SQL, FACTS_SQL, PIECES_SQL, _escaped, _paragraphs, built_pages, leaf_score

# --- resolution of listings against parsed pages --------------------------------------

_RESOLVE_LISTED = """
listed AS (SELECT org_abbrev, job_index, title, doc_id,
                  CASE WHEN url = '' THEN '' WHEN org_abbrev = 'SRC5' AND doc_id % 2 = 1 THEN url || '#row-3'
                       WHEN doc_id % 13 = 0 THEN url || '/x.PDF' ELSE url END AS url FROM results)"""
_PDF_FILE = f"'ops/runs/{RUN_ID}/pdfs/' || org_abbrev || '/' || {sql_slug('named')} || '-{DAY}.pdf'"

RESOLVED_SQL = f"""{RESULTS_SQL}, {BEST_SQL.strip()}, {FACTS_SQL.strip()}, {_RESOLVE_LISTED.strip()},
joined AS (
  SELECT l.*, CASE WHEN l.title = '' THEN 'job-' || l.job_index ELSE l.title END AS named,
         l.url LIKE '%#row-3' AS is_row, l.url LIKE '%.PDF' AS is_file, coalesce(f.description, '') AS body,
         coalesce(best.pdf_link, '') <> '' AND f.page_id IS NOT NULL AS has_link, l.org_abbrev IN ('SRC1', 'SRC2') AS prefers
  FROM listed l LEFT JOIN facts f ON f.page_id = l.doc_id AND l.url NOT LIKE '%#row-3' AND l.url NOT LIKE '%.PDF' AND l.url <> ''
  LEFT JOIN best ON best.page_id = l.doc_id),
resolved AS (
  SELECT *, CASE WHEN url = '' THEN 'no_detail_url' WHEN is_row OR is_file OR (has_link AND (prefers OR {sql_short('body')})) THEN 'pdf'
              WHEN {sql_short('body')} AND {sql_any('lower(body)', C.NEEDS_JS_MARKERS)} THEN 'js_required'
              WHEN {sql_short('body')} THEN 'short_content' ELSE 'ok' END AS enrich_status,
         CASE WHEN url = '' THEN 'missing_url' WHEN is_row THEN 'table_download_button' WHEN is_file THEN ''
              WHEN has_link AND prefers THEN 'embedded_pdf_preferred' WHEN has_link AND {sql_short('body')} THEN 'embedded_pdf'
              WHEN {sql_short('body')} AND {sql_any('lower(body)', C.NEEDS_JS_MARKERS)} THEN 'js_required'
              WHEN {sql_short('body')} THEN 'short_description' ELSE '' END AS status_reason
  FROM joined)"""


@query(
    "resolved_postings",
    f"""WITH {RESOLVED_SQL}
        SELECT doc_id, enrich_status, status_reason,
               CASE WHEN enrich_status = 'no_detail_url' THEN 'error' WHEN enrich_status = 'pdf' THEN 'pdf' ELSE 'html' END AS content_type,
               CASE WHEN enrich_status IN ('pdf', 'no_detail_url') THEN '' ELSE body END AS description,
               CASE WHEN enrich_status = 'pdf' THEN {_PDF_FILE} ELSE '' END AS pdf_path,
               CASE WHEN url = '' THEN 'none' WHEN is_row THEN 'playwright' ELSE 'http' END AS fetch_method
        FROM resolved""",
)
def resolved_postings(spark, folder):
    """Pages are parsed once, listings meet the facts of their page, the cascade picks the result."""
    rules = rules_frame(
        spark,
        {
            "browser_domains": ["src1.", "src4."],
            "prefer_pdf_orgs": ["SRC1", "SRC2"],
            "table_domains": ["src5."],
        },
    )
    facts = page_facts(built_pages(spark, folder), rules)
    rows = listings(spark, folder)
    url = F.col("url")
    moved = (
        F.when(url == "", "")
        .when((F.col("org_abbrev") == "SRC5") & (F.col("doc_id") % 2 == 1), F.concat(url, F.lit("#row-3")))
        .when(F.col("doc_id") % 13 == 0, F.concat(url, F.lit("/x.PDF")))
        .otherwise(url)
    )
    listed = rows.select("org_abbrev", "job_index", "title", moved.alias("url"), "doc_id")
    return resolve(listed, facts, rules, RUN_ID, DAY).select("doc_id", "res.*")


_WITH_HEAD = "('Main part' || chr(10) || text)"


@query(
    "description_sources",
    f"""WITH p AS (
          SELECT doc_id, doc_id % 4 AS kind, {sql_clean('text')} AS whole, {sql_clean(_WITH_HEAD)} AS main, {PIECES_SQL} AS pieces FROM documents),
        t AS (SELECT *, coalesce(array_to_string(pieces, chr(10)), '') AS legacy, length(whole) >= {C.MIN_LEAF_CHARS} AND {leaf_score('whole', False)} >= {C.MIN_LEAF_SCORE} AS is_leaf FROM p)
        SELECT doc_id AS page_id, substr(CASE WHEN kind = 0 AND doc_id % 10 <> 7 AND whole <> '' THEN whole WHEN kind = 1 AND is_leaf THEN whole
               WHEN kind = 2 AND legacy <> '' THEN legacy ELSE main END, 1, {C.MAX_DESCRIPTION_CHARS}) AS description FROM t""",
)
def description_sources(spark, folder):
    """Descriptions of pages of four kinds: a landed payload, application JSON, a percent-coded page, the article itself."""
    text, doc, kind = F.col("text"), F.col("doc_id").cast("string"), F.col("doc_id") % 4
    url = (
        F.when(kind == 0, F.concat(F.lit("https://nested.example.org/External/job/"), doc))
        .when(kind == 1, F.concat(F.lit("https://app.example.org/job/"), doc))
        .when(kind == 2, F.concat(F.lit("https://old.example.org/careersection/2/jobdetail.ftl?job="), doc))
        .otherwise(F.concat(F.lit("https://plain.example.org/job/"), doc))
    )
    data = F.to_json(F.struct(F.struct(_escaped(text).alias("body")).alias("props")))
    script = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script>"))
    page = F.concat(F.lit("<html><body>"), F.when(kind == 1, script).otherwise(""), F.lit("<article><p>Main part</p>"), _paragraphs(text), F.lit("</article></body></html>"))
    box = F.concat(F.lit('<div class="x singleview">'), _paragraphs(text), F.lit("</div>"))
    coded = F.concat(F.lit("<html><body>"), F.replace(F.url_encode(box), F.lit("+"), F.lit("%20")))
    pages = table(spark, folder, "documents").select(
        F.col("doc_id").alias("page_id"), url.alias("url"), F.when(kind == 2, coded).otherwise(page).alias("html"), F.lit("").alias("title")
    )
    rules = rules_frame(spark, {"detail_api_domains": ["nested."], "app_json_domains": ["app."]})
    payloads = _nested_payloads(spark, folder).drop("doc_id")
    return page_facts(pages, rules, payloads).select("page_id", "description")


_FIRST_ORGS = 17
_LOG_ERROR = """CASE WHEN org_abbrev = 'SRC4' AND job_index BETWEEN 4 AND 8 THEN '429 Too Many Requests'
              WHEN doc_id % 41 = 3 THEN '404 Client Error: Not Found' WHEN doc_id % 41 = 6 THEN 'fetch timed out after 30.0s' ELSE '' END"""

COMPOSED_SQL = f"""{RESOLVED_SQL},
chosen AS (SELECT DISTINCT org_abbrev FROM results ORDER BY org_abbrev LIMIT {_FIRST_ORGS}),
tried AS (
  SELECT r.*, {_LOG_ERROR} AS log_error, url <> '' AND {_LOG_ERROR} <> '' AS failed,
         url <> '' AND org_abbrev = 'SRC4' AND job_index BETWEEN 4 AND 8 AS limited
  FROM resolved r WHERE org_abbrev IN (SELECT org_abbrev FROM chosen) AND org_abbrev <> 'SRC12'),
runs_of AS (SELECT *, sum(CASE WHEN limited THEN 0 ELSE 1 END) OVER (PARTITION BY org_abbrev ORDER BY job_index) AS island FROM tried),
opening AS (SELECT org_abbrev, min(job_index) AS open_at FROM (
              SELECT *, count(*) FILTER (WHERE limited) OVER (PARTITION BY org_abbrev, island ORDER BY job_index) AS streak FROM runs_of) s
            WHERE streak >= {C.BREAKER_THRESHOLD} GROUP BY org_abbrev),
composed AS (
  SELECT t.*, coalesce(job_index > open_at, false) AS is_skipped FROM tried t LEFT JOIN opening USING (org_abbrev)),
posted AS (
  SELECT org_abbrev, job_index, title, url,
         CASE WHEN is_skipped OR failed OR url = '' THEN 'error' WHEN enrich_status = 'pdf' THEN 'pdf' ELSE 'html' END AS content_type,
         CASE WHEN is_skipped THEN 'blocked_source' WHEN failed THEN {sql_error('log_error', 0)} ELSE enrich_status END AS enrich_status,
         CASE WHEN is_skipped THEN 'org_rate_limited_skip' WHEN failed THEN {sql_error('log_error', 1)} ELSE status_reason END AS status_reason,
         CASE WHEN is_skipped OR failed THEN 'http' WHEN url = '' THEN 'none' WHEN is_row THEN 'playwright' ELSE 'http' END AS fetch_method,
         CASE WHEN is_skipped OR failed OR url = '' OR enrich_status = 'pdf' THEN '' ELSE body END AS description,
         CASE WHEN is_skipped OR failed OR enrich_status <> 'pdf' THEN '' ELSE {_PDF_FILE} END AS pdf_path,
         CASE WHEN is_skipped OR url = '' THEN 0.0 ELSE CAST((doc_id * 7) % 353 AS DOUBLE) / 10 END AS fetch_seconds,
         CASE WHEN failed AND NOT is_skipped THEN log_error ELSE '' END AS error
  FROM composed)"""


@query(
    "composed_run",
    f"""WITH {COMPOSED_SQL}
        SELECT org_abbrev, CASE WHEN org_abbrev = 'SRC12' THEN 'page 2: TimeoutError: gave up' ELSE '' END AS scraper_error, job_index AS position,
               title, url, content_type, enrich_status, status_reason, fetch_method, description, pdf_path, fetch_seconds, error
        FROM chosen LEFT JOIN posted USING (org_abbrev)""",
)
def composed_run(spark, folder):
    """A whole run: first organisations, one failed source, page facts, resolution, logged attempts, breaker, postings."""
    rules = rules_frame(
        spark, {"browser_domains": ["src1.", "src4."], "prefer_pdf_orgs": ["SRC1", "SRC2"], "table_domains": ["src5."]}
    )
    facts = page_facts(built_pages(spark, folder), rules)
    rows = listings(spark, folder)
    registry = first_orgs(rows.select("org_abbrev").distinct(), _FIRST_ORGS, "org_abbrev").select(
        "org_abbrev", F.col("org_abbrev").alias("org_name"), F.lit("f").alias("scraper_file"), F.lit(False).alias("is_playwright")
    )
    failures = spark.createDataFrame(
        [("SRC12", 3, "KeyError: later"), ("SRC12", 2, "TimeoutError: gave up")], "source_id string, page_no bigint, reason string"
    )
    orgs = org_rows(registry, failed_orgs(failures))
    doc, url = F.col("doc_id"), F.col("url")
    limited = (F.col("org_abbrev") == "SRC4") & F.col("job_index").between(4, 8)
    error = F.when(limited, "429 Too Many Requests").when(doc % 41 == 3, "404 Client Error: Not Found")
    log = rows.select(
        "org_abbrev", "job_index", "fetch_seconds", error.when(doc % 41 == 6, "fetch timed out after 30.0s").otherwise("").alias("error")
    )
    moved = (
        F.when(url == "", "")
        .when((F.col("org_abbrev") == "SRC5") & (doc % 2 == 1), F.concat(url, F.lit("#row-3")))
        .when(doc % 13 == 0, F.concat(url, F.lit("/x.PDF")))
        .otherwise(url)
    )
    listed = rows.select("org_abbrev", "job_index", "title", moved.alias("url"), F.lit("").alias("description"))
    listed = drop_failed(listed.join(orgs.select("org_abbrev"), "org_abbrev", "left_semi"), orgs)

    def read(todo):
        return with_outcome(resolve(with_attempts(todo.drop("description"), log), facts, rules, RUN_ID, DAY)).withColumn("description", F.lit(""))

    done = postings_of(collect_outcomes(listed, rules, read)).withColumnRenamed("index", "position")
    return orgs.select("org_abbrev", "scraper_error").join(done, "org_abbrev", "left")


# --- outcomes of logged attempts ---------------------------------------------------------

_EMPTY_CANDIDATES = "array<struct<pos:int,url:string,text:string,context:string>>"


@query(
    "fetch_outcomes",
    f"""WITH {RESULTS_SQL},
        shown AS (SELECT *, CASE WHEN org_abbrev NOT IN ('SRC5', 'SRC6') OR url = '' THEN ''
                                 WHEN doc_id % 3 = 0 THEN text || ' rendered' ELSE 'tiny' END AS rendered FROM results),
        bodies AS (SELECT *, CASE WHEN org_abbrev = 'SRC5' THEN rendered
                              WHEN org_abbrev = 'SRC6' AND length(rendered) > length(text) THEN rendered
                              ELSE CASE WHEN url = '' THEN '' ELSE text END END AS body,
                             url <> '' AND error <> '' AS failed,
                             url <> '' AND error <> '' AND org_abbrev = 'SRC5' AND length(rendered) > {C.MIN_RENDERED_CHARS} AS rescued
                   FROM shown)
        SELECT doc_id,
               CASE WHEN url = '' THEN 'no_detail_url' WHEN rescued THEN 'ok' WHEN failed THEN {sql_error('error', 0)}
                    WHEN {sql_short('body')} AND {sql_any('lower(body)', C.NEEDS_JS_MARKERS)} THEN 'js_required'
                    WHEN {sql_short('body')} THEN 'short_content' ELSE 'ok' END AS enrich_status,
               CASE WHEN url = '' THEN 'missing_url' WHEN rescued THEN 'playwright_fallback' WHEN failed THEN {sql_error('error', 1)}
                    WHEN {sql_short('body')} AND {sql_any('lower(body)', C.NEEDS_JS_MARKERS)} THEN 'js_required'
                    WHEN {sql_short('body')} THEN 'short_description' ELSE '' END AS status_reason,
               CASE WHEN url = '' THEN '' WHEN rescued THEN rendered WHEN failed THEN '' ELSE body END AS description,
               CASE WHEN url = '' THEN 0.0 WHEN rescued THEN 1.25 ELSE fetch_seconds END AS fetch_seconds,
               CASE WHEN failed AND NOT rescued THEN error ELSE '' END AS error
        FROM bodies""",
)
def fetch_outcomes(spark, folder):
    rows = listings(spark, folder).filter(F.col("url") != "")
    text = F.col("text")
    none = F.array().cast(_EMPTY_CANDIDATES).alias("pdf_candidates")
    facts = rows.select(
        F.col("doc_id").alias("page_id"), "url", text.alias("description"),
        (F.col("org_abbrev") == "SRC6").alias("needs_browser"), F.lit(False).alias("has_pdf_link"), none,
    )
    shown = F.when(F.col("doc_id") % 3 == 0, F.concat(text, F.lit(" rendered"))).otherwise("tiny")
    shown_rows = rows.filter(F.col("org_abbrev").isin("SRC5", "SRC6")).select("url", shown.alias("rendered_text"))
    listed = listings(spark, folder).select(
        "org_abbrev", "job_index", "title", "url", "doc_id", (F.col("org_abbrev") == "SRC5").alias("use_browser")
    )
    log = listings(spark, folder).select(
        "org_abbrev", "job_index", "error", "fetch_seconds", F.lit(1.25).alias("rendered_seconds")
    )
    tried = with_attempts(listed, log)
    done = with_outcome(resolve(tried, facts, rules_frame(spark, {}), RUN_ID, DAY, rendered=shown_rows))
    return done.select(
        "doc_id", "res.enrich_status", "res.status_reason", "res.description", "fetch_seconds", "error"
    )


# --- runs over the event log: one organisation per user ------------------------------------

_TRUSTED = ("U3", "U7", "U11")
_RUN_BASE_SQL = rf"""
run_rows AS (
  SELECT 'U' || user_id AS org_abbrev, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS job_index,
         count(*) OVER (PARTITION BY user_id) AS total_jobs, 'Event ' || event_id AS title,
         CASE WHEN event_id % 29 = 0 THEN '' ELSE 'https://u' || user_id || '.example.org/job/' || event_id END AS url,
         trim(repeat('word ', CAST(10 + event_id % 90 AS BIGINT))) AS text,
         CASE WHEN event_type = 'error' THEN '429 Too Many Requests' WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'Not Found'
              ELSE '' END AS err,
         CASE WHEN 'U' || user_id IN ('U3', 'U7', 'U11') THEN trim(repeat('detail ', CAST(event_id % 120 AS BIGINT))) ELSE '' END AS listed_text,
         CAST(event_id % 400 AS DOUBLE) / 10 AS took
  FROM events)"""
_JUDGED_SQL = f"""
judged AS (
  SELECT *, {sql_words('listed_text')} >= {C.MIN_WORDS} AND length(listed_text) >= {C.MIN_CHARS} AS has_detail,
         url <> '' AND err <> '' AS failed FROM ({{rows}}) r),
states AS (
  SELECT *, CASE WHEN is_cached THEN 'ok' WHEN has_detail THEN 'ok' WHEN url = '' THEN 'no_detail_url' WHEN failed THEN {sql_error('err', 0)}
              WHEN {sql_short('text')} THEN 'short_content' ELSE 'ok' END AS raw_status,
         CASE WHEN is_cached THEN 'earlier' WHEN has_detail THEN 'scraper_detail' WHEN url = '' THEN 'missing_url' WHEN failed THEN {sql_error('err', 1)}
              WHEN {sql_short('text')} THEN 'short_description' ELSE '' END AS raw_reason FROM judged),
islands AS (SELECT *, sum(CASE WHEN raw_reason = 'http_429' THEN 0 ELSE 1 END) OVER (PARTITION BY org_abbrev ORDER BY job_index) AS island
            FROM states WHERE NOT is_cached),
opened AS (SELECT org_abbrev, min(job_index) AS open_at FROM (
             SELECT *, count(*) FILTER (WHERE raw_reason = 'http_429') OVER (PARTITION BY org_abbrev, island ORDER BY job_index) AS streak
             FROM islands) s WHERE streak >= {C.BREAKER_THRESHOLD} GROUP BY org_abbrev),
done AS (
  SELECT s.*, open_at, NOT is_cached AND open_at IS NOT NULL AND job_index > open_at AS is_skipped FROM states s LEFT JOIN opened USING (org_abbrev)),
run_results AS (
  SELECT org_abbrev, 'Organisation ' || org_abbrev AS org_name, event_id, job_index, total_jobs, title, url, is_cached, is_skipped,
         NOT is_skipped AND NOT is_cached AND has_detail AS is_detail, coalesce(job_index = open_at, false) AS opens,
         CASE WHEN is_skipped THEN 'blocked_source' ELSE raw_status END AS enrich_status,
         CASE WHEN is_skipped THEN 'org_rate_limited_skip' ELSE raw_reason END AS status_reason,
         CASE WHEN is_skipped THEN 'error' WHEN is_cached OR has_detail THEN 'html' WHEN url = '' OR failed THEN 'error' ELSE 'html' END AS content_type,
         CASE WHEN is_skipped THEN '' WHEN is_cached THEN 'old text' WHEN has_detail THEN listed_text WHEN url = '' OR failed THEN '' ELSE text END AS description,
         CASE WHEN is_skipped THEN 'http' WHEN is_cached THEN 'http' WHEN has_detail THEN 'scraper' WHEN url = '' THEN 'none' ELSE 'http' END AS fetch_method,
         CASE WHEN is_skipped OR is_cached OR has_detail OR url = '' THEN 0.0 ELSE took END AS fetch_seconds,
         CASE WHEN is_skipped OR is_cached OR has_detail OR NOT failed THEN '' ELSE err END AS error, listed_text
  FROM done)"""
COLLECT_SQL = f"{_RUN_BASE_SQL}, {_JUDGED_SQL.format(rows='SELECT *, false AS is_cached FROM run_rows').strip()}"
ENRICH_SQL = f"""{_RUN_BASE_SQL}, {_JUDGED_SQL.format(rows="SELECT *, url <> '' AND event_id % 6 = 0 AS is_cached FROM run_rows").strip()}"""


def run_listings(spark, folder):
    """Numbered listings with the text and the failure their page would give."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    ranged = range_chunks(events, "user_id", ["ts", "event_id"])
    rows = number_rows(ranged, "user_id", ["ts", "event_id"], F.col("chunk"), total="total_jobs")
    event, user = F.col("event_id"), F.col("user_id").cast("string")
    org = F.concat(F.lit("U"), user)
    words = F.rtrim(F.repeat(F.lit("word "), (event % 90 + 10).cast("int")))
    detail = F.rtrim(F.repeat(F.lit("detail "), (event % 120).cast("int")))
    url = F.concat(F.lit("https://u"), user, F.lit(".example.org/job/"), event.cast("string"))
    failure = F.when(F.col("event_type") == "error", "429 Too Many Requests").when(
        (F.col("event_type") == "click") & (event % 5 == 0), "Not Found"
    )
    return rows.select(
        org.alias("org_abbrev"),
        F.concat(F.lit("Organisation "), org).alias("org_name"),
        "event_id",
        "job_index",
        "total_jobs",
        "chunk",
        F.concat(F.lit("Event "), event.cast("string")).alias("title"),
        F.when(event % 29 == 0, "").otherwise(url).alias("url"),
        F.when(org.isin(*_TRUSTED), detail).otherwise("").alias("description"),
        words.alias("text"),
        failure.otherwise("").alias("error"),
        ((event % 400).cast("double") / 10).alias("fetch_seconds"),
        F.lit(False).alias("is_pdf"),
        event.alias("doc_id"),
    )


def _trust(spark):
    return rules_frame(spark, {"trusted_detail_orgs": list(_TRUSTED)})


def collected(spark, folder):
    return collect_outcomes(run_listings(spark, folder), _trust(spark), outcomes_of, chunk=F.col("chunk"))


_POSTING_SQL = """org_abbrev, job_index AS position, title, url, content_type, enrich_status, status_reason, fetch_method, description,
        '' AS pdf_path, fetch_seconds, error"""


@query("collected_postings", f"WITH {COLLECT_SQL} SELECT {_POSTING_SQL} FROM run_results")
def collected_postings(spark, folder):
    return postings_of(collected(spark, folder)).withColumnRenamed("index", "position")


_JOB_EVENTS_SQL = """
job_events AS (
  SELECT org_abbrev, org_name, job_index AS seq, 0 AS step, 'job_start' AS event, job_index, total_jobs, title AS job_title, url AS job_url,
         NULL AS duration_seconds, NULL AS enrich_status, NULL AS word_count, NULL AS status_reason, NULL AS error, NULL AS consecutive_429,
         NULL AS job_count FROM run_results WHERE NOT is_cached AND NOT is_skipped AND NOT is_detail
  UNION ALL
  SELECT org_abbrev, org_name, job_index, 1, CASE WHEN error <> '' THEN 'job_error' ELSE 'job_result' END, job_index, NULL, title, url,
         fetch_seconds, enrich_status, {words}, CASE WHEN is_cached THEN 'cached' ELSE status_reason END, error, NULL, NULL FROM run_results
  UNION ALL
  SELECT org_abbrev, org_name, job_index, 2, 'org_rate_limited', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(3 AS BIGINT), NULL
  FROM run_results WHERE opens
  UNION ALL
  SELECT org_abbrev, org_name, -1, 0, 'org_start', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM run_results GROUP BY ALL
  UNION ALL
  SELECT org_abbrev, org_name, -1, 1, 'scraper_done', NULL, NULL, NULL, NULL, 0.0, NULL, NULL, NULL, NULL, NULL, count(*) FROM run_results GROUP BY org_abbrev, org_name
  UNION ALL
  SELECT org_abbrev, org_name, 4611686018427387904, 9, 'org_done', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*)
  FROM run_results GROUP BY org_abbrev, org_name)""".replace("{words}", sql_words("description"))
_EVENT_COLUMNS = (
    "org_abbrev, org_name, seq, step, event, job_index, total_jobs, job_title, job_url, duration_seconds, enrich_status, "
    "word_count, status_reason, error, consecutive_429, job_count"
)


def run_orgs(rows):
    orgs = rows.select("org_abbrev", "org_name").distinct()
    return orgs.withColumns({"scraper_file": F.lit("scrape.py"), "scraper_error": F.lit("")})


@query(
    "run_events",
    f"WITH {COLLECT_SQL}, {_JOB_EVENTS_SQL.strip()} SELECT {_EVENT_COLUMNS}, '{RUN_ID}' AS run_id, '{NOW_TEXT}' AS ts_utc FROM job_events",
)
def run_event_rows(spark, folder):
    done = collected(spark, folder)
    events = run_events(run_orgs(done), done, RUN_ID, now())
    return events.select(*_EVENT_COLUMNS.split(", "), "run_id", "ts_utc")


_LINE = "event, org_abbrev, job_index, job_title, enrich_status, word_count, error"


@query(
    "event_log",
    f"""WITH {COLLECT_SQL}, {_JOB_EVENTS_SQL.strip()}
        SELECT {_LINE}, row_number() OVER (ORDER BY org_abbrev, seq, step) AS line FROM job_events""",
)
def event_log(spark, folder):
    """Events appended as JSON lines and read back in the order of files and lines."""
    done = collected(spark, folder)
    runs = scratch_path(spark, "runs")
    path = append_events(run_events(run_orgs(done), done, RUN_ID, now()), runs, RUN_ID, lines=5_000)
    log = spark.read.schema(EVENT).json(path).select(
        *_LINE.split(", "), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    # files in order of their names; a file is a part of the log, so no task numbers the whole of it
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    lines = number_rows(log.withColumn("log", F.lit(0)), "log", ["at"], part, index="line")
    return lines.select(*_LINE.split(", "), "line")


def run_prior(rows):
    """Earlier state: every third listing, half of them finished."""
    done = F.col("event_id") % 6 == 0
    return rows.filter(F.col("event_id") % 3 == 0).select(
        "org_name",
        "org_abbrev",
        F.col("job_index").alias("index"),
        F.concat(F.lit("old "), F.col("title")).alias("title"),
        "url",
        F.lit("html").alias("content_type"),
        F.lit("old text").alias("description"),
        F.lit("").alias("pdf_path"),
        F.lit("2025-12-01T00:00:00.000000+00:00").alias("enriched_at"),
        F.when(done, "").otherwise("broken").alias("enrich_error"),
        F.when(done, "ok").otherwise("error").alias("enrich_status"),
        F.lit("earlier").alias("status_reason"),
        F.lit("http").alias("fetch_method"),
        F.lit(7.5).alias("fetch_seconds"),
        F.create_map(F.lit("kept"), F.lit("yes")).alias("extras"),
    ).select(*STATE.fieldNames())


def enriched(spark, folder):
    rows = run_listings(spark, folder)
    return enrich_outcomes(rows, run_prior(rows), _trust(spark), outcomes_of, chunk=F.col("chunk"))


_STATE_SQL = f"""
state AS (
  SELECT org_abbrev, org_name, job_index AS position, CASE WHEN is_cached THEN 'old ' || title ELSE title END AS title, url,
         CASE WHEN error <> '' THEN 'error' ELSE content_type END AS content_type,
         CASE WHEN error <> '' THEN listed_text ELSE description END AS description, '' AS pdf_path,
         CASE WHEN is_cached THEN '2025-12-01T00:00:00.000000+00:00' ELSE '{NOW_TEXT}' END AS enriched_at, error AS enrich_error,
         enrich_status, status_reason, fetch_method, CASE WHEN is_cached THEN 7.5 ELSE fetch_seconds END AS fetch_seconds,
         CASE WHEN is_cached THEN 'yes' END AS kept
  FROM run_results)"""


@query("enriched_state", f"WITH {ENRICH_SQL}, {_STATE_SQL.strip()} SELECT * FROM state")
def enriched_state(spark, folder):
    state = new_state(enriched(spark, folder), now())
    kept = state.withColumn("kept", F.col("extras")["kept"]).drop("extras")
    return kept.withColumnRenamed("index", "position")


@query(
    "stored_state",
    f"""WITH {ENRICH_SQL}, {_STATE_SQL.strip()} SELECT * FROM state
        UNION ALL SELECT 'GONE', NULL, 1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ok', NULL, NULL, NULL, NULL""",
)
def stored_state(spark, folder):
    """Write the state beside the earlier snapshot, keep an organisation that was not in the run, empty one that was."""
    home = scratch_path(spark, "state")
    rows = run_listings(spark, folder)
    apart = spark.createDataFrame([("GONE",), ("EMPTIED",)], "org_abbrev string")
    apart = apart.select(
        *[
            F.col("org_abbrev")
            if f.name == "org_abbrev"
            else F.lit({"enrich_status": "ok", "index": 1}.get(f.name)).cast(f.dataType).alias(f.name)
            for f in STATE.fields
        ]
    )
    first = run_prior(rows).unionByName(apart)
    write_state(first, home, first.select("org_abbrev"))
    done = enrich_outcomes(rows, read_state(spark, home), _trust(spark), outcomes_of, chunk=F.col("chunk"))
    ran = rows.select("org_abbrev").union(apart.select("org_abbrev").where("org_abbrev = 'EMPTIED'"))
    write_state(new_state(done, now()), home, ran)
    kept = read_state(spark, home).withColumn("kept", F.col("extras")["kept"]).drop("extras")
    return kept.withColumnRenamed("index", "position")


# --- quality gates ---------------------------------------------------------------------------

_GATES = {
    "defaults": {"min_words": 50, "max_words": 10_000, "max_fetch_seconds_per_job": 30.0},
    "org_overrides": {
        "SRC2": {"min_words": 10, "expires_on": "2025-12-31", "reason": "Known outage"},
        "SRC4": {"max_words": 60, "expires_on": "someday"},
        "SRC6": {"min_jobs_per_org": 1_000_000, "max_fetch_seconds_per_job": 5},
        "SRC8": {"allow_empty": True, "min_jobs_per_org": 1_000_000, "expires_on": "2027-01-01"},
    },
}
_SAME = "trim(repeat('word ', 60))"
VIOLATIONS_SQL = f"""{RESULTS_SQL}, {ORGS_SQL.strip()},
org_list AS (SELECT org_abbrev, scraper_error FROM orgs UNION ALL SELECT 'EMPTY', ''),
gates AS (
  SELECT org_abbrev, scraper_error, CASE org_abbrev WHEN 'SRC2' THEN 10 ELSE 50 END AS low, CASE org_abbrev WHEN 'SRC4' THEN 60 ELSE 10000 END AS high,
         CASE org_abbrev WHEN 'SRC6' THEN 5.0 ELSE 30.0 END AS cap, CASE WHEN org_abbrev IN ('SRC6', 'SRC8') THEN 1000000 ELSE 1 END AS min_jobs,
         org_abbrev = 'SRC8' AS allow_empty FROM org_list),
jobs AS (
  SELECT *, {sql_words('body')} AS words, {sql_strip('body')} <> '' AND enrich_status IN ('ok', 'short_content') AS ok
  FROM (SELECT *, CASE WHEN org_abbrev = 'SRC13' AND description <> '' THEN {_SAME} ELSE description END AS body FROM results) r),
sums AS (SELECT org_abbrev, count(*) AS n, bool_or(content_type = 'pdf' OR pdf_path <> '') AS has_pdf, count(*) FILTER (WHERE ok) AS good,
                min(words) FILTER (WHERE ok) AS least, max(words) FILTER (WHERE ok) AS most FROM jobs GROUP BY org_abbrev),
org_gates AS (SELECT g.*, coalesce(n, 0) AS n, coalesce(has_pdf, false) AS has_pdf, good, least, most FROM gates g LEFT JOIN sums USING (org_abbrev)),
found AS (
  SELECT org_abbrev, 'scraper_error' AS rule, 1 AS rule_seq, NULL AS job_index, org_abbrev || ': scraper_error present: ' || scraper_error AS message
  FROM org_gates WHERE scraper_error <> ''
  UNION ALL SELECT 'SRC2', 'override_expired', 2, NULL, 'SRC2: override expired on 2025-12-31 (reason=Known outage)'
  UNION ALL SELECT 'SRC4', 'override_invalid', 2, NULL, 'SRC4: invalid override expires_on ''someday'''
  UNION ALL SELECT org_abbrev, 'too_few_jobs', 3, NULL, org_abbrev || ': returned ' || n || ' jobs (< ' || min_jobs || ')' FROM org_gates
  WHERE n < min_jobs AND NOT allow_empty
  UNION ALL SELECT org_abbrev, 'identical_length', 4, NULL,
         org_abbrev || ': all successful descriptions share identical length (' || least || ' words)' FROM org_gates
  WHERE NOT has_pdf AND n > 2 AND good >= 3 AND least = most
  UNION ALL SELECT j.org_abbrev, 'word_bounds', 5, job_index, j.org_abbrev || ': job #' || job_index || ' word_count=' || words
         || ' out of bounds [' || low || ', ' || high || '] url=' || url FROM jobs j JOIN org_gates g USING (org_abbrev)
  WHERE ok AND NOT g.has_pdf AND (words < low OR words > high)
  UNION ALL SELECT j.org_abbrev, 'fetch_seconds', 6, job_index, j.org_abbrev || ': job #' || job_index || ' fetch_seconds='
         || printf('%.3f', CAST(seconds AS DOUBLE)) || ' > ' || printf('%.3f', CAST(cap AS DOUBLE)) || ' url=' || url FROM jobs j JOIN org_gates g USING (org_abbrev)
  WHERE url <> '' AND seconds > cap)"""


def _gated(spark, folder):
    """Organisations and postings that the gates judge; one organisation's texts all have the same length."""
    same = F.rtrim(F.repeat(F.lit("word "), F.lit(60)))
    fixed = (F.col("org_abbrev") == "SRC13") & (F.col("description") != "")
    rows = postings(spark, folder).withColumn("description", F.when(fixed, same).otherwise(F.col("description")))
    return report_orgs(table_orgs(spark, folder)), rows


def found_violations(spark, folder):
    orgs, rows = _gated(spark, folder)
    today = F.to_date(F.lit("2026-02-13"))
    return violations(orgs, rows, overrides_frame(spark, _GATES), _GATES["defaults"], today)


@query("quality_violations", f"WITH {VIOLATIONS_SQL} SELECT org_abbrev, rule, rule_seq, job_index, message FROM found")
def quality_violations(spark, folder):
    return found_violations(spark, folder)


@query("violation_lines", f"WITH {VIOLATIONS_SQL} SELECT '- ' || message AS line FROM found")
def violation_lines(spark, folder):
    return rendered(found_violations(spark, folder))


@query(
    "run_outputs",
    f"""WITH {VIOLATIONS_SQL},
        first_errors AS (
          SELECT org_abbrev, CASE WHEN bool_or(enrich_status = 'ok') THEN 'ok' ELSE arg_min(enrich_status, job_index) END AS status,
                 max(length(body)) AS longest, coalesce(arg_min(shown_error, job_index) FILTER (WHERE shown_error <> ''), '') AS first_error
          FROM jobs GROUP BY org_abbrev),
        lines AS (
          SELECT '| ' || org_abbrev || ' | ' || CASE WHEN scraper_error <> '' THEN 'error | skipped | 0' WHEN longest IS NULL THEN 'empty | skipped | 0'
                   ELSE 'ok | ' || status || ' | ' || longest END || ' | '
                 || substr(replace(CASE WHEN scraper_error <> '' THEN scraper_error ELSE coalesce(first_error, '') END, '|', '/'), 1, 120) || ' |' AS line
          FROM org_list LEFT JOIN first_errors USING (org_abbrev)),
        totals AS (
          SELECT count(*) AS jobs, count(*) FILTER (WHERE enrich_status = 'ok') AS ok_jobs, count(*) FILTER (WHERE content_type = 'pdf') AS pdf_jobs,
                 count(*) FILTER (WHERE shown_error <> '') AS failed_jobs, sum(length(body)) AS description_chars, max(seconds) AS slowest_seconds FROM jobs)
        SELECT 'line' AS part, line, NULL::DOUBLE AS value FROM lines
        UNION ALL SELECT 'jobs', NULL, jobs FROM totals UNION ALL SELECT 'ok_jobs', NULL, ok_jobs FROM totals
        UNION ALL SELECT 'pdf_jobs', NULL, pdf_jobs FROM totals UNION ALL SELECT 'failed_jobs', NULL, failed_jobs FROM totals
        UNION ALL SELECT 'description_chars', NULL, description_chars FROM totals UNION ALL SELECT 'slowest_seconds', NULL, slowest_seconds FROM totals
        UNION ALL SELECT 'violations', NULL, count(*) FROM found UNION ALL SELECT 'exit_code', NULL, CAST(count(*) > 0 AS INT) FROM found""",
)
def run_outputs(spark, folder):
    """A run's postings, violations and report written, totals gathered on the way; the report's table read back."""
    orgs, rows = _gated(spark, folder)
    runs = scratch_path(spark, "runs")
    today = F.to_date(F.lit("2026-02-13"))

    def check(orgs, written):
        return violations(orgs, written, overrides_frame(spark, _GATES), _GATES["defaults"], today)

    totals = write_run(orgs, rows, runs, RUN_ID, ["SRC1", "EMPTY"], NOW_TEXT, check)
    lines = spark.read.text(f"{runs}/{RUN_ID}/report.md").filter("value like '| %' and value not like '| Org |%' and value not like '| ---%'")
    given = spark.createDataFrame([(name, float(value)) for name, value in totals.items()], "part string, value double")
    shown = lines.select(F.lit("line").alias("part"), F.col("value").alias("line"), F.lit(None).cast("double").alias("value"))
    return shown.unionByName(given.withColumn("line", F.lit(None).cast("string")))


@query(
    "gates_without_orgs",
    "SELECT 'payload' AS rule, 'payload: missing non-empty ''orgs'' list' AS message FROM (SELECT 1 FROM documents LIMIT 1) d",
)
def gates_without_orgs(spark, folder):
    orgs = orgs_of(table_orgs(spark, folder).filter(F.col("org_abbrev") == ""))
    rows = postings(spark, folder).filter(F.col("org_abbrev") == "")
    found = violations(orgs, rows, overrides_frame(spark, _GATES), _GATES["defaults"], F.to_date(F.lit("2026-02-13")))
    return found.select("rule", "message")


# --- artifacts ---------------------------------------------------------------------------------


@query(
    "artifact_round_trip",
    f"""WITH {RESULTS_SQL}
        SELECT org_abbrev, job_index, title, url, enrich_status, description, seconds AS fetch_seconds, shown_error AS error FROM results
        UNION ALL SELECT 'EMPTY', NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
)
def artifact_round_trip(spark, folder):
    runs = scratch_path(spark, "runs")
    write_postings(report_orgs(table_orgs(spark, folder)), postings(spark, folder), runs, RUN_ID, rows=16)
    rows = flatten_blocks(read_org_blocks(spark, runs, RUN_ID))
    return rows.select(
        "org_abbrev", F.col("index").alias("job_index"), "title", "url", "enrich_status", "description",
        "fetch_seconds", "error",
    )


@query(
    "artifact_faults",
    """SELECT upper(source) || '-' || doc_id AS org_abbrev, 0 AS job_pos, 'index' AS field, 'STRING' AS found FROM documents WHERE doc_id % 5 = 0
       UNION ALL SELECT upper(source) || '-' || doc_id, 0, 'fetch_seconds', 'NULL' FROM documents WHERE doc_id % 7 = 0
       UNION ALL SELECT upper(source) || '-' || doc_id, 0, 'title', 'MISSING' FROM documents WHERE doc_id % 11 = 0
       UNION ALL SELECT upper(source) || '-' || doc_id, NULL, 'is_playwright_scraper', 'STRING' FROM documents WHERE doc_id % 3 = 0
       UNION ALL SELECT upper(source) || '-' || doc_id, NULL, 'jobs', 'OBJECT' FROM documents WHERE doc_id % 13 = 0
       EXCEPT SELECT upper(source) || '-' || doc_id, 0, f, k FROM documents, (VALUES ('index', 'STRING'), ('fetch_seconds', 'NULL'), ('title', 'MISSING')) x (f, k)
       WHERE doc_id % 13 = 0""",
)
def artifact_faults(spark, folder):
    doc = F.col("doc_id")
    text = F.to_json(F.struct(F.col("text").alias("t")))
    quoted_text = F.substring(text, F.lit(6), F.length(text) - 6)
    number = doc.cast("string")
    index = F.when(doc % 5 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    seconds = F.when(doc % 7 == 0, "null").when(doc % 2 == 0, "3").otherwise("3.25")
    title = F.when(doc % 11 == 0, "").otherwise('"title": "t", ')
    job = F.concat(
        F.lit('{"index": '), index, F.lit(", "), title,
        F.lit('"url": "", "content_type": "html", "enrich_status": "ok", "status_reason": "", "description": '),
        quoted_text, F.lit(', "pdf_path": "", "fetch_seconds": '), seconds, F.lit(', "error": ""}'),
    )
    flag = F.when(doc % 3 == 0, '"no"').otherwise("false")
    jobs = F.when(doc % 13 == 0, job).otherwise(F.concat(F.lit("["), job, F.lit("]")))
    org = F.concat(F.upper("source"), F.lit("-"), number)
    line = F.concat(
        F.lit('{"org_abbrev": "'), org, F.lit('", "org_name": "n", "scraper_file": "f", "scraper_error": "", '),
        F.lit('"is_playwright_scraper": '), flag, F.lit(', "jobs": '), jobs, F.lit("}"),
    )
    return bad_fields(table(spark, folder, "documents").select(line.alias("value")))


# --- crawl plan ------------------------------------------------------------------------------------


@query(
    "crawl_plan",
    f"""WITH {PRIOR_SQL}
        SELECT l.org_abbrev, l.job_index, l.url, 'html' AS kind, l.org_abbrev <> 'SRC1' AS verify_tls,
               l.org_abbrev IN ('SRC2', 'SRC5') AS needs_browser,
               CASE WHEN l.error = '' THEN 0.0 WHEN {sql_error('l.error', 1)} = 'http_429' THEN 90.0 ELSE pow(2.0, l.doc_id % 3) END AS delay_seconds
        FROM results l WHERE l.doc_id % 5 <> 0 AND l.url <> '' AND (l.error = '' OR l.doc_id % 3 < 2)
        AND NOT EXISTS (SELECT 1 FROM prior p WHERE p.org_abbrev = l.org_abbrev AND p.url = l.url)""",
)
def crawl_plan_rows(spark, folder):
    rules = rules_frame(
        spark,
        {
            "tls_exempt_domains": ["src1.example.org"],
            "browser_domains": ["src2."],
            "browser_orgs": ["SRC5"],
        },
    )
    rows = current_listings(spark, folder)
    failures = rows.filter(F.col("error") != "").select(
        "org_abbrev",
        "job_index",
        (F.col("doc_id") % 3).cast("int").alias("attempt"),
        F.when(F.col("error").startswith("429"), 429).otherwise(500).alias("status_code"),
        F.lit("90").alias("retry_after"),
    )
    listed = rows.select("org_abbrev", "job_index", "url")
    return crawl_plan(listed, prior_state(spark, folder), rules, now(), failures)


# --- streams ----------------------------------------------------------------------------------------


def _event_schema():
    return T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    )


def _log_rows(raw):
    """The event table in the layout of the run log."""
    given = {
        "event": F.when(F.col("event_type") == "error", "job_error").when(F.col("event_type") == "signup", "job_start").otherwise("job_result"),
        "ts_utc": iso_utc(F.col("ts").cast("timestamp")),
        "run_id": F.lit(RUN_ID),
        "org_abbrev": F.concat(F.lit("U"), F.col("user_id").cast("string")),
        "job_index": F.col("event_id"),
        "enrich_status": F.when(F.col("event_type") == "error", "blocked_source").otherwise("ok"),
        "word_count": F.col("event_id") % 100,
        "duration_seconds": (F.col("event_id") % 400).cast("double") / 8,
    }
    return raw.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields]
    )


def _raw_stream(spark, folder):
    return spark.readStream.schema(_event_schema()).option("pathGlobFilter", "events.parquet").parquet(folder)


@query(
    "streamed_counters",
    """SELECT 'U' || user_id AS org_abbrev, CASE WHEN event_type = 'error' THEN 'blocked_source' ELSE 'ok' END AS enrich_status,
              count(*) AS jobs, CAST(sum(event_id % 100) AS BIGINT) AS words, round(sum(CAST(event_id % 400 AS DOUBLE) / 8), 3) AS seconds
       FROM events WHERE event_type <> 'signup' GROUP BY ALL""",
)
def streamed_counters(spark, folder):
    """The log lands in five portions; two of the counters' batches are folded into a whole table on the way."""
    home = scratch_path(spark, "counters")
    rows = table(spark, folder, "events")
    for portion in range(5):
        rows.filter(F.col("event_id") % 5 == portion).write.mode("append").parquet(f"{home}/in")
        raw = spark.readStream.schema(_event_schema()).parquet(f"{home}/in")
        write_counters(org_counters(_log_rows(raw)), f"{home}/out", f"{home}/checkpoint", keep=2)
    return latest_counters(spark, f"{home}/out")


@query(
    "streamed_event_log",
    """SELECT CASE event_type WHEN 'error' THEN 'job_error' WHEN 'signup' THEN 'job_start' ELSE 'job_result' END AS event,
              'U' || user_id AS org_abbrev, count(*) AS lines, min(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')) AS first_at
       FROM events GROUP BY ALL""",
)
def streamed_event_log(spark, folder):
    """The log goes through JSON lines and a second stream before it is read."""
    home = scratch_path(spark, "log")
    append_stream(_log_rows(_raw_stream(spark, folder)), f"{home}/json", f"{home}/c1", "json")
    append_stream(event_stream(spark, f"{home}/json"), f"{home}/parquet", f"{home}/c2")
    rows = spark.read.schema(EVENT).parquet(f"{home}/parquet")
    return rows.groupBy("event", "org_abbrev").agg(
        F.count(F.lit(1)).alias("lines"), F.min("ts_utc").alias("first_at")
    )


@query(
    "streamed_breaker",
    f"""WITH {BREAKER_SQL}
        SELECT CAST(org_id AS VARCHAR) AS org_abbrev, event_id, NOT is_cached AND open_at IS NOT NULL AND job_index > open_at AS is_skipped
        FROM attempts LEFT JOIN openings USING (org_id)""",
)
def streamed_breaker(spark, folder):
    """Attempts land in three portions; the breaker carries its state from one to the next."""
    home = scratch_path(spark, "breaker")
    rows = attempts(spark, folder).select(
        F.col("org_id").cast("string").alias("org_abbrev"), "event_id", "job_index", "is_limited", "is_cached"
    )
    rows = settle(rows, "attempts")  # numbered once, not for each portion
    for portion in range(3):
        part = F.least(F.floor((F.col("job_index") - 1) / 20), F.lit(2)) == portion
        rows.filter(part).write.mode("append").parquet(f"{home}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        run_breaker(stream, f"{home}/out", f"{home}/checkpoint")
    openings = spark.read.schema(OPENING).parquet(f"{home}/out")
    landed = spark.read.parquet(f"{home}/in")
    return with_openings(landed, openings).select("org_abbrev", "event_id", "is_skipped")


@query(
    "streamed_listings",
    """SELECT DISTINCT 'U' || user_id AS org_abbrev, 'https://x.example/' || event_id % 500 AS url FROM events
       WHERE NOT (event_id % 500 % 3 = 0)""",
)
def streamed_listings(spark, folder):
    home = scratch_path(spark, "fresh")
    url = F.concat(F.lit("https://x.example/"), (F.col("event_id") % 500).cast("string"))
    org = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    stream = _raw_stream(spark, folder).select(
        org.alias("org_abbrev"), F.concat(F.lit(" "), url).alias("url"), F.col("event_id").alias("job_index"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    prior = table(spark, folder, "events").filter(F.col("event_id") % 500 % 3 == 0).select(
        org.alias("org_abbrev"), url.alias("url"), F.lit("ok").alias("enrich_status"),
        F.lit("html").alias("content_type"), F.col("event_id").alias("index"),
    )
    append_stream(new_listings(stream, prior, "ts", "60 days"), f"{home}/out", f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").select("org_abbrev", "url")


_LATE_SQL = """
spread AS (SELECT *, 'U' || user_id AS org_abbrev, 'https://x.example/' || event_id % 900 AS url,
                  epoch_us(ts) <= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) AND event_id % 20 = 3 AS is_held FROM events WHERE NOT (event_id % 900 % 3 = 0)),
passed AS (SELECT DISTINCT org_abbrev, url FROM spread WHERE NOT is_held)"""


@query(
    "streamed_late_listings",
    f"""WITH {_LATE_SQL}
        SELECT org_abbrev, url, false AS is_late, NULL::BIGINT AS job_index FROM passed
        UNION ALL SELECT org_abbrev, url, true, arg_min(event_id, (ts, event_id)) FROM spread
        WHERE is_held AND (org_abbrev, url) NOT IN (SELECT (org_abbrev, url) FROM passed) GROUP BY org_abbrev, url""",
)
def streamed_late_listings(spark, folder):
    """Listings land in three portions; those of the last are older than the watermark and settled afterwards."""
    home = scratch_path(spark, "late")
    url = F.concat(F.lit("https://x.example/"), (F.col("event_id") % 900).cast("string"))
    rows = table(spark, folder, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("org_abbrev"), url.alias("url"),
        F.col("event_id").alias("job_index"), F.col("ts").cast("timestamp").alias("ts"),
    )
    middle = rows.agg(F.expr("(min(unix_micros(ts)) + max(unix_micros(ts))) div 2").alias("t")).first()["t"]
    early = F.unix_micros("ts") <= middle
    held = early & (F.col("job_index") % 20 == 3)
    prior = rows.filter(F.col("job_index") % 900 % 3 == 0).withColumns(
        {"enrich_status": F.lit("ok"), "content_type": F.lit("html"), "index": F.col("job_index")}
    )
    for part in (early & ~held, ~early, held):
        rows.filter(part).write.mode("append").parquet(f"{home}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        append_stream(new_listings(stream, prior, "ts", "1 second"), f"{home}/out", f"{home}/checkpoint")
    passed = spark.read.parquet(f"{home}/out").select("org_abbrev", "url", "job_index")
    late = late_listings(spark.read.parquet(f"{home}/in"), prior, passed, "ts")
    # an address that comes again after the delay passes again
    once = passed.select("org_abbrev", "url").distinct().withColumns({"is_late": F.lit(False), "job_index": F.lit(None).cast("bigint")})
    return once.unionByName(late.select("org_abbrev", "url", F.lit(True).alias("is_late"), "job_index"))
