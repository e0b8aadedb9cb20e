"""Query registry and the views the queries share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postmill import constants as C
from postmill.functions.predicates import classify_error, has_js_marker, is_short
from postmill.functions.text import strip
from postmill.operators.positions import chunk_of, number_rows, range_chunks
from postmill.plans.resolution import result
from postmill.session import prepare, read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RUN_ID = "run-20260102T030405Z-0a1b2c3d"
DAY = "2026-01-02"
NOW_TEXT = "2026-01-02T03:04:05.000000+00:00"


def now() -> Column:
    return F.to_timestamp(F.lit("2026-01-02 03:04:05"))


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can say it."""

    def keep(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


# --- pieces of SQL ------------------------------------------------------------


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in values)


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_words(x: str) -> str:
    return rf"CAST(len(regexp_extract_all({x}, '\S+')) AS BIGINT)"


def sql_hits(x: str, parts) -> str:
    return f"CAST(len(list_filter([{quoted(parts)}], lambda m: contains({x}, m))) AS BIGINT)"


def sql_any(x: str, parts) -> str:
    return f"({sql_hits(x, parts)} > 0)"


def sql_lines(x: str) -> str:
    """Cleaned lines as a list."""
    marks = f"replace(replace({x}, '\\:', ':'), '\\;', ';')"
    lines = f"list_transform(string_split({marks}, chr(10)), lambda l: {sql_strip('l')})"
    return f"list_filter({lines}, lambda l: l <> '' AND lower(l) NOT IN ({quoted(C.NOISE_LINES)}))"


def sql_clean(x: str) -> str:
    return f"coalesce(array_to_string({sql_lines(x)}, chr(10)), '')"


def sql_short(x: str) -> str:
    few = f"length({sql_strip(x)}) < {C.MIN_CHARS} OR {sql_words(x)} < {C.MIN_WORDS}"
    return f"({few} OR {sql_any(f'lower({x})', C.NEEDS_JS_MARKERS)})"


def sql_slug(x: str) -> str:
    kept = rf"regexp_replace({sql_strip(f'lower({x})')}, '[^\p{{L}}\p{{N}}_\s-]', '', 'g')"
    dashed = rf"regexp_replace(regexp_replace({kept}, '[\s_]+', '-', 'g'), '-+', '-', 'g')"
    return f"substr(trim({dashed}, '-'), 1, {C.SLUG_CHARS})"


def sql_keywords(x: str) -> str:
    words = f"list_distinct(regexp_extract_all(lower({x}), '[a-z0-9]{{4,}}'))"
    return f"list_filter({words}, lambda w: w NOT IN ({quoted(C.TITLE_STOP_WORDS)}))"


def sql_error(x: str, part: int) -> str:
    """Status (0) or reason (1) of a failure message."""
    cases = " ".join(
        f"WHEN {sql_any(f'lower({x})', row[2])} THEN '{row[part]}'" for row in C.ERROR_CLASSES
    )
    return f"CASE {cases} ELSE '{C.OTHER_ERROR[part]}' END"


# --- listings: one organisation per document source ---------------------------

LISTINGS_SQL = rf"""
listings AS (
  SELECT org_abbrev, 'Organisation ' || org_abbrev AS org_name, job_index, doc_id, text, err AS error, is_pdf,
         {sql_strip("split_part(text, chr(10), 1)")} AS title,
         CASE WHEN doc_id % 29 = 0 THEN ''
              ELSE 'https://' || lower(org_abbrev) || '.example.org/job/' || doc_id END AS url,
         CAST((doc_id * 7) % 353 AS DOUBLE) / 10 AS fetch_seconds,
         count(*) OVER (PARTITION BY org_abbrev) AS total_jobs
  FROM (SELECT upper(source) AS org_abbrev, doc_id, text,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) AS job_index,
               source IN ('src3', 'src7') AND doc_id % 3 = 0 AS is_pdf,
               CASE WHEN source IN ('src3', 'src7') THEN ''
                    WHEN doc_id % 41 = 1 THEN '429 Too Many Requests'
                    WHEN doc_id % 41 = 2 THEN '403 Client Error: Forbidden'
                    WHEN doc_id % 41 = 3 THEN '404 Client Error: Not Found'
                    WHEN doc_id % 41 = 4 THEN 'SSL certificate verify failed'
                    WHEN doc_id % 41 = 5 THEN 'Invalid URL: no scheme supplied'
                    WHEN doc_id % 41 = 6 THEN 'fetch timed out after 30.0s'
                    ELSE '' END AS err
        FROM documents) d)"""

_FAILURES = {
    1: "429 Too Many Requests",
    2: "403 Client Error: Forbidden",
    3: "404 Client Error: Not Found",
    4: "SSL certificate verify failed",
    5: "Invalid URL: no scheme supplied",
    6: "fetch timed out after 30.0s",
}

# Result of every listing when its document is the page text.
RESULTS_SQL = rf"""{LISTINGS_SQL},
results AS (
  SELECT *,
         CASE WHEN url = '' THEN 'no_detail_url' WHEN error <> '' THEN {sql_error('error', 0)}
              WHEN is_pdf THEN 'pdf' WHEN is_js THEN 'js_required' WHEN is_short THEN 'short_content'
              ELSE 'ok' END AS enrich_status,
         CASE WHEN url = '' THEN 'missing_url' WHEN error <> '' THEN {sql_error('error', 1)}
              WHEN is_pdf THEN '' WHEN is_js THEN 'js_required' WHEN is_short THEN 'short_description'
              ELSE '' END AS status_reason,
         CASE WHEN url = '' OR error <> '' THEN 'error' WHEN is_pdf THEN 'pdf' ELSE 'html' END AS content_type,
         CASE WHEN url = '' THEN 'none' ELSE 'http' END AS fetch_method,
         CASE WHEN url = '' OR error <> '' OR is_pdf THEN '' ELSE text END AS description,
         CASE WHEN url <> '' AND error = '' AND is_pdf THEN 'pdfs/' || org_abbrev || '/' || doc_id || '.pdf'
              ELSE '' END AS pdf_path,
         CASE WHEN url = '' THEN '' ELSE error END AS shown_error,
         CASE WHEN url = '' THEN 0.0 ELSE fetch_seconds END AS seconds
  FROM (SELECT *, {sql_short('text')} AS is_short,
               {sql_short('text')} AND {sql_any('lower(text)', C.NEEDS_JS_MARKERS)} AS is_js FROM listings) l)"""


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered listings with the text their page would give and the outcome of the fetch.

    Positions are found on narrow rows; texts pass no window and meet their position in one join.
    """
    docs = table(spark, folder, "documents")
    keys = docs.select(F.upper("source").alias("org_abbrev"), "doc_id")
    places = number_rows(keys, "org_abbrev", ["doc_id"], chunk_of(F.col("doc_id")), total="total_jobs")
    title = strip(F.substring_index("text", "\n", 1))
    rows = places.join(docs.select("doc_id", "text", title.alias("title")), "doc_id")
    doc, org = F.col("doc_id"), F.col("org_abbrev")
    calm = org.isin("SRC3", "SRC7")
    error = F.when(calm, "")
    for rest, message in _FAILURES.items():
        error = error.when(doc % 41 == rest, message)
    address = F.concat(
        F.lit("https://"), F.lower(org), F.lit(".example.org/job/"), doc.cast("string")
    )
    return rows.select(
        "org_abbrev",
        F.concat(F.lit("Organisation "), org).alias("org_name"),
        "job_index",
        "total_jobs",
        "doc_id",
        "title",
        F.when(doc % 29 == 0, "").otherwise(address).alias("url"),
        "text",
        (calm & (doc % 3 == 0)).alias("is_pdf"),
        error.otherwise("").alias("error"),
        (((doc * 7) % 353).cast("double") / 10).alias("fetch_seconds"),
    )


def read_text(rows: DataFrame) -> DataFrame:
    """Resolve listings whose page text is their document."""
    rows = rows.withColumn("_short", is_short(F.col("text")))
    rows = rows.withColumn("_js", F.col("_short") & has_js_marker(F.col("text")))
    text = F.col("text")
    path = F.concat(F.lit("pdfs/"), F.col("org_abbrev"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    res = (
        F.when(F.col("url") == "", result("error", "", "", "no_detail_url", "missing_url", "none"))
        .when(F.col("is_pdf"), result("pdf", "", path, "pdf", "", "http"))
        .when(F.col("_js"), result("html", text, "", "js_required", "js_required", "http"))
        .when(F.col("_short"), result("html", text, "", "short_content", "short_description", "http"))
        .otherwise(result("html", text, "", "ok", "", "http"))
    )
    return rows.withColumn("res", res).drop("_short", "_js")


def outcomes_of(rows: DataFrame) -> DataFrame:
    """Read the rows and judge their logged attempt, which they carry themselves."""
    read = read_text(rows)
    failed = (F.col("error") != "") & (F.col("url") != "")
    kind = classify_error(F.col("error"))
    res = F.when(failed, result("error", "", "", kind["status"], kind["reason"], "http")).otherwise(F.col("res"))
    return read.withColumns(
        {
            "res": res,
            "fetch_seconds": F.when(F.col("url") == "", 0.0).otherwise(F.col("fetch_seconds")),
            "error": F.when(failed, F.col("error")).otherwise(""),
        }
    )


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Postings without a breaker, all fields flat."""
    return outcomes_of(listings(spark, folder)).select(
        "org_abbrev",
        F.col("job_index").alias("index"),
        "doc_id",
        "title",
        "url",
        "res.*",
        "fetch_seconds",
        "error",
    )


def orgs_of(rows: DataFrame) -> DataFrame:
    """Header rows of the organisations, one of which has a failed source."""
    orgs = rows.select("org_abbrev").distinct()
    return orgs.select(
        "org_abbrev",
        F.concat(F.lit("Organisation "), F.col("org_abbrev")).alias("org_name"),
        F.concat(F.lit("scrape_"), F.lower("org_abbrev"), F.lit(".py")).alias("scraper_file"),
        (F.col("org_abbrev") == "SRC5").alias("is_playwright_scraper"),
        F.when(F.col("org_abbrev") == "SRC9", "source timed out | gave up").otherwise("").alias("scraper_error"),
    )


ORGS_SQL = """
orgs AS (
  SELECT DISTINCT upper(source) AS org_abbrev, 'Organisation ' || upper(source) AS org_name,
         'scrape_' || lower(source) || '.py' AS scraper_file, upper(source) = 'SRC5' AS is_playwright_scraper,
         CASE WHEN upper(source) = 'SRC9' THEN 'source timed out | gave up' ELSE '' END AS scraper_error
  FROM documents)"""


# --- attempts: one organisation per user ---------------------------------------

ATTEMPTS_SQL = """
attempts AS (
  SELECT user_id AS org_id, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS job_index,
         event_type = 'error' AS is_limited, event_type = 'signup' AS is_cached
  FROM events)"""

BREAKER_SQL = f"""{ATTEMPTS_SQL},
live AS (SELECT *, sum(CASE WHEN is_limited THEN 0 ELSE 1 END) OVER (PARTITION BY org_id ORDER BY job_index) AS island
         FROM attempts WHERE NOT is_cached),
streaks AS (SELECT *, count(*) FILTER (WHERE is_limited) OVER (PARTITION BY org_id, island ORDER BY job_index) AS streak
            FROM live),
openings AS (SELECT org_id, min(job_index) AS open_at FROM streaks WHERE streak >= {C.BREAKER_THRESHOLD} GROUP BY org_id)"""


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Fetch attempts numbered per user in time order, with the chunk they were numbered in."""
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("org_id"), "event_id", "ts", "event_type"
    )
    ranged = range_chunks(events, "org_id", ["ts", "event_id"])
    numbered = number_rows(ranged, "org_id", ["ts", "event_id"], F.col("chunk"))
    return numbered.select(
        "org_id",
        "event_id",
        "job_index",
        "chunk",
        (F.col("event_type") == "error").alias("is_limited"),
        (F.col("event_type") == "signup").alias("is_cached"),
    )


def as_long(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")
