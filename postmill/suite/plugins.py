"""Plug-ins that may fail, first organisations of a run, and a marker table."""

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from postmill.operators.markers import marker_scores
from postmill.plans.collect import failed_orgs, org_rows
from postmill.plans.plugins import Plugin, first_orgs, number_listings, run_plugins
from postmill.suite.base import query, sql_strip, table

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIRST = 100


def every_link(page):
    """Each link of a page."""
    return [{"title": title, "url": url} for url, title in re.findall('<a href="(/[^"]*)">([^<]*)</a>', page["html"])]


def headline(page):
    """One listing for each headline, with its length; raises on a page with a tracked address."""
    found = re.findall("<h1>([^<]*)</h1>", page["html"])
    if "?" in page["url"]:
        raise ValueError(f"tracked address on page {page['page_no']}")
    return [{"title": title, "url": page["url"], "letters": len(title)} for title in found]


PLUGINS = {"every_link": Plugin(every_link), "headline": Plugin(headline, "title string, url string, letters bigint")}

_PLUGIN_SQL = f"""
pages_of AS (
  SELECT page_id AS page_no, url, html, regexp_extract(url, '://([^/?#]*)', 1) AS org_abbrev FROM pages
), named AS (
  SELECT *, CASE WHEN ends_with(org_abbrev, '.net') THEN 'every_link' WHEN ends_with(org_abbrev, '.org') THEN 'headline'
                 WHEN page_no % 7 = 0 THEN 'gone' ELSE 'every_link' END AS extractor FROM pages_of
), chosen AS (
  SELECT org_abbrev FROM pages_of GROUP BY org_abbrev ORDER BY min(page_no) LIMIT {FIRST}
), failing AS (
  SELECT org_abbrev, min(page_no) AS page_no, arg_min(reason, page_no) AS reason FROM (
    SELECT org_abbrev, page_no, CASE extractor WHEN 'gone' THEN 'no plug-in gone' ELSE 'ValueError: tracked address on page ' || page_no END AS reason
    FROM named WHERE extractor = 'gone' OR (extractor = 'headline' AND contains(url, '?'))) GROUP BY org_abbrev
), found AS (
  SELECT org_abbrev, page_no, i, titles[i] AS title, hrefs[i] AS url, NULL::BIGINT AS letters FROM (
    SELECT *, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2) AS titles
    FROM named WHERE extractor = 'every_link') p, generate_series(1, len(hrefs)) AS s(i)
  UNION ALL
  SELECT org_abbrev, page_no, i, heads[i], url, length(heads[i]) FROM (
    SELECT *, regexp_extract_all(html, '<h1>([^<]*)</h1>', 1) AS heads FROM named WHERE extractor = 'headline') p, generate_series(1, len(heads)) AS s(i)
), listed AS (
  SELECT *, row_number() OVER (PARTITION BY org_abbrev ORDER BY page_no, i) AS job_index, count(*) OVER (PARTITION BY org_abbrev) AS total_jobs
  FROM found WHERE {sql_strip('title')} <> '' AND {sql_strip('url')} <> ''
    AND org_abbrev IN (SELECT org_abbrev FROM chosen) AND org_abbrev NOT IN (SELECT org_abbrev FROM failing)
)"""


def _run(spark, folder):
    """Listings, failures and registry of the first organisations."""
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("page_no"), "url", "html", host.alias("org_abbrev"))
    registry = pages.groupBy("org_abbrev").agg(F.min("page_no").alias("reg_pos")).select(
        "org_abbrev", "reg_pos", F.concat(F.lit("Organisation "), F.col("org_abbrev")).alias("org_name"),
        F.lit("scrape.py").alias("scraper_file"), F.lit(False).alias("is_playwright"),
    )
    chosen = first_orgs(registry, FIRST)
    pages = pages.join(chosen.select("org_abbrev"), "org_abbrev", "left_semi")
    name = F.when(F.endswith("org_abbrev", F.lit(".net")), "every_link").when(F.endswith("org_abbrev", F.lit(".org")), "headline")
    name = name.when(F.col("page_no") % 7 == 0, "gone").otherwise("every_link")
    listings, failures = run_plugins(pages.withColumn("extractor", name), PLUGINS)
    return listings, failures, chosen


@query(
    "plugin_listings",
    f"WITH {_PLUGIN_SQL} SELECT org_abbrev, page_no, job_index, total_jobs, title, url, letters FROM listed",
)
def plugin_listings(spark, folder):
    """Listings of user functions over the first organisations; one function raises on some pages."""
    listings, _, _ = _run(spark, folder)
    return number_listings(listings).select("org_abbrev", "page_no", "job_index", "total_jobs", "title", "url", "letters")


@query(
    "plugin_orgs",
    f"""WITH {_PLUGIN_SQL}
        SELECT c.org_abbrev, coalesce('page ' || f.page_no || ': ' || f.reason, '') AS scraper_error, coalesce(n, 0)::BIGINT AS job_count
        FROM chosen c LEFT JOIN failing f USING (org_abbrev)
        LEFT JOIN (SELECT org_abbrev, count(*) AS n FROM listed GROUP BY ALL) USING (org_abbrev)""",
)
def plugin_orgs(spark, folder):
    """A row for each of the first organisations; one whose function failed has its error and no listings."""
    listings, failures, chosen = _run(spark, folder)
    counted = listings.groupBy("org_abbrev").agg(F.count(F.lit(1)).alias("job_count"))
    orgs = org_rows(chosen, failed_orgs(failures)).join(counted, "org_abbrev", "left")
    return orgs.select("org_abbrev", "scraper_error", F.coalesce("job_count", F.lit(0)).cast("bigint").alias("job_count"))


@query(
    "marker_table_scores",
    """WITH heads AS (SELECT lower(unnest(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1))) AS head FROM pages),
    markers AS (
      SELECT marker, length(marker) % 7 - 2 AS weight FROM (
        SELECT DISTINCT unnest(regexp_extract_all(head, '[a-z]{4,}')) AS marker FROM heads UNION ALL SELECT head FROM heads)
    )
    SELECT doc_id, count(marker) AS hits, coalesce(sum(weight), 0)::BIGINT AS score
    FROM documents LEFT JOIN markers ON contains(lower(text), marker) GROUP BY doc_id""",
)
def marker_table_scores(spark, folder):
    """Documents scored by the words of all page headlines and by the headlines themselves."""
    heads = table(spark, folder, "pages").select(F.explode(F.regexp_extract_all("html", F.lit("<h1>([^<]*)</h1>"), F.lit(1))).alias("head"))
    heads = heads.select(F.lower("head").alias("head"))
    words = heads.select(F.explode(F.regexp_extract_all("head", F.lit("[a-z]{4,}"), F.lit(0))).alias("marker")).distinct()
    markers = words.union(heads).withColumn("weight", F.length("marker") % 7 - 2)
    texts = table(spark, folder, "documents").select("doc_id", F.lower("text").alias("text"))
    return marker_scores(texts, markers, ["doc_id"], "text")
