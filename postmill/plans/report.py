"""Run report: rows, header and table lines."""

from pyspark.sql import DataFrame, functions as F

from postmill import constants as C
from postmill.functions.text import null_if_blank
from postmill.operators.rollup import org_report

# --- fixed values: report layout ---------------------------------------------
HEADER = (
    "# Run Report",
    "",
    "Generated at: `{generated_at}`",
    "Run ID: `{run_id}`",
    "Test exit code: `{exit_code}`",
    "",
    "## Orgs",
    "{orgs}",
    "",
    "## Results",
    "| Org | Scraper Status | Enrich Status | Desc Len | Error |",
    "| --- | --- | --- | ---: | --- |",
)


def run_report(orgs: DataFrame, postings: DataFrame) -> DataFrame:
    return org_report(orgs, postings)


def table_lines(report: DataFrame) -> DataFrame:
    """One table line per organisation, in order."""
    error = F.coalesce(null_if_blank(F.col("scraper_error")), F.col("enrich_error"))
    shown = F.substring(F.replace(error, F.lit("|"), F.lit("/")), 1, C.REPORT_ERROR_CHARS)
    cells = (F.col("org"), F.col("scraper_status"), F.col("enrich_status"), F.col("desc_len").cast("string"), shown)
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return report.orderBy("org").select("org", line.alias("line"))
