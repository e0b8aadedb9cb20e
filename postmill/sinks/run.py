"""The outputs of a run, written in one go: postings, violations, report and totals."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from postmill.operators.rollup import flatten_blocks
from postmill.plans.report import run_report
from postmill.session import settle
from postmill.sinks.artifacts import write_postings, write_report, write_violations
from postmill.sources.artifacts import read_org_blocks

def _totals() -> dict[str, Column]:
    return {
        "jobs": F.count(F.lit(1)),
        "ok_jobs": F.count_if(F.col("enrich_status") == "ok"),
        "pdf_jobs": F.count_if(F.col("content_type") == "pdf"),
        "failed_jobs": F.count_if(F.col("error") != ""),
        "description_chars": F.coalesce(F.sum(F.length("description")), F.lit(0)),
        "slowest_seconds": F.max("fetch_seconds"),
    }


def write_run(
    orgs: DataFrame,
    postings: DataFrame,
    runs_dir: str,
    run_id: str,
    requested: Sequence[str],
    generated_at: str,
    check=None,
) -> dict:
    """Write a run and give its totals and exit code.

    Totals are gathered while the postings are written, so postings are read once. The report is rolled up from
    the written artifacts. `check(orgs, postings)` gives the violations of the written postings; any violation makes the
    exit code 1, which is 0 without a check.
    """
    seen = Observation()
    write_postings(orgs, postings.observe(seen, *(total.alias(name) for name, total in _totals().items())), runs_dir, run_id)
    totals = dict(seen.get)
    blocks = read_org_blocks(orgs.sparkSession, runs_dir, run_id)
    written = flatten_blocks(blocks).filter(F.col("index").isNotNull())
    totals["violations"] = 0
    if check is not None:
        # settled, as the ordered file reads them twice (an observation would count them twice)
        found = settle(check(orgs, written), "violations")
        write_violations(found, f"{runs_dir}/{run_id}/violations")
        totals["violations"] = found.count()
    exit_code = int(totals["violations"] > 0)
    write_report(run_report(orgs, written), requested, runs_dir, run_id, exit_code, generated_at)
    return {**totals, "exit_code": exit_code}
