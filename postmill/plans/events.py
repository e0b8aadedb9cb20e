"""Event rows of a run, derived from its outcome table in one pass over the rows."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill import constants as C
from postmill.functions.text import iso_utc, word_count
from postmill.operators.rows import unnest
from postmill.plans.collect import CACHED, FETCHED
from postmill.schemas import EVENT


def _event(name: str, step: int, **fields) -> Column:
    given = {"event": F.lit(name), **fields}
    columns = [
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields
    ]
    return F.struct(F.lit(step).alias("step"), *columns)


def job_events(outcomes: DataFrame) -> DataFrame:
    """Start (fetched rows only), result or error, and breaker opening of every posting."""
    org = {"org_abbrev": F.col("org_abbrev"), "org_name": F.col("org_name")}
    job = {
        **org,
        "job_index": F.col("job_index"),
        "job_title": F.col("title"),
        "job_url": F.col("url"),
    }
    res, failed = F.col("res"), F.col("error") != ""
    cached = F.col("origin") == CACHED
    done = {
        **job,
        "duration_seconds": F.col("fetch_seconds"),
        "enrich_status": res["enrich_status"],
        "content_type": res["content_type"],
        "word_count": word_count(res["description"]),
        "status_reason": F.when(cached, "cached").otherwise(res["status_reason"]),
        "error": F.col("error"),
    }
    opened = {**org, "consecutive_429": F.lit(C.BREAKER_THRESHOLD), "threshold": F.lit(C.BREAKER_THRESHOLD)}
    emitted = F.array(
        F.when(F.col("origin") == FETCHED, _event("job_start", 0, **job, total_jobs=F.col("total_jobs"))),
        F.when(failed, _event("job_error", 1, **done)).otherwise(_event("job_result", 1, **done)),
        F.when(F.col("opens_breaker"), _event("org_rate_limited", 2, **opened)),
    )
    seq = F.col("job_index").cast("bigint").alias("seq")
    return unnest(outcomes, seq, array=F.array_compact(emitted), item="e").select("seq", "e.*")


def org_events(orgs: DataFrame, job_counts: DataFrame) -> DataFrame:
    """Start, listing count and end of every organisation.

    `orgs(org_abbrev, org_name, scraper_file, scraper_error, [scrape_seconds, output_path])`.
    """
    rows = orgs.join(job_counts.select("org_abbrev", "job_count"), "org_abbrev", "left")
    count = F.coalesce("job_count", F.lit(0))
    org = {"org_abbrev": F.col("org_abbrev"), "org_name": F.col("org_name")}
    failed = F.col("scraper_error") != ""
    seconds = F.col("scrape_seconds") if "scrape_seconds" in orgs.columns else F.lit(0.0)
    if "output_path" in orgs.columns:
        end = {"output_path": F.col("output_path")}
    else:
        end = {"scraper_error": F.col("scraper_error")}
    emitted = F.array(
        F.struct(F.lit(-1).alias("seq"), _event("org_start", 0, **org, scraper_file=F.col("scraper_file")).alias("e")),
        F.when(
            ~failed,
            F.struct(
                F.lit(-1).alias("seq"),
                _event("scraper_done", 1, **org, job_count=count, duration_seconds=seconds).alias("e"),
            ),
        ),
        F.struct(
            F.lit(None).cast("int").alias("seq"), _event("org_done", 9, **org, job_count=count, **end).alias("e")
        ),
    )
    rows = unnest(rows, array=F.array_compact(emitted), item="x")
    last = F.lit(2**62)
    return rows.select(F.coalesce(F.col("x.seq").cast("bigint"), last).alias("seq"), "x.e.*")


def run_events(
    orgs: DataFrame, outcomes: DataFrame, run_id: str, now: Column, batch_id: str = ""
) -> DataFrame:
    """All events; `(org_abbrev, seq, step)` gives their order inside an organisation."""
    counts = outcomes.groupBy("org_abbrev").agg(F.count(F.lit(1)).alias("job_count"))
    both = job_events(outcomes).unionByName(org_events(orgs, counts))
    return both.withColumns(
        {"run_id": F.lit(run_id), "batch_id": F.lit(batch_id), "ts_utc": iso_utc(now)}
    )
