"""Postings, state, events, report, manifest and violation writers."""

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from postmill import constants as C
from postmill.functions.text import null_if_blank
from postmill.operators.rollup import org_blocks
from postmill.plans.quality import rendered
from postmill.plans.report import HEADER, table_lines
from postmill.plans.resolution import pdf_path
from postmill.operators.positions import range_chunks
from postmill.schemas import EVENT, STATE
from postmill.session import settle
from postmill.sources.artifacts import read_folders, state_bucket, state_folders

# Folders of a new state, and event lines in a file.
STATE_BUCKETS, LOG_LINES = 64, 1_000_000


def new_run_id(prefix: str = "run") -> str:
    """`prefix-YYYYMMDDTHHMMSSZ-8hex`."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    return f"{prefix}-{stamp}-{uuid.uuid4().hex[:8]}"


def _folder_name(org: Column) -> Column:
    return F.coalesce(F.upper(null_if_blank(org)), F.lit("UNKNOWN"))


def write_postings(
    orgs: DataFrame, postings: DataFrame, runs_dir: str, run_id: str, rows: int = C.BLOCK_ROWS
) -> str:
    """One folder per organisation under the run; only the given organisations are replaced."""
    path = f"{runs_dir}/{run_id}/postings"
    blocks = org_blocks(orgs, postings, rows).withColumn("org", _folder_name(F.col("org_abbrev")))
    # Rebalancing gives each organisation few files and splits a very large one.
    writer = blocks.hint("rebalance", "org").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("ignoreNullFields", "false").partitionBy("org").json(path)
    return path


def write_state(state: DataFrame, state_dir: str, ran: DataFrame, buckets: int = STATE_BUCKETS) -> str:
    """Write the rows of a run and point to them in a new snapshot; the path of the rows.

    `ran` lists the organisations (`org_abbrev`) that ran without a source failure: their earlier rows go, and one
    that found nothing is emptied. All others keep their rows. Only the folders (buckets) of organisations that
    ran or have rows are written; the snapshot points to the folders of earlier runs for the rest. A folder is
    never overwritten, so a plan may read the state it replaces, and a run that fails changes nothing. The number of
    buckets is that of the first run.
    """
    spark = state.sparkSession
    stored, folders = state_folders(spark, state_dir)
    buckets = stored or buckets
    place = lambda rows: rows.withColumn("org_bucket", state_bucket(F.col("org_abbrev"), buckets))
    state = settle(place(state.select(*STATE.fieldNames())), "state")
    touched = settle(state.select("org_abbrev").union(ran.select("org_abbrev")).distinct(), "touched")
    named = {r[0] for r in place(touched).select("org_bucket").distinct().collect()}
    earlier = place(read_folders(spark, [folders[b] for b in sorted(named & set(folders))]))
    kept = earlier.join(touched, "org_abbrev", "left_anti").select(*state.columns)
    path = f"{state_dir}/rows/{uuid.uuid4().hex}"
    placed = state.unionByName(kept).hint("rebalance", "org_bucket")
    placed.sortWithinPartitions("org_bucket", "org_abbrev", "index").write.partitionBy("org_bucket").parquet(path)
    layout = state.schema
    written = {r[0] for r in spark.read.schema(layout).parquet(path).select("org_bucket").distinct().collect()}
    now = {b: p for b, p in folders.items() if b not in named} | {b: f"{path}/org_bucket={b}" for b in written}
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    lines = [(-1, buckets, ""), *((b, buckets, p) for b, p in sorted(now.items()))]
    manifest = spark.createDataFrame(lines, "org_bucket int, buckets int, path string").coalesce(1)
    manifest.write.json(f"{state_dir}/manifests/snapshot={stamp}")
    return path


def state_headers(orgs: DataFrame, state: DataFrame, now: str) -> DataFrame:
    """Name, time and number of rows per organisation of a snapshot."""
    counted = state.groupBy("org_abbrev").agg(F.count(F.lit(1)).alias("job_count"))
    joined = orgs.select("org_abbrev", "org_name").join(counted, "org_abbrev", "left")
    return joined.select(
        "org_name",
        "org_abbrev",
        F.lit(now).alias("enriched_at"),
        F.coalesce("job_count", F.lit(0)).cast("bigint").alias("job_count"),
    )


def append_events(events: DataFrame, runs_dir: str, run_id: str, lines: int = LOG_LINES) -> str:
    """Append event lines in organisation order, `lines` to a file; absent fields are left out of a line.

    A line's place is the number of lines of the organisations before its own, plus its place there. Files are cut
    by that number, so the log is in order without a sort of the whole run. File names rise with the places.
    """
    path = f"{runs_dir}/{run_id}/logs.ndjson"
    part = F.floor(F.col("seq") / F.lit(C.CHUNK_ROWS)).cast("bigint")
    rows = settle(events.withColumn("_part", part), "events")
    keys = ["org_abbrev", "_part"]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lines")).withColumn("_all", F.lit(0))
    # small rows, one a part of an organisation: lines before each within its range, and before the range
    ranged = range_chunks(sizes, "_all", keys, chunk="_range")
    inside = W.partitionBy("_range").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("_all").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("_all", "_range").agg(F.sum("_lines").alias("_sum"))
    starts = starts.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    ranged = ranged.withColumn("_before", F.coalesce(F.sum("_lines").over(inside), F.lit(0)))
    offsets = settle(ranged.join(starts, "_range").select(*keys, (F.col("_before") + F.col("_start")).alias("_offset")), "event-offsets")
    local = F.row_number().over(W.partitionBy(*keys).orderBy("seq", "step"))
    placed = rows.withColumn("_local", local).join(offsets, keys)
    place = F.col("_offset") + F.col("_local") - 1
    placed = placed.withColumn("_place", place).withColumn("_file", F.floor(place / F.lit(lines)).cast("int"))
    files = placed.repartitionById(max(1, -(-rows.count() // lines)), F.col("_file")).sortWithinPartitions("_place")
    files.select(*EVENT.fieldNames()).write.mode("append").option("ignoreNullFields", "true").json(path)
    return path


def write_report(
    report: DataFrame, orgs: Sequence[str], runs_dir: str, run_id: str, exit_code: int, generated_at: str
) -> str:
    """Report rows and a header row as JSON, and the table as ordered text. `orgs` is the run's request."""
    spark, path = report.sparkSession, f"{runs_dir}/{run_id}"
    report.write.mode("overwrite").json(f"{path}/report.json/results")
    head = [(run_id, generated_at, list(orgs), exit_code)]
    kinds = "run_id string, generated_at string, orgs array<string>, test_exit_code int"
    spark.createDataFrame(head, kinds).write.mode("overwrite").json(f"{path}/report.json/header")
    fixed = {
        "generated_at": generated_at, "run_id": run_id, "exit_code": exit_code, "orgs": ", ".join(orgs)
    }

    def literal(lines: Sequence[str], part: int) -> DataFrame:
        rows = [(part, i, "", text.format(**fixed)) for i, text in enumerate(lines)]
        return spark.createDataFrame(rows, "part int, at int, org string, line string")

    body = table_lines(report).select(F.lit(1).alias("part"), F.lit(0).alias("at"), "org", "line")
    parts = literal(HEADER, 0).unionByName(body)
    ordered = parts.orderBy("part", "at", "org").select("line")
    ordered.write.mode("overwrite").text(f"{path}/report.md")
    return path


def pdf_manifest(postings: DataFrame, run_id: str, day: str) -> DataFrame:
    """Target path of every PDF posting and how many postings share it."""
    rows = postings.withColumn("path", pdf_path(run_id, day, F.col("org_abbrev"), F.col("title")))
    # Written first: both join sides are then plain shuffles, which AQE can split at a hot path.
    shared = settle(rows.groupBy("path").agg(F.count(F.lit(1)).alias("same_path")), "paths")
    return rows.select("org_abbrev", "index", "url", "path").join(shared, "path")


def write_violations(found: DataFrame, path: str) -> str:
    rendered(found).write.mode("overwrite").text(path)
    return path
