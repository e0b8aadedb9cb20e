"""Quality gates of a run as violation rows."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from postmill.constants import GATE_FALLBACKS
from postmill.functions.predicates import is_successful
from postmill.functions.text import blank_if_null, strip, word_count
from postmill.operators.positions import chunk_of
from postmill.operators.rollup import org_measures
from postmill.operators.rows import unnest
from postmill.sources.gates import GATE_COLUMNS


def thresholds(orgs: DataFrame, overrides: DataFrame, defaults: Mapping) -> DataFrame:
    """Effective gate per organisation: override, else default, else fallback."""
    joined = orgs.select("org_abbrev", "scraper_error").join(overrides, "org_abbrev", "left")
    for name, fallback in GATE_FALLBACKS.items():
        kind = GATE_COLUMNS[name].dataType
        basis = F.lit(defaults.get(name, fallback)).cast(kind)
        joined = joined.withColumn(name, F.coalesce(F.col(name), basis))
    return joined


def _iso_date(text: Column) -> Column:
    dashed = F.when(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}$")), text)
    packed = F.when(F.rlike(text, F.lit(r"^\d{8}$")), text)
    return F.coalesce(
        F.to_date(F.try_to_timestamp(dashed, F.lit("yyyy-MM-dd"))),
        F.to_date(F.try_to_timestamp(packed, F.lit("yyyyMMdd"))),
    )


def _line(org: Column, *parts) -> Column:
    return F.concat(org, F.lit(": "), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _found(hit: Column, seq: int, rule: str, message: Column) -> Column:
    row = F.struct(F.lit(rule).alias("rule"), F.lit(seq).alias("rule_seq"), message.alias("message"))
    return F.when(F.coalesce(hit, F.lit(False)), row)


def org_gates(orgs: DataFrame, postings: DataFrame, overrides: DataFrame, defaults: Mapping) -> DataFrame:
    """Thresholds and measures per organisation, the narrow side of the posting checks."""
    limits = thresholds(orgs, overrides, defaults)
    return limits.join(org_measures(postings), "org_abbrev", "left")


def org_violations(gates: DataFrame, today: Column) -> DataFrame:
    org, expires = F.col("org_abbrev"), F.col("expires_on")
    due = _iso_date(expires)
    count = F.coalesce("job_count", F.lit(0))
    expired = due.isNotNull() & (today > due)
    broken = (blank_if_null(expires) != "") & due.isNull()
    same = (
        ~F.coalesce("has_pdf", F.lit(False))
        & (count > 2)
        & (F.col("successes") >= 3)
        & (F.col("least_words") == F.col("most_words"))
    )
    reason = blank_if_null(F.col("reason"))
    error = F.col("scraper_error")
    rows = F.array(
        _found(error != "", 1, "scraper_error", _line(org, "scraper_error present: ", error)),
        _found(
            expired,
            2,
            "override_expired",
            _line(org, "override expired on ", F.date_format(due, "yyyy-MM-dd"), " (reason=", reason, ")"),
        ),
        _found(broken, 2, "override_invalid", _line(org, "invalid override expires_on '", expires, "'")),
        _found(
            (count < F.col("min_jobs_per_org")) & ~F.col("allow_empty"),
            3,
            "too_few_jobs",
            _line(org, "returned ", count, " jobs (< ", F.col("min_jobs_per_org"), ")"),
        ),
        _found(
            same,
            4,
            "identical_length",
            _line(
                org,
                "all successful descriptions share identical length (",
                F.col("least_words"),
                " words)",
            ),
        ),
    )
    return unnest(gates, "org_abbrev", array=F.array_compact(rows), item="v").select(
        "org_abbrev", "v.rule", "v.rule_seq", F.lit(None).cast("bigint").alias("job_index"), "v.message"
    )


def posting_violations(gates: DataFrame, postings: DataFrame) -> DataFrame:
    """Word bounds and fetch time per posting; only narrow columns are shuffled."""
    ok = is_successful(F.col("enrich_status"), F.col("description"))
    raw_url = blank_if_null(F.col("url"))
    narrow = postings.select(
        "org_abbrev",
        F.col("index").alias("job_index"),
        raw_url.alias("url"),
        strip(raw_url).alias("trimmed"),
        F.when(ok, word_count(F.col("description"))).alias("words"),
        F.coalesce("fetch_seconds", F.lit(0.0)).alias("seconds"),
    )
    # One row of limits per chunk of an organisation: joined by chunk, a hot organisation stays spread.
    chunks = F.sequence(F.lit(0).cast("bigint"), chunk_of(F.coalesce("last_index", F.lit(0))))
    limits = unnest(
        gates, "org_abbrev", "min_words", "max_words", "max_fetch_seconds_per_job", "has_pdf",
        array=chunks, item="_chunk",
    )
    rows = narrow.withColumn("_chunk", chunk_of(F.coalesce("job_index", F.lit(0)))).join(limits, ["org_abbrev", "_chunk"])
    org, index, words = F.col("org_abbrev"), F.col("job_index"), F.col("words")
    low, high, cap = F.col("min_words"), F.col("max_words"), F.col("max_fetch_seconds_per_job")
    outside = ~F.coalesce("has_pdf", F.lit(False)) & ((words < low) | (words > high))
    slow = (F.col("trimmed") != "") & (F.col("seconds") > cap)
    found = F.array(
        _found(
            outside,
            5,
            "word_bounds",
            _line(
                org, "job #", index, " word_count=", words, " out of bounds [", low, ", ", high,
                "] url=", F.col("url"),
            ),
        ),
        _found(
            slow,
            6,
            "fetch_seconds",
            _line(
                org, "job #", index, " fetch_seconds=", F.format_string("%.3f", F.col("seconds")),
                " > ", F.format_string("%.3f", cap), " url=", F.col("trimmed"),
            ),
        ),
    )
    return unnest(rows, "org_abbrev", "job_index", array=F.array_compact(found), item="v").select(
        "org_abbrev", "v.rule", "v.rule_seq", "job_index", "v.message"
    )


def violations(
    orgs: DataFrame, postings: DataFrame, overrides: DataFrame, defaults: Mapping, today: Column
) -> DataFrame:
    """All violations; order by `(org_abbrev, rule_seq, job_index)`. No organisations is one violation."""
    orgs = orgs.withColumn("scraper_error", blank_if_null(F.col("scraper_error")))
    gates = org_gates(orgs, postings, overrides, defaults)
    nothing = orgs.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0)
    empty = nothing.select(
        F.lit("").alias("org_abbrev"),
        F.lit("payload").alias("rule"),
        F.lit(0).alias("rule_seq"),
        F.lit(None).cast("bigint").alias("job_index"),
        F.lit("payload: missing non-empty 'orgs' list").alias("message"),
    )
    return org_violations(gates, today).unionByName(posting_violations(gates, postings)).unionByName(empty)


def rendered(found: DataFrame) -> DataFrame:
    """Violations as list lines, in order."""
    ordered = found.orderBy("org_abbrev", "rule_seq", F.col("job_index").asc_nulls_first())
    return ordered.select(F.concat(F.lit("- "), F.col("message")).alias("line"))
