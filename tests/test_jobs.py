"""Breaker, positions, reuse, gates, state, artifacts and streams on hand-made rows."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from postmill.operators.breaker import with_breaker
from postmill.operators.dedupe import dedupe_listings
from postmill.operators.positions import chunk_of, number_rows, range_chunks
from postmill.operators.reuse import with_prior, work_list
from postmill.operators.rollup import org_report
from postmill.operators.rules import flag_equal, flag_inside
from postmill.plans.artifact_check import bad_fields
from postmill.plans.collect import collect_outcomes, drop_failed, failed_orgs, org_rows, postings_of
from postmill.plans.enrich import enrich_outcomes, new_state
from postmill.plans.quality import rendered, violations
from postmill.plans.resolution import result
from postmill.schemas import EVENT, ORG_BLOCK, STATE
from postmill.sinks.artifacts import append_events, new_run_id, write_postings, write_report, write_state, write_violations
from postmill.sinks.reuse_index import append_reuse, read_reuse, with_stored_prior
from postmill.sources.artifacts import read_org_blocks, read_state, state_folders
from postmill.sources.gates import load_gates, overrides_frame
from postmill.sources.registry import find_orgs, merge_registries, registry_frame
from postmill.sources.rules import rules_frame
from postmill.sources.search_pages import facet_listings, simple_failures, simple_listings, table_failures, table_listings
from postmill.sinks.run import write_run
from postmill.streaming.breaker import OPENING, breaker_openings, limited_runs, run_breaker, with_openings
from postmill.streaming.jobs import append_stream, late_listings, latest_counters, new_listings, org_counters, write_counters

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


def brute_breaker(rows):
    """Skipped positions, by reading the rows one after the other."""
    skipped, streak, is_open = set(), {}, set()
    for org, pos, limited, cached in sorted(rows):
        if cached:
            continue
        if org in is_open:
            skipped.add((org, pos))
            continue
        streak[org] = streak.get(org, 0) + 1 if limited else 0
        if streak[org] >= 3:
            is_open.add(org)
    return skipped


def random_attempts(seed, n=400):
    pick = random.Random(seed)
    positions = {}
    rows = []
    for _ in range(n):
        # one organisation holds most of the rows
        org = pick.choice(["hot", "hot", "hot", "a", "b", "c"])
        positions[org] = positions.get(org, 0) + 1
        limited = pick.random() < {"hot": 0.25, "a": 0.9}.get(org, 0.5)
        rows.append((org, positions[org], limited, pick.random() < 0.2))
    return rows


SCHEMA = "org string, pos bigint, limited boolean, cached boolean"


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 7, 1000])
def test_breaker_is_the_same_for_every_chunk_size(rows, seed, chunk_rows):
    attempts = random_attempts(seed)
    frame = rows(SCHEMA, *attempts).repartition(5, "pos")
    chunk = chunk_of(F.col("pos"), chunk_rows)
    labelled = with_breaker(frame, "org", "pos", F.col("limited"), chunk, F.col("cached"))
    found = {(r.org, r.pos) for r in labelled.filter("is_skipped").collect()}
    assert found == brute_breaker(attempts)


def test_breaker_cases(rows):
    def skipped(*outcomes):
        data = [("o", i, kind == "429", kind == "cached") for i, kind in enumerate(outcomes, 1)]
        frame = with_breaker(rows(SCHEMA, *data), "org", "pos", F.col("limited"), chunk_of(F.col("pos")), F.col("cached"))
        return [r.pos for r in frame.filter("is_skipped").orderBy("pos").collect()]

    assert skipped("429", "429", "429", "429", "429") == [4, 5]
    assert skipped("429", "429", "cached", "429", "detail") == [5]
    assert skipped("429", "429", "ok", "429", "429") == []


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_numbering_over_chunks(rows, chunk_rows):
    data = [(("hot", "b")[i % 5 == 0], i * 3) for i in range(50)]
    frame = number_rows(rows("org string, pos bigint", *data), "org", ["pos"], chunk_of(F.col("pos"), chunk_rows), total="n")
    found = {(r.org, r.pos): (r.job_index, r.n) for r in frame.collect()}
    for org in ("hot", "b"):
        ordered = sorted(p for o, p in data if o == org)
        assert [found[org, p] for p in ordered] == [(i, len(ordered)) for i in range(1, len(ordered) + 1)]


def test_numbering_over_range_chunks(rows):
    data = [("hot" if i % 4 else "b", (i * 7919) % 1000, i) for i in range(300)]
    ranged = range_chunks(rows("org string, at bigint, id bigint", *data), "org", ["at", "id"])
    found = {r.id: r.job_index for r in number_rows(ranged, "org", ["at", "id"], F.col("chunk")).collect()}
    for org in ("hot", "b"):
        ordered = [i for o, a, i in sorted(data) if o == org]
        assert [found[i] for i in ordered] == list(range(1, len(ordered) + 1))


def test_dedupe_keeps_the_first_usable_row(rows):
    frame = rows(
        "org string, pos int, url string, title string, extra string",
        ("o", 3, "u", "third", "c"), ("o", 1, " u ", " ", "a"), ("o", 2, "u\n", " second ", "b"), ("o", 4, "", "x", "d"),
        ("p", 1, "u", "other", "e"),
    )
    for parts in (1, 4):
        found = dedupe_listings(frame.repartition(parts), ["org"], ["pos"]).collect()
        assert {tuple(r) for r in found} == {("o", 2, "u", "second", "b"), ("p", 1, "u", "other", "e")}


def test_rule_flags(rows, spark):
    many = [f"n{i}" for i in range(600)]
    given = {"browser_domains": ["example.org", "b", *many], "browser_orgs": ["X"], "table_domains": [""]}
    rules = rules_frame(spark, given)
    frame = rows("id int, host string", (1, "jobs.example.org"), (2, "abc"), (3, "x"), (4, ""), (5, None))
    inside = flag_inside(frame, F.col("host"), rules, "browser_domains", "hit")
    assert {r.id for r in inside.filter("hit").collect()} == {1, 2} and inside.count() == 5
    equal = flag_equal(frame, F.upper("host"), rules, "browser_orgs", "hit")
    assert {r.id for r in equal.filter("hit").collect()} == {3} and equal.count() == 5
    blank = flag_inside(frame, F.col("host"), rules, "table_domains", "hit")
    assert {r.id for r in blank.filter("hit").collect()} == {1, 2, 3, 4} and blank.count() == 5
    none = flag_inside(frame, F.col("host"), rules, "app_json_domains", "hit")
    assert none.filter("hit").count() == 0 and none.count() == 5
    with pytest.raises(ValueError):
        rules_frame(spark, {"other": ["x"]})


def state_row(spark, *values):
    rows = [{**{f.name: None for f in STATE.fields}, **v} for v in values]
    return spark.createDataFrame([tuple(r[f.name] for f in STATE.fields) for r in rows], STATE)


LISTING = "org_abbrev string, org_name string, job_index bigint, total_jobs bigint, title string, url string, description string, error string"


def read_all(frame):
    limited = F.col("error").startswith("429")
    res = F.when(limited, result("error", "", "", "blocked_source", "http_429", "http")).when(
        F.col("error") != "", result("error", "", "", "error", "fetch_error", "http")
    ).otherwise(result("html", F.lit("new text"), "", "ok", "", "http"))
    return frame.withColumns({"res": res, "fetch_seconds": F.lit(0.1)})


def test_reuse_takes_the_last_finished_row(spark, rows):
    prior = state_row(
        spark,
        {"org_abbrev": "O", "url": "u", "enrich_status": "ok", "index": 1, "title": "first"},
        {"org_abbrev": "O", "url": "u", "enrich_status": "pdf", "index": 2, "title": "last"},
        {"org_abbrev": "O", "url": "v", "enrich_status": "error", "content_type": "html", "index": 3},
        {"org_abbrev": "O", "url": "", "enrich_status": "ok", "index": 4},
        {"org_abbrev": "P", "url": "w", "enrich_status": "ok", "index": 5},
    )
    listed = rows(
        "org_abbrev string, job_index bigint, url string", ("O", 1, " u "), ("O", 2, "v"), ("O", 3, ""), ("O", 4, "w"), ("O", 5, None)
    )
    found = {r.job_index: r.prior and r.prior.title for r in with_prior(listed, prior).collect()}
    assert found == {1: "last", 2: None, 3: None, 4: None, 5: None}
    assert {r.job_index for r in work_list(listed, prior).collect()} == {2, 3, 4, 5}
    assert work_list(listed, prior, force=True).count() == 5


def test_collect_prefers_listing_detail_but_not_after_the_breaker(spark, rows):
    detail = "word " * 70
    listed = rows(
        LISTING,
        ("T", "Trusted", 1, 6, "a", "u1", detail, ""),
        ("T", "Trusted", 2, 6, "b", "u2", "too short", "429"),
        ("T", "Trusted", 3, 6, "c", "u3", "", "429"),
        ("T", "Trusted", 4, 6, "d", "u4", "", "429"),
        ("T", "Trusted", 5, 6, "e", "u5", detail, ""),
        ("N", "Not trusted", 1, 1, "f", "u6", detail, ""),
    )
    rules = rules_frame(spark, {"trusted_detail_orgs": ["T"]})
    done = {(r.org_abbrev, r["index"]): r for r in postings_of(collect_outcomes(listed, rules, read_all)).collect()}
    assert done["T", 1].fetch_method == "scraper" and done["T", 1].description == detail.strip()
    assert [done["T", i].status_reason for i in (2, 3, 4)] == ["http_429"] * 3
    assert (done["T", 5].status_reason, done["T", 5].description) == ("org_rate_limited_skip", "")
    assert (done["N", 1].fetch_method, done["N", 1].description) == ("http", "new text")


def test_enrichment_keeps_reused_rows_whole_and_failures_partly(spark, rows):
    prior = state_row(
        spark,
        {"org_abbrev": "O", "url": "u1", "enrich_status": "ok", "index": 9, "title": "old title", "description": "old",
         "content_type": "html", "extras": {"grade": "P4"}, "fetch_seconds": 3.0, "enriched_at": "then"},
    )
    listed = rows(
        LISTING,
        ("O", "Org", 1, 3, "new title", "u1", "", ""),
        ("O", "Org", 2, 3, "b", "u2", "listed text", "boom"),
        ("O", "Org", 3, 3, "c", "u3", "listed text", ""),
    )
    outcomes = enrich_outcomes(listed, prior, rules_frame(spark, {}), read_all)
    state = {r["index"]: r for r in new_state(outcomes, F.lit(NOW)).collect()}
    assert (state[1].title, state[1].description, state[1].extras, state[1].enriched_at) == ("old title", "old", {"grade": "P4"}, "then")
    assert (state[2].content_type, state[2].description, state[2].enrich_error) == ("error", "listed text", "boom")
    assert (state[3].content_type, state[3].description, state[3].enrich_error) == ("html", "new text", "")
    assert state[3].enriched_at == "2026-01-02T03:04:05.000000+00:00"
    forced = enrich_outcomes(listed, prior, rules_frame(spark, {}), read_all, force=True, max_jobs=1)
    assert [r.description for r in new_state(forced, F.lit(NOW)).collect()] == ["new text"]


def orgs_frame(spark, *orgs):
    return spark.createDataFrame([(o,) for o in orgs], "org_abbrev string")


def test_state_snapshots(spark, tmp_path):
    home = str(tmp_path / "state")
    assert read_state(spark, home).count() == 0
    write_state(state_row(spark, {"org_abbrev": "A", "index": 1}, {"org_abbrev": "B", "index": 1}), home, orgs_frame(spark, "A", "B"))
    write_state(state_row(spark, {"org_abbrev": "A", "index": 7}), home, orgs_frame(spark, "A"))
    assert {(r.org_abbrev, r["index"]) for r in read_state(spark, home).collect()} == {("A", 7), ("B", 1)}
    assert read_state(spark, home, ["B"]).count() == 1
    write_state(state_row(spark, {"org_abbrev": "A", "index": 8}), home, orgs_frame(spark, "A", "B"))
    assert {(r.org_abbrev, r["index"]) for r in read_state(spark, home).collect()} == {("A", 8)}
    write_state(state_row(spark), home, orgs_frame(spark, "A"))
    assert read_state(spark, home).count() == 0


def test_state_writes_touched_folders_only(spark, tmp_path):
    home = str(tmp_path / "state")
    names = [f"O{k}" for k in range(40)]
    write_state(state_row(spark, *({"org_abbrev": n, "index": k} for k, n in enumerate(names))), home, orgs_frame(spark, *names), buckets=16)
    buckets, before = state_folders(spark, home)
    assert buckets == 16 and len(before) > 8
    earlier = read_state(spark, home)
    # the stored number of buckets holds, whatever is asked for
    path = write_state(state_row(spark, {"org_abbrev": "O3", "index": 99}), home, orgs_frame(spark, "O3"), buckets=4)
    buckets, after = state_folders(spark, home)
    changed = {b for b in before if after[b] != before[b]}
    assert buckets == 16 and set(after) == set(before) and len(changed) == 1
    assert sorted(p for p in os.listdir(path) if p.startswith("org_bucket=")) == [f"org_bucket={b}" for b in changed]
    want = {(n, k) for k, n in enumerate(names)}
    assert {(r.org_abbrev, r["index"]) for r in earlier.collect()} == want  # a plan over the older snapshot still reads it
    assert {(r.org_abbrev, r["index"]) for r in read_state(spark, home).collect()} == want - {("O3", 3)} | {("O3", 99)}


@pytest.mark.parametrize("lines", [1, 3, 7, 1000])
def test_event_log_is_in_order(spark, rows, tmp_path, lines):
    pick = random.Random(lines)
    given = [(org, seq, step, f"e{step}") for org, n in (("b", 5), ("a", 9), ("hot", 30), ("c", 1)) for seq in range(-1, n) for step in range(2)]
    pick.shuffle(given)
    schema = "org_abbrev string, seq bigint, step int, event string"
    events = rows(schema, *given).repartition(5)
    for name in EVENT.fieldNames():
        if name not in events.columns:
            events = events.withColumn(name, F.col("seq") if name == "job_index" else F.lit(None).cast(EVENT[name].dataType))
    path = append_events(events, str(tmp_path), "run", lines)
    found = []
    for file in sorted(f for f in os.listdir(path) if f.startswith("part-")):
        with open(f"{path}/{file}") as body:
            own = [json.loads(line) for line in body]
        assert len(own) <= lines
        found += [(e["org_abbrev"], e["job_index"], e["event"]) for e in own]
    assert found == [(org, seq, event) for org, seq, _, event in sorted(given)]


def test_reuse_index_over_several_runs(spark, rows, tmp_path):
    home = str(tmp_path / "index")
    done = {"enrich_status": "ok", "content_type": "html"}

    def state(*values):
        return state_row(spark, *({**done, "org_abbrev": o, "url": u, "index": i, "description": d} for o, u, i, d in values))

    def stored():
        return {(r.org_abbrev, r.url): r.prior.description for r in read_reuse(spark, home).collect()}

    listed = rows("org_abbrev string, job_index bigint, url string", ("A", 1, " u1 "), ("A", 2, ""), ("A", 3, None), ("B", 1, "u1"), ("A", 4, "u9"))
    assert with_stored_prior(listed, home).filter("prior is not null").count() == 0
    append_reuse(state(("A", "u1", 1, "first"), ("A", "u1", 5, "last"), ("A", "u2", 2, "two"), ("A", "", 3, "no address"), ("B", "u1", 1, "b")), orgs_frame(spark, "A", "B"), home, buckets=4)
    assert stored() == {("A", "u1"): "last", ("A", "u2"): "two", ("B", "u1"): "b"}
    append_reuse(state(("A", "u1", 1, "again")), orgs_frame(spark, "A", "C"), home, buckets=9)
    assert stored() == {("A", "u1"): "again", ("B", "u1"): "b"}  # u2 is gone, B did not run
    found = {(r.org_abbrev, r.job_index): r.prior and r.prior.description for r in with_stored_prior(listed, home).collect()}
    assert found == {("A", 1): "again", ("A", 2): None, ("A", 3): None, ("A", 4): None, ("B", 1): "b"}
    append_reuse(state(("A", "u2", 1, "back")), orgs_frame(spark, "A"), home)
    assert stored() == {("A", "u2"): "back", ("B", "u1"): "b"}


def test_reuse_index_shuffles_listings_only(spark, rows, tmp_path):
    home = str(tmp_path / "index")
    values = [{"org_abbrev": "A", "url": f"u{k}", "index": k, "enrich_status": "ok"} for k in range(20)]
    append_reuse(state_row(spark, *values), orgs_frame(spark, "A"), home, buckets=8)
    listed = rows("org_abbrev string, job_index bigint, url string", *(("A", k, f"u{k}") for k in range(30)))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = with_stored_prior(listed, home)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan


GATES = {"defaults": {"min_words": 50, "max_words": 10000, "max_fetch_seconds_per_job": 10.0}, "org_overrides": {}}
TODAY = dt.date(2026, 2, 13)
JOB = ("index", "url", "fetch_seconds", "content_type", "enrich_status", "description", "pdf_path")


def messages(rows, jobs, gates=GATES, org="X", error=""):
    orgs = rows("org_abbrev string, scraper_error string", (org, error))
    schema = "org_abbrev string, index bigint, url string, fetch_seconds double, content_type string, enrich_status string, description string, pdf_path string"
    data = [(org, *[job.get(name, "") for name in JOB]) for job in jobs]
    found = violations(orgs, rows(schema, *data), overrides_frame(orgs.sparkSession, gates), gates["defaults"], F.lit(TODAY))
    return [r.line[2:] for r in rendered(found).collect()]


def job(i, text="word " * 60, **more):
    return {"index": i, "url": f"https://a/{i}", "fetch_seconds": 1.0, "enrich_status": "ok", "description": text, **more}


def test_gates_expired_override(rows):
    gates = {**GATES, "org_overrides": {"X": {"reason": "Known outage", "expires_on": "2025-12-31"}}}
    assert messages(rows, [], gates) == [
        "X: override expired on 2025-12-31 (reason=Known outage)",
        "X: returned 0 jobs (< 1)",
    ]
    gates = {**GATES, "org_overrides": {"X": {"allow_empty": True, "expires_on": dt.date(2026, 2, 13)}}}
    assert messages(rows, [], gates) == []
    gates = {**GATES, "org_overrides": {"X": {"allow_empty": True, "expires_on": "31.12.2025"}}}
    assert messages(rows, [], gates) == ["X: invalid override expires_on '31.12.2025'"]


def test_gates_identical_lengths(rows):
    same = "X: all successful descriptions share identical length (60 words)"
    assert messages(rows, [job(1), job(2), job(3)]) == [same]
    assert messages(rows, [job(1), job(2)]) == []
    assert messages(rows, [job(1), job(2), job(3, "word " * 61)]) == []


def test_gates_bounds_and_time(rows):
    assert messages(rows, [job(1, "tiny text", fetch_seconds=12.5)], error="broke") == [
        "X: scraper_error present: broke",
        "X: job #1 word_count=2 out of bounds [50, 10000] url=https://a/1",
        "X: job #1 fetch_seconds=12.500 > 10.000 url=https://a/1",
    ]
    assert messages(rows, [job(1, "tiny", url=" ", fetch_seconds=99.0)]) == [
        "X: job #1 word_count=1 out of bounds [50, 10000] url= "
    ]


def test_gates_skip_word_checks_for_pdf_organisations(rows):
    jobs = [job(1), job(2), job(3), job(4, "", content_type="pdf", enrich_status="pdf", pdf_path="pdfs/X/t.pdf")]
    assert messages(rows, jobs) == []


def test_gates_without_organisations(rows, spark):
    orgs = rows("org_abbrev string, scraper_error string")
    jobs = rows("org_abbrev string, index bigint, url string, fetch_seconds double, content_type string, enrich_status string, description string, pdf_path string")
    found = violations(orgs, jobs, overrides_frame(spark, GATES), {}, F.lit(TODAY))
    assert [r.message for r in found.collect()] == ["payload: missing non-empty 'orgs' list"]


def test_gates_from_yaml(tmp_path, spark):
    path = tmp_path / "gates.yaml"
    path.write_text("defaults:\n  min_words: 50\norg_overrides:\n  X:\n    max_words: 10\n    expires_on: 2026-01-01\n")
    gates = load_gates(str(path))
    assert gates["defaults"] == {"min_words": 50}
    row = overrides_frame(spark, gates).first()
    assert (row.org_abbrev, row.max_words, row.min_words, row.expires_on) == ("X", 10, None, "2026-01-01")
    path.write_text("org_overrides:\n  {}\n")
    assert load_gates(str(path)) == {"defaults": {}, "org_overrides": {}}


def test_report_picks_ok_or_the_first_status(rows):
    orgs = rows("org_abbrev string, scraper_error string", ("A", ""), ("B", "down"), ("C", ""), ("D", ""))
    schema = "org_abbrev string, index bigint, enrich_status string, description string, error string"
    jobs = rows(
        schema,
        ("A", 2, "error", "", "late"), ("A", 1, "pdf", "", ""), ("A", 3, "error", "abc", "later"),
        ("B", 1, "ok", "abcd", ""), ("D", 1, "error", "", "x"), ("D", 2, "ok", "é" * 5, ""),
    )
    found = {r.org: tuple(r)[1:] for r in org_report(orgs, jobs).collect()}
    assert found == {
        "A": ("ok", "pdf", 3, "", "late"),
        "B": ("error", "skipped", 0, "down", ""),
        "C": ("empty", "skipped", 0, "", ""),
        "D": ("ok", "ok", 5, "", "x"),
    }


def lines_of(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_artifacts_round_trip(spark, rows, tmp_path):
    orgs = rows(
        "org_abbrev string, org_name string, scraper_file string, is_playwright_scraper boolean, scraper_error string",
        ("abc", "Org", "s.py", False, ""), ("", "Nameless", "t.py", True, "down"),
    )
    jobs = rows(
        "org_abbrev string, index bigint, title string, url string, content_type string, enrich_status string, status_reason string, "
        "fetch_method string, description string, pdf_path string, fetch_seconds double, error string",
        *[("abc", i, f"t{i}", "", "html", "ok", "", "http", "x\ny", "", 2.0, "") for i in (3, 1, 2)],
    )
    runs = str(tmp_path)
    path = write_postings(orgs, jobs, runs, "run-1", rows=2)
    blocks = read_org_blocks(spark, runs, "run-1")
    found = {(r.org_abbrev, r.block): [j["index"] for j in r.jobs] for r in blocks.collect()}
    assert found == {("abc", 0): [1, 2], ("abc", 1): [3], ("", 0): []}
    assert bad_fields(spark.read.text(path).select("value")).count() == 0
    with pytest.raises(FileNotFoundError):
        read_org_blocks(spark, runs, "run-2")
    report = org_report(orgs, jobs)
    write_report(report, ["ABC", ""], runs, "run-1", 0, "now")
    lines = lines_of(spark, f"{runs}/run-1/report.md")
    assert "| abc | ok | ok | 3 |  |" in lines and "|  | error | skipped | 0 | down |" in lines
    assert json.loads(lines_of(spark, f"{runs}/run-1/report.json/header")[0])["orgs"] == ["ABC", ""]


def test_artifact_faults(spark):
    good = {name: "x" for name in ("org_abbrev", "org_name", "scraper_file", "scraper_error")}
    blocks = [
        {**good, "is_playwright_scraper": True, "jobs": [{"index": 1, "title": "t", "url": "", "content_type": "", "enrich_status": "",
         "status_reason": "", "description": "", "pdf_path": "", "fetch_seconds": 3, "error": ""}]},
        {**good, "org_name": 5, "jobs": [{"index": 1.5}]},
    ]
    frame = spark.createDataFrame([(json.dumps(b),) for b in blocks], "value string")
    found = {(r.job_pos, r.field, r.found) for r in bad_fields(frame).collect()}
    assert (None, "org_name", "INTEGER") in found and (None, "is_playwright_scraper", "MISSING") in found
    assert (0, "index", "NUMBER") in found and (0, "title", "MISSING") in found and len(found) == 12
    assert ORG_BLOCK.fieldNames()[0] == "org_abbrev"


def test_registry(spark, rows):
    standard = registry_frame(spark, {"a.py": ("Alpha [AL]", "u1"), "b.py": ("Beta house", "u2")}, False)
    browser = registry_frame(spark, {"a.py": ("Alpha two [AL]", "u3"), "c.py": ("Gamma [BETA HOUSE]", "u4")}, True)
    merged = {r.scraper_file: (r.listing_url, r.is_playwright, r.org_abbrev) for r in merge_registries(standard, browser).collect()}
    assert merged == {"a.py": ("u3", True, "AL"), "b.py": ("u2", False, "BETA"), "c.py": ("u4", True, "BETA HOUSE")}
    asked = rows("org_pos int, org string", (1, "al"), (2, " beta house "), (3, "beta"))
    found = {r.org_pos: (r.listing_url, r.is_known) for r in find_orgs(asked, standard, browser).collect()}
    assert found == {1: ("u1", True), 2: ("u4", True), 3: (None, False)}


def test_search_pages(rows):
    schema = "source_id string, page_no bigint, body string"

    def facet(*jobs, total=40):
        return json.dumps({"total": total, "jobPostings": list(jobs)})

    pages = rows(
        schema,
        ("s", 1, facet({"title": "One", "externalPath": "job/1", "locationsText": "Rome"}, {"title": "Two"})),
        ("s", 2, facet({"title": "Three", "externalPath": "/Ext/job/3"})),
        ("s", 3, facet({"title": "Beyond the total"})),
        ("broken", 1, "<html>"), ("list", 1, "[1]"),
    )
    found = facet_listings(pages, F.lit("https://h"), F.lit("https://h/wday/cxs/t/Ext/jobs")).orderBy("page_no", "pos").collect()
    assert [(r.title, r.url, r.location) for r in found] == [
        ("One", "https://h/Ext/job/1", "Rome"), ("Two", "https://h/Ext", ""), ("Three", "https://h/Ext/job/3", ""),
    ]
    entry = {"contestNo": "9", "column": ["Title", '["Rome"]']}
    pages = rows(schema, ("s", 1, json.dumps({"requisitionList": [entry, entry]})), ("s", 2, json.dumps({"requisitionList": [entry]})))
    found = table_listings(pages, F.lit("https://h"), F.lit("ext"), {0: "title", 1: "place", 2: "grade"}, {1}, True).collect()
    assert [(r.title, r.place, r.grade, r.job_number) for r in found] == [("Title", "Rome", "", "9")]
    assert found[0].url == "https://h/careersection/ext/jobdetail.ftl?job=9"
    # without a total a source ends after its first page
    assert table_listings(pages, F.lit("https://h"), F.lit("ext"), {0: "title"}).count() == 2

    def listed(total, *numbers):
        return json.dumps({"requisitionList": [{"contestNo": n, "column": []} for n in numbers], "pagingData": {"totalCount": total}})

    pages = rows(
        schema,
        ("total", 1, listed(3, "1", "2")), ("total", 2, listed(3, "3")), ("total", 3, listed(3, "4")),
        ("stale", 1, listed(9, "1")), ("stale", 2, listed(9, "1")), ("stale", 3, listed(9, "2")),
        ("broken", 1, listed(9, "1")), ("broken", 2, "<html>"), ("broken", 3, listed(9, "2")),
    )
    for once, expected in ((True, {"total": "123", "stale": "1", "broken": "1"}), (False, {"total": "123", "stale": "112", "broken": "1"})):
        found = table_listings(pages, F.lit("https://h"), F.lit("ext"), {}, deduplicate=once).collect()
        by = {s: "".join(sorted(r.job_number for r in found if r.source_id == s)) for s in expected}
        assert by == expected
    pages = rows(schema, ("s", 1, json.dumps({"results": [{"title": "A", "id": 5}]})), ("s", 2, json.dumps({"results": [{"title": "B"}]})))
    found = simple_listings(pages, F.lit("https://example.com")).collect()
    assert [(r.title, r.url, r.location) for r in found] == [("A", "https://example.com/jobs/5", "")]


def test_unreadable_search_pages_fail_their_source(rows):
    """An unreadable page on the way is a failure, an empty one or one behind the end is not."""

    def listed(total, *numbers):
        return json.dumps({"requisitionList": [{"contestNo": n, "column": []} for n in numbers], "pagingData": {"totalCount": total}})

    schema = "source_id string, page_no bigint, body string"
    pages = rows(
        schema,
        ("html", 1, listed(9, "1")), ("html", 2, "<html>"), ("html", 3, listed(9, "2")), ("html", 4, "<html>"),
        ("cut", 1, listed(9, "1", "2")[:40]), ("null", 1, None), ("array", 1, "[1]"), ("blank", 1, ""), ("text", 1, '"x"'),
        ("empty", 1, listed(9, "1")), ("empty", 2, listed(9)), ("empty", 3, "<html>"), ("none", 1, "{}"),
        ("done", 1, listed(1, "1")), ("done", 2, "<html>"),
    )
    expected = {"html": 2, "cut": 1, "null": 1, "array": 1, "blank": 1, "text": 1}
    for once in (True, False):
        assert {r.source_id: r.page_no for r in table_failures(pages, once).collect() if r.reason} == expected
    registry = rows("org_abbrev string, org_name string, scraper_file string, is_playwright boolean", *[(o, o, "a.py", False) for o in ("html", "empty")])
    orgs = org_rows(registry, failed_orgs(table_failures(pages)))
    assert {r.org_abbrev: r.scraper_error for r in orgs.collect()} == {"html": "page 2: not a JSON object", "empty": ""}
    kept = table_listings(pages, F.lit("https://h"), F.lit("ext"), {}).withColumnRenamed("source_id", "org_abbrev")
    assert {r.org_abbrev for r in drop_failed(kept, orgs).collect()} == {"empty", "done"}

    def results(n):
        return json.dumps({"results": [{"title": "A", "id": i} for i in range(n)]})

    pages = rows(schema, ("html", 1, results(2)), ("html", 2, "<html>"), ("short", 1, results(1)), ("short", 2, "<html>"), ("empty", 1, results(0)))
    assert [(r.source_id, r.page_no) for r in simple_failures(pages, 2).collect()] == [("html", 2)]


ATTEMPT = "org_abbrev string, job_index bigint, is_limited boolean, is_cached boolean"


@pytest.mark.parametrize("seed", range(2))
def test_streamed_breaker_carries_its_state(spark, rows, tmp_path, seed):
    attempts, read = random_attempts(seed, 150), []
    for portion in range(3):
        part = [a for a in attempts if min(a[1] // 12, 2) == portion]
        rows(ATTEMPT, *part).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(ATTEMPT).parquet(f"{tmp_path}/in")
        read.append(run_breaker(stream, f"{tmp_path}/out", f"{tmp_path}/c") == len(part))
    assert read == [True, True, True]  # no attempt is read twice
    openings = spark.read.schema(OPENING).parquet(f"{tmp_path}/out")
    out = with_openings(rows(ATTEMPT, *attempts), openings)
    assert out.count() == len(attempts)
    assert {(r.org_abbrev, r.job_index) for r in out.filter("is_skipped").collect()} == brute_breaker(attempts)
    # the same as the breaker over all rows at once
    whole = with_breaker(rows(ATTEMPT, *attempts), "org_abbrev", "job_index", F.col("is_limited"), chunk_of(F.col("job_index"), 5), F.col("is_cached"))
    assert sorted(map(tuple, openings.collect())) == sorted({(r.org_abbrev, r.open_at) for r in whole.collect() if r.open_at is not None})


def test_organisations_share_the_state_of_their_bucket(spark, rows, tmp_path):
    found = set()
    for batch in range(3):
        part = [(f"o{k}" if k else None, batch + 1, k % 3 > 0, False) for k in range(90)]
        rows(ATTEMPT, *part).write.mode("append").parquet(f"{tmp_path}/in")
        stream = breaker_openings(spark.readStream.schema(ATTEMPT).parquet(f"{tmp_path}/in"), 3, buckets=4)
        writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/c")
        running = writer.trigger(availableNow=True).start(f"{tmp_path}/out")
        running.awaitTermination()
        assert 0 < max(p.stateOperators[0].numRowsTotal for p in running.recentProgress) <= 4
        found = {tuple(r) for r in spark.read.schema(OPENING).parquet(f"{tmp_path}/out").collect()}
        assert batch == 2 or not found
    assert found == {(f"o{k}", 3) for k in range(90) if k % 3 > 0}


def test_idle_breaker_state_expires(spark, rows, tmp_path):
    def land(name, *attempts):
        rows(ATTEMPT, *attempts).write.mode("append").parquet(f"{tmp_path}/{name}")
        return spark.readStream.schema(ATTEMPT).parquet(f"{tmp_path}/{name}")

    for name, idle in (("kept", None), ("idle", 1)):
        for k in range(3):
            run_breaker(land(name, ("a", k + 1, True, False)), f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-c", idle=idle)
    found = {n: spark.read.schema(OPENING).parquet(f"{tmp_path}/{n}-out").collect() for n in ("kept", "idle")}
    assert [tuple(r) for r in found["kept"]] == [("a", 3)] and found["idle"] == []


def test_a_hot_organisation_enters_the_state_as_runs(spark):
    attempts = spark.range(1, 100_001, 1, 4).select(
        F.lit("hot").alias("org_abbrev"), F.col("id").alias("job_index"), (F.col("id") % 50_000 < 2).alias("is_limited"), (F.col("id") % 7 == 0).alias("is_cached")
    )
    found = limited_runs(attempts)
    live = attempts.filter("is_limited and not is_cached").count()
    assert found.count() < 100_000 / 100 and found.agg(F.sum("hits")).first()[0] == live


def test_violation_file_and_run_id(spark, rows, tmp_path):
    found = rows("org_abbrev string, rule_seq int, job_index bigint, message string", ("b", 1, None, "b: x"), ("a", 1, None, "a: y"))
    assert lines_of(spark, write_violations(found, f"{tmp_path}/v")) == ["- a: y", "- b: x"]
    import re

    assert re.fullmatch(r"org-x-\d{8}T\d{6}Z-[0-9a-f]{8}", new_run_id("org-x"))


COUNTED = "event string, org_abbrev string, enrich_status string, word_count bigint, duration_seconds double"


def test_live_counters_are_folded(spark, rows, tmp_path):
    home, every = str(tmp_path), []
    for batch in range(7):
        part = [("job_result", f"o{(batch + k) % 4}", "ok", batch, 0.5) for k in range(batch % 3 + 1)]
        every += part
        rows(COUNTED, *part).write.mode("append").parquet(f"{home}/in")
        stream = spark.readStream.schema(COUNTED).parquet(f"{home}/in")
        write_counters(org_counters(stream), f"{home}/out", f"{home}/c", keep=3)
        found = {(r.org_abbrev, r.jobs, r.words) for r in latest_counters(spark, f"{home}/out").collect()}
        want = {}
        for _, org, _, words, _ in every:
            jobs, total = want.get(org, (0, 0))
            want[org] = (jobs + 1, total + words)
        assert found == {(org, *counts) for org, counts in want.items()}
        assert len([f for f in os.listdir(f"{home}/out/changes") if f.startswith("batch=")]) < 3
    assert len([f for f in os.listdir(f"{home}/out/whole") if f.startswith("batch=")]) == 1
    assert latest_counters(spark, f"{home}/none").count() == 0


def test_late_listings_are_found(spark, rows, tmp_path):
    schema = "org_abbrev string, job_index bigint, url string, ts timestamp"
    at = lambda hour: dt.datetime(2026, 1, 1) + dt.timedelta(hours=hour)
    batches = [
        [("A", 1, "u1", at(0)), ("A", 2, "", at(1)), ("A", 3, "done", at(1))],
        [("A", 4, "u2", at(50)), ("A", 5, " u1", at(50))],
        [("A", 6, "u9", at(2)), ("A", 7, "u9", at(1)), ("A", 8, "", at(2)), ("A", 9, "u2", at(2)), ("A", 10, "done", at(0)), ("B", 1, "u3", at(60))],
    ]
    prior = rows("org_abbrev string, url string, enrich_status string, content_type string", ("A", "done", "ok", "html"))
    for batch in batches:
        rows(schema, *batch).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        append_stream(new_listings(stream, prior, "ts", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/c")
    passed = spark.read.parquet(f"{tmp_path}/out").select("org_abbrev", "url", "job_index")
    assert {(r.org_abbrev, r.job_index) for r in passed.collect()} >= {("A", 1), ("A", 2), ("A", 4), ("B", 1)}
    late = late_listings(spark.read.parquet(f"{tmp_path}/in"), prior, passed, "ts")
    assert {(r.org_abbrev, r.job_index) for r in late.collect()} == {("A", 7), ("A", 8)}


def test_run_totals_come_from_the_write(spark, rows, tmp_path):
    orgs = rows("org_abbrev string, org_name string, scraper_file string, is_playwright_scraper boolean, scraper_error string", ("a", "A", "f", False, ""), ("b", "B", "f", False, "down"))
    schema = "org_abbrev string, index bigint, title string, url string, content_type string, enrich_status string, status_reason string, fetch_method string, description string, pdf_path string, fetch_seconds double, error string"
    posted = rows(schema, ("a", 1, "t", "u", "html", "ok", "", "http", "abc", "", 1.5, ""), ("a", 2, "t", "v", "error", "error", "", "http", "", "", 4.0, "gone"))
    counted = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    posted = posted.mapInArrow(watch, posted.schema)
    check = lambda orgs, written: violations(orgs, written, overrides_frame(spark, GATES), GATES["defaults"], F.lit(TODAY))
    totals = write_run(orgs, posted, str(tmp_path), "r1", ["a", "b"], "now", check)
    assert counted.value == 2  # the postings are computed once
    assert totals["violations"] > 0 and totals.pop("violations") and totals.pop("exit_code") == 1
    assert totals == {"jobs": 2, "ok_jobs": 1, "pdf_jobs": 0, "failed_jobs": 1, "description_chars": 3, "slowest_seconds": 4.0}
    assert "| a | ok | ok | 3 | gone |" in lines_of(spark, f"{tmp_path}/r1/report.md")
    assert json.loads(lines_of(spark, f"{tmp_path}/r1/report.json/header")[0])["test_exit_code"] == 1
    assert write_run(orgs, posted, str(tmp_path), "r2", ["a"], "now")["exit_code"] == 0
