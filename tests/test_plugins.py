"""Plug-ins that fail, and marker tables, on hand-made rows."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postmill.operators.markers import _Searcher, marker_scores
from postmill.plans.collect import failed_orgs, org_rows
from postmill.plans.plugins import Plugin, first_orgs, number_listings, plugin_function, run_plugins

# The plug-ins below travel with the task: workers can't import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGE = "org_abbrev string, page_no bigint, extractor string, body string"


def lines(page):
    for line in page["body"].split("\n"):
        if line == "boom":
            raise KeyError("boom")
        yield {"title": line, "url": f"https://x/{page['page_no']}/{line}"}


def words(page):
    return [{"title": w, "url": "https://w", "letters": len(w)} for w in page["body"].split()]


PLUGINS = {"lines": Plugin(lines), "words": Plugin(words, "title string, url string, letters int")}


@pytest.mark.parametrize("part_pages", [1, 2, 1000])
def test_plugins(spark, rows, part_pages):
    pages = rows(
        PAGE,
        ("A", 1, "lines", "a\nb"), ("A", 2, "lines", "c\n \n"),
        ("B", 1, "lines", "a"), ("B", 4, "lines", "a\nboom"), ("B", 3, "lines", "boom"), ("B", 2, "lines", "z"),
        ("C", 1, "words", "one three"), ("D", 1, "gone", "x"), ("E", 1, None, "x"), ("F", 1, "words", ""),
    )
    listings, failures = run_plugins(pages, PLUGINS, part_pages)
    found = sorted((r.org_abbrev, r.page_no, r.pos, r.title, r.letters) for r in listings.collect())
    assert found == [("A", 1, 0, "a", None), ("A", 1, 1, "b", None), ("A", 2, 0, "c", None), ("C", 1, 0, "one", 3), ("C", 1, 1, "three", 5)]
    reasons = {r.source_id: (r.page_no, r.reason) for r in failures.collect()}
    assert reasons == {"B": (3, "KeyError: 'boom'"), "D": (1, "no plug-in gone"), "E": (1, "no plug-in named")}
    numbered = {(r.org_abbrev, r.title): (r.job_index, r.total_jobs) for r in number_listings(listings, part_pages).collect()}
    assert numbered[("A", "c")] == (3, 3) and numbered[("C", "one")] == (1, 2)
    registry = rows("org_abbrev string, org_name string, scraper_file string, is_playwright boolean, reg_pos int", *((o, o, "f", False, k) for k, o in enumerate("ABCDEF")))
    errors = {r.org_abbrev: r.scraper_error for r in org_rows(first_orgs(registry, 4), failed_orgs(failures)).collect()}
    assert errors == {"A": "", "B": "page 3: KeyError: 'boom'", "C": "", "D": "page 1: no plug-in gone"}


def test_plugin_columns_follow_the_plugin(rows):
    pages = rows(PAGE + ", part bigint", ("A", 1, "words", "one", 0))
    function = plugin_function(PLUGINS)
    assert function(pages.asTable(), F.lit("words")).columns == ["org_abbrev", "page_no", "pos", "title", "url", "letters", "error"]
    assert function(pages.asTable(), F.lit("lines")).columns == ["org_abbrev", "page_no", "pos", "title", "url", "error"]
    with pytest.raises(AnalysisException, match="no plug-in"):
        function(pages.asTable(), F.lit("other")).collect()


def test_first_orgs(rows):
    registry = rows("org_abbrev string, reg_pos int", ("c", 2), ("a", 0), ("b", 1))
    assert [r.org_abbrev for r in first_orgs(registry, 2).collect()] == ["a", "b"]
    assert first_orgs(registry, None).count() == first_orgs(registry, 0).count() == first_orgs(registry, -1).count() == 3


@pytest.mark.parametrize("automaton_bytes", [1 << 20, 1000])
def test_marker_scores(spark, automaton_bytes):
    pick = random.Random(2)
    names = ["".join(pick.choice("abé ") for _ in range(pick.randint(1, 4))) for _ in range(60)]
    markers = [(m, pick.randint(-5, 9)) for m in names] + [("", 4), ("", 1), (None, 7)] + [(names[0], 2)]
    texts = [(k, "".join(pick.choice("abéc ") for _ in range(pick.randint(0, 30)))) for k in range(40)] + [(90, None), (91, "")]
    given = spark.createDataFrame(texts, "id long, text string")
    found = marker_scores(given, spark.createDataFrame(markers, "marker string, weight int"), ["id"], "text", automaton_bytes)
    expected = {}
    for k, t in texts:
        hit = [w for m, w in markers if m is not None and t is not None and m in t]
        expected[k] = (len(hit), sum(hit))
    assert {r.id: (r.hits, r.score) for r in found.collect()} == expected
    none = marker_scores(given, spark.createDataFrame([], "marker string, weight int"), ["id"], "text")
    assert {(r.hits, r.score) for r in none.collect()} == {(0, 0)}


@pytest.mark.parametrize("prefix, shared", [(1, 1), (2, 3), (3, 100)])
def test_markers_behind_shared_prefixes(prefix, shared):
    pick = random.Random(prefix)
    markers = sorted({"".join(pick.choice("abé") for _ in range(pick.randint(1, 9))) for _ in range(200)}, key=lambda _: pick.random())
    search = _Searcher(markers, prefix, shared)
    for _ in range(50):
        text = "".join(pick.choice("abéc") for _ in range(pick.randint(0, 60)))
        assert {search.markers[k] for k in search.places(text)} == {m for m in markers if m in text}
    assert _Searcher([]).places("abc") == set()


def test_long_markers_take_few_nodes():
    pick = random.Random(0)
    markers = ["".join(pick.choice("abcdefghijklmnop ") for _ in range(60)) for _ in range(2000)]
    assert _Searcher(markers).groups.get_stats()["nodes_count"] <= 12 * len(markers) + 1
