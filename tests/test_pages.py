"""Page parsing, links, PDF choice and description texts on hand-made pages."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postmill.functions.html import html_outline, html_text, node_text
from postmill.operators.listings import frame_links, keyword_links, strict_links
from postmill.operators.page_text import with_leaf_text, with_legacy_text, with_main_text
from postmill.operators.pdf_links import first_pdf_link, with_pdf_candidates, with_pdf_link
from postmill.plans.description import page_facts
from postmill.sources.rules import rules_frame

WORDS = "word " * 60


@pytest.fixture
def page(rows):
    def make(html, url="https://example.org/jobs/123"):
        table = rows("page_id bigint, url string, html string", (1, url, html))
        return table.withColumn("outline", html_outline("html"))

    return make


def main_text(page, html):
    return with_main_text(page(html)).first()["main_text"]


def test_text_of_a_fragment(one):
    html = "<p> a&amp;b &eacute; &#8211; &#150; &unknown; &copy</p><!-- no --><script>no</script><b>x<br>y</b>\n<style>z"
    assert one(html_text(F.lit(html))) == "a&b é – – &unknown ©\nx\ny"


def test_unclosed_paragraphs_nest(page):
    frame = page("<div><p>one<p>two <a href='/x'>three</a></div><a href='/y'>four</a>")
    outline = F.col("outline")
    texts = F.transform(F.col("outline.nodes"), lambda n: node_text(outline, n, "|"))
    assert frame.select(texts.alias("t")).first()["t"] == ["three", "four"]


def test_first_pdf_link(page):
    def link(html):
        return page(html).select(first_pdf_link(F.col("outline"), F.col("url")).alias("v")).first()["v"]

    assert link('<a href="./docs/vacancy.pdf">Download PDF</a>') == "https://example.org/jobs/docs/vacancy.pdf"
    assert link("<html><body><h1>No attachment</h1></body></html>") == ""
    assert link('<a href="/get">Download <b>the PDF</b></a>') == "https://example.org/get"
    assert link('<a href="/get">Download PDF</a><a href="/b.PDF">x</a>') == "https://example.org/b.PDF"
    assert link('<a href="">Download pdf</a>') == "https://example.org/jobs/123"


def candidates(page, html, url="https://example.org/jobs/123"):
    frame = with_pdf_candidates(page(html, url))
    return [tuple(c) for c in frame.first()["pdf_candidates"]]


def test_pdf_candidates_keep_the_raw_text_quirks(page):
    found = candidates(page, '<p>See <a href="docs/a.pdf">the <b>notice</b></a> now</p>')
    assert found == [
        (0, "https://example.org/jobs/docs/a.pdf", "the notice", "See the notice now"),
        (1, "https://example.org/a.pdf", "", ""),
    ]
    found = candidates(page, '<script>{"u":"https:\\/\\/cdn.x\\/b.pdf?1"}</script>', "http://example.org/")
    assert [c[1] for c in found] == ["https://cdn.x/b.pdf?1", "http://cdn.x/b.pdf?1"]
    found = candidates(page, '<a href="/a.pdf">x</a><a href="/a.pdf">y</a><a href="/page">z</a>')
    assert [(c[1], c[2]) for c in found] == [("https://example.org/a.pdf", "x")]


def test_best_pdf_link(page):
    html = (
        '<li><a href="/f/01-data-protection-notice.pdf">Data protection notice</a></li>'
        '<li><a href="/f/vn-08-2026-legal-and-policy-officer_en.pdf">Vacancy notice</a></li>'
        '<li><a href="/Online-Application-Manual-for-Candidates.pdf">Candidate manual</a></li>'
    )
    frame = with_pdf_candidates(page(html))
    picked = with_pdf_link(frame, F.lit("Legal and policy officer"), F.lit(False), "page_id")
    assert picked.first()["pdf_link"] == "https://example.org/f/vn-08-2026-legal-and-policy-officer_en.pdf"


def test_pdf_link_needs_suffix_or_header(page, rows):
    frame = with_pdf_candidates(page('<a href="/assets/22_Vacancy_Notice.pdf?276029">Vacancy notice</a>'))
    assert with_pdf_link(frame, F.lit("x"), F.lit(False), "page_id").first()["pdf_link"] == ""
    url = "https://example.org/assets/22_Vacancy_Notice.pdf?276029"
    headers = rows("url string, content_type_header string", (url, "application/pdf"))
    assert with_pdf_link(frame, F.lit("x"), F.lit(False), "page_id", headers).first()["pdf_link"] == url


def test_equal_scores_keep_the_first_candidate(page):
    frame = with_pdf_candidates(page('<a href="/b.pdf">Notice</a><div><a href="/a.pdf">Notice</a></div>'))
    assert with_pdf_link(frame, F.lit(""), F.lit(False), "page_id").first()["pdf_link"].endswith(".pdf")


def test_main_text_stops_at_the_first_long_enough_rank(page):
    article = "<article>" + "a" * 260 + "</article>"
    assert main_text(page, f"<body>{article}{'b' * 900}</body>") == "a" * 260
    # a short earlier rank survives when it is the longest, and the first of equals wins
    html = f"<div itemprop='description'>{'x' * 100}</div><article>{'y' * 100}</article>"
    assert main_text(page, html) == "x" * 100
    # within the deciding rank the longest counts
    html = f"<body><article>{'a' * 260}</article><article>{'b' * 300}</article></body>"
    assert main_text(page, html) == "b" * 300


def test_main_text_leaves_noise_out(page):
    html = "<body><nav>menu</nav><header>top</header><p>Loading</p><p>kept</p><script>x</script><footer>end</footer>"
    assert main_text(page, html) == "kept"
    assert main_text(page, "<nav><article>" + "a" * 300 + "</article></nav><body>rest</body>") == "rest"
    assert main_text(page, "plain text without a body") == ""


def test_strict_links(page):
    html = (
        '<a href="/jobs/1">\n Officer <b> one </b></a><a href="/jobs/1">Again</a><a href="/jobs/2">abc</a>'
        '<a href="/jobs/2">Long enough</a><a href="/jobs/archive/3">Archived job</a><a href="/Jobs/4">Wrong case</a>'
        '<nav><a href="https://x/jobs/5">In the menu</a></nav>'
    )
    links = strict_links(page(html), "/jobs/", "https://example.com", 5, ["archive"])
    found = [(r.title, r.url) for r in links.orderBy("pos").collect()]
    assert found == [
        ("Officerone", "https://example.com/jobs/1"),
        ("Long enough", "https://example.com/jobs/2"),
        ("In the menu", "https://x/jobs/5"),
    ]


def test_keyword_links(page):
    html = (
        '<a href=" /job/1 ">Job  one</a><a href="job/1">relative twin</a><a href="javascript:job()">Job two</a>'
        '<a href="mailto:job@x">Job three</a><a href="/x">Careers page</a><a href="/job/9">Expired job</a><a>no href job</a>'
    )
    links = keyword_links(page(html), "https://example.com/", ["JOB", "career"], ["expired"])
    found = [(r.title, r.url) for r in links.orderBy("pos").collect()]
    assert found == [("Job one", "https://example.com/job/1"), ("Careers page", "https://example.com/x")]


def test_frame_links_go_over_frames_in_order(rows):
    frames = rows(
        "page_id bigint, frame_pos int, frame_url string, html string",
        (1, 1, "https://h/JobBoard", '<a href="/a">Second frame</a><a href="/b">Other link</a>'),
        (1, 0, "https://h/careers", '<a href="/a">First frame</a>'),
        (1, 2, "https://h/news", '<a href="/c">Not wanted</a>'),
        (1, 3, "https://h/careers", None),
    )
    links = frame_links(frames, ["careers", "jobboard"], "https://x", [])
    assert {(r.title, r.url) for r in links.collect()} == {("First frame", "https://x/a"), ("Other link", "https://x/b")}


def test_app_json_leaf(page):
    about = "about the role " * 15
    data = {"props": {"items": [{"About": f"<p>{about}</p>"}], "misc": WORDS}, "n": 1}
    html = f'<script id="__NEXT_DATA__">{json.dumps(data)}</script>'
    assert with_leaf_text(page(html), F.lit(True)).first()["leaf_text"] == about.strip()
    assert with_leaf_text(page(html), F.lit(False)).first()["leaf_text"] == ""
    assert with_leaf_text(page('<script id="__NEXT_DATA__">{oops</script>'), F.lit(True)).first()["leaf_text"] == ""


def legacy(page, html):
    return with_legacy_text(page(html), F.lit(True)).first()["legacy_text"]


def test_legacy_container_wins_even_when_empty(page):
    assert legacy(page, "%3Cdiv class='a singleview'%3Eone\\: %3Cb%3Etwo%3C/b%3E%3C/div%3E") == "one:\ntwo"
    assert legacy(page, "<div class='singleview'></div>!|!!*!<p>fragment</p>") == ""


def test_legacy_section(page):
    html = "<div id='xRequisitionDescription1'><p class='msoNormal'>a line that is long enough</p><p class='MsoNormal'>short</p></div>"
    assert legacy(page, html) == "a line that is long enough"
    assert legacy(page, f"<div id='requisitionDescription'>{'z' * 201}</div>") == "z" * 201
    assert legacy(page, f"<div id='requisitionDescription'>{'z' * 200}</div>") == ""


def test_legacy_fragments(page):
    html = "x!|!!*!How to apply!|!!*!<p>Job purpose</p> text!|!123456!|!tail!|!!*!Job purpose text"
    assert legacy(page, html) == "Job purpose\ntext"
    assert legacy(page, "x!|!!*!apply now") == ""


def test_page_facts_cascade(rows, spark):
    js = "<body>Please wait, you must enable JavaScript</body>"
    pages = rows(
        "page_id bigint, url string, html string",
        (1, "https://a.example/1", f"<article>{WORDS * 2}</article>"),
        (2, "https://a.example/2", '<body>short <a href="/x.pdf">file</a></body>'),
        (3, "https://a.example/3", js),
        (4, "https://a.example/careersection/2/jobdetail.ftl", f"%3Cdiv class='singleview'%3E{WORDS}%3C/div%3E"),
        (5, "https://t.api.example/Site/job/R1", "<body>page</body>"),
    )
    payloads = rows(
        "api_url string, body string",
        ("https://t.api.example/wday/cxs/t/Site/job/R1", json.dumps({"jobPostingInfo": {"jobDescription": "<p>From the API</p>"}})),
    )
    rules = rules_frame(spark, {"detail_api_domains": ["api.example"]})
    facts = {r.page_id: r for r in page_facts(pages, rules, payloads).collect()}
    assert facts[1].description == (WORDS * 2).strip()
    assert facts[2].description == "" and facts[2].has_pdf_link
    assert facts[3].needs_browser and facts[3].description.startswith("Please wait")
    assert facts[4].description == WORDS.strip()
    assert facts[5].description == "From the API"


def test_no_exchange_carries_html(rows, spark, capsys):
    pages = rows("page_id bigint, url string, html string", (1, "https://a.example/x", "<p>text</p>"))
    rules = rules_frame(spark, {"browser_domains": ["a.", ""], "app_json_domains": ["b."]})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        page_facts(pages, rules).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [part for part in capsys.readouterr().out.split("\n\n") if ") Exchange" in part and "Input" in part]
    assert exchanges and not any("html#" in part or "outline#" in part for part in exchanges)


def test_pages_reach_python_in_batches_of_few_bytes(spark):
    @F.arrow_udf("bigint")
    def together(pages):
        return pa.array([pages.nbytes] * len(pages), pa.int64())

    pages = spark.range(0, 300, 1, 1).select(F.repeat(F.col("id").cast("string"), F.lit(60_000)).alias("html"))
    assert pages.select(together.asNondeterministic()("html").alias("n")).agg(F.max("n")).first()[0] <= 6 << 20
