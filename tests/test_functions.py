import pytest
from pyspark.sql import functions as F

from postmill.functions import predicates as P, text as T, urls as U
from postmill.functions.scoring import leaf_score, pdf_score


def test_word_count_splits_on_all_white_space(one):
    assert one(T.word_count(F.lit("alpha beta\ngamma\t delta"))) == 4
    assert one(T.word_count(F.lit(" a b\x1cc　"))) == 3
    assert one(T.word_count(F.lit(None).cast("string"))) == 0
    assert one(T.word_count(F.lit(""))) == 0


@pytest.mark.parametrize(
    "title, slug",
    [
        ("  Senior   Officer (AD 5) ", "senior-officer-ad-5"),
        ("Été_2026 -- ½!", "été-2026-½"),
        ("-a-", "a"),
        ("x" * 79 + " y", "x" * 79 + "-"),
        ("", ""),
    ],
)
def test_slug(one, title, slug):
    assert one(T.slug(F.lit(title))) == slug


def test_clean_text(one):
    dirty = "  Title\\: a\\;\r\n\n\n\nLanguage\n LOADING \nCreate/ View Profile\x85 x  y"
    assert one(T.clean_text(F.lit(dirty))) == "Title: a;\nx\ny"


def test_keywords(one):
    assert one(T.keywords(F.lit("About the Policy policy officer from 2026 for EU"))) == ["policy", "officer", "2026"]


def test_org_abbrev(one):
    assert one(T.org_abbrev(F.lit("Full Name [ABC] [D]"))) == "ABC"
    assert one(T.org_abbrev(F.lit("  plain name"))) == "PLAIN"


def test_section_text(one):
    sections = [("Description", F.lit("a")), ("Skills", F.lit("")), ("Conditions", F.lit("c"))]
    text = T.section_text(sections, F.lit(" T "), F.lit(None).cast("string"))
    assert one(text) == "T\n\nDescription\na\n\nConditions\nc"
    assert one(T.section_text([("Skills", F.lit(""))], F.lit("T"), F.lit("R"))) == ""


BASE = "https://example.org/jobs/123?q=1"


@pytest.mark.parametrize(
    "href, url",
    [
        ("./docs/vacancy.pdf", "https://example.org/jobs/docs/vacancy.pdf"),
        ("../x/../y", "https://example.org/y"),
        ("/a/./b/../c", "https://example.org/a/c"),
        ("/plain?x#y", "https://example.org/plain?x#y"),
        ("//cdn.example/p.pdf", "https://cdn.example/p.pdf"),
        ("?k=v", "https://example.org/jobs/123?k=v"),
        ("#f", "https://example.org/jobs/123?q=1#f"),
        ("", BASE),
        ("https://Other.example/p?", "https://Other.example/p"),
        ("HTTP://other.example/p", "HTTP://other.example/p"),
        ("HTTPS://other.example/p", "https://other.example/p"),
        ("/with space", "https://example.org/with space"),
        ("/empty?", "https://example.org/empty"),
        ("mailto:a@b.c", "mailto:a@b.c"),
        ("/semi;", "https://example.org/semi"),
    ],
)
def test_join_url_is_rfc_resolution(one, spark, href, url):
    from urllib.parse import urljoin

    assert urljoin(BASE, href) == url
    assert one(U.join_url(F.lit(BASE), F.lit(href))) == url
    assert one(U.join_urls(F.lit(BASE), F.array(F.lit(href), F.lit("/z")))) == [url, "https://example.org/z"]


def test_prefix_url_only_looks_at_the_start(one):
    assert one(U.prefix_url(F.lit("httpx"), F.lit("https://b"))) == "httpx"
    assert one(U.prefix_url(F.lit("jobs/1"), F.lit("https://b/"))) == "https://b/jobs/1"


def test_host_keeps_port_and_user(one):
    assert one(U.url_host(F.lit("https://Us:pw@Ex.org:81/x y"))) == "us:pw@ex.org:81"
    assert one(U.url_host(F.lit("no-host"))) == ""


@pytest.mark.parametrize(
    "url, api",
    [
        ("https://Tenant.wd3.x.com/External/job/Paris/R1/apply", "https://Tenant.wd3.x.com/wday/cxs/tenant/External/job/Paris/R1"),
        ("https://t.x.com/External/en-US/job/R1/", "https://t.x.com/wday/cxs/t/External/job/R1"),
        ("https://t.x.com/en-US/job/R1", "https://t.x.com/wday/cxs/t/en-US/job/R1"),
        ("https://t.x.com/job/R1", ""),
        ("https://t.x.com/External/job/", ""),
        ("https://t.x.com/External/jobs/1", ""),
    ],
)
def test_detail_api_url(one, url, api):
    assert one(U.detail_api_url(F.lit(url))) == api


def test_facet_detail_url(one):
    api = F.lit("https://tenant.wd3.x.com/wday/cxs/tenant/External/jobs")
    for path in ("/job/Paris/Example_JR1", "job/Paris/Example_JR1", "/External/job/Paris/Example_JR1"):
        made = U.facet_detail_url(F.lit("https://tenant.wd3.x.com"), api, F.lit(path))
        assert one(made) == "https://tenant.wd3.x.com/External/job/Paris/Example_JR1"


def test_ids_in_addresses(one):
    assert one(U.vacancy_number(F.lit("https://x/en/vacancies/77/a"))) == 77
    assert one(U.vacancy_number(F.lit("https://x/vacancies/a"))) is None
    assert one(U.vacancy_key(F.lit("https://x/Vacancy/0123456789abcdefAB"))) == "0123456789abcdefAB"
    assert one(U.table_row_index(F.lit("https://x/y.GBL?FOCUS=A#row-42"))) == 42
    assert one(U.table_row_index(F.lit("https://x/y#row-42b"))) is None
    assert one(U.is_legacy_ats(F.lit("https://x/careersection/external/jobdetail.ftl?job=2600348")))


def test_percent_decode(one):
    assert one(U.percent_decode(F.lit("a%20b+c"))) == "a b+c"
    assert one(U.percent_decode(F.lit("100% %C3%A9%zz"))) == "100% é%zz"


@pytest.mark.parametrize(
    "message, status, reason",
    [
        ("403 Client Error: Forbidden", "blocked_source", "http_403"),
        ("404 Client Error: Not Found", "broken_link", "http_404"),
        ("429 Too Many Requests", "blocked_source", "http_429"),
        ("SSL: bad CERTIFICATE", "blocked_source", "ssl_error"),
        ("Invalid URL '': No scheme supplied", "broken_link", "invalid_url"),
        ("fetch timed out after 30.0s", "error", "fetch_error"),
        ("timeout for https://x/404", "broken_link", "http_404"),
    ],
)
def test_classify_error(one, message, status, reason):
    assert tuple(one(P.classify_error(F.lit(message)))) == (status, reason)


@pytest.mark.parametrize(
    "attempt, status, header, delay",
    [
        (0, 429, "3", 3.0),
        (0, 429, "", 1.0),
        (1, 429, None, 2.0),
        (0, 500, "3", 1.0),
        (1, 500, None, 2.0),
        (2, 429, "3", None),
        (0, 429, "-5", 0.0),
        (1, 429, "soon", 2.0),
        (0, 429, "Thu, 01 Jan 2026 00:01:30 GMT", 90.0),
        (0, 429, "Thu, 01 Jan 2026 01:01:30 +0100", 90.0),
        (0, 429, "Wed, 31 Dec 2025 00:00:00 GMT", 0.0),
        (0, None, "3", 1.0),
    ],
)
def test_retry_delay(one, attempt, status, header, delay):
    now = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    column = P.retry_delay(F.lit(attempt), F.lit(status).cast("int"), F.lit(header).cast("string"), now)
    assert one(column) == delay


def test_is_short(one):
    assert one(P.is_short(F.lit(("alpha " * 21).strip())))
    assert not one(P.is_short(F.lit("alpha " * 60)))
    assert one(P.is_short(F.lit("alpha " * 60 + "You need to enable JavaScript")))
    assert one(P.is_short(F.lit("alpha " * 60 + "Loading\n.\n.\n.")))


def test_blocked_and_rendering(one):
    none = F.lit(None).cast("int")
    assert one(P.looks_blocked(F.lit("<h1>Access DENIED</h1>"), none))
    assert one(P.looks_blocked(F.lit("fine"), F.lit(503)))
    assert not one(P.looks_blocked(F.lit("fine"), none))
    no = F.lit(False)
    assert one(P.needs_rendering(F.lit("https://x.oraclecloud.com/1"), F.lit(""), no, no))
    assert not one(P.needs_rendering(F.lit("https://x.example/1"), F.lit("text"), no, no))


def test_is_enriched(one):
    cases = [("ok", "", True), ("pdf", "", True), ("error", "html", False), ("", "html", True), ("", "error", False)]
    for status, kind, expected in cases:
        assert one(P.is_enriched(F.lit(status), F.lit(kind))) is expected


def test_pdf_score_adds_overlapping_markers(one):
    words = T.keywords(F.lit("Legal and policy officer"))

    def score(url, text="", context=""):
        return one(pdf_score(F.lit(url), F.lit(text), F.lit(context), words))

    notice = "https://h/2026-02/vn-08-2026-agencyh-legal-and-policy-officer_en.pdf"
    privacy = "https://h/2026-02/01-agencyh-data-protection-notice.pdf"
    # .pdf 60, vn- 45, three title words 60
    assert score(notice) == 165
    # .pdf 60, notice 45
    assert score(privacy) == 105
    # .pdf 60, notice 45, privacy notice -120
    assert score("https://h/x.pdf", "Privacy notice") == -15
    # .pdf 60, download 15, manual markers twice -240, "ad " in "download " 45
    assert score("https://h/x.pdf", "Download candidate manual") == -120
    assert score("https://h/x.docx") == -200


def test_leaf_score(one):
    assert one(leaf_score(F.lit("props.description"), F.lit("one two"))) == 252
    assert one(leaf_score(F.lit("x"), F.lit("job list please confirm this action"))) == 6 - 1000
