"""Fixed values the results depend on: word lists, markers, limits and closed vocabularies."""

# --- fixed values -----------------------------------------------------------

MAX_DESCRIPTION_CHARS = 50_000
CONTEXT_CHARS = 400
REPORT_ERROR_CHARS = 120
SLUG_CHARS = 80
BREAKER_THRESHOLD = 3
MIN_MAIN_TEXT = 250
MIN_WORDS = 50
MIN_CHARS = 120
MIN_RENDERED_CHARS = 100
MIN_LEAF_CHARS = 180
MIN_LEAF_SCORE = 80
PDF_THRESHOLD = 60
PDF_THRESHOLD_PREFERRED = 30
RETRYABLE_ATTEMPTS = 2
SEARCH_PAGE_SIZE = 20

NEEDS_JS_MARKERS = (
    "you need to enable javascript",
    "loading application",
    "loading\n.\n.\n.",
    "please wait",
)

PDF_POSITIVE_MARKERS = (
    "vacancy",
    "vacancy notice",
    "vacancy_notice",
    "notice",
    "call for expression",
    "call for expressions",
    "job profile",
    "job description",
    "recruitment",
    "position",
    "reference",
    "srb/",
    "vn-",
    "ta ",
    "ad ",
    "ast",
    "ca fg",
)

PDF_NEGATIVE_MARKERS = (
    "candidate manual",
    "online application manual",
    "manual",
    "privacy notice",
    "data protection notice",
    "cookie",
    "gdpr",
)

TITLE_STOP_WORDS = (
    "with", "from", "into", "the", "and", "for", "this", "that", "your", "our", "about",
)

NOISE_LINES = (
    "view profile",
    "employee login",
    "create/ view profile",
    "language",
    "loading",
)

SECTION_MARKERS = (
    "organizational setting",
    "minimum requirements",
    "technical skills",
    "responsibilities",
    "duties and responsibilities",
    "selection criteria",
    "job purpose",
    "qualifications",
    "required skills",
)

SECTION_NOISE = (
    "important notice",
    "how to apply",
    "additional information",
    "apply now",
)

LEAF_PATH_MARKERS = (
    "description",
    "jobdescription",
    "job_description",
    "responsibil",
    "profile",
    "qualification",
    "requirement",
    "offer",
    "about",
)

LEAF_NOISE = (
    "job list",
    "please confirm this action",
    "privacy policy",
    "imprint",
    "navigation",
)

BLOCK_MARKERS = (
    "attention required",
    "verify you are human",
    "access denied",
    "request blocked",
)
BLOCK_STATUS_CODES = (401, 403, 429, 503)

VACANCY_HTML_FIELDS = (
    "jobDescription",
    "purposeforthepost",
    "requiredcompetencies",
    "maindutiesandresponsibilities",
)

PAYLOAD_SECTIONS = (
    ("Description", "description"),
    ("Qualifications", "qualifications"),
    ("Skills", "skills"),
    ("Requirements", "requirements"),
    ("Conditions", "conditions"),
)

RAW_PDF_URL = r"(?i)https?://[^\s\"'<>]+?\.pdf(?:\?[^\s\"'<>]*)?"
RAW_PDF_PATH = r"(?i)/[^\s\"'<>]+?\.pdf(?:\?[^\s\"'<>]*)?"

FRAGMENT_END = r"(?s)!\|!\d{6,8}!\|!.*"

# (status, reason, message parts), first hit wins
ERROR_CLASSES = (
    ("blocked_source", "http_429", ("429", "too many requests")),
    ("blocked_source", "http_403", ("403", "forbidden")),
    ("broken_link", "http_404", ("404", "not found")),
    ("blocked_source", "ssl_error", ("ssl", "certificate")),
    ("broken_link", "invalid_url", ("invalid url", "no scheme supplied")),
)
OTHER_ERROR = ("error", "fetch_error")

DONE_STATUSES = ("ok", "pdf")
DONE_TYPES = ("html", "pdf")
SUCCESS_STATUSES = ("ok", "short_content")

GATE_FALLBACKS = {
    "min_jobs_per_org": 1,
    "min_words": 50,
    "max_words": 10_000,
    "max_fetch_seconds_per_job": 20.0,
    "allow_empty": False,
}

RULES = (
    "browser_orgs",
    "browser_domains",
    "app_json_domains",
    "detail_api_domains",
    "vacancy_list_domains",
    "vacancy_item_domains",
    "table_domains",
    "prefer_pdf_orgs",
    "tls_exempt_domains",
    "trusted_detail_orgs",
)

# --- sizes this library chooses ---------------------------------------------

# Rows of one organisation handled by one window group; longer runs are split.
CHUNK_ROWS = 500_000
# Postings nested into one block row; larger organisations span several rows.
BLOCK_ROWS = 1_000
