"""Row types shared by readers, jobs and writers."""

from pyspark.sql import types as T


def _s(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


REGISTRY = T.StructType(
    [
        _s("scraper_file"),
        _s("org_name"),
        _s("listing_url"),
        T.StructField("is_playwright", T.BooleanType()),
        T.StructField("reg_pos", T.IntegerType()),
    ]
)

RULE = T.StructType([_s("rule"), _s("value")])

RESULT_FIELDS = (
    "content_type",
    "description",
    "pdf_path",
    "enrich_status",
    "status_reason",
    "fetch_method",
)

POSTING = T.StructType(
    [
        T.StructField("index", T.LongType()),
        _s("title"),
        _s("url"),
        _s("content_type"),
        _s("enrich_status"),
        _s("status_reason"),
        _s("fetch_method"),
        _s("description"),
        _s("pdf_path"),
        T.StructField("fetch_seconds", T.DoubleType()),
        _s("error"),
    ]
)
POSTING_FIELDS = tuple(POSTING.fieldNames())

ORG_BLOCK = T.StructType(
    [
        _s("org_abbrev"),
        _s("org_name"),
        _s("scraper_file"),
        T.StructField("is_playwright_scraper", T.BooleanType()),
        _s("scraper_error"),
        T.StructField("jobs", T.ArrayType(POSTING)),
    ]
)
ORG_FIELDS = ("org_abbrev", "org_name", "scraper_file", "is_playwright_scraper", "scraper_error")

STATE_FIELDS = (
    "org_name",
    "org_abbrev",
    "content_type",
    "description",
    "pdf_path",
    "enriched_at",
    "enrich_error",
    "enrich_status",
    "status_reason",
    "fetch_method",
)
STATE = T.StructType(
    [
        T.StructField("index", T.LongType()),
        _s("title"),
        _s("url"),
        *[_s(name) for name in STATE_FIELDS],
        T.StructField("fetch_seconds", T.DoubleType()),
        T.StructField("extras", T.MapType(T.StringType(), T.StringType())),
    ]
)

EVENT = T.StructType(
    [
        _s("event"),
        _s("ts_utc"),
        _s("run_id"),
        _s("batch_id"),
        _s("org_abbrev"),
        _s("org_name"),
        _s("scraper_file"),
        T.StructField("job_count", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("job_index", T.LongType()),
        T.StructField("total_jobs", T.LongType()),
        _s("job_title"),
        _s("job_url"),
        _s("enrich_status"),
        _s("content_type"),
        T.StructField("word_count", T.LongType()),
        _s("status_reason"),
        _s("error"),
        T.StructField("consecutive_429", T.LongType()),
        T.StructField("threshold", T.LongType()),
        _s("output_path"),
        _s("scraper_error"),
    ]
)

NODE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        _s("tag"),
        T.StructField("first", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("outer_first", T.IntegerType()),
        T.StructField("outer_last", T.IntegerType()),
        T.StructField("noise", T.BooleanType()),
        _s("id"),
        _s("css"),
        _s("href"),
        _s("itemprop"),
        _s("propertyid"),
    ]
)
SEGMENT = T.StructType([_s("text"), T.StructField("noise", T.BooleanType())])
OUTLINE = T.StructType(
    [
        T.StructField("nodes", T.ArrayType(NODE)),
        T.StructField("segments", T.ArrayType(SEGMENT)),
        _s("app_json"),
    ]
)
LEAF = T.StructType([_s("path"), _s("text")])
