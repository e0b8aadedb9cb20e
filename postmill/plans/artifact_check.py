"""Field types of written organisation blocks, checked on the raw text."""

from pyspark.sql import Column, DataFrame, functions as F

from postmill.operators.rows import unnest

# --- fixed values: field -> allowed JSON types -------------------------------
ORG_TYPES = {
    "org_abbrev": ("STRING",),
    "org_name": ("STRING",),
    "scraper_file": ("STRING",),
    "is_playwright_scraper": ("BOOLEAN",),
    "scraper_error": ("STRING",),
    "jobs": ("ARRAY",),
}
JOB_TYPES = {
    "index": ("INTEGER",),
    "title": ("STRING",),
    "url": ("STRING",),
    "content_type": ("STRING",),
    "enrich_status": ("STRING",),
    "status_reason": ("STRING",),
    "description": ("STRING",),
    "pdf_path": ("STRING",),
    "fetch_seconds": ("INTEGER", "NUMBER"),
    "error": ("STRING",),
}


def _json_type(value: Column) -> Column:
    """JSON type name of a variant field; MISSING when absent."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.isNull(), "MISSING")
        .when(kind == "BIGINT", "INTEGER")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "NUMBER")
        .when(kind.startswith("ARRAY"), "ARRAY")
        .when(kind.startswith("OBJECT"), "OBJECT")
        .when(kind == "VOID", "NULL")
        .otherwise(kind)
    )


def _bad_fields(value: Column, types: dict[str, tuple[str, ...]]) -> Column:
    found = []
    for name, allowed in types.items():
        kind = _json_type(F.try_variant_get(value, f"$.{name}", "variant"))
        row = F.struct(F.lit(name).alias("field"), kind.alias("found"))
        found.append(F.when(~kind.isin(*allowed), row))
    return F.array_compact(F.array(*found))


def bad_fields(lines: DataFrame) -> DataFrame:
    """Wrong fields of block lines `(value)`: organisation, job position (null for the block), field."""
    blocks = lines.select(F.try_parse_json("value").alias("block"))
    org = F.try_variant_get("block", "$.org_abbrev", "string").alias("org_abbrev")
    no_job = F.lit(None).cast("int").alias("job_pos")
    own = unnest(blocks, org, no_job, array=_bad_fields(F.col("block"), ORG_TYPES), item="b")
    listed = F.try_variant_get("block", "$.jobs", "array<variant>")
    jobs = unnest(blocks, org, array=listed, item="job", pos="job_pos")
    inner = unnest(jobs, "org_abbrev", "job_pos", array=_bad_fields(F.col("job"), JOB_TYPES), item="b")
    return own.unionByName(inner).select("org_abbrev", "job_pos", "b.field", "b.found")
