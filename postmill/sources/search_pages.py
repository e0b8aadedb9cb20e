"""Landed JSON search responses as listing rows.

Input rows are `(source_id, page_no, body)`. A body that is not the expected JSON object gives no rows. It ends a
facet source like an empty page; in the other two styles it makes the source a failed one, which `table_failures`
and `simple_failures` tell (`plans.collect.failed_orgs` turns these into failures of organisations).
"""

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill import constants as C
from postmill.functions.text import blank_if_null
from postmill.functions.urls import facet_detail_url
from postmill.operators.dedupe import first_row
from postmill.operators.rows import unnest

_FACET = (
    "total bigint, jobPostings array<struct<title: string, externalPath: string, locationsText: string>>"
)
_TABLE = (
    "requisitionList array<struct<contestNo: string, column: array<string>>>, "
    "pagingData struct<totalCount: bigint>"
)
_SIMPLE = "results array<struct<title: string, id: string, location: string, department: string>>"


def _items(pages: DataFrame, schema: str, field: str) -> DataFrame:
    parsed = pages.select("source_id", "page_no", F.from_json("body", schema)[field].alias("items"))
    return unnest(parsed, "source_id", "page_no", array="items", item="item", pos="pos")


def _before_stop(pages: DataFrame, stops: Column) -> DataFrame:
    """Pages of a source up to its first stopping page; one small row per source is joined back."""
    marked = pages.withColumn("_stop", F.when(F.coalesce(stops, F.lit(True)), F.col("page_no")))
    ends = marked.groupBy("source_id").agg(F.min("_stop").alias("_end"))
    joined = marked.join(ends, "source_id")
    return joined.filter(F.col("_end").isNull() | (F.col("page_no") <= F.col("_end"))).drop("_stop", "_end")


def _failures(pages: DataFrame, schema: str) -> DataFrame:
    """First unreadable page of each source as `source_id, page_no, reason`; a null body is unreadable."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json("body", f"{schema}, _corrupt string", options)
    is_object = F.coalesce(F.col("body").rlike(r"^\s*\{"), F.lit(False))
    reason = (
        F.when(F.col("body").isNull(), "no body")
        .when(~is_object, "not a JSON object")
        .when(parsed.isNull() | parsed["_corrupt"].isNotNull(), "malformed JSON or unexpected types")
    )
    bad = pages.select("source_id", "page_no", reason.alias("reason")).filter(F.col("reason").isNotNull())
    first = bad.groupBy("source_id").agg(F.min(F.struct("page_no", "reason")).alias("_first"))
    return first.select("source_id", "_first.page_no", "_first.reason")


def facet_listings(pages: DataFrame, base_url: Column, api_url: Column) -> DataFrame:
    """Facet-style pages (numbered from 1); a source ends at its last, first empty or unreadable page."""
    parsed = F.from_json("body", _FACET)
    size = F.coalesce(F.size(parsed["jobPostings"]), F.lit(0))
    total = F.coalesce(parsed["total"], F.lit(0))
    sized = pages.withColumns({"_size": size, "_total": total})
    last = (F.col("_size") <= 0) | (F.col("page_no") * C.SEARCH_PAGE_SIZE >= F.col("_total"))
    items = _items(_before_stop(sized, last), _FACET, "jobPostings")
    path = blank_if_null(F.col("item.externalPath"))
    return items.select(
        "source_id",
        "page_no",
        "pos",
        blank_if_null(F.col("item.title")).alias("title"),
        facet_detail_url(base_url, api_url, path).alias("url"),
        blank_if_null(F.col("item.locationsText")).alias("location"),
    )


def _table_pages(pages: DataFrame, deduplicate: bool) -> DataFrame:
    """Pages of a source up to the one that is empty, brings no new posting or reaches the total.

    Decided on narrow rows, one per page; a page without a total ends its source.
    """
    parsed = F.from_json("body", _TABLE)
    facts = pages.select(
        "source_id",
        "page_no",
        F.coalesce(F.size(parsed["requisitionList"]), F.lit(0)).alias("_size"),
        F.coalesce(parsed["pagingData"]["totalCount"], F.lit(0)).alias("_total"),
    )
    if deduplicate:
        number = blank_if_null(F.col("item.contestNo"))
        items = _items(pages, _TABLE, "requisitionList").select("source_id", "page_no", number.alias("_number"))
        firsts = items.groupBy("source_id", "_number").agg(F.min("page_no").alias("page_no"))
        fresh = firsts.groupBy("source_id", "page_no").agg(F.count(F.lit(1)).alias("_fresh"))
        facts = facts.join(fresh, ["source_id", "page_no"], "left").withColumn("_fresh", F.coalesce("_fresh", F.lit(0)))
    else:
        facts = facts.withColumn("_fresh", F.col("_size"))
    so_far = Window.partitionBy("source_id").orderBy("page_no").rowsBetween(Window.unboundedPreceding, 0)
    facts = facts.withColumn("_kept", F.sum("_fresh").over(so_far))
    last = (F.col("_fresh") <= 0) | (F.col("_kept") >= F.col("_total"))
    ends = facts.filter(last).groupBy("source_id").agg(F.min("page_no").alias("_end"))
    joined = pages.join(ends, "source_id", "left")
    return joined.filter(F.col("_end").isNull() | (F.col("page_no") <= F.col("_end"))).drop("_end")


def table_listings(
    pages: DataFrame,
    base_url: Column,
    section: Column,
    column_map: Mapping[int, str],
    strip_columns: Collection[int] = (),
    deduplicate: bool = False,
) -> DataFrame:
    """Positional-column pages; a missing column is empty, the posting number comes along.

    A source ends where `pagingData.totalCount` rows are kept or, with `deduplicate`, a page brings no new number.
    """
    items = _items(_table_pages(pages, deduplicate), _TABLE, "requisitionList")
    number = blank_if_null(F.col("item.contestNo"))
    fields = {}
    for at, name in column_map.items():
        value = F.coalesce(F.get("item.column", F.lit(at)), F.lit(""))
        fields[name] = F.regexp_replace(value, r'^[\[\]"]+|[\[\]"]+\z', "") if at in strip_columns else value
    fields.setdefault("job_number", number)
    address = F.concat(base_url, F.lit("/careersection/"), section, F.lit("/jobdetail.ftl?job="), number)
    rows = items.select(
        "source_id",
        "page_no",
        "pos",
        number.alias("_number"),
        *[value.alias(name) for name, value in fields.items()],
        address.alias("url"),
    )
    if deduplicate:
        rows = first_row(rows, ["source_id", "_number"], ["page_no", "pos"])
    return rows.drop("_number")


def table_failures(pages: DataFrame, deduplicate: bool = False) -> DataFrame:
    """`source_id, page_no, reason` of each source that `table_listings` leaves at an unreadable page.

    The rows of its earlier pages are a part of the source only.
    """
    return _failures(_table_pages(pages, deduplicate), _TABLE)


def _simple_pages(pages: DataFrame, page_size: int) -> DataFrame:
    size = F.coalesce(F.size(F.from_json("body", _SIMPLE)["results"]), F.lit(0))
    return _before_stop(pages.withColumn("_size", size), F.col("_size") < page_size)


def simple_listings(pages: DataFrame, site_url: Column, page_size: int = C.SEARCH_PAGE_SIZE) -> DataFrame:
    """Plain result pages; a source ends at its first short page."""
    items = _items(_simple_pages(pages, page_size), _SIMPLE, "results")
    return items.select(
        "source_id",
        "page_no",
        "pos",
        blank_if_null(F.col("item.title")).alias("title"),
        F.concat(site_url, F.lit("/jobs/"), blank_if_null(F.col("item.id"))).alias("url"),
        blank_if_null(F.col("item.location")).alias("location"),
        blank_if_null(F.col("item.department")).alias("department"),
    )


def simple_failures(pages: DataFrame, page_size: int = C.SEARCH_PAGE_SIZE) -> DataFrame:
    """`source_id, page_no, reason` of each source that `simple_listings` leaves at an unreadable page."""
    return _failures(_simple_pages(pages, page_size), _SIMPLE)
