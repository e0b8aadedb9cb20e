"""Descriptions from landed JSON payloads, one text per payload address."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from postmill import constants as C
from postmill.functions.html import html_text, html_texts
from postmill.functions.text import cap_description, clean_text, null_if_blank, section_text, strip
from postmill.functions.urls import detail_api_url, site_url, vacancy_key, vacancy_number
from postmill.operators.dedupe import first_row
from postmill.operators.rows import unnest
from postmill.session import settle

# Payload families, best first.
ITEM, NESTED, LISTED = 0, 1, 2

_NESTED = "jobPostingInfo struct<jobDescription: string, description: string>"
_VACANCIES = T.ArrayType(
    T.StructType(
        [T.StructField("jobVacancyId", T.LongType())]
        + [T.StructField(name, T.StringType()) for name in C.VACANCY_HTML_FIELDS]
    )
)
_ITEM = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("title", "reference")]
    + [T.StructField(key, T.StringType()) for _, key in C.PAYLOAD_SECTIONS]
)


def _capped(html: Column) -> Column:
    return F.coalesce(cap_description(clean_text(html_text(html))), F.lit(""))


def nested_texts(payloads: DataFrame) -> DataFrame:
    """Text of `jobPostingInfo.jobDescription`, else of its `description`."""
    info = F.from_json("body", _NESTED)["jobPostingInfo"]
    rows = payloads.select("api_url", info.alias("info"))
    html = F.coalesce(null_if_blank(F.col("info.jobDescription")), null_if_blank(F.col("info.description")))
    return rows.select("api_url", _capped(html).alias("text"))


def vacancy_rows(payloads: DataFrame) -> DataFrame:
    """One row per vacancy of the list payloads; the first of equal ids wins."""
    rows = unnest(payloads, "api_url", array=F.from_json("body", _VACANCIES), item="v", pos="pos")
    rows = rows.filter(F.col("v.jobVacancyId").isNotNull()).select(
        "api_url", F.col("v.jobVacancyId").alias("vacancy_id"), "pos", "v"
    )
    return first_row(rows, ["api_url", "vacancy_id"], ["pos"])


def vacancy_texts(payloads: DataFrame) -> DataFrame:
    """Joined HTML fields of every vacancy as text."""
    parts = [
        F.when(strip(F.col(f"v.{name}")) != "", F.col(f"v.{name}")) for name in C.VACANCY_HTML_FIELDS
    ]
    merged = null_if_blank(F.concat_ws("\n", *parts))
    rows = vacancy_rows(payloads).select("api_url", "vacancy_id", merged.alias("html"))
    return rows.select("api_url", "vacancy_id", _capped(F.col("html")).alias("text"))


def item_texts(payloads: DataFrame) -> DataFrame:
    """Headed sections of flat vacancy objects."""
    item = F.from_json("body", _ITEM)
    rows = payloads.select("api_url", item.alias("v")).select(
        "api_url",
        F.col("v.title").alias("title"),
        F.col("v.reference").alias("reference"),
        html_texts(F.array(*[F.col(f"v.{key}") for _, key in C.PAYLOAD_SECTIONS])).alias("parts"),
    )
    sections = [
        (heading, F.coalesce(clean_text(F.get("parts", F.lit(i))), F.lit("")))
        for i, (heading, _) in enumerate(C.PAYLOAD_SECTIONS)
    ]
    text = section_text(sections, F.col("title"), F.col("reference"))
    return rows.select("api_url", cap_description(text).alias("text"))


def detail_addresses(postings: DataFrame) -> DataFrame:
    """Add the three derived addresses of a posting; a rule flag gates each one."""
    url = F.col("url")
    number, key = vacancy_number(url), vacancy_key(url)
    return postings.withColumns(
        {
            "detail_api_url": F.when(F.col("is_detail_api"), null_if_blank(detail_api_url(url))),
            "vacancy_list_url": F.when(
                F.col("is_vacancy_list") & number.isNotNull(),
                site_url(url, F.lit("/api/CurrentJobVacancies")),
            ),
            "vacancy_id": F.when(F.col("is_vacancy_list"), number),
            "vacancy_item_url": F.when(
                F.col("is_vacancy_item") & (key != ""),
                site_url(url, F.concat(F.lit("/api/Vacancy/"), key)),
            ),
        }
    )


def _addresses(postings: DataFrame, key: Sequence[str]) -> DataFrame:
    """Derived addresses as narrow rows `(key, rank, api_url, vacancy_id)`; the lowest rank counts first."""

    def asked(rank: int, address: str, vacancy: Column) -> Column:
        row = F.struct(F.lit(rank).alias("rank"), F.col(address).alias("api_url"), vacancy.alias("vacancy_id"))
        return F.when(F.col(address).isNotNull(), row)

    none = F.lit(-1).cast("bigint")
    every = F.array_compact(
        F.array(
            asked(ITEM, "vacancy_item_url", none),
            asked(NESTED, "detail_api_url", none),
            asked(LISTED, "vacancy_list_url", F.col("vacancy_id")),
        )
    )
    return unnest(detail_addresses(postings), *key, array=every, item="a").select(*key, "a.*")


def with_payload_text(
    postings: DataFrame, payloads: DataFrame, key: Sequence[str], out: str = "payload_text"
) -> DataFrame:
    """Add the landed API text of a posting: flat item, else nested detail, else vacancy list.

    Addresses and payloads meet as narrow rows, every wanted payload is parsed once under the shape its
    address belongs to, and the postings themselves take part in one join by their key.
    """
    addresses = _addresses(postings, key)
    # Each shape reads the wanted payloads, so they are picked out once.
    wanted = settle(payloads.join(addresses.select("api_url", "rank").distinct(), "api_url"), "payloads")

    def of(rank: int) -> DataFrame:
        return wanted.filter(F.col("rank") == rank).select("api_url", "body")

    none = F.lit(-1).cast("bigint")
    columns = ("rank", "api_url", "vacancy_id", "text")
    items = item_texts(of(ITEM)).withColumns({"rank": F.lit(ITEM), "vacancy_id": none})
    nested = nested_texts(of(NESTED)).withColumns({"rank": F.lit(NESTED), "vacancy_id": none})
    listed = vacancy_texts(of(LISTED)).withColumn("rank", F.lit(LISTED))
    texts = items.select(*columns).unionByName(nested.select(*columns)).unionByName(listed.select(*columns))
    texts = settle(texts.filter(F.col("text") != ""), "texts")
    best = (
        addresses.join(texts, ["rank", "api_url", "vacancy_id"])
        .groupBy(*key)
        .agg(F.min_by("text", F.struct("rank", "text")).alias(out))
    )
    joined = postings.join(best, list(key), "left")
    return joined.withColumn(out, F.coalesce(out, F.lit("")))
