"""Listing plug-ins that may fail: user functions over landed pages, run as a polymorphic table function."""

import sys
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import AnalyzeResult, OrderingColumn, PartitioningColumn, udtf

from postmill.functions.text import strip
from postmill.operators.positions import chunk_of, number_rows
from postmill.session import settle

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pages of an organisation that one call of a plug-in may see.
PART_PAGES = 1_000


@dataclass(frozen=True)
class Plugin:
    """A function from a page, a dictionary of its columns, to listings, dictionaries with `columns` (DDL)."""

    extract: Callable[[dict], Iterable[dict]]
    columns: str = "title string, url string"


def plugin_function(plugins: Mapping[str, Plugin]):
    """Table function `(pages, name)`: the listings of plug-in `name`, page by page.

    Its result columns are those of the plug-in, after `org_abbrev, page_no, pos` and before `error`. Pages are
    partitioned by `org_abbrev` and `part` and come in order of `page_no`. An exception ends the part: the listings of the failing
    page are dropped, and one row with its `page_no` and `error` takes their place.
    """
    columns = {name: T.StructType.fromDDL(plugin.columns) for name, plugin in plugins.items()}

    class Extract:
        @staticmethod
        def analyze(pages, name) -> AnalyzeResult:
            if not pages.isTable or name.value not in plugins:
                raise ValueError(f"no plug-in {name.value!r}; there are {sorted(plugins)}")
            schema = T.StructType().add("org_abbrev", T.StringType()).add("page_no", T.LongType()).add("pos", T.IntegerType())
            for field in columns[name.value]:
                schema = schema.add(field.name, field.dataType)
            return AnalyzeResult(
                schema=schema.add("error", T.StringType()),
                partitionBy=[PartitioningColumn("org_abbrev"), PartitioningColumn("part")],
                orderBy=[OrderingColumn("page_no")],
            )

        def __init__(self):
            self.failed = False

        def eval(self, page, name):
            if self.failed:
                return
            names = columns[name].fieldNames()
            head = (page["org_abbrev"], page["page_no"])
            try:
                found = [tuple(row.get(n) for n in names) for row in plugins[name].extract(page.asDict())]
            except Exception as failure:  # whatever a plug-in raises is its organisation's failure
                self.failed = True
                yield (*head, None, *[None] * len(names), f"{type(failure).__name__}: {failure}")
                return
            for pos, row in enumerate(found):
                yield (*head, pos, *row, None)

    return udtf(Extract)


def run_plugins(pages: DataFrame, plugins: Mapping[str, Plugin], part_pages: int = PART_PAGES) -> tuple[DataFrame, DataFrame]:
    """Listings and failures of pages `(org_abbrev, page_no, extractor, ...)`, each read by the plug-in it names.

    Failures are `(source_id, page_no, reason)` as `failed_orgs` takes them, one for each organisation: that of its first
    failing page. Listings (`org_abbrev, page_no, pos, extractor` and the plug-in's columns) are those of
    organisations without a failure that have a title and a url. An organisation with many pages is read in parts
    of `part_pages` page numbers. Pages that name no known plug-in, or none, are failures as well.
    """
    function = plugin_function(plugins)
    parted = pages.withColumn("part", chunk_of(F.col("page_no"), part_pages))
    found = [
        function(parted.filter(F.col("extractor") == name).asTable(), F.lit(name)).withColumn("extractor", F.lit(name))
        for name in plugins
    ]
    known = F.coalesce(F.col("extractor").isin(*plugins), F.lit(False))
    lost = parted.filter(~known).select(
        "org_abbrev", "page_no", "extractor", F.concat(F.lit("no plug-in "), F.coalesce("extractor", F.lit("named"))).alias("error")
    )
    # written once: plug-ins may be slow, and listings and failures both read their rows
    rows = settle(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*found, lost]), "plugin-rows")
    first = rows.filter("error is not null").groupBy("org_abbrev").agg(F.min(F.struct("page_no", "error")).alias("_first"))
    failures = first.select(F.col("org_abbrev").alias("source_id"), "_first.page_no", F.col("_first.error").alias("reason"))
    usable = rows.filter("error is null").filter((strip(F.col("title")) != "") & (strip(F.col("url")) != "")).drop("error")
    return usable.join(settle(failures, "plugin-failures"), F.col("org_abbrev") == F.col("source_id"), "left_anti"), failures


def number_listings(listings: DataFrame, pages: int = PART_PAGES) -> DataFrame:
    """`job_index` and `total_jobs` by page and position; an organisation is counted in parts of its pages."""
    return number_rows(listings, "org_abbrev", ["page_no", "pos"], chunk_of(F.col("page_no"), pages), total="total_jobs")


def first_orgs(registry: DataFrame, limit: int | None, order: str = "reg_pos") -> DataFrame:
    """The first organisations of the registry; all when the limit is null or not positive."""
    if not limit or limit < 0:
        return registry
    return registry.orderBy(order).limit(limit)
