"""Organisation registry: merge, lookup and selection."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from postmill.functions.text import null_if_blank, org_abbrev
from postmill.operators.dedupe import first_row
from postmill.schemas import REGISTRY


def registry_frame(
    spark: SparkSession, entries: Mapping[str, tuple[str, str]], is_playwright: bool
) -> DataFrame:
    """A registry given as `{file: (name, listing address)}`."""
    rows = [
        (file, name, url, is_playwright, pos) for pos, (file, (name, url)) in enumerate(entries.items())
    ]
    return spark.createDataFrame(rows, REGISTRY)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry landed as JSON lines."""
    return spark.read.schema(REGISTRY).json(path)


def merge_registries(standard: DataFrame, browser: DataFrame) -> DataFrame:
    """All entries with their abbreviation; the browser entry wins a file name clash."""
    both = standard.withColumn("is_playwright", F.lit(False)).unionByName(
        browser.withColumn("is_playwright", F.lit(True))
    )
    ranked = both.withColumn("_rank", (~F.col("is_playwright")).cast("int"))
    chosen = first_row(ranked, ["scraper_file"], ["_rank", "reg_pos"]).drop("_rank")
    return chosen.withColumn("org_abbrev", org_abbrev(F.col("org_name")))


def find_orgs(requested: DataFrame, standard: DataFrame, browser: DataFrame) -> DataFrame:
    """Registry entry per requested `(org_pos, org)`, by bracketed abbreviation, else by full name."""
    entries = standard.withColumn("_browser", F.lit(0)).unionByName(
        browser.withColumn("_browser", F.lit(1))
    )
    bracketed = null_if_blank(F.regexp_extract("org_name", r"\[([^\]]+)\]", 1))
    keys = F.array(
        F.struct(F.upper(bracketed).alias("key"), F.lit(0).alias("rank")),
        F.struct(F.upper("org_name").alias("key"), F.lit(1).alias("rank")),
    )
    entry = F.struct(
        "scraper_file", "org_name", "listing_url", (F.col("_browser") == 1).alias("is_playwright")
    )
    named = entries.select(F.explode(keys).alias("k"), entry.alias("entry"), "_browser", "reg_pos")
    named = named.filter(F.col("k.key").isNotNull())
    best = named.groupBy(F.col("k.key").alias("_key")).agg(
        F.min_by("entry", F.struct("k.rank", "_browser", "reg_pos")).alias("entry")
    )
    asked = requested.withColumn("_key", F.upper(F.trim("org")))
    return asked.join(best, "_key", "left").select(
        "org_pos", F.col("_key").alias("org"), "entry.*", F.col("entry").isNotNull().alias("is_known")
    )


def all_orgs(registry: DataFrame) -> DataFrame:
    """Distinct upper-case abbreviations, in order."""
    return registry.select(F.upper(org_abbrev(F.col("org_name"))).alias("org")).distinct().orderBy("org")


def unknown_orgs(found: DataFrame) -> DataFrame:
    """Requested organisations without a registry entry."""
    return found.filter(~F.col("is_known")).select("org_pos", "org")
