"""First-wins and last-wins choices by aggregation, so hot keys shrink before the shuffle."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.predicates import is_usable_row
from postmill.functions.text import strip


def _pick(df: DataFrame, keys: Sequence[str], choose, order: Sequence[str]) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    best = choose(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key."""
    return _pick(df, keys, F.min_by, order)


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key."""
    return _pick(df, keys, F.max_by, order)


def dedupe_listings(df: DataFrame, scope: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First listing per trimmed URL inside a scope; rows without URL or title go."""
    usable = df.filter(is_usable_row(F.col("url"), F.col("title"))).withColumns(
        {"url": strip(F.col("url")), "title": strip(F.col("title"))}
    )
    return first_row(usable, [*scope, "url"], order)


def first_in_array(df: DataFrame, column: str, key: str, order: str = "pos") -> DataFrame:
    """Keep, inside an array of structs, the first item of every key; items stay in order."""
    keyed = F.transform(
        column, lambda x: F.struct(x[key].alias("key"), x[order].alias("at"), x.alias("item"))
    )
    df = df.withColumn("_keyed", F.array_sort(keyed))

    def is_first(item: Column, i: Column) -> Column:
        return (i == 0) | (F.get("_keyed", i - 1)["key"] != item["key"])

    by_order = F.transform(
        F.filter("_keyed", is_first), lambda x: F.struct(x["at"].alias("at"), x["item"].alias("item"))
    )
    kept = F.transform(F.array_sort(by_order), lambda x: x["item"])
    return df.withColumn(column, kept).drop("_keyed")
