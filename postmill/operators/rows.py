"""Array items as rows."""

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, *keep: Column | str, array: Column | str, item: str, pos: str | None = None) -> DataFrame:
    """One row per array item. Items are never null.

    The outer form with a filter above it is meant: for the inner form the optimizer infers a filter on
    the array, pushes it below and so computes the array, with any parse in it, a second time.
    """
    if pos:
        rows = df.select(*keep, F.posexplode_outer(array).alias(pos, item))
    else:
        rows = df.select(*keep, F.explode_outer(array).alias(item))
    return rows.filter(F.col(item).isNotNull())
