"""Configuration rules: rows are flagged by a join on their keys, however many rules there are."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from postmill.operators.rows import unnest
from postmill.session import settle


def has_rule(rules: DataFrame, rule: str) -> bool:
    return bool(rules.filter(F.col("rule") == rule).limit(1).collect())


def _attach(df: DataFrame, key: Column, hits: DataFrame, flags: list[str]) -> DataFrame:
    """Flags of the keys in `hits` (one row per key) as columns of `df`.

    The hits are written first: their size is then known to the planner, and where they are too many to
    broadcast, AQE can split the other side at a frequent key.
    """
    joined = df.withColumn("_rule_key", key).join(settle(hits, "rule-flags"), "_rule_key", "left")
    return joined.drop("_rule_key").withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in flags})


def flag_equal(df: DataFrame, key: Column, rules: DataFrame, rule: str, out: str) -> DataFrame:
    """Flag rows whose key equals a rule value; a null key equals none."""
    values = rules.filter((F.col("rule") == rule) & F.col("value").isNotNull()).select("value").distinct()
    return _attach(df, key, values.select(F.col("value").alias("_rule_key"), F.lit(True).alias(out)), [out])


def flag_inside(df: DataFrame, text: Column, rules: DataFrame, rule: str, out: str) -> DataFrame:
    """Flag rows whose text (a host) contains a rule value."""
    return flag_hosts(df, text, rules, {rule: out})


def flag_hosts(
    df: DataFrame, text: Column, rules: DataFrame, flags: Mapping[str, str], keys: DataFrame | None = None
) -> DataFrame:
    """One flag per rule (`flags`: rule to column) on rows whose text contains a value of that rule.

    Every text contains a blank value; a null text contains none. The distinct texts of `keys` (by default of
    `df`) meet the values of all rules in one equi-join, on their substrings of the lengths that values have.
    """
    wanted = rules.filter(F.col("rule").isin(*flags) & F.col("value").isNotNull()).select("rule", "value").distinct()
    # a row per length, so no more than the longest value has characters
    lengths = sorted(row[0] for row in wanted.select(F.length("value")).distinct().collect())
    if not lengths:
        return df.withColumns({flag: F.lit(False) for flag in flags.values()})
    size = F.length("_rule_key")

    def cut(n: int) -> Column:
        starts = F.sequence(F.lit(1), size - n + 1)
        return F.when(size >= n, F.transform(starts, lambda i: F.substring("_rule_key", i, F.lit(n))))

    cuts = F.array_distinct(F.flatten(F.filter(F.array(*map(cut, lengths)), lambda x: x.isNotNull())))
    source = df if keys is None else keys
    texts = source.select(text.alias("_rule_key")).filter(F.col("_rule_key").isNotNull()).distinct()
    found = unnest(texts, "_rule_key", array=cuts, item="value").join(wanted, "value")
    hits = found.groupBy("_rule_key").agg(
        *[F.bool_or(F.col("rule") == rule).alias(flag) for rule, flag in flags.items()]
    )
    return _attach(df, text, hits, list(flags.values()))
