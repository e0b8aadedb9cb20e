"""Organisation and domain rule sets as one long table."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from postmill.constants import RULES
from postmill.schemas import RULE


def rules_frame(spark: SparkSession, rules: Mapping[str, Iterable[str]]) -> DataFrame:
    unknown = set(rules) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    return spark.createDataFrame([(rule, v) for rule, values in rules.items() for v in values], RULE)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RULE).json(path)
