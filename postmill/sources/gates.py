"""Quality gates from YAML."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

GATE_COLUMNS = T.StructType(
    [
        T.StructField("org_abbrev", T.StringType()),
        T.StructField("min_jobs_per_org", T.LongType()),
        T.StructField("min_words", T.LongType()),
        T.StructField("max_words", T.LongType()),
        T.StructField("max_fetch_seconds_per_job", T.DoubleType()),
        T.StructField("allow_empty", T.BooleanType()),
        T.StructField("expires_on", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
_CASTS = {T.LongType(): int, T.DoubleType(): float, T.BooleanType(): bool, T.StringType(): str}


def load_gates(path: str) -> dict:
    """Gate settings of a YAML file; empty parts become empty maps."""
    import yaml

    with open(path, encoding="utf-8") as file:
        data = yaml.safe_load(file) or {}
    return {key: data.get(key) or {} for key in ("defaults", "org_overrides")}


def overrides_frame(spark: SparkSession, gates: Mapping) -> DataFrame:
    """Overrides as rows; a key that is absent is null."""
    rows = []
    for org, values in (gates.get("org_overrides") or {}).items():
        row = [org]
        for field in GATE_COLUMNS.fields[1:]:
            value = (values or {}).get(field.name)
            row.append(None if value is None else _CASTS[field.dataType](value))
        rows.append(tuple(row))
    return spark.createDataFrame(rows, GATE_COLUMNS)
