"""Readers of a run's artifacts: postings, events and earlier state."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postmill.schemas import EVENT, ORG_BLOCK, ORG_FIELDS, STATE

_BLOCK = T.StructType([*ORG_BLOCK.fields, T.StructField("block", T.LongType())])

# One line per folder of a snapshot, and a header line (bucket -1); all carry the number of buckets.
_MANIFEST = "org_bucket int, buckets int, path string"


def read_landed(reader, path: str) -> DataFrame | None:
    """A landed folder, or nothing if there is none."""
    try:
        return reader(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_org_blocks(spark: SparkSession, runs_dir: str, run_id: str) -> DataFrame:
    """Organisation blocks of one run; a run without artifacts is an error."""
    path = f"{runs_dir}/{run_id}/postings"
    blocks = read_landed(spark.read.schema(_BLOCK).json, path)
    if blocks is None:
        raise FileNotFoundError(f"missing postings folder: {path}")
    texts = {f: F.coalesce(f, F.lit("")) for f in ORG_FIELDS if f != "is_playwright_scraper"}
    return blocks.select(*_BLOCK.fieldNames()).withColumns(texts)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).json(path)


def state_bucket(org: Column, buckets: int) -> Column:
    """Folder number of an organisation."""
    return F.pmod(F.xxhash64(org), F.lit(buckets)).cast("int")


def state_folders(spark: SparkSession, state_dir: str) -> tuple[int, dict[int, str]]:
    """Number of buckets of the newest snapshot and the folder of each bucket with rows; 0 without a snapshot.

    A snapshot is one small file, so it is there wholly or not at all.
    """
    layout = T.StructType.fromDDL(_MANIFEST).add("snapshot", T.StringType())
    lines = read_landed(spark.read.schema(layout).json, f"{state_dir}/manifests")
    newest = lines.agg(F.max("snapshot").alias("s")).first()["s"] if lines is not None else None
    if newest is None:
        return 0, {}
    found = lines.filter(F.col("snapshot") == newest).collect()
    return found[0]["buckets"], {r["org_bucket"]: r["path"] for r in found if r["org_bucket"] >= 0}


def read_folders(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(*paths)


def read_state(spark: SparkSession, state_dir: str, orgs: Sequence[str] | None = None) -> DataFrame:
    """Earlier enriched rows, empty when there are none; organisations prune folders and row groups."""
    buckets, folders = state_folders(spark, state_dir)
    if not orgs or not folders:
        return read_folders(spark, list(folders.values()))
    named = spark.createDataFrame([(org,) for org in orgs], "org string")
    asked = [r[0] for r in named.select(state_bucket(F.col("org"), buckets)).distinct().collect()]
    return read_folders(spark, [folders[b] for b in asked if b in folders]).filter(F.col("org_abbrev").isin(list(orgs)))
