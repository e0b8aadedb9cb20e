"""Five stages from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.llm.components import components
from postmill.llm.mixing import mix
from postmill.llm.packing import pack_documents
from postmill.llm.scratch import collected, remove_all, settle
from postmill.llm.shingle_sets import similar_sets
from postmill.llm.simhash import fingerprints, links
from postmill.llm.substring_dedup import remove_repeats
from postmill.llm.toxicity import grade


# Tables that the stage before has settled for its result.
_left: list[str] = []


def stage(build: Callable) -> Callable:
    """Remove the tables of the stage before, whose result has been written by now, and collect those of this one."""

    @wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_all(spark, _left)
        with collected() as paths:
            found = build(spark, docs, sf_dir)
        _left.extend(paths)
        return found

    return run


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return grade(docs, labels).where(~F.col("toxic")).select(*docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id, of several the one with the least text hash.

    Two kinds of link are followed together: fingerprints of the query (4 words) at 4 or fewer differing bits, and
    five-word shingle sets at a similarity of 0.8. Documents are told apart by id and text, so two texts under one
    id are two documents; a row repeated with id and text stays once. A null id takes part and comes last. Texts without
    words (or null) are copies of each other.
    """
    keys = [F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("_doc"), F.xxhash64("text").alias("_twin")]
    with collected() as paths:
        texts = docs.select(*keys, "text")
        prints = settle(fingerprints(texts, "_twin").distinct(), "text-fingerprints")
        bits = links(prints.select("fingerprint").distinct(), radius=4)
        sets, similar = similar_sets(texts, ["_doc", "_twin"])
        both = sets.select(F.col("key._twin").alias("_twin"), "node").distinct().join(prints, "_twin")
        print_node = lambda c: F.xxhash64(F.lit("fingerprint"), c)
        set_node = lambda c: F.xxhash64(F.lit("set"), c)
        edges = bits.select(print_node("a").alias("a"), print_node("b").alias("b"))
        edges = edges.union(similar.select(set_node("a"), set_node("b"))).union(both.select(print_node("fingerprint"), set_node("node")))
        joined = settle(components(edges), "document-components").withColumnRenamed("node", "_node")
        # the least node of a component is its name and has no row
        placed = prints.join(joined, print_node("fingerprint") == F.col("_node"), "left")
        placed = settle(placed.select("_twin", F.coalesce("component", print_node("fingerprint")).alias("component")), "text-components")
        first = F.min(F.struct("_doc", "_twin")).alias("first")
        kept = sets.select("key.*").join(placed, "_twin").groupBy("component").agg(first).select("first.*")
    # outside: this table is read when the result is written
    kept = settle(kept, "kept-documents")
    remove_all(spark, paths)
    rows = docs.select("*", *keys).join(kept, ["_doc", "_twin"])
    once = Window.partitionBy("_doc", "_twin").orderBy("_doc")
    return rows.withColumn("_n", F.row_number().over(once)).where("_n = 1").select(*docs.columns)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier in the corpus."""
    kept = remove_repeats(docs, respace=False)
    kept = kept.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long"))
    return kept.select(*docs.columns)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    keys = [F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("_doc"), F.xxhash64("text").alias("_twin")]
    plan = mix(docs.select("doc_id", "text", "source", *keys), keep=["source", "_doc", "_twin"])
    plan = plan.where("copies > 0").groupBy("_doc", "_twin").agg(F.sum("copies").cast("int").alias("_copies"))
    rows = docs.select("*", *keys).join(settle(plan, "mix"), ["_doc", "_twin"])
    # rows equal in id and text stand for each other
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_doc", "_twin").orderBy("source"))).where("_n = 1")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained models, hash-based links and bin packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
