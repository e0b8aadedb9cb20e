"""The registered queries of the operators, each over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document after removal of 20-word windows that start earlier."""
    from .substring_dedup import remove_repeats

    kept = remove_repeats(table(spark, folder, "documents"), keep=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of each document after removal of 100-byte strings that start earlier."""
    from .suffix_dedup import remove_repeated_bytes

    kept = remove_repeated_bytes(table(spark, folder, "documents"), keep=["doc_id"])
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of each document."""
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of each document when sources are mixed 3:1:2 to 150% of all words."""
    from .mixing import mix

    return mix(table(spark, folder, "documents"), keep=["doc_id", "source"]).select("doc_id", "size", "source_size", "target", "taken")


SQL["op4_mixing"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT 0 AS step, 0::DOUBLE AS level, -1::DOUBLE AS previous
  UNION ALL
  SELECT step + 1, (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) FILTER (2.0::DOUBLE * source_size <= level * weight), 0))
      / sum(weight) FILTER (2.0::DOUBLE * source_size > level * weight) FROM sources), level
  FROM levels WHERE level <> previous AND step < 100
), goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * (SELECT max(level) FROM levels)) AS target,
    (('0x' || md5('7:' || coalesce('=' || source, 'null'))[1:13])::BIGINT)::DOUBLE / 4503599627370496 AS shift
  FROM sources
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS place FROM sized
)
SELECT doc_id, size, source_size, target,
  ((floor(place * (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) + shift)
    - floor((place - 1) * (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) + shift))::BIGINT * size)::BIGINT AS taken
FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source
"""

# The rules of the URL query (verdict, host, path).
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on each page's URL."""
    from .url_filter import judge

    return judge(table(spark, folder, "pages"), URL_RULES, keep=["page_id"])


SQL["op5_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, coalesce(regexp_extract(url, '^(.*?)://(.*)$', 2, 's'), '') AS tail FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts of each document and whether rules and forest keep it."""
    from .quality_rules import COUNTS, apply_rules

    found = apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of each document."""
    from .toxicity import grade

    return grade(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])


@query
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of each document from compressed sizes."""
    from .compression_classifier import score_quality

    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])


@query
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    from .neighbours import search

    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query
def op12_exact_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 highest integer inner products of every vector whose id is divisible by 50."""
    from .exact_search import search

    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


SQL["op12_exact_search"] = r"""
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Eight whitened coordinates of every vector."""
    from .whitening import whiten

    found = whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best collocations of each language."""
    from .collocations import collocations

    return collocations(table(spark, folder, "documents"))


SQL["op11_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lines AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM lines GROUP BY lang
), phrases AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, k AS size, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM lines, generate_series(1, 5) AS ks(k), generate_series(1, len(w) - k + 1) AS places(i)
  ) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, n, k, l.f AS l, r.f AS r, ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM phrases WHERE size > 1) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 : c.size], ' ')
  JOIN sizes ON sizes.lang = c.lang
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM phrases p WHERE p.lang = s.lang AND p.phrase <> s.phrase AND 100 * p.f >= 100 * s.a
      AND contains(' ' || p.phrase || ' ', ' ' || s.phrase || ' ')
  )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
