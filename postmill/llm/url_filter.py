"""URL filters: a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str, str]  # verdict, host, path

# Rules as text up to this size go to every task; more of them are joined.
BROADCAST_BYTES = 32 << 20


def build(rules: Sequence[Rule]) -> dict:
    """Trie: host labels from the right, then path segments; a rule may end within a segment.

    A node is (nodes by label, nodes by segment, rules that end here as (rest of a segment, verdict, rule)).
    """
    root: tuple[dict, dict, list] = ({}, {}, [])
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node[0].setdefault(label, ({}, {}, []))
        *whole, rest = path.split("/")
        for segment in whole:
            node = node[1].setdefault(segment, ({}, {}, []))
        node[2].append((rest, verdict, host + path))
    return root


def match(root: tuple, host: str, path: str) -> tuple[str, str] | None:
    """Verdict and name of the longest rule: most host labels, then most of the path; block before allow."""
    best, found, node = None, None, root
    for depth, label in enumerate(reversed(host.split(".")), 1):
        node = node[0].get(label)
        if node is None:
            break
        inner, length = node, 0
        segments = path.split("/")
        for k, segment in enumerate(segments):
            for rest, verdict, name in inner[2]:
                if segment.startswith(rest):
                    rank = (depth, length + len(rest), verdict == "block")
                    if best is None or rank > best:
                        best, found = rank, (verdict, name)
            inner = inner[1].get(segment) if k + 1 < len(segments) else None
            if inner is None:
                break
            length += len(segment) + 1
    return found


def parts(url_col: str) -> tuple:
    """Host and path of a URL, both empty for null or without `://`."""
    after = F.regexp_extract(F.col(url_col), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", default: str = "allow", keep: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Pages with `host`, `path`, `rule` (null: none fits) and `verdict` (`default` if no rule fits).

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with the rule's. The longest
    rule wins: most host labels, then the longest path, then block. A null URL, or one without `://`, has an
    empty host and path, which no rule fits. Other columns are kept, but a result column replaces one of its
    name. Repeated rows are judged alike; an empty table gives an empty table. Rules beyond `broadcast_bytes`
    are joined to the distinct hosts' suffixes instead.
    """
    results = ["host", "path", "rule", "verdict"]
    keep = [c for c in (keep if keep is not None else pages.columns) if c not in results]
    host, path = parts(url_col)
    rows = pages.select(F.struct(*keep).alias("row"), host.alias("host"), path.alias("path"))
    if sum(len(h) + len(p) for _, h, p in rules) > broadcast_bytes:
        found = _joined(rows, rules)
    else:
        trie = pages.sparkSession.sparkContext.broadcast(build(rules))

        def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for hosts, paths in batches:
                hits = [match(trie.value, h, p) or (None, None) for h, p in zip(hosts, paths, strict=True)]
                yield pd.DataFrame(hits, columns=["verdict", "rule"], dtype=object)

        found = rows.withColumn("hit", F.pandas_udf(run, "verdict string, rule string", F.PandasUDFType.SCALAR_ITER)("host", "path"))
    return found.select("row.*", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def _joined(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same answers by a join: each distinct host and path meets the rules of its host's suffixes."""
    spark = rows.sparkSession
    listed = spark.createDataFrame([(v, h, p, h.count(".") + 1) for v, h, p in rules], "verdict string, rule_host string, rule_path string, depth int")
    listed = listed.groupBy("rule_host", "rule_path", "depth").agg(F.max("verdict").alias("verdict"))  # block is after allow
    asked = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    near = asked.withColumn("rule_host", F.explode(suffixes)).join(listed, "rule_host").where(F.startswith("path", "rule_path"))
    rank = F.struct("depth", F.length("rule_path"), "verdict")
    hits = near.groupBy("host", "path").agg(F.max_by(F.struct("verdict", F.concat("rule_host", "rule_path").alias("rule")), rank).alias("hit"))
    return rows.join(hits, ["host", "path"], "left")
