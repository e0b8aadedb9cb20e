"""Near copies by the similarity of shingle sets: bands of minimum hashes propose, whole sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .components import components
from .scratch import settle, shards
from .simhash import _LOWER, _shingles

# Shingles of the texts that share a band in one cell, and texts that are compared with one copy of a pivot.
CELL, FOLLOWERS = 1 << 17, 1 << 10


def _shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, where each text's begin, and a hash of each set."""
    _, _, words, first = flat.words(_LOWER[data], bounds)
    number, begin, end = _shingles(first, shingle)
    hashes = flat.range_hash(flat.prefix_hash(words), begin, end)
    owner = np.repeat(np.arange(len(number)), number)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    edges = np.searchsorted(owner, np.arange(len(number) + 1))
    total = np.append(np.uint64(0), np.cumsum(flat.mix(hashes), dtype=np.uint64))
    return hashes, edges, flat.mix(total[edges[1:]] - total[edges[:-1]] + flat.mix(np.diff(edges).astype(np.uint64)))


def _bands(hashes: np.ndarray, edges: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of each set that is not empty: a key hashes the least values of a set under `rows` functions."""
    head = edges[:-1][np.diff(edges) > 0]
    factors = np.random.default_rng(8).integers(0, 1 << 63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.zeros((len(head), bands), dtype=np.uint64)
    for band in range(bands) if len(head) else ():
        for factor in factors[band]:
            keys[:, band] = flat.mix(keys[:, band] + np.minimum.reduceat(hashes * factor, head))
    return keys


def _near(values: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have a Jaccard similarity that high."""
    at = np.minimum(np.searchsorted(values, other), len(values) - 1)
    shared = int((values[at] == other).sum())
    return shared >= similarity * (len(values) + len(other) - shared) - 1e-9


def set_links(values: np.ndarray, edges: np.ndarray, similarity: float, fresh: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs of sets (none empty) with a Jaccard similarity that high connect.

    Sets that are not `fresh` (all are by default) are connected already; pairs of two of them are not looked at.
    Each set is compared with those that nothing has reached yet, so many copies of one text cost little.
    """
    size = np.diff(edges)
    fresh = np.ones(len(size), dtype=bool) if fresh is None else fresh
    index = np.unique(values, return_inverse=True)[1]
    inside = np.zeros(len(index), dtype=bool)
    waiting = fresh.copy()
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for start in np.flatnonzero(fresh):
        queue, joined = [start] if waiting[start] else [], False
        waiting[start] = False
        while queue:
            x = queue.pop()
            fits = np.minimum(size, size[x]) >= similarity * np.maximum(size, size[x]) - 1e-9
            todo = np.flatnonzero(fits & (waiting if joined else waiting | ~fresh))
            if not len(todo):
                continue
            own = index[edges[x] : edges[x + 1]]
            inside[own] = True
            head = np.cumsum(size[todo]) - size[todo]
            shared = np.add.reduceat(inside[index[flat.ragged(edges[todo], size[todo])]], head, dtype=np.int64)
            inside[own] = False
            near = todo[shared >= similarity * (size[x] + size[todo] - shared) - 1e-9]
            known = near[~fresh[near]][:1]  # one link to the connected ones is enough
            joined |= len(known) > 0
            near = near[fresh[near]]
            waiting[near] = False
            queue += near.tolist()
            near = np.concatenate([known, near])
            a.append(np.full(len(near), x))
            b.append(near)
    return np.concatenate(a), np.concatenate(b)


def _keys(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in flat.groups(batch):
                hashes, edges, whole = _shingle_sets(data, bounds, shingle)
                found = _bands(hashes, edges, bands, rows).view(np.int64).ravel()
                size = np.diff(edges)
                offsets = np.append(0, np.cumsum(np.where(size > 0, bands, 0)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": batch.column("key").slice(a, b - a),
                        "node": pa.array(whole.view(np.int64)),
                        "size": pa.array(size.astype(np.int64)),
                        "bands": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found)),
                    }
                )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in flat.groups(batch):
                hashes, edges, whole = _shingle_sets(data, bounds, shingle)
                yield pa.RecordBatch.from_pydict({"node": pa.array(whole.view(np.int64)), "shingles": flat.binaries(hashes, edges)})

    return run


def _pivots(similarity: float):
    """Links of each pivot (`node` is `pivot`, first of its rows) with its near followers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            a, b = [], []
            for pivot, node, body in zip(batch.column("pivot").to_pylist(), batch.column("node").to_pylist(), batch.column("shingles"), strict=True):
                values = np.frombuffer(body.as_py(), dtype=np.uint64)
                if pivot == node:
                    head, own = pivot, values
                elif pivot == head and _near(own, values, similarity):
                    a.append(pivot)
                    b.append(node)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _cells(similarity: float):
    """Links within each cell of a sorted stream of `band, slot, low, high, node, fresh, shingles`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, nodes, fresh, sets = None, [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1 and any(fresh):
                edges = np.append(0, np.cumsum([len(x) for x in sets]))
                a, b = set_links(np.concatenate(sets), edges, similarity, np.array(fresh))
                own = np.array(nodes, dtype=np.int64)
                yield pa.RecordBatch.from_pydict({"a": pa.array(own[a]), "b": pa.array(own[b])})

        for batch in batches:
            *key, names, flags, bodies = batch.columns
            for *own, node, flag, body in zip(*(k.to_pylist() for k in key), names.to_pylist(), flags.to_pylist(), bodies, strict=True):
                if own != cell:
                    yield from close()
                    cell, nodes, fresh, sets = own, [], [], []
                nodes.append(node)
                fresh.append(flag)
                sets.append(np.frombuffer(body.as_py(), dtype=np.uint64))
        yield from close()

    return run


def similar_sets(
    texts: DataFrame, keys: list[str], shingle: int = 5, similarity: float = 0.8, bands: int = 24, rows: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Two tables: `key` (struct of `keys`) with `node`, the hash of the shingle set of `text`; and links `a`, `b` of nodes.

    Nodes link at a Jaccard similarity of `similarity` or more. Candidates agree in all `rows` minimum hashes of
    one of `bands` bands (at 0.8 a pair is missed with a probability of 7 in 100,000); whole sets decide.

    First every text meets the pivot of its bands, the member of least hash, which the bands of many copies of a
    text share: a pair of text and pivot is compared once, whatever the number of bands. A band all of whose
    texts are near its pivot is connected. In the others the texts that are not (the fresh ones) meet all members
    of the band; many of them are dealt out as pairs of parts, of which one holds fresh texts. So a set is sent
    once for each of its pivots, and again only where a band's texts differ.
    """
    spark = texts.sparkSession
    texts = texts.select(*keys, "text")
    named = texts.select(F.struct(*keys).alias("key"), "text")
    schema = f"key {named.schema['key'].dataType.simpleString()}, node long, size long, bands array<long>"
    prints = settle(named.mapInArrow(_keys(shingle, bands, rows), schema), "shingle-bands")
    distinct = prints.groupBy("node").agg(F.min("key").alias("key"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    distinct = settle(distinct, "distinct-shingle-bands")

    each = distinct.select("node", "size", F.posexplode("bands").alias("band", "slot"))
    pivot = F.min(F.struct(F.xxhash64("node").alias("order"), F.col("node").alias("pivot"), F.col("size").alias("pivot_size"))).alias("head")
    shared = each.groupBy("band", "slot").agg(F.count("*").alias("_n"), pivot).where("_n > 1")
    shared = settle(shared.select("band", "slot", "head.pivot", "head.pivot_size"), "shared-bands")
    members = settle(each.join(shared, ["band", "slot"]), "band-members")

    wanted = members.select("node").distinct().join(distinct.select("node", "key"), "node")
    wanted = settle(wanted.select("node", "key.*"), "member-nodes")
    bodies = texts.join(wanted.select(*keys).distinct(), keys).select("text")
    bodies = bodies.mapInArrow(_sets(shingle), "node long, shingles binary").join(wanted.select("node"), "node", "left_semi")
    bodies = settle(bodies.dropDuplicates(["node"]), "member-shingles")

    fits = F.least("size", "pivot_size") >= similarity * F.greatest("size", "pivot_size") - 1e-9
    pairs = settle(members.where((F.col("node") != F.col("pivot")) & fits).select("pivot", "node").distinct(), "pivot-pairs")
    salts = (F.count("*") / FOLLOWERS + 1).cast("int").alias("salts")
    heads = settle(pairs.groupBy("pivot").agg(salts), "pivots")
    followers = pairs.join(heads, "pivot").withColumn("salt", F.pmod(F.xxhash64("node"), "salts").cast("int"))
    leaders = heads.select(F.col("pivot"), F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    met = followers.select("pivot", "node", "salt").unionByName(leaders).join(bodies, "node")
    met = met.repartition(shards(spark), "pivot", "salt").sortWithinPartitions("pivot", "salt", F.col("pivot") != F.col("node"))
    near = settle(met.select("pivot", "node", "shingles").mapInArrow(_pivots(similarity), "a long, b long"), "pivot-links")

    known = near.select(F.col("a").alias("pivot"), F.col("b").alias("node"), F.lit(True).alias("known"))
    flagged = members.join(known, ["pivot", "node"], "left")
    fresh = (F.col("node") != F.col("pivot")) & F.col("known").isNull()
    flagged = settle(flagged.select("band", "slot", "node", "size", fresh.alias("fresh")), "flagged-members")
    mass = lambda c, name: F.sum(F.when(c, F.col("size")).otherwise(0)).alias(name)
    unsettled = flagged.groupBy("band", "slot").agg(mass(F.col("fresh"), "_new"), mass(~F.col("fresh"), "_old")).where("_new > 0")
    count = lambda c: (F.when(F.col("_new") + F.col("_old") > CELL, F.col(c) / CELL).otherwise(0) + 1).cast("int")
    alone = F.col("_new") + F.col("_old") <= CELL
    unsettled = settle(unsettled.select("band", "slot", alone.alias("alone"), count("_new").alias("news"), count("_old").alias("olds")), "unsettled-bands")

    spread = F.xxhash64("node", "band")
    part = F.when(F.col("alone"), F.lit(0)).when(F.col("fresh"), F.pmod(spread, "news")).otherwise(F.col("news") + F.pmod(spread, "olds")).cast("int")
    last = F.when(F.col("part") < F.col("news"), F.col("news") + F.col("olds") - 1).otherwise(F.col("news") - 1)
    dealt = flagged.join(unsettled, ["band", "slot"]).withColumn("part", part)
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("alone"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), last)))).where("alone or part <> other")
    dealt = dealt.select("band", "slot", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "fresh")
    at = ["band", "slot", "low", "high"]
    cells = dealt.join(bodies, "node").select(*at, "node", "fresh", "shingles").repartition(shards(spark), *at).sortWithinPartitions(*at)
    links = settle(near.unionByName(cells.mapInArrow(_cells(similarity), "a long, b long")), "similar-links")
    return prints.select("key", "node"), links


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, bands: int = 24, rows: int = 5
) -> DataFrame:
    """`id_col` and `component_id` of every document with an id, linked as `similar_sets` says.

    `component_id` is the smallest id that links reach. Words are those of `fingerprints`; texts without words (or
    null) link with each other. Equality of shingles and of sets is that of 64-bit hashes. Rows with a null id are
    left out; repeated rows are returned as often; an empty table gives an empty table.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("twin"), F.col(text_col).cast("string").alias("text"))
    prints, links = similar_sets(texts.where("id is not null"), ["id", "twin"], shingle, similarity, bands, rows)
    joined = settle(components(links), "similar-components")
    named = prints.groupBy("node").agg(F.min("key.id").alias("least")).join(joined, "node", "left")
    named = settle(named.select("node", "least", F.coalesce("component", "node").alias("component")), "shingle-components")
    least = settle(named.groupBy("component").agg(F.min("least").alias("component_id")), "least-similar-ids")
    named = settle(named.join(least, "component").select("node", "component_id"), "named-shingle-sets")
    return prints.join(named, "node").select(F.col("key.id").alias(id_col), "component_id")
