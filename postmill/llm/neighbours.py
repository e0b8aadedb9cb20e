"""Approximate nearest neighbours by several shifted Hilbert orderings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import settle, shards

# Rows of an ordering that are compared at a time.
CHUNK = 1 << 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of `bits`-bit coordinates) along the Hilbert curve, as int64.

    Gray-code each coordinate's bits against the first one from the top bit down, then interleave them.
    """
    x = cells.T.astype(np.int64)
    d = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(d):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(set_, below, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


class Orderings:
    """Random rotations to few dimensions, each with its shift of the grid."""

    def __init__(self, sample: np.ndarray, number: int, dims: int, bits: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.dims, self.bits = min(dims, size), bits
        self.turns, self.low, self.width = [], [], []
        for _ in range(number):
            turn = np.linalg.qr(rng.normal(size=(size, size)))[0][:, : self.dims]
            spread = sample @ turn
            centre, scale = spread.mean(0), np.maximum(spread.std(0), 1e-12)
            self.turns.append(turn)
            self.low.append(centre + scale * (rng.uniform(-0.5, 0.5, self.dims) - 3))
            self.width.append(6 * scale)

    def key(self, which: int, x: np.ndarray) -> np.ndarray:
        cells = (x @ self.turns[which] - self.low[which]) / self.width[which] * (1 << self.bits)
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed coordinate by coordinate, so that equal vectors give equal products."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


def _matrix(values: pa.Array | list[bytes], kind: np.dtype, size: int) -> np.ndarray:
    """Packed vectors in double precision."""
    body = b"".join(values.to_pylist() if isinstance(values, pa.Array) else map(bytes, values))
    return np.frombuffer(body, dtype=kind).reshape(-1, size).astype(np.float64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k greatest of each row; -inf is none."""
    k = min(k, scores.shape[1])
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(scores)), k)
    top = top.ravel()
    real = np.isfinite(scores[rows, top])
    return rows[real], top[real]


def _distinct(rows: DataFrame, kind: np.dtype, k: int) -> DataFrame:
    """`vec`, `node` (its least id), the k + 1 least `ids` (more are never asked for), the dimension's vectors once.

    Ids are cut down in each batch, then by salted groups, so that no task gathers those of a frequent vector.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pd.DataFrame({"id": batch.column("id").to_pylist(), "vec": [np.asarray(v, dtype=np.float64) for v in batch.column("vec").to_pylist()]})
            good = [len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any()) for v in frame["vec"]]
            frame = frame[good].sort_values("id")
            frame["vec"] = [(v + 0.0).astype(kind).tobytes() for v in frame["vec"]]  # no negative zero
            found = frame.groupby("vec", sort=False)["id"].agg(lambda ids: ids.head(k + 1).tolist())
            yield pa.RecordBatch.from_pydict({"vec": pa.array(list(found.index), pa.binary()), "ids": pa.array(list(found), pa.list_(pa.int64()))})

    least = lambda c: F.slice(F.array_sort(F.flatten(F.collect_list(c))), 1, k + 1).alias("ids")
    packed = rows.mapInArrow(pack, "vec binary, ids array<long>")
    salted = packed.groupBy("vec", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("salt")).agg(least("ids"))
    return salted.groupBy("vec").agg(least("ids")).withColumn("node", F.col("ids")[0])


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", orderings: int = 16, dims: int = 8, bits: int = 6, fit_rows: int = 4096, probes: int = 256, recall: float = 0.96
) -> DataFrame:
    """Each query's k nearest rows by inner product: `query_id`, `rank`, `vec_id`, `score`; ties to the smaller id.

    Vectors are put on a unit sphere of one dimension more, where the greatest inner product is the nearest point;
    `orderings` random projections of `dims` dimensions are each ordered along a shifted Hilbert curve and range-
    partitioned. A query meets the rows within a window of its place in each ordering; the best of every window
    are merged and ranked by the exact product. The window is calibrated: for at most `probes` queries the true
    neighbours are found by comparing with every row, and the window is the least that holds `recall` of them.
    On data without structure that window is a share of the table; see the README.

    Projections are scaled on at most `fit_rows` vectors; every vector is in every ordering. Vectors that are
    null, empty, zero or hold null or non-finite components take no part, as queries or as rows, nor do rows with
    a null id; vectors of another length than the most frequent one take no part either. Equal vectors are one
    point, with the ids that may be asked for. Repeated (id, vector) rows are one candidate.
    """
    spark = vectors.sparkSession
    shape = lambda t: t.select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vec_col), lambda v: v.cast("double")).alias("vec")).where("id is not null and vec is not null").distinct()
    plain = all("array<float>" in t.schema[vec_col].dataType.simpleString() for t in (vectors, queries))
    kind = np.dtype(np.float32 if plain else np.float64)  # as stored; products are in double precision
    points = settle(_distinct(shape(vectors), kind, k), "vectors")
    asked = settle(shape(queries).join(shape(vectors), ["id", "vec"]).select(F.col("id").alias("query_id"), "vec").mapInArrow(_bytes(kind), "query_id long, vec binary"), "queries")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = points.groupBy(F.length("vec").alias("bytes")).count().orderBy(F.desc("count"), "bytes").limit(1).collect()
    if not sizes:
        return empty
    size = sizes[0]["bytes"] // kind.itemsize
    points, asked = points.where(F.length("vec") == kind.itemsize * size), asked.where(F.length("vec") == kind.itemsize * size)

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"norm": pa.array((_matrix(batch.column("vec"), kind, size) ** 2).sum(1))})

    longest = float(points.select("vec").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0])
    wanted = settle(asked.select("vec").distinct().withColumn("query", F.xxhash64("vec")), "query-vectors")

    def lift(x: np.ndarray, query: bool) -> np.ndarray:
        """Points on the unit sphere: rows get their missing length, queries their direction."""
        own = (x**2).sum(1)
        if query:
            return np.column_stack([x / np.sqrt(own)[:, None], np.zeros(len(x))])
        return np.column_stack([x / np.sqrt(longest), np.sqrt(np.maximum(1 - own / longest, 0))])

    fit = points.orderBy(F.xxhash64("vec"), "vec").limit(fit_rows).select("vec").collect()
    curves = Orderings(lift(_matrix([r.vec for r in fit], kind, size), False), orderings, dims, bits)

    def keys(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = lift(_matrix(batch.column("vec"), kind, size), query)
                for which in range(orderings):
                    yield pa.RecordBatch.from_pydict({"curve": pa.array(np.full(len(x), which, np.int32)), "key": pa.array(curves.key(which, x)), "node": batch.column("node"), "query": pa.array(np.full(len(x), query))})

        return run

    schema = "curve int, key long, node long, query boolean"
    entries = points.select("node", "vec").mapInArrow(keys(False), schema).unionByName(wanted.select(F.col("query").alias("node"), "vec").mapInArrow(keys(True), schema))
    # places: number within each range partition, moved on by the partitions before
    order = ["curve", "key", "query", "node"]
    ranged = entries.repartitionByRange(shards(spark), *order).withColumn("part", F.spark_partition_id())
    ranged = settle(ranged.withColumn("local", F.row_number().over(Window.partitionBy("part", "curve").orderBy(*order))), "orderings")
    counts = ranged.groupBy("part", "curve").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = ranged.join(counts.withColumn("before", before), ["part", "curve"]).select("curve", "query", "node", (F.col("local") + F.col("before")).alias("place"))
    places = settle(places, "places")
    window = _window(points, wanted, places, kind, size, k, probes, recall)
    both = points.select("node", "vec", F.lit(False).alias("query")).unionByName(wanted.select(F.col("query").alias("node"), "vec", F.lit(True).alias("query")))
    found = _windows(places.join(both, ["query", "node"]), window, kind, size, k)
    # merge the windows, then rank by the exact product
    top = found.distinct().join(points.select("node", "vec", "ids"), "node").join(wanted.withColumnRenamed("vec", "query_vec"), "query")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _products(_matrix(batch.column("query_vec"), kind, size), _matrix(batch.column("vec"), kind, size))
            yield pa.RecordBatch.from_pydict({"query": batch.column("query"), "ids": batch.column("ids"), "score": pa.array(score)})

    scored = top.select("query", "ids", "query_vec", "vec").mapInArrow(rerank, "query long, ids array<long>, score double")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = scored.select("query", "score", F.explode("ids").alias("vec_id")).withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1)
    listed = settle(listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")), "nearest")
    mine = asked.select("query_id", F.xxhash64("vec").alias("query")).distinct().join(listed, "query")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = mine.select("query_id", F.posexplode(others).alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def _bytes(kind: np.dtype):
    """Valid query vectors as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.asarray(v, dtype=np.float64) + 0.0 for v in batch.column("vec").to_pylist()]
            good = np.array([len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any()) for v in own], dtype=bool)
            packed = [v.astype(kind).tobytes() for v, g in zip(own, good, strict=True) if g]
            yield pa.RecordBatch.from_pydict({"query_id": batch.column("query_id").filter(pa.array(good)), "vec": pa.array(packed, pa.binary())})

    return run


def _window(points: DataFrame, wanted: DataFrame, places: DataFrame, kind: np.dtype, size: int, k: int, probes: int, recall: float) -> int:
    """Least window that holds `recall` of the true neighbours of some queries, found among all rows."""
    chosen = wanted.orderBy("query", "vec").limit(probes).collect()
    if not chosen:
        return 1
    names = np.array([r["query"] for r in chosen])
    ask = _matrix([r["vec"] for r in chosen], kind, size)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = ask @ _matrix(batch.column("vec"), kind, size).T
                row, column = _best(scores, k)
                yield pa.RecordBatch.from_pydict({"query": pa.array(names[row]), "node": pa.array(batch.column("node").to_numpy()[column]), "score": pa.array(scores[row, column])})

    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    true = points.select("node", "vec").mapInArrow(nearest, "query long, node long, score double").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("query", "node")
    true = F.broadcast(settle(true, "true-neighbours"))  # at most `probes` times k rows
    rows = places.where("not query").select("curve", "node", "place").join(true, "node")
    own = places.where("query").select("curve", F.col("node").alias("query"), F.col("place").alias("own"))
    gaps = rows.join(F.broadcast(own.join(F.broadcast(settle(wanted.orderBy("query", "vec").limit(probes).select("query"), "probes")), "query")), ["curve", "query"])
    least = gaps.groupBy("query", "node").agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap")).toPandas()["gap"]
    return int(np.quantile(least, recall, method="higher")) if len(least) else 1


def _windows(places: DataFrame, window: int, kind: np.dtype, size: int, k: int) -> DataFrame:
    """`query`, `node`: the k best rows of each query in each ordering's window, by chunk of rows.

    Chunks of rows are packed once; a chunk with queries meets the chunks within the window, one pair at a time.
    """
    spark = places.sparkSession
    parts = shards(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            frame = batch.to_pandas()
            for name, own in frame.groupby(["curve", "chunk"], sort=False):
                held.setdefault(name, []).append(own)
            for name in list(held)[:-1]:  # sorted: only the last may go on
                yield _pack(name, held.pop(name))
        for name, own in held.items():
            yield _pack(name, own)

    rows = places.withColumn("chunk", F.floor(F.col("place") / CHUNK).cast("int")).repartition(parts, "curve", "chunk").sortWithinPartitions("curve", "chunk", "place")
    chunks = settle(rows.mapInArrow(pack, "curve int, chunk int, asks binary, ask_places binary, ask_vecs binary, nodes binary, node_places binary, vecs binary"), "chunks")
    reach = -(-window // CHUNK)
    asks = chunks.where(F.length("asks") > 0).select("curve", "asks", "ask_places", "ask_vecs", F.explode(F.sequence(F.col("chunk") - reach, F.col("chunk") + reach)).alias("chunk"))
    pairs = asks.join(chunks.select("curve", "chunk", "nodes", "node_places", "vecs"), ["curve", "chunk"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ask, at = np.frombuffer(row["asks"], dtype=np.int64), np.frombuffer(row["ask_places"], dtype=np.int64)
                node, place = np.frombuffer(row["nodes"], dtype=np.int64), np.frombuffer(row["node_places"], dtype=np.int64)
                scores = _matrix([row["ask_vecs"]], kind, size) @ _matrix([row["vecs"]], kind, size).T
                scores[np.abs(at[:, None] - place[None, :]) > window] = -np.inf
                if not scores.size:
                    continue
                # k + 1, as one may be the query itself
                i, j = _best(scores, k + 1)
                yield pa.RecordBatch.from_pydict({"query": pa.array(ask[i]), "node": pa.array(node[j]), "score": pa.array(scores[i, j])})

    near = pairs.mapInArrow(compare, "query long, node long, score double")
    near = near.groupBy("query", "node").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    # a margin over k + 1, as products of a matrix differ in the last digits
    return near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 4).select("query", "node")


def _pack(name: tuple, parts: list[pd.DataFrame]) -> pa.RecordBatch:
    own = pd.concat(parts)
    ask, rows = own[own["query"]], own[~own["query"]]
    values = {"curve": pa.array([name[0]], pa.int32()), "chunk": pa.array([name[1]], pa.int32())}
    for kind, nodes, at, vecs in ((ask, "asks", "ask_places", "ask_vecs"), (rows, "nodes", "node_places", "vecs")):
        values[nodes] = pa.array([kind["node"].to_numpy(dtype=np.int64).tobytes()], pa.binary())
        values[at] = pa.array([kind["place"].to_numpy(dtype=np.int64).tobytes()], pa.binary())
        values[vecs] = pa.array([b"".join(kind["vec"])], pa.binary())
    return pa.RecordBatch.from_pydict(values)
