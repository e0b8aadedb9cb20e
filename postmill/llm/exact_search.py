"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie in cells of bounded size, dimension block by dimension block. A block of queries runs through a
cell's tiles and adds up inner products one dimension block at a time. After each, what the rest can still add
is at most the product of the two rest lengths; candidates that can't reach the query's k-th best score go, and
the survivors are compacted before the next dimension block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import settle, shards
from .vectors import integer_rows, unpacked, usual_size

# Vectors in a tile, queries compared at a time, dimensions in a block.
TILE, ASKED, DIMS = 4096, 256, 16
# Bytes of vectors in a cell (8 a dimension), which one task holds.
CELL_BYTES = 64 << 20
# A tile is searched pair by pair once this share of its pairs is left.
SPARSE = 1 / 16
# Products beyond this are not exact in double precision.
EXACT = 1 << 53
NONE = -(1 << 63)


def _rests(blocks: list[np.ndarray]) -> np.ndarray:
    """Length of each vector's part after each dimension block, one row a block; vectors are columns."""
    mass = [(b * b).sum(axis=0) for b in [*blocks[1:], np.zeros_like(blocks[0])]]
    return np.sqrt(np.cumsum(mass[::-1], axis=0)[::-1])


class Tile:
    """Some vectors, one matrix for each dimension block (a dimension is a row), longest first."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, order: np.ndarray):
        self.ids, self.rows = ids, rows
        turned = rows[:, order].T.astype(np.float64)
        self.blocks = [np.ascontiguousarray(turned[k : k + DIMS]) for k in range(0, len(turned), DIMS)]
        self.length = np.sqrt((turned * turned).sum(axis=0))
        self.rest = _rests(self.blocks)

    def hits(self, other: Tile, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query of `other`, vector) whose product reaches the query's `least`, and the products."""
        ask = np.arange(len(other.ids))
        if self.length.max() * other.length.max() >= EXACT / 2:
            return self._whole(other, least)
        ask = ask[other.length * self.length.max() * (1 + 1e-9) + 1 >= least]
        own = np.arange(len(self.ids))
        total = np.zeros((len(ask), len(own)))
        pairs = None
        for k, block in enumerate(self.blocks):
            if pairs is None:
                if not total.size:
                    break
                total += other.blocks[k][:, ask].T @ block[:, own]
                reach = total + other.rest[k][ask, None] * self.rest[k][None, own] * (1 + 1e-9)
                alive = reach + 0.5 >= least[ask, None]
                if alive.mean() < SPARSE:
                    r, c = np.nonzero(alive)
                    pairs, total = (ask[r], own[c]), total[r, c]
                else:
                    rows, columns = alive.any(axis=1), alive.any(axis=0)
                    if rows.mean() < 0.9 or columns.mean() < 0.9:
                        ask, own, total = ask[rows], own[columns], total[np.ix_(rows, columns)]
            else:
                q, c = pairs
                total = total + np.einsum("dp,dp->p", other.blocks[k][:, q], block[:, c])
                alive = total + other.rest[k][q] * self.rest[k][c] * (1 + 1e-9) + 0.5 >= least[q]
                pairs, total = (q[alive], c[alive]), total[alive]
        if pairs is None:
            r, c = np.nonzero(total >= least[ask, None]) if total.size else (ask[:0], own[:0])
            pairs, total = (ask[r], own[c]), total[r, c]
        score = np.rint(total).astype(np.int64)
        near = (score >= least[pairs[0]]) & (other.ids[pairs[0]] != self.ids[pairs[1]])
        return pairs[0][near], pairs[1][near], score[near]

    def _whole(self, other: Tile, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for numbers beyond double precision, in whole numbers of any size; scores saturate at 64 bits."""
        product = other.rows.astype(object) @ self.rows.astype(object).T
        score = np.clip(product, NONE, -NONE - 1).astype(np.int64)
        q, c = np.nonzero((score >= least[:, None]) & (other.ids[:, None] != self.ids[None, :]))
        return q, c, score[q, c]


def _ranked(ask: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, greatest score first, ties to the smaller id."""
    order = np.lexsort((ids, ~score, ask))
    head = np.append(True, ask[order][1:] != ask[order][:-1])[: len(order)]
    begin = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0)) if len(order) else order
    return order[np.arange(len(order)) - begin < k]


def best_of_cell(tiles: list[Tile], asked: Tile, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best of a cell that reach its `least`: place of the query, id, score."""
    least = least.copy()
    best = (np.zeros(0, np.int64),) * 3
    for tile in tiles:
        q, c, score = tile.hits(asked, least)
        if not len(q):
            continue
        best = tuple(np.concatenate(x) for x in zip(best, (q, tile.ids[c], score), strict=True))
        top = _ranked(*best, k)
        best = tuple(x[top] for x in best)
        count = np.bincount(best[0], minlength=len(least))
        kth = np.cumsum(count)[count >= k] - 1
        least[count >= k] = np.maximum(least[count >= k], best[2][kth])
    return best


def _tiles(ids: np.ndarray, rows: np.ndarray, order: np.ndarray) -> list[Tile]:
    return [Tile(ids[a : a + TILE], rows[a : a + TILE], order) for a in range(0, len(ids), TILE)]


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", factor: int = 256, seed_rows: int = 2048
) -> DataFrame:
    """Each query's k best rows by integer inner product: `query_id`, `rank`, `vec_id`, `score`; ties to the smaller id.

    Entries become floor(factor * entry). Every row of `vectors` but those with the query's own id is a candidate;
    results are exact. The cost is a product of the number of queries and of rows, less what the bounds save: with
    queries that are a share of the rows it grows with the square of the table, as exact search must. Queries cross
    the shuffle once a cell, vectors once.

    A query starts from the k-th best score among about `seed_rows` rows of least hash (a lower bound, so nothing
    is lost). Dimensions of great mass come first; it is summed over all rows.

    Vectors that are null, empty or hold null or non-finite entries take no part, as queries or as rows, nor do
    rows with a null id and vectors of another length than the most frequent one. Zero vectors take part.
    Repeated (id, vector) rows are one; one id with several vectors is several rows. Entries saturate at 2**61
    and scores at the ends of 64 bits. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    rows = settle(integer_rows(vectors, id_col, vec_col, factor), "integer-vectors")
    asks = settle(integer_rows(queries, id_col, vec_col, factor), "integer-queries")
    size, count = usual_size(rows)
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows, asks = (t.where(F.col("size") == size).select("id", "vec") for t in (rows, asks))

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(size)
        for batch in batches:
            mass += (unpacked(batch.column("vec"), size).astype(np.float64) ** 2).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(np.arange(size, dtype=np.int32)), "mass": pa.array(mass)})

    heavy = {r.dim: r.mass for r in rows.mapInArrow(masses, "dim int, mass double").groupBy("dim").agg(F.sum("mass").alias("mass")).collect()}
    order = np.argsort([-heavy[d] for d in range(size)], kind="stable")

    # rows of least hash, at most twice as many as asked for
    share = int(min(1.0, seed_rows / count) * ((1 << 62) - 1))
    drawn = rows.where(F.xxhash64("id", "vec").bitwiseAND((1 << 62) - 1) <= share).limit(2 * seed_rows).toArrow()
    seeds = _tiles(drawn.column("id").to_numpy(), unpacked(drawn.column("vec"), size), order)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ASKED):
                part = batch.slice(a, ASKED)
                asked = Tile(part.column("id").to_numpy(), unpacked(part.column("vec"), size), order)
                least = np.full(len(asked.ids), NONE)
                q, _, score = best_of_cell(seeds, asked, least, k)
                found = np.bincount(q, minlength=len(least))
                least[found >= k] = score[np.cumsum(found)[found >= k] - 1]
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "vec": part.column("vec"), "least": pa.array(least)})

    cells = shards(spark, count * size * 8, CELL_BYTES)
    dealt = rows.withColumn("least", F.lit(None).cast("long")).withColumn("cell", F.pmod(F.xxhash64("id", "vec"), F.lit(cells)).cast("int"))
    started = asks.mapInArrow(start, "id long, vec binary, least long")
    everywhere = started.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    # within a cell the vectors come first (`least` is null), then the queries
    met = dealt.unionByName(everywhere).repartition(cells, "cell").distinct().sortWithinPartitions("cell", F.asc_nulls_first("least"), "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, tiles = None, [], []

        def built() -> list[Tile]:
            if not held:
                return []
            ids, own = (np.concatenate(x) for x in zip(*held, strict=True))
            by_length = np.argsort(-np.einsum("nd,nd->n", own.astype(np.float64), own.astype(np.float64)), kind="stable")
            return _tiles(ids[by_length], own[by_length], order)

        for batch in batches:
            names, waiting = batch.column("cell").to_numpy(), np.asarray(batch.column("least").is_valid())
            change = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (waiting[1:] != waiting[:-1]))) if len(names) else []
            for a, z in zip(change, [*change[1:], len(names)], strict=True):
                if names[a] != cell:
                    cell, held, tiles = names[a], [], []
                ids, own = batch.column("id")[a:z].to_numpy(), unpacked(batch.column("vec")[a:z], size)
                if not waiting[a]:
                    held.append((ids, own))
                    continue
                if held:
                    tiles, held = built(), []
                least = batch.column("least")[a:z].to_numpy()
                for s in range(0, len(ids), ASKED):
                    part = slice(s, s + ASKED)
                    asked = Tile(ids[part], own[part], order)
                    q, found, score = best_of_cell(tiles, asked, least[part], k)
                    twin = pa.array([hash_of(own[part][x]) for x in range(len(asked.ids))], pa.int64()).take(pa.array(q))
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(asked.ids[q]), "twin": twin, "vec_id": pa.array(found), "score": pa.array(score)})

    near = met.mapInArrow(compare, "query_id long, twin long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def hash_of(row: np.ndarray) -> int:
    """Tells vectors of one id apart."""
    return xxhash.xxh64_intdigest(row.tobytes()) - (1 << 63)
