"""SimHash near-dedup: fingerprints compared exactly within blocks of equal bits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .components import components, forest
from .scratch import settle, shards

# Fingerprints in a tile, and in a bucket that one task compares by itself.
TILE, BUCKET = 512, 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _majority(hashes: Callable[[int, int], np.ndarray], owner: np.ndarray, shingles: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Each text's bits that are set in over half of its hashes; `hashes(a, z)` gives those of shingles a to z."""
    ones = np.zeros((len(shingles), 64), dtype=np.int64)
    for a in range(0, len(owner), step):
        bits = np.unpackbits(hashes(a, a + step).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[a : a + step]
        head = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[own[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
    major = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()


def _shingles(first: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of shingles of each text, and the first word and the end of every shingle."""
    counts = np.diff(first)
    number = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    begin = flat.ragged(first[:-1], number)
    return number, begin, np.minimum(begin + shingle, np.repeat(first[1:], number))


def _fingerprints(data: np.ndarray, bounds: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    """64-bit SimHash of each text, from the XXH64 of its shingles."""
    data = _LOWER[data]
    starts, ends, _, first = flat.words(data, bounds, hashed=False)
    # the words of all texts with one space after each
    room = ends - starts + 1
    to = np.cumsum(room)
    spaced = np.full(int(to[-1]) if len(to) else 0, 32, dtype=np.uint8)
    spaced[flat.ragged(to - room, room - 1)] = data[flat.ragged(starts, room - 1)]
    body = spaced.tobytes()
    number, begin, end = _shingles(first, shingle)
    frm, til = (to - room)[begin], to[end - 1] - 1
    digest = xxhash.xxh64_intdigest

    def hashes(a: int, z: int) -> np.ndarray:
        return np.array([digest(body[s:e], seed) for s, e in zip(frm[a:z].tolist(), til[a:z].tolist(), strict=True)], dtype="<u8")

    return _majority(hashes, np.repeat(np.arange(len(number)), number), number)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """`id_col` and the `fingerprint` (long, the 64 bits) of every whole text.

    Words are lower-cased (A-Z) runs of anything but ASCII white space; shingles are `shingle` words joined by
    one space, repeats included; a shorter text is one shingle; a text without words (or null) has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprints(data, bounds, shingle, seed) for _, _, data, bounds in flat.groups(batch)]
            values = np.concatenate(found).view(np.int64) if found else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "fingerprint": pa.array(values)})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fingerprint long").withColumnRenamed("id", id_col)


def blocks(radius: int) -> list[int]:
    """Masks of bits such that two fingerprints within the radius agree on all bits of at least one mask.

    The 64 bits are cut into `radius + 2` blocks. At most `radius` of them differ, so two are equal: a mask
    for every pair of blocks.
    """
    edges = np.linspace(0, 64, radius + 3).astype(int)
    parts = [sum(1 << int(b) for b in range(a, z)) for a, z in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(parts, 2)]


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int, beyond: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the pairs of two sets, or of one with itself, within the radius.

    A row holds a fingerprint, further fingerprints if any, and last its node (alone, it is its own node). The
    further ones may differ in `beyond` bits together. Sets are sorted by population count and cut into tiles; a
    pair of tiles is skipped when their population counts lie more than the radius apart. What earlier tiles have
    connected is not looked at again, so what is held is at most the pairs of two tiles.
    """
    order = lambda x: x[np.argsort(np.bitwise_count(x[:, 0]), kind="stable")]
    rows = order(left) if right is None else np.concatenate([order(left), order(right)])
    split = 0 if right is None else len(left)
    prints, nodes = rows[:, 0], rows[:, -1]
    size = np.bitwise_count(prints).astype(int)
    group = np.arange(len(rows))  # a row that each row is connected with
    a, b = [], []
    for i in range(0, len(left), TILE):
        own = slice(i, min(i + TILE, len(left)))
        for k in range(i if right is None else split, len(rows), TILE):
            other = slice(k, min(k + TILE, len(rows)))
            if size[other.start] > size[own.stop - 1] + radius or size[other.stop - 1] < size[own.start] - radius:
                continue
            near = np.bitwise_count(prints[own, None] ^ prints[None, other]) <= radius
            if i == k:
                near = np.triu(near, 1)
            if not near.any():
                continue
            r, c = np.nonzero(near & (group[own, None] != group[None, other]))
            r, c = r + i, c + k
            if rows.shape[1] > 2:
                close = np.bitwise_count(rows[r, 1:-1] ^ rows[c, 1:-1]).sum(axis=1, dtype=np.int64) <= beyond
                r, c = r[close], c[close]
            root, joined = forest(group[r], group[c])
            to = np.arange(len(rows))
            to[joined] = root
            group = to[group]
            a.append(nodes[root])
            b.append(nodes[joined])
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


_EDGES = "a long, b long, block int, key long, tile int, body binary"


def _compare(radius: int, beyond: int):
    """Links within each bucket of a sorted stream; a bucket over `BUCKET` is passed on in parts."""
    masks = np.array(blocks(radius), dtype=np.uint64)

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = forest(a, b)
        none = pa.nulls(len(a))
        return pa.RecordBatch.from_pydict(
            {"a": pa.array(a), "b": pa.array(b), "block": none.cast(pa.int32()), "key": none.cast(pa.int64()), "tile": none.cast(pa.int32()), "body": none.cast(pa.binary())}
        )

    def part(block: int, key: int, tile: int, body: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(1).cast(pa.int64())
        return pa.RecordBatch.from_pydict(
            {"a": none, "b": none, "block": pa.array([block], pa.int32()), "key": pa.array([key], pa.int64()), "tile": pa.array([tile], pa.int32()), "body": pa.array([body.tobytes()], pa.binary())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, key, rows so far, parts passed on)
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def close():
            block, key, own, passed = held
            own = np.concatenate(own)
            if passed:
                yield part(block, key, passed, own)
            elif len(own) > 1:
                a, b = tile_links(own, None, radius, beyond)
                if len(a):
                    found.append((a.view(np.int64), b.view(np.int64)))

        for batch in batches:
            block = batch.column("block").to_numpy()
            rows = np.stack([batch.column(k).to_numpy().view(np.uint64) for k in range(1, batch.num_columns)], axis=1)
            key = (rows[:, 0] & masks[block]).view(np.int64)
            head = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (key[1:] != key[:-1]))) if len(block) else []
            for i, s in enumerate(head):
                e = head[i + 1] if i + 1 < len(head) else len(block)
                if held and (held[0], held[1]) == (block[s], key[s]):
                    held[2].append(rows[s:e])
                else:
                    if held:
                        yield from close()
                    held = [block[s], key[s], [rows[s:e]], 0]
                while sum(map(len, held[2])) > BUCKET:
                    own = np.concatenate(held[2])
                    yield part(held[0], held[1], held[3], own[:BUCKET])
                    held[2], held[3] = [own[BUCKET:]], held[3] + 1
            if sum(len(a) for a, _ in found) > 1 << 16:
                yield edges(*map(np.concatenate, zip(*found, strict=True)))
                found = []
        if held:
            yield from close()
        if found:
            yield edges(*map(np.concatenate, zip(*found, strict=True)))

    return run


def _compare_parts(radius: int, beyond: int, width: int):
    """Links between two parts of one large bucket, of `width` values a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, other = (np.frombuffer(row[x], dtype=np.uint64).reshape(-1, width) for x in ("body", "other_body"))
                a, b = tile_links(left, None if row["tile"] == row["other_tile"] else other, radius, beyond)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return run


def links(distinct: DataFrame, radius: int, beyond: int = 0) -> DataFrame:
    """Links `a`, `b` that connect all distinct fingerprints within the radius of each other.

    `distinct` has the `fingerprint` alone, which is then its own node, or further fingerprints after it and last
    the node; see `tile_links`. Every pair within the radius shares a bucket (`blocks`), where it is compared
    exactly. A bucket returns the links of a spanning forest, which connects what its pairs connect.
    """
    spark = distinct.sparkSession
    masks = F.array(*(F.lit(m - (1 << 64) if m >= 1 << 63 else m).cast("long") for m in blocks(radius)))
    rows = distinct.select(F.posexplode(masks).alias("block", "mask"), *distinct.columns).drop("mask")
    key = F.col("fingerprint").bitwiseAND(F.get(masks, F.col("block")))
    rows = rows.repartition(shards(spark), "block", key).sortWithinPartitions("block", key)
    found = settle(rows.mapInArrow(_compare(radius, beyond), _EDGES), "tile-links")
    parts = found.where("a is null").select("block", "key", "tile", "body")
    other = parts.select("block", "key", F.col("tile").alias("other_tile"), F.col("body").alias("other_body"))
    pairs = parts.join(other, ["block", "key"]).where("tile <= other_tile")
    within = pairs.mapInArrow(_compare_parts(radius, beyond, len(distinct.columns)), "a long, b long")
    return found.where("a is not null").select("a", "b").unionByName(within)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, radius: int = 4) -> DataFrame:
    """`id_col`, `fingerprint` (long) and `component_id` of every document.

    Fingerprints link at `radius` or fewer differing bits; `component_id` is the smallest id that links reach,
    the document's own included. Equal fingerprints, those of empty texts included, link like any other.
    A null id takes part and has the smallest id of its component, null if that has none; rows repeated in the
    table are returned as often. An empty table gives an empty table.
    """
    prints = settle(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = settle(prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    joined = settle(components(links(distinct.select("fingerprint"), radius)), "fingerprint-components")
    named = distinct.join(joined, distinct["fingerprint"] == joined["node"], "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    least = settle(named.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    named = settle(named.select("fingerprint", "component").join(least, "component").select("fingerprint", "component_id"), "named-fingerprints")
    return prints.join(named, "fingerprint").select(id_col, "fingerprint", "component_id")
