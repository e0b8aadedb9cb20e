"""Repeated windows of a corpus: which passages can repeat, where they meet, what goes.

Shared by the two exact substring operators. Five steps:

1. Each text is cut into runs of windows that share an anchor (`flat.window_runs`). Equal windows have
   equal anchors wherever they stand. Anchors go to reducers, one entry per anchor and map buffer.
2. Anchors that occur once in the corpus are done: their windows are unique. The other runs are listed
   by document. Anchors that fill an eighth of a reducer or more are listed as heavy: at most `HEAVY` per reducer.
3. The passages of listed runs go to the shard of their anchor, equal passages of a map buffer once.
   A heavy anchor's passages are cut into single windows and dealt out by their content instead.
4. Each shard builds its index and says which windows start earlier somewhere else.
5. The answers return to the documents as ranges of windows.

No step holds more than a map buffer, a shard or one document's ranges. Texts are shuffled once: the two
joins by document share their exchange. Shards are counted by the bytes listed in step 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .scratch import settle, shards

# Heaviest anchors listed by each reducer: each has an eighth of its entries, and so many occurrences, at least.
HEAVY, HEAVY_COUNT = 8, 4096
# Entries and their documents, and bytes of passages, that a map buffer holds.
BUFFER_ROWS, BUFFER_BYTES = 1 << 20, 16 << 20
SHARD_BYTES = 16 << 20

Answer = Callable[["Passages"], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Unit:
    """What windows are made of: words or bytes."""

    words: bool
    window: int
    gram: int

    def runs(self, data: np.ndarray, bounds: np.ndarray):
        """Runs of windows, a function for their bytes and one for a hash of their content.

        The bytes of words have one space after each word, so that equal words have equal bytes.
        """
        if self.words:
            starts, ends, units, bounds = flat.words(data, bounds)
        else:
            units = data
        text, first, n, anchor, twice = flat.window_runs(units, bounds, self.window, self.gram)

        def cut(text, first, n):
            at = bounds[text] + first
            length = n + self.window - 1
            if not self.words:
                return length, data[flat.ragged(at, length)]
            own = flat.ragged(at, length)
            body, room = flat.spaced(data, starts[own], ends[own])
            return np.diff(np.concatenate([[0], np.cumsum(room)])[np.concatenate([[0], np.cumsum(length)])]), body

        def content(text, first, n):
            at = bounds[text] + first
            prefix = flat.prefix_hash(units if self.words else flat._BYTES[units])
            return flat.range_hash(prefix, at, at + n + self.window - 1)

        return text, first, n, anchor, twice, cut, content


@dataclass
class Passages:
    """Passages of a shard: keys of their document, first window, number of windows, anchor, bytes."""

    doc: np.ndarray
    twin: np.ndarray
    first: np.ndarray
    n: np.ndarray
    anchor: np.ndarray
    size: np.ndarray
    body: np.ndarray

    FIELDS = (("doc", np.int64), ("twin", np.int64), ("first", np.int64), ("n", np.int32), ("anchor", np.uint64), ("size", np.int32), ("body", np.uint8))

    @classmethod
    def joined(cls, parts: list[Passages]) -> Passages:
        return cls(*(np.concatenate([getattr(p, k) for p in parts]) if parts else np.zeros(0, kind) for k, kind in cls.FIELDS))

    def take(self, index: np.ndarray) -> Passages:
        rows = [getattr(self, k)[index] for k, _ in self.FIELDS[:-1]]
        return Passages(*rows, flat.picked(self.body, self.size, index))

    def again(self) -> np.ndarray:
        """Mask of passages that are the one before once more: a row repeated in the table."""
        out = np.zeros(len(self), dtype=bool)
        out[1:] = (self.doc[1:] == self.doc[:-1]) & (self.twin[1:] == self.twin[:-1]) & (self.first[1:] == self.first[:-1])
        return out

    def __len__(self) -> int:
        return len(self.doc)


def _record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket, the buckets that occur, and where each begins."""
    order = np.argsort(bucket, kind="stable")
    names, begins = np.unique(bucket[order], return_index=True)
    return order, names, np.append(begins, len(bucket))


def keyed(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """Texts with `doc` and `twin`, the order of documents: by id (null last), then by the text's hash."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("twin"),
        F.col(text_col).cast("string").alias("text"),
        F.struct(*keep).alias("carried"),
    )


_ANCHORS = "bucket int, rows int, anchor binary, doc binary, twin binary, place binary, first binary, times binary"


def _anchors(unit: Unit, buckets: int):
    """Step 1: entries by bucket. `times` is 0 for a later occurrence in the buffer, which needs no answer."""

    def flush(parts):
        anchor, text, first, twice, doc, twin = zip(*parts, strict=True)
        rows = np.cumsum([0, *map(len, doc)])
        place = np.concatenate([t + at for t, at in zip(text, rows, strict=False)])
        anchor, first, twice, doc, twin = (np.concatenate(x) for x in (anchor, first, twice, doc, twin))
        docs = np.stack([doc, twin], 1)
        order = np.argsort(anchor, kind="stable")
        anchor, place, first = anchor[order], place[order].astype(np.uint32), first[order].astype(np.uint32)
        head = np.ones(len(anchor), dtype=bool)
        head[1:] = anchor[1:] != anchor[:-1]
        times = np.zeros(len(anchor), dtype=np.uint32)
        times[head] = np.add.reduceat(1 + twice[order], np.flatnonzero(head))
        bucket = np.where(head, (anchor >> np.uint64(32)).astype(np.int64), flat.mix(docs[place, 0].view(np.uint64)).astype(np.int64) & 0x7FFFFFFF) % buckets
        order, names, begins = _by_bucket(bucket)
        used = [np.unique(place[order[a:b]], return_inverse=True) for a, b in zip(begins, begins[1:], strict=False)]
        doc_bounds = np.cumsum([0, *(len(u) for u, _ in used)])
        listed = docs[np.concatenate([u for u, _ in used])]
        yield _record(
            bucket=pa.array(names.astype(np.int32)),
            rows=pa.array(np.diff(begins).astype(np.int32)),
            anchor=flat.binaries(anchor[order], begins),
            doc=flat.binaries(listed[:, 0], doc_bounds),
            twin=flat.binaries(listed[:, 1], doc_bounds),
            place=flat.binaries(np.concatenate([r.ravel() for _, r in used]).astype(np.uint32), begins),
            first=flat.binaries(first[order], begins),
            times=flat.binaries(times[order], begins),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            docs, twins = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            for a, b, data, bounds in flat.groups(batch):
                text, first, _, anchor, twice, _, _ = unit.runs(data, bounds)
                if not len(anchor):
                    continue
                parts.append((anchor, text, first, twice, docs[a:b], twins[a:b]))
                size += len(anchor) + b - a
                if size >= BUFFER_ROWS:
                    yield from flush(parts)
                    parts, size = [], 0
        if size:
            yield from flush(parts)

    return run


def _to_documents(doc: np.ndarray, twin: np.ndarray, first: np.ndarray, n: np.ndarray, buckets: int) -> dict:
    """Ranges of windows packed by bucket of their document."""
    bucket = (flat.mix(doc.view(np.uint64)) >> np.uint64(33)).astype(np.int64) % buckets
    order, names, begins = _by_bucket(bucket)
    columns = {k: flat.binaries(v[order].astype(np.int64), begins) for k, v in (("doc", doc), ("twin", twin), ("first", first), ("n", n))}
    return {"bucket": pa.array(names.astype(np.int32)), "rows": pa.array(np.diff(begins).astype(np.int32)), **columns}


_BY_DOCUMENT = "doc long, twin long, ranges binary"


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of a bucket, with its ranges (first, number) in order."""
    parts = [[np.frombuffer(row[k], dtype=np.int64) for k in ("doc", "twin", "first", "n")] for batch in batches for row in batch.to_pylist()]
    if not parts:
        return
    doc, twin, first, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.lexsort((first, twin, doc))
    doc, twin = doc[order], twin[order]
    head = np.ones(len(doc), dtype=bool)
    head[1:] = (doc[1:] != doc[:-1]) | (twin[1:] != twin[:-1])
    begins = np.append(np.flatnonzero(head), len(doc))
    step = 1 << 12
    doc, twin, ranges = doc[head], twin[head], np.stack([first[order], n[order]], 1)
    for a in range(0, len(doc), step):
        own = begins[a : a + step + 1]
        yield _record(doc=pa.array(doc[a : a + step]), twin=pa.array(twin[a : a + step]), ranges=flat.binaries(ranges[own[0] : own[-1]].ravel(), 2 * (own - own[0])))


_LISTED = "bucket int, rows int, doc binary, twin binary, first binary, n binary, heavy long, times long"


def _repeated(buckets: int):
    """Step 2, over one bucket: runs whose anchor occurs again, by document; then the heavy anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _repeated_anchors(batches, buckets)

    return run


def _repeated_anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    parts = []
    for batch in batches:
        for row in batch.to_pylist():
            read = lambda k, kind: np.frombuffer(row[k], dtype=kind)  # noqa: E731,B023
            place = read("place", np.uint32)
            parts.append((read("anchor", np.uint64), read("doc", np.int64)[place], read("twin", np.int64)[place], read("first", np.uint32), read("times", np.uint32)))
    if not parts:
        return
    anchor, doc, twin, first, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    asked = times > 0
    names, back = np.unique(anchor[asked], return_inverse=True)
    total = np.bincount(back, weights=times[asked], minlength=len(names)).astype(np.int64)
    kept = ~asked
    kept[asked] = total[back] > 1
    doc, twin, first = doc[kept], twin[kept], first[kept].astype(np.int64)
    heavy = np.flatnonzero(total >= max(HEAVY_COUNT, total.sum() / HEAVY))
    heavy = heavy[np.argsort(-total[heavy], kind="stable")[:HEAVY]]
    columns = _to_documents(doc, twin, first, np.zeros(len(doc), dtype=np.int64), buckets)
    none = pa.nulls(len(columns["bucket"]), pa.int64())
    yield _record(**columns, heavy=none, times=none)
    if len(heavy):
        none = pa.nulls(len(heavy), pa.int32())
        empty = none.cast(pa.string()).cast(pa.binary())
        yield _record(bucket=none, rows=none, doc=empty, twin=empty, first=empty, n=empty, heavy=pa.array(names[heavy].view(np.int64)), times=pa.array(total[heavy]))


_SHIPPED = "bucket int, rows int, answer boolean, doc binary, twin binary, first binary, n binary, anchor binary, size binary, body binary"


def _ship(unit: Unit, heavy: np.ndarray, buckets: int):
    """Step 3: passages by shard; what repeats an earlier passage of the buffer goes on as an answer."""

    def rows(p: Passages, bucket: np.ndarray, answer: bool):
        order, names, begins = _by_bucket(bucket)
        if not len(names):
            return
        p = p.take(order)
        at = np.concatenate([[0], np.cumsum(p.size, dtype=np.int64)])
        yield _record(
            bucket=pa.array(names.astype(np.int32)),
            rows=pa.array(np.diff(begins).astype(np.int32)),
            answer=pa.array(np.full(len(names), answer)),
            **{k: flat.binaries(getattr(p, k).astype(kind), begins) for k, kind in Passages.FIELDS[:-1]},
            body=flat.binaries(p.body, at[begins]),
        )

    def flush(parts):
        p = Passages.joined(parts)
        ends = np.cumsum(p.size, dtype=np.int64)
        content = flat.slice_ids(p.body, ends - p.size, ends)
        order = np.lexsort((p.first, p.twin, p.doc, content))
        keys = Passages(p.doc[order], p.twin[order], p.first[order], *[p.n[:0]] * 4)
        order = order[~keys.again()]
        head = np.ones(len(order), dtype=bool)
        head[1:] = content[order][1:] != content[order][:-1]
        earliest = p.take(order[head])
        yield from rows(earliest, (flat.mix(earliest.anchor) >> np.uint64(33)).astype(np.int64) % buckets, False)
        later = order[~head]
        empty = np.zeros(len(later), dtype=np.int32)
        gone = Passages(p.doc[later], p.twin[later], p.first[later], p.n[later], p.anchor[later], empty, np.zeros(0, np.uint8))
        yield from rows(gone, (flat.mix(gone.doc.view(np.uint64)) >> np.uint64(33)).astype(np.int64) % buckets, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            batch = batch.filter(batch.column("listed").is_valid())
            docs, twins, lists = batch.column("doc").to_numpy(), batch.column("twin").to_numpy(), batch.column("listed")
            for a, b, data, bounds in flat.groups(batch):
                text, first, n, anchor, _, cut, content = unit.runs(data, bounds)
                wanted = [np.frombuffer(x.as_py(), dtype=np.int64)[::2] for x in lists.slice(a, b - a)]
                key = np.concatenate([(k << 40) + w for k, w in enumerate(wanted)])
                take = np.isin((text << 40) + first, key)
                text, first, n, anchor = text[take], first[take], n[take], anchor[take]
                if not len(n):
                    continue
                single = np.isin(anchor, heavy)
                if single.any():
                    times = np.where(single, n, 1)
                    k = flat.ragged(np.zeros(len(n), dtype=np.int64), times)
                    text, first, n, anchor, single = (np.repeat(x, times) for x in (text, first, n, anchor, single))
                    first, n = first + k, np.where(single, 1, n)
                    anchor[single] = content(text[single], first[single], n[single])
                size, body = cut(text, first, n)
                parts.append(Passages(docs[a + text], twins[a + text], first, n.astype(np.int32), anchor, size.astype(np.int32), body))
                held += len(body) + 48 * len(n)
                if held >= BUFFER_BYTES:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)

    return run


_ANSWERS = "bucket int, rows int, doc binary, twin binary, first binary, n binary"


def _answers(answer: Answer, buckets: int, piece_bytes: int):
    """Step 4, over one shard: ranges of windows (first, number) that start earlier elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, out = [], []
        for batch in batches:
            for row in batch.to_pylist():
                p = Passages(*(np.frombuffer(row[k], dtype=kind) for k, kind in Passages.FIELDS))
                if row["answer"]:
                    out.append((p.doc, p.twin, p.first, p.n.astype(np.int64)))
                else:
                    parts.append(p)
        passages = Passages.joined(parts)
        del parts
        if len(passages):
            pieces = int(passages.size.sum(dtype=np.int64)) // piece_bytes + 1
            piece = flat.mix(passages.anchor ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(pieces)
            order, _, begins = _by_bucket(piece)
            for a, b in zip(begins, begins[1:], strict=False):
                own = passages.take(order[a:b])
                own = own.take(np.lexsort((own.first, own.twin, own.doc)))
                own = own.take(np.flatnonzero(~own.again()))
                who, first, n = answer(own)
                out.append((own.doc[who], own.twin[who], first, n))
        if not out:
            return
        doc, twin, first, n = (np.concatenate(x) for x in zip(*out, strict=True))
        yield _record(**_to_documents(doc, twin, first, n, buckets))

    return run


def windows_to_ranges(passages: Passages, who: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single windows (passage, place in it; sorted) as ranges: passage, first window in the document, number."""
    if not len(who):
        return who, offset, offset
    head = np.ones(len(who), dtype=bool)
    head[1:] = (who[1:] != who[:-1]) | (offset[1:] != offset[:-1] + 1)
    begins = np.flatnonzero(head)
    return who[head], passages.first[who[head]] + offset[head], np.diff(np.append(begins, len(who)))


def covered(length: int, ranges: bytes, window: int) -> np.ndarray:
    """Mask of the units that the windows of the ranges cover."""
    first, n = np.frombuffer(ranges, dtype=np.int64).reshape(-1, 2).T
    edge = np.zeros(length + 1, dtype=np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + n + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_windows(texts: DataFrame, unit: Unit, answer: Answer, piece_bytes: int) -> DataFrame:
    """The rows of `keyed` with `ranges`: windows of each text that start earlier somewhere (null: none).

    `answer` gets the passages of some anchors, about `piece_bytes` of them, in document order.
    """
    spark = texts.sparkSession
    buckets = shards(spark)
    keys = ["doc", "twin"]
    entries = texts.select(*keys, "text").mapInArrow(_anchors(unit, buckets), _ANCHORS).repartitionById(buckets, "bucket")
    listed = settle(entries.mapInArrow(_repeated(buckets), _LISTED), "listed-runs")
    heavy = np.array([r.heavy for r in listed.where("heavy is not null").select("heavy").collect()], dtype=np.int64).view(np.uint64)
    runs = listed.where("heavy is null").select(F.sum(F.col("rows").cast("long"))).first()[0] or 0
    parts = shards(spark, runs * unit.window * (10 if unit.words else 2), SHARD_BYTES)
    ranges = ["bucket", "doc", "twin", "first", "n"]
    by_doc = listed.where("heavy is null").select(*ranges).repartitionById(buckets, "bucket").mapInArrow(_by_document, _BY_DOCUMENT)
    shipped = texts.join(by_doc.withColumnRenamed("ranges", "listed"), keys, "left")
    shipped = shipped.mapInArrow(_ship(unit, heavy, parts), _SHIPPED).repartitionById(parts, "bucket")
    answers = shipped.mapInArrow(_answers(answer, buckets, piece_bytes), _ANSWERS).select(*ranges)
    answers = answers.repartitionById(buckets, "bucket").mapInArrow(_by_document, _BY_DOCUMENT)
    return texts.join(answers, keys, "left").select("carried", "text", "ranges")
