"""Best-fit packing with certified bin counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .scratch import settle, shards

END = 0
# A character that is one token where it stands alone.
MARK = "~"
# Distinct words whose ids a worker keeps.
CACHE = 1 << 20
# Pieces packed by one task.
TASK_PIECES = 1 << 20


class Encoder:
    """Token ids of whole texts.

    The tokenizer drops white space and splits at it first, so a text's ids are those of its words one after
    the other; a special token written out in a text has no white space inside and keeps its own id. Each
    distinct word is encoded once while the cache has room.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids[0]
        self.known = np.zeros(0, dtype=np.uint64)  # hashes, sorted
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _encoded(self, texts: list[str], step: int = 1024) -> tuple[np.ndarray, list[int]]:
        """Ids of all words with a mark after each, and the words left out.

        Words go to the tokenizer many at a time, parted by a mark that is a token of its own; words that hold
        the mark are left out.
        """
        alone = [k for k, t in enumerate(texts) if MARK in t]
        for k in alone:
            texts[k] = ""
        joined = [f" {MARK} ".join([*texts[a : a + step], ""]) for a in range(0, len(texts), step)]
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        return ids, alone

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        whole = list(texts)
        ids, alone = self._encoded(texts)
        marks = np.flatnonzero(ids == self.mark)
        size = np.diff(np.concatenate([[-1], marks])) - 1
        ids = ids[ids != self.mark]
        if alone:  # put the ids of these words in their places
            own = [self.tokenizer.encode(whole[k], add_special_tokens=False).ids for k in alone]
            parts = np.split(ids, np.cumsum(size)[:-1])
            for k, found in zip(alone, own, strict=True):
                parts[k] = np.array(found, dtype=np.uint32)
            ids, size = np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)
        if len(self.known) + len(hashes) > CACHE:  # start again with the words at hand
            self.known, self.at, self.size, self.ids = self.known[:0], self.at[:0], self.size[:0], self.ids[:0]
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, ids])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known, self.at, self.size = known[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin."""
        starts, ends, hashes, first = flat.words(data, bounds)
        names, example, back = np.unique(hashes, return_index=True, return_inverse=True)
        for again in (False, True):
            place = np.minimum(np.searchsorted(self.known, names), max(len(self.known) - 1, 0))
            new = np.ones(len(names), dtype=bool) if again or not len(self.known) else self.known[place] != names
            if not new.any():
                break
            if new.sum() + len(self.known) > CACHE:
                new[:] = True  # the cache is emptied, so all words at hand are learned
            pick = example[new]
            body = data.tobytes()
            self._learn(names[new], [body[s:e].decode("utf-8", "replace") for s, e in zip(starts[pick].tolist(), ends[pick].tolist(), strict=True)])
            place = np.searchsorted(self.known, names)
            break
        at, size = self.at[place][back], self.size[place][back]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.ids[flat.ragged(at, size)], total[first]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The worker's encoder, which the tasks it runs share."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048) -> DataFrame:
    """Pieces of at most `capacity` tokens: `doc_id`, `piece`, `start`, `length`, `ids_crc32`.

    A document's ids are its text's and one closing 0; only longer ones are cut. A null text is empty and
    gives one piece of one token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            names = batch.column("id")
            for a, b, data, bounds in flat.groups(batch, size=1 << 22):
                ids, first = encoder.encode(data, bounds)
                for k in range(b - a):
                    own = np.append(ids[first[k] : first[k + 1]], np.uint32(END)).astype("<u4")
                    name = names[a + k].as_py()
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        out.append((name, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin.

    Open bins are kept by the room they have left; a set bit of `rooms` says that a room occurs, so the
    tightest bin for a length is the lowest set bit from it on.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill = 0, []
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fill, dtype=np.int64)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; `counts[s]` lengths of s.

    Dual feasible functions map lengths to shares of a bin such that what fits one bin sums to at most one:
    the length itself; for each threshold t up to half the bin, lengths over capacity - t as whole bins and those
    under t as nothing; and the rounding of k + 1 times the length, for small k.
    """
    sizes = np.arange(capacity + 1)
    total = np.concatenate([[0], np.cumsum(counts * sizes)])  # of lengths below
    number = np.concatenate([[0], np.cumsum(counts)])
    best = -(-int(total[-1]) // capacity)
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t + 1]
    between = total[capacity - t + 1] - total[t]
    if len(t):
        best = max(best, int((whole * capacity + between + capacity - 1).max()) // capacity)
    for k in range(1, 101):
        exact = (k + 1) * sizes % capacity == 0
        share = np.where(exact, sizes * k, (k + 1) * sizes // capacity * capacity)  # in 1 / (k * capacity)
        best = max(best, -(-int((counts * share).sum()) // (k * capacity)))
    return best


_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, filled long, gap long"


def _pack(capacity: int):
    """Pack the pieces of a task; `gap` says how many bins the task has over its lower bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0

        def pack():
            nonlocal number
            rows = pa.Table.from_batches(held).combine_chunks()
            lengths = rows.column("length").to_numpy()
            bins, offsets, fill = best_fit_decreasing(lengths, capacity)
            gap = len(fill) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
            task = (TaskContext.get().partitionId() << 40) + number
            number += len(fill)
            rows = rows.append_column("bin", pa.array(task + bins)).append_column("offset", pa.array(offsets))
            rows = rows.append_column("filled", pa.array(fill[bins])).append_column("gap", pa.array(np.full(len(bins), gap)))
            yield from rows.to_batches()

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= TASK_PIECES:
                yield from pack()
                held, size = [], 0
        if size:
            yield from pack()

    return run


def pack(found: DataFrame, capacity: int = 2048, rounds: int = 6) -> DataFrame:
    """Pieces with `sequence_id` and `offset`, in as few sequences as can be.

    Each task packs its pieces best-fit decreasing and certifies its number of bins by a lower bound. Bins that
    are full stay, and so do nearly full ones of a task that meets its bound. The other bins, among them every
    task's last ones and all but the full ones of tasks with a gap, go in
    the next round to a quarter of the tasks (more if they hold too many), which exchange their documents that way. The rounds end when all
    bins together meet the bound of all pieces, or one task has packed the rest.
    """
    spark = found.sparkSession
    columns = found.columns
    counts = dict(found.groupBy("length").count().collect())  # one entry per length, at most `capacity`
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        histogram[size] = n
    bound = lower_bound(histogram, capacity)
    tasks = shards(spark, int(histogram.sum()), TASK_PIECES)
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    rest, done, settled = found, [], 0
    for number in range(rounds + 1):
        dealt = rest.select(*columns).repartition(tasks, key, "start")
        packed = settle(dealt.mapInArrow(_pack(capacity), _PACKED).withColumn("round", F.lit(number)), "packed")
        bins = packed.where("offset = 0").select(F.count("*"), F.coalesce(F.sum("gap"), F.lit(0))).first()
        last = tasks == 1 or number == rounds or settled + bins[0] <= bound
        # a certified task keeps its nearly full bins; a task with a gap keeps its full ones
        stays = F.lit(True) if last else F.when(F.col("gap") == 0, F.col("filled") >= capacity - capacity // 256).otherwise(F.col("filled") == capacity)
        done.append(packed.where(stays))
        if last:
            break
        settled += done[-1].where("offset = 0").count()
        rest = packed.where(~stays)
        tasks = max(1, tasks // 4, -(-rest.count() // TASK_PIECES))
    union = done[0]
    for more in done[1:]:
        union = union.unionByName(more)
    sequence = F.col("round").cast("long") * F.lit(1 << 58) + F.col("bin")
    return union.select(*columns, sequence.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most `capacity` tokens.

    Columns: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`. A null id is returned
    as null, repeated rows are packed as often as they occur, and an empty table gives an empty table.
    """
    return pack(settle(pieces(docs, tokenizer, id_col, text_col, capacity), "pieces"), capacity)
