"""Weighted markers of a table, found in texts by one automaton (goto and failure links) instead of one search each."""

import sys
import uuid
from array import array
from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Memory of one automaton, as estimated: its markers, and a node for each character of the prefixes that it holds.
AUTOMATON_BYTES = 192 << 20
_NODE, _MARKER = 80, 160
# Characters of a marker that the automaton holds. Where more markers than that share them, it holds twice as many.
PREFIX, SHARED = 12, 16

_built: dict = {}


class _Searcher:
    """Sorted markers, found by an automaton of their prefixes; those of a group share one and lie side by side."""

    def __init__(self, markers: Sequence[str], prefix: int = PREFIX, shared: int = SHARED):
        self.order = sorted(range(len(markers)), key=markers.__getitem__)
        self.markers = [markers[k] for k in self.order]
        self.groups = ahocorasick.Automaton()
        self.ends = array("q", bytes(8 * len(markers)))  # by first marker of a group; 0: that marker is the prefix, and alone
        todo = [(0, len(markers), prefix)]
        while todo:
            at, end, length = todo.pop()
            while at < end:
                head, last = self.markers[at][:length], at + 1
                while last < end and self.markers[last][:length] == head:
                    last += 1
                if last - at > shared:
                    todo.append((at, last, 2 * length))
                else:
                    self.ends[at] = 0 if last == at + 1 and self.markers[at] == head else last
                    self.groups.add_word(head, (at << 32) + len(head))
                at = last
        if markers:
            self.groups.make_automaton()

    def places(self, text: str) -> set[int]:
        """Places of the markers that occur in a text, in sorted order."""
        seen = set()
        if not self.markers:
            return seen
        for end, group in self.groups.iter(text):
            first = group >> 32
            last = self.ends[first]
            if not last:
                seen.add(first)
                continue
            begin = end + 1 - (group & 0xFFFFFFFF)
            for place in range(first, last):
                if place not in seen and text.startswith(self.markers[place], begin):
                    seen.add(place)
        return seen


def _scan(shared, blank: tuple[int, int]):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _built:  # once a worker; a worker keeps the automaton it used last
            _built.clear()
            search = _Searcher(shared.value["marker"])
            _built[name] = search, *(np.array(shared.value[k], dtype=np.int64)[search.order] for k in ("times", "weight"))
            search.order = None
        search, times, weight = _built[name]
        for batch in batches:
            hits, score = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for row, text in enumerate(batch.column("_text")):
                if text.is_valid:
                    seen = list(search.places(text.as_py()))
                    hits[row], score[row] = blank[0] + times[seen].sum(), blank[1] + weight[seen].sum()
            yield pa.RecordBatch.from_pydict({"_row": batch.column("_row"), "hits": pa.array(hits), "score": pa.array(score)})

    return run


def marker_scores(
    texts: DataFrame, markers: DataFrame, keys: Sequence[str], text: str, automaton_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """Per text (`keys` name it): `hits`, how many rows of `markers(marker, weight)` occur in it, and `score`, the sum of their weights.

    A marker counts once for a text, however often it occurs, and once for each of its rows. The blank marker
    occurs in every text; null markers in none, null texts hold none. Texts are scanned once for each
    `automaton_bytes` that distinct markers take, and the markers of each automaton are broadcast by themselves, so a task
    holds one of bounded size.
    """
    spark = texts.sparkSession
    distinct = markers.filter("marker is not null").groupBy("marker").agg(
        F.count(F.lit(1)).alias("times"), F.sum(F.col("weight").cast("bigint")).alias("weight")
    )
    size = F.octet_length("marker") + F.least(F.length("marker"), F.lit(PREFIX)) * _NODE + F.lit(_MARKER)
    blank = F.col("marker") == ""
    total = distinct.agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.when(blank, F.col("times"))), F.lit(0)).alias("times"),
        F.coalesce(F.sum(F.when(blank, F.col("weight"))), F.lit(0)).alias("weight"),
    ).first()
    slices = max(1, -(-5 * total["bytes"] // (4 * automaton_bytes))) if total["bytes"] > automaton_bytes else 1
    row = F.struct(*keys).alias("_row")
    rows = texts.select(row, F.col(text).alias("_text"))
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, hits bigint, score bigint"
    parts = []
    for part in range(slices):
        chosen = distinct.filter(~blank & (F.pmod(F.xxhash64("marker"), F.lit(slices)) == part))
        shared = spark.sparkContext.broadcast(chosen.toArrow().to_pydict())
        always = (0, 0) if part else (total["times"], total["weight"])
        parts.append(rows.mapInArrow(_scan(shared, always), schema))
    found = reduce(DataFrame.unionByName, parts)
    if slices > 1:
        found = found.groupBy("_row").agg(F.sum("hits").alias("hits"), F.sum("score").alias("score"))
    return found.select("_row.*", "hits", "score")
