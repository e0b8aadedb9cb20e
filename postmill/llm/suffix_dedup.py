"""Suffix-array dedup: a suffix array per shard finds byte strings that occur earlier in the corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import flat
from .passages import Passages, Unit, covered, keyed, repeated_windows, windows_to_ranges
from .suffix_sort import common_prefixes, suffix_arrays

# Bytes an anchor is taken from.
GRAM = 32
# Bytes of passages sorted side by side, and in one string of them.
SIDE_BY_SIDE, STRING = 8 << 20, 4 << 10


def _answer(window: int):
    """Windows of a shard's passages that start earlier in it, by suffix array and common prefixes."""

    def run(passages: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bounds = np.concatenate([[0], np.cumsum(passages.size, dtype=np.int64)])
        # equal passages: the earliest stands for all, the later ones go entirely
        content = flat.slice_ids(passages.body, bounds[:-1], bounds[1:])
        _, earliest = np.unique(content, return_index=True)
        later = np.ones(len(passages), dtype=bool)
        later[earliest] = False
        copies = np.flatnonzero(later)
        stay = np.flatnonzero(~later)
        own = passages.take(stay)
        # passages of one anchor share a string; strings of like length are sorted side by side
        strings = max(1, len(own.body) // STRING)
        string = (flat.mix(own.anchor) % np.uint64(strings)).astype(np.int64)
        by_string = np.argsort(string, kind="stable")
        stay, own, string = stay[by_string], own.take(by_string), string[by_string]
        head = np.ones(len(own), dtype=bool)
        head[1:] = string[1:] != string[:-1]
        number = np.cumsum(head) - 1
        lengths = own.size.astype(np.int64)
        ends = np.append(head[1:], True) if len(own) else head
        taken = lengths + 1 + ends  # a 1 ends a passage, a 0 a string
        begin = np.cumsum(taken) - taken
        text = np.repeat(number * 258, taken).astype(np.int32)
        text[flat.ragged(begin, lengths)] += own.body.astype(np.int32) + 2
        text[begin + lengths] += 1
        order = suffix_arrays(text, begin[head])
        shared = common_prefixes(text, order, window, begin[head])[order] >= window
        group = np.cumsum(~shared, dtype=np.int32)  # equal for suffixes that share `window` bytes
        several = shared.copy()
        several[:-1] |= shared[1:]
        place, group = order[several].astype(np.int64), group[several]
        # of equal windows the first in document order stays
        who = np.searchsorted(begin, place, side="right") - 1
        inside = place - begin[who] < own.n[who]  # not across the end of a passage
        place, group, who = place[inside], group[inside], who[inside]
        rank = np.lexsort((place - begin[who], stay[who]))
        place, group = place[rank], group[rank]
        _, earliest = np.unique(group, return_index=True)
        gone = np.ones(len(place), dtype=bool)
        gone[earliest] = False
        place = place[gone]
        place.sort()
        who = np.searchsorted(begin, place, side="right") - 1
        found, first, n = windows_to_ranges(own, who, place - begin[who])
        return np.concatenate([stay[found], copies]), np.concatenate([first, passages.first[copies]]), np.concatenate([n, passages.n[copies].astype(np.int64)])

    return run


def _cut(window: int):
    def run(batches):
        for batch in batches:
            ranges = batch.column("ranges")
            total, removed, spans, kept = [], [], [], []
            for a, b, data, bounds in flat.groups(batch):
                for k in range(a, b):
                    own = data[bounds[k - a] : bounds[k - a + 1]]
                    gone = ranges[k].as_py()
                    total.append(len(own))
                    if gone:
                        out = covered(len(own), gone, window)
                        removed.append(int(out.sum()))
                        spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                        own = own[~out]
                    else:
                        removed.append(0)
                        spans.append(0)
                    kept.append(own.tobytes())
            yield pa.RecordBatch.from_pydict({"carried": batch.column("carried"), "n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_bytes": pa.array(kept, pa.binary())})

    return run


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, window: int = 100) -> DataFrame:
    """Documents without the bytes of `window`-byte strings that start earlier in the corpus.

    Texts are UTF-8 bytes; strings never cross documents; earlier means a smaller id, or the same document
    and an earlier start. Strings are judged on the input. Result: the columns `keep` (all but the text by
    default), then `n_bytes`, `n_removed`, `n_spans` (maximal removed runs), `kept_bytes` (binary, since a cut
    can part a character); result columns replace kept ones of the same name.

    A null or empty text has no bytes. A null id sorts last. Rows with one id and one text count as one
    document, each with the same result; one id with different texts is ordered by the texts' hash. An empty
    table gives an empty table.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept_bytes"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c != text_col and c not in results]
    texts = keyed(docs, id_col, text_col, keep)
    found = repeated_windows(texts, Unit(words=False, window=window, gram=min(GRAM, window)), _answer(window), SIDE_BY_SIDE)
    schema = f"carried {found.schema['carried'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_bytes binary"
    return found.mapInArrow(_cut(window), schema).select("carried.*", *results)
