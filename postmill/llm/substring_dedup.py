"""Substring dedup: an FM-index per shard finds word windows that occur earlier in the corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import flat
from .fm_index import FmIndex
from .passages import Passages, Unit, covered, keyed, repeated_windows, windows_to_ranges

# Words an anchor is taken from.
GRAM = 6
# Bytes of passages in one index.
INDEX = 1 << 18


def _answer(window: int):
    """Windows of a shard's passages that start earlier in it, by backward search of the FM-index."""

    def run(passages: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bounds = np.concatenate([[0], np.cumsum(passages.size, dtype=np.int64)])
        _, _, hashes, first = flat.words(passages.body, bounds)
        names = np.unique(hashes)
        lengths = np.diff(first)
        begin = first[:-1] + np.arange(len(lengths))  # in the text with a 0 after each passage
        text = np.zeros(len(hashes) + len(lengths), dtype=np.int64)
        text[flat.ragged(begin, lengths)] = np.searchsorted(names, hashes) + 1
        n = passages.n.astype(np.int64)
        starts = flat.ragged(begin, n)
        who = np.repeat(np.arange(len(n)), n)
        found, interval = FmIndex(text, begin + lengths).repeats(text, starts, window)
        # passages are in document order, so the first window of an interval is the one that stays
        _, earliest = np.unique(interval, return_index=True)
        later = np.ones(len(found), dtype=bool)
        later[earliest] = False
        gone = found[later]
        return windows_to_ranges(passages, who[gone], starts[gone] - begin[who[gone]])

    return run


def _cut(window: int, respace: bool):
    def run(batches):
        for batch in batches:
            ranges = batch.column("ranges")
            total, removed, kept = [], [], []
            for a, b, data, bounds in flat.groups(batch):
                starts, ends, _, first = flat.words(data, bounds, hashed=False)
                for k in range(a, b):
                    s, e = starts[first[k - a] : first[k - a + 1]], ends[first[k - a] : first[k - a + 1]]
                    total.append(len(s))
                    gone = ranges[k].as_py()
                    if gone:
                        stay = ~covered(len(s), gone, window)
                        removed.append(len(s) - int(stay.sum()))
                        s, e = s[stay], e[stay]
                    else:
                        removed.append(0)
                        if not respace:
                            kept.append(data[bounds[k - a] : bounds[k - a + 1]].tobytes().decode("utf-8", "replace"))
                            continue
                    if not len(s):
                        kept.append("")
                        continue
                    # words with one byte of room after each, which becomes the space between them
                    room = e - s + 1
                    out = np.full(int(room.sum()), 32, dtype=np.uint8)
                    out[flat.ragged(np.cumsum(room) - room, e - s)] = data[flat.ragged(s, e - s)]
                    kept.append(out[:-1].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_pydict({"carried": batch.column("carried"), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, window: int = 20, respace: bool = True) -> DataFrame:
    """Documents without the words of windows that start earlier in the corpus.

    Words are runs of anything but ASCII white space, unchanged. A window is `window` consecutive words of
    one document; earlier means a smaller id, or the same document and an earlier start. Windows are judged
    on the input. Result: the columns `keep` (all but the text by default), then `n_words`, `n_removed`,
    `kept_text` (kept words joined by one space; without `respace`, texts that lose nothing stay as they are);
    result columns replace kept ones of the same name.

    A null or empty text has no words and an empty `kept_text`. A null id sorts last. Rows with one id and
    one text count as one document, each with the same result; one id with different texts is ordered by the
    texts' hash. An empty table gives an empty table.
    """
    results = ["n_words", "n_removed", "kept_text"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c != text_col and c not in results]
    texts = keyed(docs, id_col, text_col, keep)
    found = repeated_windows(texts, Unit(words=True, window=window, gram=min(GRAM, window)), _answer(window), INDEX)
    schema = f"carried {found.schema['carried'].dataType.simpleString()}, n_words long, n_removed long, kept_text string"
    return found.mapInArrow(_cut(window, respace), schema).select("carried.*", *results)
