"""Suffix arrays by induced sorting, and permuted common prefixes.

A suffix is smaller (S) or larger (L) than the one after it; a leftmost S (LMS) follows an L. The LMS
suffixes are sorted by their first symbols, up to the next LMS place at least, then by doubling, and the
rest of the array is induced from them. Inducing is a scan of the array in which each place depends on
the ones before it; many strings are scanned side by side, one place of each in a numpy step.
"""

from __future__ import annotations

import numpy as np

# With fewer strings left, they are scanned one after the other.
FEW = 24


def _types(text: np.ndarray, last: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last suffix of a string is the smallest."""
    n = len(text)
    rise = np.zeros(n, dtype=np.int8)  # 1: smaller, -1: larger, 0: as the next one
    rise[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1])
    rise[last] = 1
    known = np.where(rise != 0, np.arange(n, dtype=np.int32), np.int32(n))
    return rise[np.minimum.accumulate(known[::-1])[::-1]] == 1


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, begins: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix arrays induced from LMS suffixes in their order, all strings side by side."""
    n = len(text)
    out = np.full(n, -1, dtype=np.int32)
    symbol = text[lms]
    place = np.empty(len(lms), dtype=np.int64)  # LMS suffixes fill the ends of their buckets
    order = np.argsort(symbol, kind="stable")
    stop = np.cumsum(np.bincount(symbol, minlength=len(begins) - 1))
    place[order] = np.arange(len(lms)) - stop[symbol[order]] + begins[symbol[order] + 1]
    out[place] = lms
    out[starts] = ends - 1
    # symbol of the suffix before this one, -1 if that may not be induced; entry n answers for -1, an empty place
    before = np.full(n + 1, -1, dtype=np.int32)
    lengths = ends - starts
    long_first = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(np.sort(lengths), np.arange(lengths.max()), side="right")
    active = (len(lengths) - active).tolist()
    for step, slots, begin in ((1, begins[:-1].copy(), starts), (-1, begins[1:] - 1, ends - 1)):
        before[1:n] = np.where(smaller[:-1] == (step < 0), text[:-1], np.int32(-1))
        before[starts] = -1
        at = begin[long_first].astype(np.int64)
        for m in active:
            if m < len(at):
                at = at[:m]
            if m < FEW:
                break
            i = out[at]
            c = before[i]
            may = np.flatnonzero(c >= 0)
            i, c = i[may], c[may].astype(np.int64)
            slot = slots[c]
            out[slot] = i - 1
            slots[c] = slot + step
            at += step
        else:
            continue
        for place, k in zip(at.tolist(), long_first[: len(at)].tolist(), strict=True):
            _scan_alone(out, text, before, slots, int(starts[k]), int(ends[k]), place, step)
    out[starts] = ends - 1
    return out


def _scan_alone(out: np.ndarray, text: np.ndarray, before: np.ndarray, slots: np.ndarray, start: int, end: int, place: int, step: int) -> None:
    """The rest of one string's scan, place by place."""
    symbols = text[start:end]
    low, high = int(symbols.min()), int(symbols.max()) + 1
    symbol = np.maximum(before[start:end] - low, -1).tolist()
    own, slot = (out[start:end] - start).tolist(), (slots[low:high] - start).tolist()
    for i in range(place - start, end - start) if step > 0 else range(place - start, -1, -1):
        j = own[i]
        if j > 0 and symbol[j] >= 0:
            c = symbol[j]
            own[slot[c]] = j - 1
            slot[c] += step
    out[start:end] = np.maximum(np.array(own, dtype=np.int32) + start, -1)


def _codes(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbols numbered without gaps, from 0 in each string, in their order."""
    lengths = np.diff(np.append(starts, len(text)))
    own = text - np.repeat(text[starts + lengths - 1], lengths)
    return (np.cumsum(np.bincount(own) > 0) - 1)[own]


def _order(high: np.ndarray, low: np.ndarray, low_bits: int) -> np.ndarray:
    """Order of pairs of values from 0; the place goes into the key if there is room, as values sort faster than places."""
    bits = max(1, len(high) - 1).bit_length()
    if int(high.max()).bit_length() + low_bits + bits > 63:
        return np.lexsort((low, high))
    key = ((high << low_bits) | low) << bits
    key |= np.arange(len(high))
    key.sort()
    return key & ((1 << bits) - 1)


def _refined(rank: np.ndarray, open_: np.ndarray, low: np.ndarray, low_bits: int) -> np.ndarray:
    """Split groups of equal rank by `low`, in place; the open ones that are still not alone.

    A rank is the number of suffixes in the groups before.
    """
    high = rank[open_]
    order = _order(high, low, low_bits)
    open_, high, low = open_[order], high[order], low[order]
    head = np.ones(len(order) + 1, dtype=bool)
    head[1:-1] = high[1:] != high[:-1]
    group = np.flatnonzero(head)
    head[1:-1] |= low[1:] != low[:-1]
    own = np.flatnonzero(head)
    first = np.repeat(group[:-1], np.diff(group))
    rank[open_] = high + np.repeat(own[:-1], np.diff(own)) - first
    return np.sort(open_[~(head[:-1] & head[1:])])


def _sorted_lms(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """LMS suffixes in their order: by string, by their symbols and types up to the next LMS place, by doubling."""
    n = len(text)
    code = (_codes(text, starts) << 1) | smaller
    bits = max(1, int(code.max()).bit_length())
    string = np.searchsorted(starts, lms, side="right") - 1
    length = np.append(lms[1:], n - 1) - lms + 1
    _, counts = np.unique(string, return_counts=True)
    rank = np.repeat(np.cumsum(counts) - counts, counts)
    open_ = np.arange(len(lms))
    # as many symbols in one word as fit with a rank and a place; with codes this long, one
    width = max(1, (63 - 2 * len(lms).bit_length()) // bits)
    done = 0
    while len(open_):
        word = np.zeros(len(open_), dtype=np.int64)
        for k in range(width):  # what follows a string's last symbol, which no other place has, decides nothing
            word = (word << bits) | code[np.minimum(lms[open_] + (done + k), n - 1)]
        left = _refined(rank, open_, word, width * bits)
        done += width
        open_ = left[length[left] > done]  # equal symbols and types end at the same LMS place
    group = np.bincount(rank, minlength=len(lms))
    open_ = np.flatnonzero(group[rank] > 1)
    step, bits = 1, len(lms).bit_length()
    while len(open_):  # those not alone end before the string's last symbol
        open_ = _refined(rank, open_, rank[open_ + step], bits)
        step *= 2
    order = np.empty(len(lms), dtype=np.int32)
    order[rank] = lms
    return order


def suffix_arrays(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Suffix arrays, one after the other, of strings that begin at `starts`.

    Each string ends with a symbol of its own, less than its others, and a string's symbols are all less
    than the next string's.
    """
    text = text.astype(np.int32)
    n = len(text)
    ends = np.append(starts[1:], n)
    begins = np.concatenate([[0], np.cumsum(np.bincount(text))])
    smaller = _types(text, ends - 1)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    is_lms[starts] = False
    lms = np.flatnonzero(is_lms)
    if len(lms):
        lms = _sorted_lms(text, smaller, lms, starts)
    return _induce(text, smaller, lms, begins, starts, ends)


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int, starts: np.ndarray | None = None) -> np.ndarray:
    """For each suffix, by place in the text, its common prefix with the one sorted before it, up to `limit`.

    Where the symbols before both are equal, the prefix is one shorter than that of the place before;
    the other places, which are few in repetitive text, are compared a word of symbols at a time. With
    `starts`, as in `suffix_arrays`, more symbols fit in a word.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    has = before >= 0
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ~has[1:] | ~has[:-1] | (before[1:] == 0) | (text[:-1] != text[before[1:] - 1])
    places = np.flatnonzero(fresh & has)
    places = places[text[places] == text[before[places]]]  # so both are of one string
    code = (_codes(text, starts) if starts is not None else text).astype(np.int64) + 1
    bits = int(code.max()).bit_length() if n else 1
    width = 1
    while 2 * width * bits <= 63 and width < n:
        code[:-width] = (code[:-width] << (width * bits)) | code[width:]
        code[-width:] <<= width * bits  # no symbol is 0
        width *= 2
    found = np.zeros(n, dtype=np.int64)
    a, b = places, before[places].astype(np.int64)
    while len(a):
        differ = code[a] ^ code[b]
        same = np.zeros(len(a), dtype=np.int64)
        for k in range(width):
            same += differ >> (k * bits) == 0
        found[places] += same
        alive = np.flatnonzero(differ == 0)
        a, b, places = a[alive] + width, b[alive] + width, places[alive]
        inside = np.maximum(a, b) < n
        if not inside.all():
            a, b, places = a[inside], b[inside], places[inside]
    origin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return np.minimum(found[origin] - (np.arange(n) - origin), limit)
