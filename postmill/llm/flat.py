"""Whole texts of Arrow batches as flat numpy arrays: bytes, words, hashes, runs of windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes that part words; everything else belongs to a word.
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

# Hashes of ranges are polynomials over a random base modulo a prime, 2**61 - 1. (Modulo 2**64, ranges with a
# regular structure collide whatever the base.)
PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_BASE = 0x0F3A91C4D2B7E685 % PRIME
_BYTES = np.random.default_rng(20).integers(1, PRIME, 256, dtype=np.uint64)
# Powers of the base and of its inverse modulo the prime, and of an odd base modulo 2**64 for anchors.
_powers = [np.ones(1, dtype=np.uint64) for _ in range(3)]
_ODD = 0x9E3779B97F4A7C15

GROUP_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _reduced(t: np.ndarray) -> np.ndarray:
    t = (t & _P) + (t >> np.uint64(61))
    return np.where(t >= _P, t - _P, t)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, from halves of 31 and 30 bits."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0 + a0 * b1
    shifted = (middle & np.uint64((1 << 30) - 1)) << half
    return _reduced(np.uint64(2) * a1 * b1 + (middle >> np.uint64(30)) + shifted + a0 * b0)


def _grown(base: int, n: int, modulus: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if modulus != PRIME:
        out[1:] = np.uint64(base)
        return np.cumprod(out, dtype=np.uint64)
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, modulus))
        out[size : 2 * size] = times(out[: min(size, n - size)], step)
        size *= 2
    return out


def powers(n: int, which: int = 2) -> np.ndarray:
    """Powers of the base (0), of its inverse (1), or of the anchors' base (2)."""
    if len(_powers[which]) < n:
        base, modulus = ((_BASE, PRIME), (pow(_BASE, -1, PRIME), PRIME), (_ODD, 1 << 64))[which]
        _powers[which] = _grown(base, max(n, 2 * len(_powers[which])), modulus)
    return _powers[which][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which `range_hash` takes the hash of any range."""
    terms = times(_reduced(values), powers(len(values), 0))
    half, low = np.uint64(32), np.uint64((1 << 32) - 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    high = _reduced(np.cumsum(terms >> half, dtype=np.uint64))
    out[1:] = _reduced(times(high, np.uint64(1 << 32)) + _reduced(np.cumsum(terms & low, dtype=np.uint64)))
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of values; equal ranges have equal hashes."""
    inverse = powers(len(prefix), 1)
    own = times(_reduced(prefix[ends] + (_P - prefix[starts])), inverse[starts])
    return mix(own + mix((ends - starts).astype(np.uint64)))


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """Slices of bytes as a dictionary and places in it."""
    size = ends - starts
    if len(starts) and (starts[1:] == ends[:-1]).all():  # they lie one after the other
        body = np.ascontiguousarray(data[starts[0] : ends[-1]])
    else:
        body = np.ascontiguousarray(data[ragged(starts, size)])
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()


def picked(data: np.ndarray, size: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Of slices of bytes that lie one after the other, those at `index`."""
    offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    slices = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return flat(slices.take(pa.array(index, pa.int64())))[0]


def slice_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for slices of equal bytes, and for no others."""
    return coded(data, starts, ends).indices.to_numpy().astype(np.int64)


def slice_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of slices of bytes; each distinct slice is hashed once."""
    found = coded(data, starts, ends)
    names = [xxhash.xxh64_intdigest(x) for x in found.dictionary.to_numpy(zero_copy_only=False)]
    return np.array(names, dtype=np.uint64)[found.indices.to_numpy()] if names else np.zeros(0, dtype=np.uint64)


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of bytes with one space after each, and the length of each with its space."""
    room = ends - starts + 1
    out = np.full(int(room.sum()), 32, dtype=np.uint8)
    out[ragged(np.cumsum(room) - room, room - 1)] = data[ragged(starts, room - 1)]
    return out, room


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings, and where each begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = pc.fill_null(column.cast(large), b"" if large == pa.large_binary() else "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(batch: pa.RecordBatch, name: str = "text", size: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows a to b of a batch with their bytes and bounds, so that each group has about `size` bytes."""
    if not batch.num_rows:
        return
    data, offsets = flat(batch.column(name))
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, bounds: np.ndarray, hashed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of each word, and the first word of each text (one entry more than texts)."""
    starts, ends, hashes = [], [], []
    at, n = 0, len(data)
    edges = bounds[1:-1]
    while at < n:
        to = min(n, at + GROUP_BYTES)
        while to < n and not WHITE[data[to - 1]]:  # a chunk ends after white space
            more = np.flatnonzero(WHITE[data[to : to + GROUP_BYTES]])
            to = to + int(more[0]) + 1 if len(more) else min(n, to + GROUP_BYTES)
        part = data[at:to]
        inside = np.zeros(len(part) + 2, dtype=bool)
        inside[1:-1] = ~WHITE[part]
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cut = edges[(edges > at) & (edges < to)] - at  # words end where texts do
        first[cut] |= inside[1:-1][cut]
        last[cut - 1] |= inside[1:-1][cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if hashed:
            hashes.append(slice_hash(part, s, e))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    s = join(starts, np.int64)
    return s, join(ends, np.int64), join(hashes, np.uint64), np.searchsorted(s, bounds)


def _grams(h: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every `gram` values in a row."""
    out, length, block, size = None, 0, h, 1
    while True:
        if gram & size:
            if out is None:
                out, length = block, size
            else:
                n = len(h) - length - size + 1
                out = out[:n] + block[length : length + n] * powers(length + 1)[length]
                length += size
        size *= 2
        if size > gram:
            return mix(out)
        n = max(0, len(block) - size // 2)
        block = block[:n] + block[size // 2 : size // 2 + n] * powers(size // 2 + 1)[size // 2]


def _sliding(of: np.ufunc, h: np.ndarray, width: int) -> np.ndarray:
    """Least (`np.minimum`) or greatest (`np.maximum`) of every `width` values in a row."""
    size = 1
    while size * 2 <= width:
        h = of(h[:-size], h[size:])
        size *= 2
    return of(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


def window_runs(
    units: np.ndarray, bounds: np.ndarray, window: int, gram: int, chunk: int = 1 << 20, longest: int = 4096
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: text, first window in its text, windows, anchor, twice.

    The anchor of a window is its least hash of `gram` units, so equal windows have equal anchors in
    any text. Runs depend on their own text alone and hold at most `longest` windows. `twice`: the run
    has its anchor at two places, so that two of its own windows can be equal.
    """
    texts, firsts, counts, anchors, doubles = [], [], [], [], []
    width = window - gram + 1
    last = bounds[1:] - window  # last window of each text
    long = np.flatnonzero(last >= bounds[:-1])
    pieces = []  # (texts a to b, windows from, to)
    a = 0
    while a < len(long):
        lo = int(bounds[long[a]])
        if last[long[a]] - lo >= chunk:
            pieces += [(a, a + 1, x, min(x + chunk, int(last[long[a]]) + 1)) for x in range(lo, int(last[long[a]]) + 1, chunk)]
            a += 1
            continue
        b = a
        while b < len(long) and last[long[b]] - lo < chunk:
            b += 1
        pieces.append((a, b, lo, int(last[long[b - 1]]) + 1))
        a = b
    for a, b, lo, hi in pieces:
        part = units[lo : hi + window - 1]
        h = _BYTES[part] if part.dtype == np.uint8 else part
        grams = _grams(h, gram)
        least = _sliding(np.minimum, grams, width)
        own = long[a:b]
        valid = np.zeros(hi - lo + 1, dtype=np.int8)
        np.add.at(valid, np.maximum(bounds[own], lo) - lo, 1)
        np.add.at(valid, np.minimum(last[own] + 1, hi) - lo, -1)
        valid = np.cumsum(valid[:-1]).astype(bool)
        change = np.ones(len(valid), dtype=bool)
        change[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
        s = np.flatnonzero(change & valid)
        stop = np.ones(len(valid), dtype=bool)
        stop[:-1] = change[1:] | ~valid[1:]
        n = np.flatnonzero(stop & valid) + 1 - s
        edge = np.zeros(width - 1, dtype=np.uint64)
        seen = np.flatnonzero(grams == _sliding(np.maximum, np.concatenate([edge, least, edge]), width))
        at, to = np.searchsorted(seen, s), np.searchsorted(seen, s + n - 1 + width)
        own = np.bincount(np.repeat(np.arange(len(s)), to - at), weights=grams[seen[ragged(at, to - at)]] == np.repeat(least[s], to - at), minlength=len(s))
        twice = own > 1
        if len(n) and n.max() > longest:
            times = -(-n // longest)
            k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            twice = np.repeat(twice, times)
            s, n = np.repeat(s, times) + k * longest, np.minimum(np.repeat(n, times) - k * longest, longest)
        text = np.searchsorted(bounds, s + lo, side="right") - 1
        texts.append(text)
        firsts.append(s + lo - bounds[text])
        counts.append(n)
        anchors.append(least[s])
        doubles.append(twice)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    return join(texts, np.int64), join(firsts, np.int64), join(counts, np.int64), join(anchors, np.uint64), join(doubles, bool)


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of an array as binary values."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(bounds) * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
