"""Phrase collocations: frequent phrases counted in HAT-tries, scored by their weakest cut.

Three passes over the texts. The first counts words. The second adds up hashes of pairs of frequent words; a pair
whose hash stays under the threshold is not frequent. The third counts phrases of two words and more whose pairs
are all left. A part of a phrase is at least as frequent as the phrase, so nothing is lost, and the third pass counts
exactly. What is left goes from pass to pass as a Bloom filter of fixed size: a false hit costs work, never a result.

In the third pass each task counts in a HAT-trie of word ids and spills whole subtrees as sorted runs; a run goes to
the partition of its prefix (language and up to three words), where runs are merged. No step holds more than a
trie, a run or one partition's runs, and equal phrases of a task are one entry before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import flat
from .hat_trie import HELD, HatTrie, counted
from .scratch import settle, shards

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Bytes between words (1) and at the end of a piece (2).
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2
# Bytes of texts counted at a time, and of texts whose phrases one partition merges.
SLICE, MERGED = 1 << 21, 32 << 20
# Words of a phrase that choose its partition, and distinct words that a task names before it spills all.
PREFIX, NAMED = 3, 1 << 18
# Bits of a Bloom filter, and bits set for an entry.
FILTER_BITS, HITS = 1 << 26, 4
# Pairs that a task holds before it sends their sums, and bits of a pair's hash.
PAIRS, PAIR_BITS = 1 << 19, 40
# Parts into which a language's rows are dealt for a join on the language.
SPREAD = 64
_RUNS = "bucket int, size int, langs array<binary>, words binary, places binary, counts binary"
_SUMS = "bucket int, keys binary, counts binary"


def _slices(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased bytes with begin and end of each word, and whether the next word follows in the same piece."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + SLICE)
        while to < n and _KIND[data[to - 1]] != 2:  # a slice ends where a piece does
            more = np.flatnonzero(_KIND[data[to : to + SLICE]] == 2)
            to = to + int(more[0]) + 1 if len(more) else min(n, to + SLICE)
        part = _LOWER[data[at:to]]
        kind = _KIND[part]
        inside = np.zeros(len(part) + 2, dtype=bool)
        inside[1:-1] = kind == 0
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edge = bounds[(bounds > at) & (bounds < to)] - at  # words end where texts do
        first[edge] |= inside[1:-1][edge]
        last[edge - 1] |= inside[1:-1][edge - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        piece = (kind == 2).astype(np.int64)
        np.add.at(piece, edge, 1)
        piece = np.cumsum(piece)
        follows = np.zeros(len(starts), dtype=bool)
        follows[:-1] = piece[starts[1:]] == piece[starts[:-1]]
        yield part, starts, ends, follows, at
        at = to


class Names:
    """Ids of words or languages within a task, with their hashes."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.hashes = np.zeros(1 << 10, dtype=np.uint64)

    def of(self, names: list[bytes]) -> np.ndarray:
        ids, before = self.ids, len(self.ids)
        place = ids.setdefault
        out = [place(name, len(ids)) for name in names]
        if len(ids) > before:
            new = list(islice(ids, before, None))
            self.names += new
            if len(ids) > len(self.hashes):
                self.hashes = np.append(self.hashes, np.zeros(max(len(self.hashes), len(ids)), dtype=np.uint64))
            self.hashes[before : len(ids)] = [xxhash.xxh64_intdigest(n) for n in new]
        return np.array(out, dtype=np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all low bytes first: small numbers leave planes of zeros, which compress well."""
    return np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).reshape(len(values), -1).T).tobytes()


def _numbers(body: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(body, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).ravel()


def _word_key(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    return flat.mix(word + flat.mix(lang))


def _pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return flat.mix(first + flat.mix(second ^ np.uint64(0x5851F42D4C957F2D)))


def _bits(keys: np.ndarray) -> Iterator[np.ndarray]:
    step = flat.mix(keys) | np.uint64(1)
    for k in range(HITS):
        yield ((keys + np.uint64(k) * step) >> np.uint64(20)) & np.uint64(FILTER_BITS - 1)


def _known(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), dtype=bool)
    for bit in _bits(keys):
        out &= (filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63))).astype(np.uint64) & np.uint64(1) == 1
    return out


def _filter(bits: DataFrame) -> np.ndarray:
    """Bloom filter of rows `slot, mask`; its size is fixed, so is what the driver gets."""
    found = bits.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[found.column("slot").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return out


def _rows_of(keys: np.ndarray) -> pa.RecordBatch:
    bits = np.concatenate(list(_bits(keys)))
    slots = pa.array((bits >> np.uint64(6)).astype(np.int32))
    return pa.RecordBatch.from_pydict({"slot": slots, "mask": pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64))})


def word_filter(counts: DataFrame) -> np.ndarray:
    """Filter of the words of a table `lang, phrase`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = (np.array([xxhash.xxh64_intdigest(x.encode()) for x in batch.column(k).to_pylist()], dtype=np.uint64) for k in ("lang", "phrase"))
            yield _rows_of(_word_key(langs, words))

    return _filter(counts.select("lang", "phrase").mapInArrow(run, "slot int, mask long"))


def _runs(rows: np.ndarray, counts: np.ndarray, words: Names, langs: Names, parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of one length by the partition of their prefix; words sort by their bytes."""
    size = rows.shape[1] - 1
    used = np.unique(rows[:, 1:])
    names = [words.names[k] for k in used]
    order = sorted(range(len(names)), key=names.__getitem__)
    rank = np.zeros(int(used.max(initial=-1)) + 1, dtype=np.int64)
    rank[used[order]] = np.arange(len(order))
    key = flat.mix(langs.hashes[rows[:, 0]])
    for k in range(1, min(size, PREFIX) + 1):
        key = flat.mix(key + words.hashes[rows[:, k]])
    bucket = ((key >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
    tongue = sorted(range(len(langs.names)), key=langs.names.__getitem__)
    at = np.zeros(len(tongue), dtype=np.int64)
    at[tongue] = np.arange(len(tongue))
    sorted_names = [names[k] for k in order]
    ranked = np.column_stack([at[rows[:, 0]], *(rank[rows[:, k]] for k in range(1, size + 1))])
    by = np.lexsort([*ranked.T[::-1], bucket])
    ranked, counts, bucket = ranked[by], counts[by], bucket[by]
    buckets, begins = np.unique(bucket, return_index=True)
    for b, a, z in zip(buckets, begins, [*begins[1:], len(bucket)], strict=True):
        own = ranked[a:z]
        tongues, lang = np.unique(own[:, 0], return_inverse=True)
        spoken, word = np.unique(own[:, 1:], return_inverse=True)
        places = np.column_stack([lang.reshape(len(own), 1), word.reshape(len(own), size)]).astype(np.int32)
        places[1:, :2] -= places[:-1, :2].copy()  # rows are sorted, so steps of the first columns are small
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([b], pa.int32()),
                "size": pa.array([size], pa.int32()),
                "langs": pa.array([[langs.names[tongue[k]] for k in tongues]], pa.list_(pa.binary())),
                "words": pa.array([b" ".join([sorted_names[k] for k in spoken])], pa.binary()),
                "places": pa.array([_planes(places.T.ravel())], pa.binary()),
                "counts": pa.array([_planes(counts[a:z].astype(np.int64))], pa.binary()),
            }
        )


class Texts:
    """Words of a task's texts: ids of words and languages, and which words follow each other."""

    def __init__(self, known: list[np.ndarray]):
        self.known, self.words, self.langs = known, Names(), Names()

    def slices(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Language and id of each word, whether the next one may follow it in a phrase, and the key of it with the next."""
        for batch in batches:
            tongue = self.langs.of([x.encode() for x in batch.column("lang").to_pylist()])
            for a, _, data, bounds in flat.groups(batch, size=SLICE):
                for part, starts, ends, follows, at in _slices(data, bounds):
                    if not len(starts):
                        continue
                    own = tongue[a + np.searchsorted(bounds, starts + at, side="right") - 1]
                    coded = flat.coded(part, starts, ends)
                    names = coded.dictionary.to_numpy(zero_copy_only=False)
                    place = coded.indices.to_numpy()
                    if not self.known:
                        yield own, self.words.of(names.tolist())[place], follows, follows
                        continue
                    # the keys of all words in all languages of the slice; only words that may be frequent get an id
                    spoken, lang = np.unique(own, return_inverse=True)
                    hashes = np.array([xxhash.xxh64_intdigest(n) for n in names], dtype=np.uint64)
                    keys = _word_key(self.langs.hashes[spoken][:, None], hashes[None, :])
                    good = _known(self.known[0], keys.ravel()).reshape(keys.shape)
                    often = np.flatnonzero(good.any(axis=0))
                    ids = np.full(len(names), -1, dtype=np.int64)
                    ids[often] = self.words.of(names[often].tolist())
                    good = good[lang, place]
                    joined = follows & good & np.append(good[1:], False)
                    near = np.flatnonzero(joined)
                    first, second = keys[lang[near], place[near]], keys[lang[near], place[near + 1]]
                    pair = _pair_key(first, second) >> np.uint64(64 - PAIR_BITS)
                    yield own, ids[place], joined, pair


def _words(parts: int):
    """Runs of all words, and of the empty phrase, which counts the words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, counts = Texts([]), {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(lang, np.flatnonzero(own), own[own > 0]) for lang, own in counts.items()]
            for lang, own, times in rows:
                yield from _runs(np.column_stack([np.full(len(own), lang), own]), times, texts.words, texts.langs, parts)
            total = np.array([[lang, times.sum()] for lang, _, times in rows]).reshape(-1, 2)
            if len(total):
                yield from _runs(total[:, :1], total[:, 1], texts.words, texts.langs, parts)

        for lang, word, _, _ in texts.slices(batches):
            for own in np.unique(lang):
                more = np.bincount(word[lang == own], minlength=len(texts.words.names))
                if own in counts:
                    more[: len(counts[own])] += counts[own]
                counts[own] = more
            if len(texts.words.names) > NAMED:
                yield from flush()
                texts.words, counts = Names(), {}
        yield from flush()

    return run


def _sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def _pairs(parts: int, known: list):
    """Hashes of pairs of frequent words with their sums, sorted, by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, keys, counts, held = Texts([f.value for f in known]), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            own, times = _sums(keys, counts)
            bucket = (own % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            own, times, bucket = own[order], times[order], bucket[order]
            names, begins = np.unique(bucket, return_index=True)
            for b, a, z in zip(names, begins, [*begins[1:], len(bucket)], strict=True):
                steps = np.diff(own[a:z], prepend=np.uint64(0))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "keys": pa.array([_planes(steps)]), "counts": pa.array([_planes(times[a:z])])})

        for _, _, _, pair in texts.slices(batches):
            own, times = np.unique(pair, return_counts=True)
            keys.append(own)
            counts.append(times)
            held += len(own)
            if held > 2 * PAIRS:
                merged, sums = _sums(keys, counts)
                keys, counts, held = [merged], [sums], len(merged)
                if held > PAIRS:
                    yield from flush()
                    keys, counts, held = [], [], 0
            if len(texts.words.names) > NAMED:
                texts.words = Names()
        if held:
            yield from flush()

    return run


def _frequent_pairs(least: int):
    """Filter rows of the pairs of a partition whose hashes add up to `least` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            for body, times in zip(batch.column("keys"), batch.column("counts"), strict=True):
                keys.append(np.cumsum(_numbers(body.as_py(), "u8"), dtype=np.uint64))
                counts.append(_numbers(times.as_py(), "i8"))
        if keys:
            own, total = _sums(keys, counts)
            yield _rows_of(own[total >= least])

    return run


def _phrases(longest: int, parts: int, known: list, held: int):
    """Runs of all phrases of two words and more whose pairs may all be frequent."""

    def grown(lang: np.ndarray, word: np.ndarray, joined: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        many = int(word.max(initial=0)) + 1
        alive = np.flatnonzero(joined)
        rank = lang[alive] * many + word[alive]  # of the phrase so far, in the order of its ids
        for size in range(2, longest + 1):
            if size > 2:
                go = joined[alive + size - 2]
                alive, rank = alive[go], rank[go]
            if not len(alive):
                return
            if size == 2:
                rank = np.unique(rank, return_inverse=True)[1].ravel()
            _, index, rank, times = np.unique(rank * many + word[alive + size - 1], return_index=True, return_inverse=True, return_counts=True)
            at = alive[index]
            yield np.column_stack([lang[at], *(word[at + k] for k in range(size))]), times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, trie = Texts([f.value for f in known[:1]]), HatTrie()
        pairs = known[1].value
        for lang, word, joined, pair in texts.slices(batches):
            near = np.flatnonzero(joined)
            joined = np.zeros(len(joined), dtype=bool)
            joined[near] = _known(pairs, pair)
            for rows, times in grown(lang, word, joined):
                trie.add(rows, times)
            full = len(texts.words.names) > NAMED
            if full or trie.size > held:
                for rows, times in trie.spill(-1 if full else held // 2):
                    yield from _runs(rows, times, texts.words, texts.langs, parts)
                texts.words = Names() if full else texts.words
        for rows, times in trie.spill(-1):
            yield from _runs(rows, times, texts.words, texts.langs, parts)

    return run


def _merge(least: int):
    """Phrases of a partition's runs with their sums; those under `least` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, runs = Names(), {}
        for batch in batches:
            for size, langs, words, places, counts in zip(*(batch.column(k) for k in ("size", "langs", "words", "places", "counts")), strict=True):
                size = size.as_py()
                rows = _numbers(places.as_py(), "i4").reshape(size + 1, -1)
                rows[:2] = np.cumsum(rows[:2], axis=1)
                lang, word = names.of(langs.as_py()), names.of(words.as_py().split(b" "))
                rows = np.column_stack([lang[rows[0]], *(word[own] for own in rows[1:])]).astype(np.int32)
                runs.setdefault(size, []).append((rows, _numbers(counts.as_py(), "i8")))
        for size, parts in sorted(runs.items()):
            rows, total = counted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            runs[size] = None
            often = np.flatnonzero(total >= (least if size else 0))
            for a in range(0, len(often), 1 << 14):
                own = often[a : a + (1 << 14)]
                lines = [[names.names[k] for k in row] for row in rows[own].tolist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "size": pa.array(np.full(len(own), size, np.int32)),
                        "lang": pa.array([x[0].decode() for x in lines], pa.string()),
                        "phrase": pa.array([b" ".join(x[1:]).decode() for x in lines], pa.string()),
                        "f": pa.array(total[own]),
                    }
                )

    return run


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, text_col: str = "text", lang_col: str = "lang", held: int = HELD) -> DataFrame:
    """`size`, `lang`, `phrase`, `f`: phrases of up to `longest` words that occur `least` times or more in a language.

    Size 0 (an empty phrase) holds the number of all words of a language. A task holds about `held` entries before
    it spills. See `collocations` for words and pieces.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    parts = shards(spark, texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0, MERGED)

    def merged(runs: DataFrame) -> DataFrame:
        runs = runs.repartitionById(parts, "bucket")
        return settle(runs.mapInArrow(_merge(least), "size int, lang string, phrase string, f long"), "phrases")

    words = merged(texts.mapInArrow(_words(parts), _RUNS))
    if longest < 2:
        return words
    known = [spark.sparkContext.broadcast(word_filter(words.where("size = 1")))]
    sums = texts.mapInArrow(_pairs(parts, known), _SUMS).repartitionById(parts, "bucket")
    known.append(spark.sparkContext.broadcast(_filter(sums.mapInArrow(_frequent_pairs(least), "slot int, mask long"))))
    return words.unionByName(merged(texts.mapInArrow(_phrases(longest, parts, known, held), _RUNS)))


def collocations(
    docs: DataFrame, longest: int = 5, least: int = 100, share: int = 100, first: int = 2000, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Each language's `first` best phrases: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    Texts are lower-cased (A-Z) and split at `[.,;:!?` and line ends`]` into pieces, these into words (anything but blank and tab).
    Candidates have 2 to `longest` words and occur `a` >= `least` times within pieces, overlaps included. A cut
    after k words gives l and r, the counts of the two sides, and floor(1000 * a * n / (l * r)), where n counts all
    words of the language; the lowest-scoring cut counts, ties to the smallest k. A candidate whose words lie
    within a longer candidate with 100 * f(longer) >= `share` * a goes. Order: score, then a, both falling, then
    the phrase by its bytes. All counts are exact, and scores in decimals of 38 digits.

    A null language is `und`; a null or empty text has no words; repeated rows count as often as they stand.
    An empty table gives an empty one.
    """
    counts = frequent_phrases(docs, longest, least, text_col, lang_col)
    sizes = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.where("size > 0").select("lang", "phrase", "f")
    chosen = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    def side(name: str, begin, length) -> list:
        return F.array_join(F.slice("words", begin, length), " ").alias(name)

    cuts = chosen.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", side("left", F.lit(1), F.col("k")), side("right", F.col("k") + 1, F.col("size") - F.col("k")))
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # a language may hold a third of all phrases, so its size meets them in parts
    sizes = sizes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    cuts = cuts.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)).cast("int")).join(sizes, ["lang", "part"])
    whole = lambda c: F.col(c).cast("decimal(17,0)")
    cuts = cuts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n")).withColumn("below", whole("l") * whole("r"))
    scored = cuts.select("lang", "phrase", "a", "n", F.struct(F.expr("above div below").alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))

    within = chosen.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    within = within.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    longer = within.select("lang", side("phrase", F.col("at"), F.col("m")), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {share} * a")
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
