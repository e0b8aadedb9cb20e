"""Collocations and the trie they are counted in, against brute force."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from postmill.llm import hat_trie
from postmill.llm.collocations import collocations, frequent_phrases
from postmill.llm.hat_trie import HatTrie, counted

SCHEMA = "doc_id long, text string, lang string, source string, phrase string, size int, n string"
rng = np.random.default_rng(3)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(n, vocabulary=30):
    marks = ["", "", "", "", ".", ",", "\n", "\t", "!"]
    return " ".join(f"{'WÉw'[int(i) % 3]}{i}{marks[int(m)]}" for i, m in zip(rng.zipf(1.5, n) % vocabulary, rng.integers(0, len(marks), n), strict=True))


def brute(rows, longest, least, first):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        chosen = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in chosen.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in chosen.items())
            if not inside:
                score, _, l, r = min((1000 * a * sizes[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:first]):
            out.append((lang, rank + 1, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations(spark):
    rows = [(["en", "en", "de", None, "und", ""][k % 6], prose(150)) for k in range(60)]
    rows += [("en", None), ("en", ""), (None, None), ("fr", " \t. "), ("en", "x " * 5000), ("en", "Ka ki ku. " * 300), ("de", "one two three four five six\x0bseven")]
    rows += rows[:4]  # repeated rows count twice
    given = spark.createDataFrame([(k, t, lang, "s", "clash", 1, "clash") for k, (lang, t) in enumerate(rows)], SCHEMA).repartition(5)
    expected = brute(rows, 5, 6, 40)
    assert len(expected) > 100
    assert found(collocations(given, least=6, first=40)) == expected
    # tasks that spill all the time count the same
    many = {(r.lang, r.phrase, r.f) for r in frequent_phrases(given, least=6, held=50).collect()}
    assert many == {(r.lang, r.phrase, r.f) for r in frequent_phrases(given, least=6).collect()}


def test_collocations_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    result = collocations(empty)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and result.count() == 0
    rare = spark.createDataFrame([(1, "a b c", "en", "s", "", 1, "")], SCHEMA)
    assert collocations(rare).count() == 0
    # ties in score and count go by the bytes of the phrase
    tied = spark.createDataFrame([(1, "b c. é f. a d. ", "en", "s", "", 1, "")] * 7, SCHEMA)
    assert [r.phrase for r in collocations(tied, least=7).orderBy("rank").collect()] == ["a d", "b c", "é f"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.lists(st.integers(0, 3), min_size=4, max_size=4)), max_size=200), st.integers(0, 60))
def test_trie_counts(rows, down_to):
    hat_trie.BURST = 3
    trie, expected, got = HatTrie(), Counter(), Counter()
    for k in range(0, len(rows), 30):
        for length in range(1, 5):
            part = np.array([r[:n] for n, r in rows[k : k + 30] if n == length], dtype=np.int64).reshape(-1, length)
            expected.update(map(tuple, part.tolist()))
            trie.add(*counted(part, np.ones(len(part), dtype=np.int64)))
        if k == 60:
            for found_rows, counts in trie.spill(down_to):
                got.update(dict(zip(map(tuple, found_rows.tolist()), counts.tolist(), strict=True)))
            assert trie.size <= down_to
    for found_rows, counts in trie.spill(-1):
        for row, count in zip(map(tuple, found_rows.tolist()), counts.tolist(), strict=True):
            got[row] += count
    assert got == expected and trie.size == 0
