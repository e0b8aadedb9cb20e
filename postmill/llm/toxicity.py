"""Toxicity: cumulative-link regression on sparse word features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .labelled import sample, with_text
from .scratch import settle

# White space for ASCII marks (texts come in lower case), so that "Word," and "word" are one feature.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32

# Bytes at the beginning of a longer word that are a feature of their own.
BEGINNING = 6


def _word_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and word beginnings (hashes) of each text, and their text; sorted by text."""
    data = _PLAIN[data]
    starts, ends, hashes, first = flat.words(data, bounds)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    long = ends - starts > BEGINNING
    if long.any():
        beginnings = ~flat.slice_hash(data, starts[long], starts[long] + BEGINNING)
        hashes, owner = np.concatenate([hashes, beginnings]), np.concatenate([owner, owner[long]])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    head = np.ones(len(hashes), dtype=bool)
    head[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[head], owner[head]


@dataclass
class Ordinal:
    """P(grade > k) is the logistic of `weights . x - cuts[k]`; the weights are shared by all thresholds."""

    words: np.ndarray  # hashes, sorted
    weights: np.ndarray
    cuts: np.ndarray

    def exceeds(self, hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Chance of each text to exceed each grade."""
        value = np.zeros(texts)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            np.add.at(value, owner[hit], self.weights[at[hit]])
        return 1 / (1 + np.exp(-np.clip(value[:, None] - self.cuts, -30, 30)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, words: np.ndarray, ridge: float = 1e-5, steps: int = 1500, rate: float = 0.1) -> Ordinal:
    """Weights and ordered cuts by gradient steps on the penalised log-likelihood of the weighted rows' grades."""
    grades = int(grade.max(initial=0))
    if not grades:
        return Ordinal(words, np.zeros(len(words)), np.full(1, 30.0))
    weight = weight / weight.sum()
    share = np.array([weight[grade > k].sum() for k in range(grades)]).clip(1e-6, 1 - 1e-6)
    params = np.concatenate([np.zeros(x.shape[1]), -np.log(share / (1 - share))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    m = x.shape[1]
    for step in range(1, steps + 1):
        w, cuts = params[:m], params[m:]
        p = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - cuts, -30, 30)))
        rows = np.arange(len(x))
        upper = np.column_stack([np.ones(len(x)), p])[rows, grade]  # P(grade > its own - 1)
        lower = np.column_stack([p, np.zeros(len(x))])[rows, grade]
        gradient = np.concatenate([x.T @ (weight * (1 - upper - lower)) - ridge * w, np.zeros(grades)])
        gap = 1 - np.exp(-np.diff(np.concatenate([[-np.inf], cuts, [np.inf]])))[grade]
        for k in range(grades):
            own, next_one = grade == k, grade == k + 1
            gradient[m + k] = (weight * lower / (upper * gap))[own].sum() - (weight * (1 - upper) / ((1 - lower) * gap))[next_one].sum()
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params = params + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        params[m:] = np.maximum.accumulate(params[m:] - 0.1 * np.arange(grades)) + 0.1 * np.arange(grades)
    return Ordinal(words, params[:m], params[m:])


def _association(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Log-likelihood ratio of each word with the label, negative where clean texts have it more."""
    table = np.array([toxic, clean, all_toxic - toxic, all_clean - clean], dtype=np.float64)
    n = all_toxic + all_clean
    row, column = np.array([toxic + clean, n - toxic - clean]), np.array([all_toxic, all_clean])
    expected = np.array([row[0] * column[0], row[0] * column[1], row[1] * column[0], row[1] * column[1]]) / n
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * np.where(table > 0, table * np.log(table / expected), 0).sum(0)
    return np.where(toxic * all_clean >= clean * all_toxic, ratio, -ratio)


def _weighted(found: DataFrame) -> DataFrame:
    """Sampled rows with `weight`: one over the number of rows that share one of their sketches.

    A group of near copies counts about once that way and doesn't pass for evidence.
    """
    each = found.select("id", F.posexplode("sketches").alias("k", "sketch"))
    sizes = each.groupBy("k", "sketch").agg(F.count("*").alias("n"))
    most = each.join(sizes, ["k", "sketch"]).groupBy("id").agg(F.max("n").alias("n"))
    return found.join(most, "id").select("label", "words", (1 / F.col("n")).alias("weight"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 20000, words: int = 256, least: float = 24.0, sketches: int = 8) -> Ordinal:
    """Model of severity grades from at most `rows` labelled documents.

    Rows weigh less the more near copies they have in the sample (`sketches` least shingle hashes per text).
    Features are the `words` words most bound to the label, by log-likelihood ratio of at least `least`. Labels
    say toxic or not; of the toxic rows, those with more of the toxic words than the median are graded 2, the
    others 1.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in flat.groups(batch):
                hashes, owner = _word_sets(data, bounds)
                first = np.searchsorted(owner, np.arange(b - a + 1))
                _, _, all_hashes, word_first = flat.words(_PLAIN[data], bounds)
                grams = flat._grams(all_hashes, 6) if len(all_hashes) >= 6 else np.zeros(0, dtype=np.uint64)
                sketch = []
                for k in range(b - a):
                    own = grams[word_first[k] : max(word_first[k + 1] - 5, word_first[k])]
                    own = own if len(own) else np.bitwise_xor.reduce(hashes[first[k] : first[k + 1]], keepdims=True)
                    sketch.append([int(flat.mix(own ^ np.uint64(j)).min().astype(np.int64)) for j in range(sketches)])
                yield pa.RecordBatch.from_pydict(
                    {"id": batch.column("id").slice(a, b - a), "label": batch.column("label").slice(a, b - a), "sketches": pa.array(sketch, pa.list_(pa.int64())), "words": flat.binaries(hashes, first)}
                )

    chosen = with_text(docs, sample(labels, "toxic", rows, id_col=id_col), id_col, text_col)
    found = chosen.select("id", "label", F.lower("text").alias("text")).mapInArrow(sets, "id long, label int, sketches array<long>, words binary")
    found = settle(_weighted(settle(found, "labelled-words").dropDuplicates(["id"])), "weighted-words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(w, dtype=np.uint64) for w in batch.column("words").to_pylist()]
            if not own:
                continue
            times = [len(w) for w in own]
            weight = np.repeat(batch.column("weight").to_numpy(), times)
            names, back = np.unique(np.concatenate(own), return_inverse=True)
            toxic = np.bincount(back, weights=weight * np.repeat(batch.column("label").to_numpy(), times), minlength=len(names))
            total = np.bincount(back, weights=weight, minlength=len(names))
            yield pa.RecordBatch.from_pydict({"word": pa.array(names.view(np.int64)), "toxic": pa.array(toxic), "total": pa.array(total)})

    exact = lambda c: F.sum(F.round(c, 6).cast("decimal(20,6)")).cast("double").alias(c)  # noqa: E731  # in any order alike
    counted = found.mapInArrow(count, "word long, toxic double, total double").groupBy("word").agg(exact("toxic"), exact("total"))
    n_toxic, n = found.agg(F.coalesce(F.sum(F.col("label") * F.col("weight")), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    none = np.zeros(0, dtype=np.uint64)
    if not 0 < n_toxic < n:
        return Ordinal(none, np.zeros(0), np.full(1, 30.0))
    # words far from the label's overall share, farthest first: a bounded list from which the best are taken
    lift = F.abs(F.col("toxic") - F.col("total") * F.lit(n_toxic / n)) / F.sqrt("total")
    top = counted.where("total >= 3").orderBy(F.desc(lift), "word").limit(16 * words).toPandas()
    top["bound"] = _association(top["toxic"].to_numpy(), (top["total"] - top["toxic"]).to_numpy(), n_toxic, n - n_toxic)
    top = top[top["bound"].abs() >= least].sort_values(["bound", "word"], key=abs, ascending=False).head(words)
    names = np.sort(top["word"].to_numpy().astype(np.int64).view(np.uint64))
    toxic_words = np.sort(top.loc[top["bound"] > 0, "word"].to_numpy().astype(np.int64).view(np.uint64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.intersect1d(np.frombuffer(w, dtype=np.uint64), names).tobytes() for w in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "words": pa.array(own, pa.binary()), "weight": batch.column("weight")})

    picked = found.mapInArrow(pick, "label int, words binary, weight double").groupBy("label", "words").agg(exact("weight"))
    rows_fit = picked.orderBy("label", "words").collect()  # at most one for each sampled row
    x = np.zeros((len(rows_fit), len(names)), dtype=np.float64)
    severe = np.zeros(len(rows_fit))
    for i, r in enumerate(rows_fit):
        own = np.frombuffer(r["words"], dtype=np.uint64)
        x[i, np.searchsorted(names, own)] = 1
        severe[i] = np.isin(own, toxic_words).sum()
    label, weight = np.array([r["label"] for r in rows_fit]), np.array([r["weight"] for r in rows_fit])
    toxic = np.flatnonzero((label == 1) & (severe > 0))
    order = toxic[np.argsort(severe[toxic], kind="stable")]
    half = np.searchsorted(np.cumsum(weight[order]), weight[order].sum() / 2)
    median = severe[order[min(half, len(order) - 1)]] if len(order) else 0
    grade = np.where(label == 1, 1 + (severe > median), 0)
    return fit_ordinal(x, grade, weight, names)


def grade(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, cut: float = 0.5, rows: int = 20000) -> DataFrame:
    """Documents with `expected_severity`, `severity` (the likeliest grade) and `toxic` (expected severity >= `cut`).

    Null and empty texts have no features and get the model's base severity. Each row is graded alone, so null or
    repeated ids and rows are graded like any other. Result columns replace kept ones of the same name. Without
    labelled toxic rows nothing is toxic.
    """
    results = ["expected_severity", "severity", "toxic"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in results]
    model = fit(docs, labels, id_col, text_col, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected, likeliest = [np.zeros(0)], [np.zeros(0, dtype=np.int32)]
            for a, b, data, bounds in flat.groups(batch):
                p = model.exceeds(*_word_sets(data, bounds), b - a)
                expected.append(p.sum(1))
                chance = np.column_stack([np.ones(b - a), p]) - np.column_stack([p, np.zeros(b - a)])
                likeliest.append(chance.argmax(1).astype(np.int32))
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "expected_severity": pa.array(np.concatenate(expected)), "severity": pa.array(np.concatenate(likeliest))})

    rows_in = docs.select(F.struct(*keep).alias("row"), F.lower(F.col(text_col).cast("string")).alias("text"))
    schema = f"row {rows_in.schema['row'].dataType.simpleString()}, expected_severity double, severity int"
    return rows_in.mapInArrow(run, schema).withColumn("toxic", F.col("expected_severity") >= cut).select("row.*", *results)
