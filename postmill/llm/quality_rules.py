"""Quality rules: counted per document, and an isolation forest over the counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import flat
from .labelled import labelled
from .scratch import settle

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_MARK = np.zeros(256, dtype=np.int64)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in SYMBOLS]] = 1

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_marks"]
AXES = ["symbols", "upper", "marks"]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _duplicates(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of values that occur again in the same text, and of those that are not the first."""
    _, first, back, counts = np.unique(hashes ^ flat.mix(owner.astype(np.uint64)), return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(hashes), dtype=bool)
    later[first] = False
    return counts[back] > 1, later


def counts(data: np.ndarray, bounds: np.ndarray, window: int = 8) -> dict[str, np.ndarray]:
    """The rules' counts of each text."""
    n = len(bounds) - 1
    starts, ends, hashes, first = flat.words(data, bounds)
    white = flat.WHITE[data]
    out = {"n_words": np.diff(first), "word_chars": _sums(~white & ((data & 0xC0) != 0x80), bounds)}
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_marks", _MARK)):
        out[name] = _sums(table[data], bounds)
    # lines with a word
    newline = np.flatnonzero(data == 10)
    at = np.unique(np.concatenate([bounds[:-1], newline + 1]))
    at = at[at < len(data)]
    owner = np.searchsorted(bounds, at, side="right") - 1
    to = np.minimum(np.append(at[1:], len(data)), bounds[owner + 1])
    to = to - ((to > at) & (data[np.maximum(to - 1, 0)] == 10))
    worded = np.searchsorted(starts, to) > np.searchsorted(starts, at)
    at, to, owner = at[worded], to[worded], owner[worded]
    _, later = _duplicates(flat.slice_hash(data, at, to), owner)
    out["n_dup_lines"] = np.bincount(owner, weights=later, minlength=n).astype(np.int64)
    # words in windows that occur twice
    place = np.arange(len(starts))
    whole = place + window <= np.repeat(first[1:], np.diff(first))
    place = place[whole]
    owner = np.searchsorted(first, place, side="right") - 1
    prefix = flat.prefix_hash(hashes)
    twice, _ = _duplicates(flat.range_hash(prefix, place, place + window), owner)
    edge = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(edge, place[twice], 1)
    np.add.at(edge, place[twice] + window, -1)
    out["n_repeat_words"] = _sums(np.cumsum(edge[:-1]) > 0, first)
    return out


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`row` (a struct of the kept columns), `id` and the counts of every whole text; null counts as empty."""
    keep = keep if keep is not None else docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [counts(data, bounds) for _, _, data, bounds in flat.groups(batch)]
            found = {k: pa.array(np.concatenate([p[k] for p in parts]) if parts else np.zeros(0), pa.int64()) for k in COUNTS + MORE}
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "id": batch.column("id"), **found})

    rows = docs.select(F.struct(*keep).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, id long, " + ", ".join(f"{k} long" for k in COUNTS + MORE)
    return rows.mapInArrow(run, schema)


def features(rows: pd.DataFrame) -> np.ndarray:
    """Rule statistics the forest splits on, as shares, so that long and short texts compare.

    Lines and windows that repeat are left to the base rule: few texts have any, and in the forest they set
    apart more good documents than bad ones.
    """
    words = np.maximum(rows["n_words"], 1)
    return np.column_stack([rows["n_symbols"] / words, rows["n_upper"] / np.maximum(rows["word_chars"], 1), rows["n_marks"] / words]).astype(np.float64)


def _expected(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n; n may be a mean itself."""
    n = np.maximum(np.asarray(n, dtype=np.float64), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, n - 1)


@dataclass
class IsolationForest:
    """Trees of random splits; a point that few splits set apart has short paths.

    Splits fall anywhere in the box of all values seen, also where the points the trees grow on have none, so
    that values those never take are set apart at once. They don't depend on the points; these decide where a
    walk ends: in the first node with one part in `size` of them, or less. Trees grow on all points that way and not on
    a few hundred each, and the points need only be counted by leaf.
    """

    column: np.ndarray  # tree, node
    cut: np.ndarray
    path: np.ndarray | None = None  # tree, leaf: length of a walk that ends there or above
    mean: float = 1.0

    @classmethod
    def grow(cls, low: np.ndarray, high: np.ndarray, trees: int = 128, depth: int = 10, seed: int = 0) -> IsolationForest:
        rng = np.random.default_rng(seed)
        nodes = 2**depth - 1
        column, cut = np.zeros((trees, nodes), dtype=np.int64), np.full((trees, nodes), np.inf)
        for t in range(trees):
            todo = [(0, low, high)]
            while todo:
                node, below, above = todo.pop()
                varied = np.flatnonzero(above > below)
                if not len(varied):
                    continue
                c = int(rng.choice(varied))
                column[t, node], cut[t, node] = c, rng.uniform(below[c], above[c])
                if 2 * node + 1 < nodes:
                    top, bottom = above.copy(), below.copy()
                    top[c] = bottom[c] = cut[t, node]
                    todo += [(2 * node + 1, below, top), (2 * node + 2, bottom, above)]
        return cls(column, cut)

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Leaf of each row, tree by tree."""
        rows, nodes = np.arange(len(x)), self.column.shape[1]
        for column, cut in zip(self.column, self.cut, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range((nodes + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, column[node]] >= cut[node])
            yield node - nodes

    def ended(self, held: np.ndarray, size: int = 256) -> IsolationForest:
        """The forest whose leaves hold so many points (tree, leaf)."""
        n = int(held[0].sum())
        size = min(size, n)
        depth = held.shape[1].bit_length() - 1
        path = np.zeros(held.shape)
        walking = np.ones(held.shape, dtype=bool)
        for level in range(depth + 1):
            own = held.reshape(len(held), 2**level, -1).sum(2).repeat(2 ** (depth - level), 1)
            ends = walking & ((own * size <= n) | (level == depth))
            path[ends] = level + _expected(own[ends] * size / n)
            walking &= ~ends
        return IsolationForest(self.column, self.cut, path, float(_expected(size)) or 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, from 0 to 1: two to the minus mean path length over the expected one."""
        total = np.zeros(len(x))
        for leaf, path in zip(self.leaves(x), self.path, strict=True):
            total += path[leaf]
        return 2.0 ** (-total / len(self.path) / self.mean)


def _leaf_counts(forest: IsolationForest):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shape = len(forest.column), forest.column.shape[1] + 1
        held = np.zeros(shape, dtype=np.int64)
        for rows in batches:
            for own, leaf in zip(held, forest.leaves(rows[AXES].to_numpy()), strict=True):
                own += np.bincount(leaf, minlength=shape[1])
        place = np.flatnonzero(held)
        yield pd.DataFrame({"place": place, "n": held.ravel()[place]})

    return run


def fit_forest(fit: DataFrame) -> IsolationForest | None:
    """Forest grown on the rows of label 1, in the box of all rows; None without any of label 1."""
    limits = [f(c) for f in (F.min, F.max) for c in AXES]
    box = fit.agg(F.sum("label"), *limits).first()
    if not box[0]:
        return None
    low, high = np.array(box[1:], dtype=np.float64).reshape(2, -1)
    forest = IsolationForest.grow(low, high)
    counted = fit.where("label = 1").select(*AXES).mapInPandas(_leaf_counts(forest), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    held = np.zeros((len(forest.column), forest.column.shape[1] + 1), dtype=np.int64)
    found = counted.toPandas()  # a row for each leaf at most
    held.ravel()[found["place"]] = found["n"]
    return forest.ended(held)


def _ordered(scored: DataFrame, place: int, cells: int) -> float:
    """The value of `score` at a place (from 0) of all rows in order: the cell that has it is cut again until it holds one value."""
    low, high = 0.0, 1.0
    while True:
        cell = F.floor((F.col("score") - low) / (high - low) * cells)
        found = scored.where(F.col("score").between(low, high)).groupBy(cell.alias("cell"))
        rows = sorted(found.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect())
        for row in rows:
            if place < row["n"]:
                break
            place -= row["n"]
        if row["low"] == row["high"]:
            return row["low"]
        low, high = row["low"], row["high"]


def threshold(scored: DataFrame, lost: float, cells: int = 1 << 14) -> float:
    """Anomaly above which documents go: best hit rate less false rate, losing at most `lost` of the good rows.

    Exact over all rows `(label, score)`. Only counts of the score's cells reach the driver; within a cell Spark adds them up in order.
    """
    cell = F.floor(F.col("score") * cells).cast("long").alias("cell")
    counted = scored.groupBy("score").agg(F.sum(F.lit(1) - F.col("label")).alias("bad"), F.sum("label").alias("good")).withColumn("cell", cell)
    sums = counted.groupBy("cell").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    n_bad, n_good = int(sums["bad"].sum()), int(sums["good"].sum())
    if not n_good:
        return 1.0
    good = scored.where("label = 1")
    at = (n_good - 1) * (1 - lost)
    below, above = _ordered(good, int(at), cells), _ordered(good, min(int(at) + 1, n_good - 1), cells)
    part = at - int(at)
    floor = above - (above - below) * (1 - part) if part >= 0.5 else below + (above - below) * part
    # the floor is a cut of its own, also where its cell has no rows
    sums.loc[len(sums)] = [int(np.floor(floor * cells)), 0, 0]
    sums = sums.groupby("cell", as_index=False).sum().sort_values("cell", ascending=False)
    before = pd.DataFrame({"cell": sums["cell"], "more_bad": sums["bad"].cumsum() - sums["bad"], "more_good": sums["good"].cumsum() - sums["good"]})
    up = Window.partitionBy("cell").orderBy(F.desc("score"))
    before = scored.sparkSession.createDataFrame(before, "cell long, more_bad long, more_good long")
    # rows above a cut are those of the cells above, and of the scores above it in its cell
    own = scored.sparkSession.createDataFrame([(floor, 0, 0, int(np.floor(floor * cells)))], "score double, bad long, good long, cell long")
    tallied = counted.unionByName(own).groupBy("cell", "score").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    tallied = tallied.withColumns({k: F.sum(k).over(up) - F.col(k) for k in ("bad", "good")} | {"is_bad": F.col("bad") > 0})
    cuts = tallied.where((F.col("score") == floor) | (F.col("is_bad") & (F.col("score") > floor))).join(F.broadcast(before), "cell")
    hits = (F.col("bad") + F.col("more_bad")) / F.lit(max(n_bad, 1)).cast("double")
    false = (F.col("good") + F.col("more_good")) / F.lit(n_good).cast("double")
    best = cuts.select((hits - false).alias("gain"), "score").orderBy(F.desc("gain"), "score").first()
    return best["score"] if best["gain"] > 0 else 1.0


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, lost: float = 0.01) -> DataFrame:
    """Documents with the rules' counts, `base_failed`, `anomaly` and `kept`.

    `base_failed`: under 20 words, or over 30 % of the words in repeated 8-word windows. `kept`: not that, and the
    forest's anomaly does not exceed the threshold. The forest is grown on all labelled documents of quality 1 that
    pass the base rules, and the threshold is calibrated on all of those and of quality 0, losing at
    most `lost` of the good ones. Without labelled rows nothing is anomalous.

    A null or empty text has no words and fails the base rule. Ids may be null or repeated; each row is judged
    alone. Result columns replace kept ones of the same name. An empty table gives an empty table.
    """
    results = COUNTS + ["base_failed", "anomaly", "kept"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in results]
    counted = settle(rule_counts(docs, id_col, text_col, keep), "rule-counts")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))

    def axes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame(features(rows), columns=AXES).assign(label=rows["label"].to_numpy())

    passing = counted.where(~failed).drop("row").join(labelled(labels, "quality", id_col=id_col), "id").drop("id")
    fit = settle(passing.mapInPandas(axes, ", ".join(f"{c} double" for c in AXES) + ", label int"), "rule-labels")
    forest, limit = fit_forest(fit), 1.0

    @F.pandas_udf("double")
    def anomaly(values: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(features(values)) if forest else np.zeros(len(values)))

    @F.pandas_udf("double")
    def known(values: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(values[AXES].to_numpy()))

    if forest:
        limit = threshold(settle(fit.select("label", known(F.struct(*AXES)).alias("score")), "rule-scores"), lost)
    scored = counted.withColumn("base_failed", failed).withColumn("anomaly", anomaly(F.struct(*COUNTS, *MORE)))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= F.lit(limit))).select("row.*", *results)
