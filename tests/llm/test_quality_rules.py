"""Forest and threshold of the quality rules, over every labelled row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm.quality_rules import AXES, IsolationForest, apply_rules, fit_forest, threshold


def brute_threshold(scores, good, lost):
    floor = np.quantile(scores[good], 1 - lost)
    bad, best, found = scores[~good], 0.0, 1.0
    for cut in np.unique(np.append(bad[bad > floor], floor)):
        gain = float((bad > cut).mean() if len(bad) else 0) - float((scores[good] > cut).mean())
        if gain > best:
            best, found = gain, float(cut)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_threshold_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    scores = np.round(np.append(rng.beta(4, 6, 300), rng.beta(6, 4, 90)), [17, 2, 17, 1][seed])
    good = np.arange(len(scores)) < 300
    scored = spark.createDataFrame([(int(g), float(s)) for g, s in zip(good, scores)], "label int, score double")
    for cells in (4, 1 << 14):
        assert threshold(scored, 0.05, cells) == brute_threshold(scores, good, 0.05)
    assert threshold(scored.where("label = 1"), 0.05) == 1.0 == threshold(scored.where("label = 0"), 0.05)


def test_forest_counts_every_row(spark):
    rng = np.random.default_rng(1)
    x = rng.beta(1, 9, (1000, len(AXES)))
    fit = spark.createDataFrame([(*map(float, row), int(k % 5 > 0)) for k, row in enumerate(x)], ", ".join(f"{c} double" for c in AXES) + ", label int")
    forest, plain = fit_forest(fit.repartition(5)), IsolationForest.grow(x.min(0), x.max(0))
    own = x[np.arange(1000) % 5 > 0]
    held = np.stack([np.bincount(leaf, minlength=forest.path.shape[1]) for leaf in plain.leaves(own)])
    assert (held.sum(1) == 800).all() and np.array_equal(forest.path, plain.ended(held).path)
    assert fit_forest(fit.where("label = 0")) is None
    far = forest.score(np.vstack([x.max(0), np.median(own, 0)]))
    assert far[0] > far[1]


def test_labels_beyond_twenty_thousand_count(spark):
    """Rows of the greatest hashes were no part of the sample; only they are bad here."""
    ids = spark.range(20_300).orderBy(F.xxhash64(F.lit(0), "id"), "id").toPandas()["id"].tolist()
    bad = set(ids[20_000:])
    words = [f"w{k}" for k in range(25)]
    rows = [(i, " ".join(w + "%%%" * (i in bad) for w in words[: 21 + i % 4]), int(i not in bad)) for i in ids]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    found = apply_rules(table.select("doc_id", "text"), table.select("doc_id", "quality"), keep=["doc_id"])
    assert {r.doc_id for r in found.where("not kept").collect()} == bad
