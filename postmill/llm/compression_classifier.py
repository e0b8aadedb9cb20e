"""Quality by compression: dictionaries of good and bad text, and the difference they make."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import logistic, sample, with_text

# Bytes of a dictionary; texts are compressed in chunks of CHUNK bytes, all of them.
DICTIONARY, CHUNK, LEVEL = 1 << 16, 1 << 11, 3


class Compressors:
    """Compressors with the bad and the good dictionary."""

    def __init__(self, dictionaries: list[bytes]):
        self.own = []
        for raw in dictionaries:
            known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT if raw[:4] != b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_AUTO)
            known.precompute_compress(level=LEVEL)
            self.own.append(zstandard.ZstdCompressor(dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False))

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Normalised difference of the compressed sizes, share of the size that stays, log length."""
        bad = good = 0
        for at in range(0, len(text), CHUNK):
            part = text[at : at + CHUNK]
            bad += len(self.own[0].compress(part))
            good += len(self.own[1].compress(part))
        return (bad - good) / max(bad + good, 1), good / max(len(text), 1), float(np.log1p(len(text)))


def _expand(x: np.ndarray) -> np.ndarray:
    """What the calibration weighs: the difference alone, and with how much text there is to tell by."""
    difference, stays, size = x.T
    return np.column_stack([10 * difference, 10 * np.minimum(difference, 0), np.minimum(stays, 2), np.minimum(stays, 0.25), size / 10, difference * size])


def train(texts: list[tuple[str, int]]) -> list[bytes]:
    """The bad and the good dictionary, from chunks with labels 0 and 1."""
    found = []
    for label in (0, 1):
        parts = [t.encode() for t, y in texts if y == label and t]
        try:
            found.append(zstandard.train_dictionary(DICTIONARY, parts).as_bytes())
        except (zstandard.ZstdError, ValueError):  # too little text to train on: the text itself
            found.append(b"".join(parts)[-DICTIONARY:] or b"\0" * 8)
    return found


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, chunks: int = 8192, rows: int = 8192, cut: float = 0.3
) -> DataFrame:
    """Documents with `held_out`, `score` (0 to 1, higher: quality 1 likelier) and `predicted` (score >= `cut`).

    `held_out` marks ids whose CRC-32, as text, is a multiple of 5; nothing is learned from their labels.
    Remainders 1 to 3 give the dictionaries, from at most `chunks` chunks of each label; remainder 4 calibrates the
    score by a logistic fit on at most `rows` rows. Every whole text is compressed, chunk by chunk, with both.

    Null and empty texts get the score the fit gives to an empty text. A null id is not held out and not learned
    from; repeated rows get equal scores. Result columns replace kept ones of the same name. Without labels every
    score is 0.5.
    """
    results = ["held_out", "score", "predicted"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in results]
    remainder = F.crc32(F.col(id_col).cast("long").cast("string")) % 5
    ids = labels.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else labels
    learn = sample(ids, "quality", 4 * chunks, F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 != 0)
    chosen = with_text(docs, learn.where(F.crc32(F.col("id").cast("string")) % 5 < 4), id_col, text_col)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                parts = [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]
                yield pa.RecordBatch.from_pydict({"text": pa.array(parts, pa.string()), "label": pa.array([label] * len(parts), pa.int32())})

    parts = chosen.mapInArrow(cut_up, "text string, label int").where(F.length("text") >= 8)
    texts = []
    for label in (0, 1):
        texts += [(r.text, label) for r in parts.where(F.col("label") == label).orderBy(F.xxhash64("text"), "text").limit(chunks).collect()]
    dictionaries = train(texts)
    fit_rows = with_text(docs, learn.where(F.crc32(F.col("id").cast("string")) % 5 == 4).limit(rows), id_col, text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Compressors(dictionaries)
        for batch in batches:
            found = np.array([own.features(t.encode()) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "difference": pa.array(found[:, 0]), "stays": pa.array(found[:, 1]), "size": pa.array(found[:, 2])})

    fit = fit_rows.select("label", "text").mapInArrow(measure, "label int, difference double, stays double, size double").limit(4 * rows).toPandas()
    if fit["label"].nunique() == 2:
        fit = fit.sort_values(list(fit.columns))
        beta = logistic(_expand(fit[["difference", "stays", "size"]].to_numpy()), fit["label"].to_numpy())
    else:
        beta = np.zeros(7)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Compressors(dictionaries)
        for batch in batches:
            found = np.array([own.features((t or "").encode()) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            z = np.column_stack([_expand(found), np.ones(len(found))]) @ beta
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "held_out": batch.column("held_out"), "score": pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))})

    rows_in = docs.select(F.struct(*keep).alias("row"), F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    schema = f"row {rows_in.schema['row'].dataType.simpleString()}, held_out boolean, score double"
    return rows_in.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= cut).cast("int")).select("row.*", *results)
