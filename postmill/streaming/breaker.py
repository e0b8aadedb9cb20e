"""Rate-limit breaker as keyed streaming state: run length and opening position of every organisation.

A stateless stage first turns each batch of attempts into runs: neighbouring positions that were all limited, or
all not. Only runs enter the state operator, so a hot organisation costs a row for each change and not for each
attempt. Organisations share the state of their bucket, which is read and written once a batch; calls for each organisation
took most of the time. What comes out is one row for each breaker that opens; `with_openings` labels attempts with it.
"""

import sys
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from postmill import constants as C
from postmill.session import settle

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPENING = "org_abbrev string, open_at bigint"
_RUNS = "org_abbrev string, first bigint, hits bigint, lead array<bigint>"
_STATE = "org_abbrev array<string>, streak array<bigint>, open_at array<bigint>, seen_ms array<bigint>"
BUCKETS = 1024
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def limited_runs(attempts: DataFrame, threshold: int = C.BREAKER_THRESHOLD) -> DataFrame:
    """Runs of `(org_abbrev, job_index, is_limited, is_cached)`: first position, limited attempts, and the
    positions of the first `threshold` of them; no limited attempt is a reset.

    A run spans neighbouring positions of one batch. Cached attempts neither count nor reset, but they hold runs
    together. Positions are distinct within an organisation, so runs of different tasks never interleave.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas().sort_values(["org_abbrev", "job_index"], kind="stable")
            org, place = rows["org_abbrev"].to_numpy(), rows["job_index"].to_numpy(dtype=np.int64)
            live = ~rows["is_cached"].to_numpy(dtype=bool)
            hit = rows["is_limited"].to_numpy(dtype=bool)
            if not live.any():
                continue
            gap = np.append(True, (org[1:] != org[:-1]) | (place[1:] != place[:-1] + 1))
            stretch = np.cumsum(gap)[live]  # cached attempts lie within a stretch
            org, place, hit = org[live], place[live], hit[live]
            begins = np.flatnonzero(np.append(True, (stretch[1:] != stretch[:-1]) | (hit[1:] != hit[:-1])))
            sizes = np.diff(np.append(begins, len(hit)))
            lead = [place[b : b + min(n, threshold)].tolist() if hit[b] else [] for b, n in zip(begins, sizes)]
            yield pa.RecordBatch.from_pydict(
                {
                    "org_abbrev": pa.array(org[begins], pa.string()),
                    "first": pa.array(place[begins]),
                    "hits": pa.array(np.where(hit[begins], sizes, 0)),
                    "lead": pa.array(lead, pa.list_(pa.int64())),
                }
            )

    narrow = attempts.select("org_abbrev", F.col("job_index").cast("bigint").alias("job_index"), "is_limited", "is_cached")
    return narrow.mapInArrow(run, _RUNS)


class Breaker(StatefulProcessor):
    """Counts the limited attempts in a row of each organisation of a bucket; a breaker stays open once the threshold is reached.

    State that has not been touched for `idle` milliseconds has expired: the organisation starts anew. Organisations
    without a streak or an opening are not kept.
    """

    def __init__(self, threshold: int, idle: int | None):
        self.threshold, self.idle = threshold, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("breaker", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = time.time_ns() // 1_000_000
        held = {org: kept for org, *kept in zip(*self.state.get())} if self.state.exists() else {}
        if self.idle is not None:
            held = {org: kept for org, kept in held.items() if now - kept[2] <= self.idle}
        opened = {}
        runs = pd.concat(rows).sort_values("first")
        for org, hits, lead in zip(runs["org_abbrev"].tolist(), runs["hits"].tolist(), runs["lead"]):
            streak, open_at, _ = held.get(org, (0, None, now))
            if open_at is None:
                if not hits:
                    streak = 0
                elif streak + hits >= self.threshold:
                    opened[org] = open_at = int(lead[self.threshold - streak - 1])
                else:
                    streak += hits
            if streak or open_at is not None:
                held[org] = [streak, open_at, now]
            else:
                held.pop(org, None)
        columns = [list(column) for column in zip(*held.values())] or [[], [], []]
        self.state.update((list(held), *columns))
        if opened:
            yield pd.DataFrame({"org_abbrev": list(opened), "open_at": list(opened.values())})

    def close(self) -> None:
        pass


def breaker_openings(
    attempts: DataFrame, threshold: int = C.BREAKER_THRESHOLD, idle: int | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Stream of openings `(org_abbrev, open_at)` of a stream of attempts.

    Positions must rise from batch to batch; a late lower position is judged against the state it meets. After `idle`
    milliseconds without attempts an organisation starts anew; its state is dropped when its bucket is next touched. (Time-driven
    clean-up needs the processing-time mode, in which an `availableNow` run never ends.) `buckets` is fixed for the life of a
    checkpoint: choose it so that a bucket has some thousands of organisations at most.
    """
    attempts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    runs = limited_runs(attempts, threshold).withColumn("bucket", F.pmod(F.xxhash64("org_abbrev"), F.lit(buckets)))
    return runs.groupBy("bucket").transformWithStateInPandas(Breaker(threshold, idle), OPENING, "Append", "None")


def run_breaker(
    attempts: DataFrame, path: str, checkpoint: str, threshold: int = C.BREAKER_THRESHOLD, idle: int | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Append the openings of everything that has landed to `path`; the number of attempts read."""
    writer = breaker_openings(attempts, threshold, idle, buckets).writeStream.format("parquet").outputMode("append")
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    running.awaitTermination()
    return sum(progress.numInputRows for progress in running.recentProgress)


def with_openings(attempts: DataFrame, openings: DataFrame) -> DataFrame:
    """Add `open_at` and `is_skipped` to landed attempts; the first opening of an organisation counts."""
    # Written first: both join sides are then plain shuffles, which AQE can split at a hot organisation.
    first = settle(openings.groupBy("org_abbrev").agg(F.min("open_at").alias("open_at")), "openings")
    skipped = ~F.col("is_cached") & (F.col("job_index") > F.col("open_at"))
    return attempts.join(first, "org_abbrev", "left").withColumn("is_skipped", F.coalesce(skipped, F.lit(False)))
