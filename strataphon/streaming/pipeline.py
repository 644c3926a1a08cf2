"""Structured Streaming: task intake, state gate, rolling statistics, snapshot sink.

Snapshots are versioned Parquet folders under one root with a pointer file, so a reader never sees a half-written
state, and a batch that is run again writes the same version.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import snapshot
from ..operators.telemetry import ALPHA

TASK_SCHEMA = (
    "flacPath string, fileSize bigint, targetScript string, trackNumber int, startSample bigint, endSample bigint, "
    "title string, artist string, album string, albumArtist string, force boolean"
)


def intake(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Task requests from JSON files dropped into ``folder``; the rate limit is the bounded queue."""
    return spark.readStream.schema(TASK_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def expand(tasks: DataFrame, tracks: DataFrame, path: str = "flacPath") -> DataFrame:
    """One row per track of a file (``tracks``: path, array of structs); a file without tracks is one row of number 0."""
    joined = tasks.join(tracks, path, "left")
    one = F.explode_outer("tracks").alias("t")
    out = joined.select(*tasks.columns, one)
    return out.select(
        *[c for c in tasks.columns if c not in ("trackNumber", "startSample", "endSample")],
        F.coalesce("t.track", F.lit(0)).alias("trackNumber"),
        F.coalesce("t.start", F.lit(0)).cast("long").alias("startSample"),
        F.coalesce("t.end", F.lit(0)).cast("long").alias("endSample"),
    )


def state_gate(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed task states over a stream of ``(keys..., seq, event, force)``.

    ``event`` is ``request`` or a new status. A request runs if the task is unknown or failed, or is forced; it then
    waits (PENDING). The output has a row for each input: ``run`` and the ``status`` after it. State is one word a key.
    """
    out = f"{', '.join(f'{k} {requests.schema[k].dataType.simpleString()}' for k in keys)}, seq long, run boolean, status string"

    def step(key, frames, state: GroupState):
        status = state.get[0] if state.exists else None
        rows = []
        for r in pd.concat(list(frames)).sort_values("seq").itertuples(index=False):
            run = None
            if r.event == "request":
                run = status in (None, "FAILED") or bool(r.force)
                status = "PENDING" if run else status
            else:
                status = r.event
            rows.append((*key, r.seq, run, status))
        state.update((status,))
        yield pd.DataFrame(rows, columns=[*keys, "seq", "run", "status"]).astype({"run": "boolean"})

    return requests.groupBy(*keys).applyInPandasWithState(step, out, "status string", "append", GroupStateTimeout.NoTimeout)


def fold_ema(ema: float, values: np.ndarray, alpha: float = ALPHA) -> float:
    """The moving average after ``values``; 0 counts as not set yet. Pieces of values are weighted sums."""
    if not len(values):
        return ema
    if ema == 0:
        some = np.flatnonzero(values)
        if not len(some):
            return 0.0
        ema, values = float(values[some[0]]), values[some[0] + 1 :]
    for start in range(0, len(values), 256):
        part = values[start : start + 256]
        weights = alpha * (1 - alpha) ** np.arange(len(part) - 1, -1, -1.0)
        ema = float(ema * (1 - alpha) ** len(part) + part @ weights)
    return ema


def rolling_stats(events: DataFrame, key: str, seq: str, value: str, alpha: float = ALPHA) -> DataFrame:
    """Stream of ``key, n, last, ema`` after each batch; the state of a key is three numbers."""

    def step(k, frames, state: GroupState):
        n, last, ema = state.get if state.exists else (0, 0.0, 0.0)
        values = pd.concat([f[[seq, value]] for f in frames]).sort_values(seq)[value].to_numpy(dtype=float)
        n, last, ema = n + len(values), float(values[-1]), fold_ema(ema, values, alpha)
        state.update((n, last, ema))
        yield pd.DataFrame([(k[0], n, last, ema)], columns=[key, "n", "last", "ema"])

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, n long, last double, ema double", "n long, last double, ema double", "update", GroupStateTimeout.NoTimeout
    )


def windowed_rate(events: DataFrame, ts: str, late: str, width: str, slide: str, *keys: str) -> DataFrame:
    """Counts per sliding event-time window with a watermark for late rows."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width, slide), *keys).agg(F.count(F.lit(1)).alias("n"))


class SnapshotStore:
    """Current, history and dead-letter tables as versioned folders."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self, table: str) -> int:
        path = self.fs_path(f"{self.root}/{table}/_versions")
        if not self.fs.exists(path):
            return -1
        return max((int(s.getPath().getName()) for s in self.fs.listStatus(path)), default=-1)

    def read(self, table: str, schema: str) -> DataFrame:
        v = self.version(table)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/v{v}") if v >= 0 else self.spark.createDataFrame([], schema)

    def write(self, table: str, df: DataFrame, version: int) -> None:
        """Write a version, then point to it; the pointer is an empty file, created last."""
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/v{version}")
        self.fs.create(self.fs_path(f"{self.root}/{table}/_versions/{version}"), True).close()


def upsert_sink(
    store: SnapshotStore, schema: str, keys: Sequence[str], documents: Sequence[str], order: Column, valid: Column, keep: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: last row per key is upserted, changed rows go to history, invalid ones to the letters.

    Versions are batch numbers, so a batch that runs again starts from the same state and overwrites its own result.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        if store.version("current") >= batch_id:
            return
        batch = batch.persist()
        current = store.read("current", schema)
        ok = F.coalesce(valid, F.lit(False))
        good = snapshot.last_per_key(batch.where(ok), keys, order).select(*current.columns)
        old = snapshot.history_of(current, good, keys, documents, F.current_timestamp())
        old.write.mode("overwrite").parquet(f"{store.root}/history/batch={batch_id}")
        batch.where(~ok).write.mode("overwrite").parquet(f"{store.root}/letters/batch={batch_id}")
        store.write("current", snapshot.upsert(current, good, keys, keep), batch_id)
        batch.unpersist()

    return sink


def dedup_stream(rows: DataFrame, ts: str, late: str, *keys: str) -> DataFrame:
    """The first row of each key that the stream meets; the watermark lets old keys go from the state."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def guarded_sink(sink: Callable[[DataFrame, int], None], letters: Callable[[DataFrame, int, str], None], seconds: float = 20.0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that gives ``sink`` so much time. If it takes longer or fails, its Spark jobs are
    cancelled and the batch goes to ``letters`` with the reason, so the stream goes on."""

    def run(batch: DataFrame, batch_id: int) -> None:
        context, tag = batch.sparkSession.sparkContext, f"sink-{uuid.uuid4().hex[:12]}"
        done: list[BaseException | None] = []

        def work():
            context.addJobTag(tag)
            try:
                sink(batch, batch_id)
                done.append(None)
            except Exception as e:  # whatever it is, the batch must not be lost
                done.append(e)

        thread = InheritableThread(work)
        thread.start()
        thread.join(seconds)
        if thread.is_alive():
            context.cancelJobsWithTag(tag)
            thread.join()
        if not done or done[0] is not None:
            letters(batch, batch_id, "timeout" if not done or "cancel" in str(done[0]).lower() else str(done[0])[:255])

    return run


def periodically(job: Callable[[], None], seconds: float = 600.0, stop: threading.Event | None = None, rounds: int | None = None) -> int:
    """Run ``job`` at once and then every ``seconds`` until ``stop`` is set; the number of runs. A run that fails is only
    logged: the next one finds the same letters."""
    stop, n = stop or threading.Event(), 0
    while not stop.is_set() and (rounds is None or n < rounds):
        try:
            job()
        except Exception:
            logging.getLogger(__name__).exception("a periodic run failed")
        n += 1
        if rounds is None or n < rounds:
            stop.wait(seconds)
    return n
