"""Rolling task telemetry: moving averages, rates, histograms, progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALPHA = 0.15
# Upper bounds of histogram buckets in seconds, by metric.
BOUNDS = {
    "task_duration": [1, 2, 5, 10, 15, 20, 30, 45, 60, 90, 120, 180, 300],
    "file_duration": [2, 5, 10, 20, 30, 45, 60, 90, 120, 180, 240, 360, 600],
    "stage_duration": [0.01, 0.05, 0.1, 0.25, 0.5, 1, 2, 5, 10, 20, 30, 60, 120],
    "demucs_wait": [0.1, 0.5, 1, 2, 5, 10, 20, 30, 60, 120, 300],
    "tensor_wait": [0.05, 0.1, 0.5, 1, 2, 5, 10, 20, 30, 60],
    "gatekeeper_wait": [1, 5, 10, 20, 30, 60, 120, 300],
    "shm_alloc_duration": [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1, 2, 5],
    "python_stage_duration": [0.005, 0.01, 0.05, 0.1, 0.25, 0.5, 1, 2, 5, 10, 20, 30, 60],
    "gpu_wait": [0.5, 1, 2, 5, 10, 20, 30, 60, 120],
}


def ema_fold(values: Column, alpha: float = ALPHA) -> Column:
    """Exponential moving average of an ordered array; 0 counts as not set yet, so the next value seeds it."""
    step = lambda a, v: F.when(a == 0.0, v).otherwise(alpha * v + (1.0 - alpha) * a)
    return F.aggregate(values, F.lit(0.0), step)


def ema(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, alpha: float = ALPHA, block: str = "day") -> DataFrame:
    """The average after the last row of each key, in the order (ts, tie); 0 counts as not set yet.

    The fold of a block of rows is a function of the average before it: ``seed`` if that is not set, else
    ``gain`` times it plus ``shift``. Such functions compose, so a key's rows meet in blocks of one ``block`` of time, and
    per key only one row a block. An average that comes to 0 within a block by cancellation alone stays set.
    """
    x = lambda v: F.coalesce(v["v"], F.lit(0.0))
    rows = F.array_sort(F.collect_list(F.struct(ts, tie, F.col(value).cast("double").alias("v"))))
    blocks = df.groupBy(*keys, F.date_trunc(block, F.col(ts)).alias("_block")).agg(rows.alias("_rows"))
    none = F.struct(F.lit(0.0).alias("seed"), F.lit(1.0).alias("gain"), F.lit(0.0).alias("shift"))
    fold = F.aggregate(
        "_rows",
        none,
        lambda a, v: F.struct(
            F.when(a["seed"] == 0.0, x(v)).otherwise(alpha * x(v) + (1.0 - alpha) * a["seed"]).alias("seed"),
            ((1.0 - alpha) * a["gain"]).alias("gain"),
            (alpha * x(v) + (1.0 - alpha) * a["shift"]).alias("shift"),
        ),
    )
    parts = blocks.select(*keys, F.struct("_block", fold.alias("f")).alias("_part"))
    whole = F.array_sort(F.collect_list("_part"))
    step = lambda a, p: F.when(a == 0.0, p["f"]["seed"]).otherwise(p["f"]["gain"] * a + p["f"]["shift"])
    return parts.groupBy(*keys).agg(whole.alias("_parts")).select(*keys, F.aggregate("_parts", F.lit(0.0), step).alias("ema"))


def with_previous(df: DataFrame, keys: Sequence[str], ts: str, tie: str, columns: Sequence[str], block: str = "day") -> DataFrame:
    """``df`` with ``previous``, a struct of ``columns`` of the key's row before in the order (ts, tie), or null.

    A key with very many rows is not one task: rows meet by key and ``block`` of time, and the last row of each block,
    which is all that the next one needs, is passed on in a table of one row a block.
    """
    here, row = F.date_trunc(block, F.col(ts)), F.struct(*columns)
    blocked = df.withColumn("_block", here)
    inside = Window.partitionBy(*keys, "_block").orderBy(ts, tie)
    rows = blocked.withColumn("_before", F.lag(row).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    last = blocked.groupBy(*keys, "_block").agg(F.max_by(row, F.struct(ts, tie)).alias("_last"))
    last = last.select(*keys, "_block", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block")).alias("_carried"))
    joined = rows.join(last, [*keys, "_block"])
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    return joined.select(*[F.col(c) for c in df.columns], previous.alias("previous"))


def rolling_count(df: DataFrame, keys: Sequence[str], ts: str, seconds: int = 60) -> DataFrame:
    """Rows of the key strictly after ``ts - seconds`` up to ``ts`` itself, as ``in_window``."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(*keys).orderBy("_us").rangeBetween(-seconds * 1_000_000 + 1, 0)
    return df.withColumn("_us", micros).withColumn("in_window", F.count(F.lit(1)).over(w)).drop("_us")


def counter_rate(df: DataFrame, keys: Sequence[str], ts: str, tie: str, counter: str) -> DataFrame:
    """Increase per second since the key's previous sample; a falling counter was reset and counts from 0."""
    rows = with_previous(df, keys, ts, tie, [ts, counter])
    before, at = F.col(f"previous.{counter}"), F.col(f"previous.{ts}")
    grown = F.when(F.col(counter) < before, F.col(counter)).otherwise(F.col(counter) - before)
    seconds = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / 1e6
    return rows.withColumn("rate", F.when(seconds > 0, grown / seconds)).drop("previous")


def range_rate(df: DataFrame, keys: Sequence[str], ts: str, tie: str, counter: str, seconds: int = 60) -> DataFrame:
    """Per key and step of ``seconds``: the increase of the counter between the step's first and last sample, resets
    added up, over the time between them; null with one sample. Sums of a step's rows, made in part before the shuffle."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = with_previous(df.withColumn("_step", F.floor(micros / (seconds * 1_000_000))), [*keys, "_step"], ts, tie, [counter])
    before = F.col(f"previous.{counter}")
    grown = F.when(before.isNull(), 0.0).when(F.col(counter) < before, F.col(counter)).otherwise(F.col(counter) - before)
    out = rows.groupBy(*keys, "_step").agg(
        F.sum(grown).alias("increase"), F.min(micros).alias("_from"), F.max(micros).alias("_to"), F.count(F.lit(1)).alias("samples")
    )
    span = (F.col("_to") - F.col("_from")) / 1e6
    return out.select(*keys, (F.col("_step") * seconds).alias("step"), "samples", F.when(span > 0, F.col("increase") / span).alias("rate"))


def histogram(df: DataFrame, keys: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative buckets: rows with value <= ``le`` for each bound, one partial aggregation for all bounds."""
    counts = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.sum((F.col(value) <= b).cast("long")).alias("n")) for b in bounds])
    return df.groupBy(*keys).agg(counts.alias("buckets")).select(*keys, F.inline("buckets"))


def metric_histograms(df: DataFrame, metric: str, value: str) -> DataFrame:
    """``metric, le, n`` of rows of the known metrics, by their own bounds; one partial aggregation, without an explode of
    the rows."""
    known = df.where(F.col(metric).isin(*BOUNDS))
    at = {m: [float(b) for b in bounds] for m, bounds in BOUNDS.items()}
    widest = max(map(len, at.values()))
    bound = lambda k: F.element_at(F.create_map(*[x for m, b in at.items() if k < len(b) for x in (F.lit(m), F.lit(b[k]))]), F.col(metric))
    sums = [F.struct(F.first(bound(k)).alias("le"), F.count(F.when(F.col(value) <= bound(k), 1)).alias("n")) for k in range(widest)]
    counted = known.groupBy(metric).agg(F.array(*sums).alias("buckets")).select(metric, F.inline("buckets"))
    return counted.where("le is not null")


def file_progress(tracks: DataFrame, file: str, total: Column, finished: Column, ok: Column) -> DataFrame:
    """Per file: tracks finished, succeeded and failed, and its status once all are finished; ``total`` is an aggregate."""
    done = tracks.groupBy(file).agg(
        total.cast("long").alias("total"),
        F.sum(finished.cast("long")).alias("finished"),
        F.sum((finished & ok).cast("long")).alias("succeeded"),
        F.sum((finished & ~ok).cast("long")).alias("failed"),
    )
    status = F.when(F.col("finished") < F.col("total"), "running").when(
        (F.col("failed") > 0) & (F.col("succeeded") == 0), "error"
    )
    return done.withColumn("status", status.otherwise("success"))


def eta_seconds(queue: Column, average: Column) -> Column:
    return F.when((queue > 0) & (average > 0), queue * average).otherwise(0.0)


def last_value(df: DataFrame, keys: Sequence[str], value: str, *order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("last"))


def anchored(column: Column, pattern: str) -> Column:
    """A label matcher: the pattern must match the whole label."""
    return column.rlike(f"^(?:{pattern})$")
