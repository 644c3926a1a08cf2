"""Text sources and sinks: scraped metrics, JSON queues, done lists, settings."""

from __future__ import annotations

import tomllib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

_SAMPLE = r'^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+-?\d+)?$'


def parse_metrics(lines: DataFrame, column: str = "value") -> DataFrame:
    """Exposition text, one line a row -> ``name, labels map<string,string>, sample``. Comments and other lines go."""
    text = F.trim(F.col(column))
    rows = lines.where(~text.startswith("#") & text.rlike(_SAMPLE))
    pairs = F.regexp_extract_all(F.regexp_extract(text, _SAMPLE, 2), F.lit(r'([A-Za-z_]\w*="(?:[^"\\]|\\.)*")'), F.lit(1))
    entry = lambda p: F.struct(F.regexp_extract(p, "^([^=]+)=", 1).alias("k"), F.regexp_extract(p, '^[^=]+="(.*)"$', 1).alias("v"))
    number = F.regexp_replace(F.regexp_extract(text, _SAMPLE, 3), r"^\+?Inf$", "Infinity")
    return rows.select(
        F.regexp_extract(text, _SAMPLE, 1).alias("name"),
        F.map_from_entries(F.transform(pairs, entry)).alias("labels"),
        F.regexp_replace(number, "^-Inf$", "-Infinity").try_cast("double").alias("sample"),
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return parse_metrics(spark.read.text(path))


def queue_documents(main: DataFrame, predictions: DataFrame, tensor: DataFrame, key: str = "audio_hash") -> DataFrame:
    """Three queue documents per key side by side; a missing or invalid one is ``{}``."""
    valid = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), F.lit("{}"))
    parts = [df.select(key, F.col("doc").alias(n)) for df, n in ((main, "main"), (predictions, "predictions"), (tensor, "tensor"))]
    joined = parts[0].join(parts[1], key, "left").join(parts[2], key, "left")
    return joined.select(key, *[valid(F.col(n)).alias(n) for n in ("main", "predictions", "tensor")])


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_report(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` as a JSON report, one object a row, at ``path`` or in the shared folder; read back."""
    spark, path = rows.sparkSession, path or f"{scratch_dir(rows.sparkSession)}/report-{uuid.uuid4().hex[:12]}"
    rows.write.option("ignoreNullFields", "false").json(path)
    return spark.read.schema(rows.schema).json(path)


#: Parts of a queue entry.
QUEUE_PARTS = ("main", "predictions", "tensor")


def write_queue(parts: dict[str, DataFrame], root: str, key: str = "audio_hash") -> None:
    """Documents ``(key, doc)`` of each part of a queue, appended to folders below ``root``."""
    for name, rows in parts.items():
        rows.select(F.to_json(F.struct(F.col(key).cast("string").alias(key), "doc")).alias("value")).write.mode("append").text(f"{root}/{name}")


def read_queue(spark: SparkSession, root: str, key: str = "audio_hash") -> DataFrame:
    """The entries of a queue, as ``queue_documents``; of a part that is written twice the greater text counts, a part
    without a folder is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    schema, parts = f"{key} string, doc string", []
    for name in QUEUE_PARTS:
        there = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"))
        rows = spark.read.schema(schema).json(f"{root}/{name}") if there else spark.createDataFrame([], schema)
        parts.append(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("doc").alias("doc")))
    return queue_documents(*parts, key)


def remove_queue(spark: SparkSession, root: str) -> bool:
    """Delete a queue whose entries were taken in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def append_done(files: DataFrame, root: str, key: str = "path") -> None:
    """Add to a done list; a name may be added again."""
    files.select(F.col(key).cast("string").alias("value")).distinct().write.mode("append").text(root)


def read_done(spark: SparkSession, root: str, key: str = "path") -> DataFrame:
    return spark.read.text(root).select(F.col("value").alias(key)).distinct()


def not_done(files: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Files that a done list doesn't name."""
    return files.join(done.select(key), key, "left_anti")


def checked_tasks(lines: DataFrame, schema: str, column: str = "value", required: str = "flacPath") -> DataFrame:
    """Requests, one JSON text a row -> ``task`` (null if refused) and ``code``: 202 taken, 400 no JSON object or without
    the required field, 200 for one that repeats an earlier request's field, by the smaller text."""
    task = F.from_json(column, schema)
    good = F.coalesce(F.trim(F.col(column)).startswith("{") & (F.trim(F.coalesce(task[required], F.lit(""))) != ""), F.lit(False))
    rows = lines.withColumn("task", F.when(good, task))
    first = rows.where("task is not null").groupBy(F.col(f"task.{required}").alias("_k")).agg(F.min(column).alias("_first"))
    joined = rows.join(first, F.col(f"task.{required}") == F.col("_k"), "left")
    code = F.when(F.col("task").isNull(), 400).when(F.col(column) == F.col("_first"), 202).otherwise(200)
    return joined.withColumn("code", code).drop("_k", "_first")


class LiveSettings:
    """Settings that are read again when their text changes; ``poll`` is cheap enough for each micro-batch."""

    def __init__(self, read: Callable[[], str], stamp: Callable[[], object], defaults: dict):
        self.read, self.stamp, self.defaults = read, stamp, defaults
        self.seen, self.now = stamp(), load_settings(read(), defaults)

    def poll(self) -> dict[str, tuple]:
        """What changed since the last call; a text that doesn't parse changes nothing."""
        stamp = self.stamp()
        if stamp == self.seen:
            return {}
        self.seen = stamp
        try:
            new = load_settings(self.read(), self.defaults)
        except tomllib.TOMLDecodeError:
            return {}
        changed, self.now = settings_diff(self.now, new), new
        return changed


def log_fields(lines: DataFrame, column: str, contains: str, schema: str, names: dict[str, str]) -> DataFrame:
    """Lines that hold ``contains``, with the fields of their JSON under other ``names``; no JSON gives nulls."""
    parsed = F.from_json(column, schema)
    kept = lines.where(F.col(column).contains(contains))
    fields: list[Column] = [parsed[k].alias(v) for k, v in names.items()]
    return kept.select("*", *fields)


def load_settings(text: str, defaults: dict) -> dict:
    """TOML over defaults, section by section."""
    found = tomllib.loads(text)
    return {k: (v | found.get(k, {}) if isinstance(v, dict) else found.get(k, v)) for k, v in defaults.items()} | {
        k: v for k, v in found.items() if k not in defaults
    }


def settings_diff(old: dict, new: dict, prefix: str = "") -> dict[str, tuple]:
    """Dotted key -> (old, new) of every setting that differs."""
    out = {}
    for k in sorted(old.keys() | new.keys()):
        a, b = old.get(k), new.get(k)
        if isinstance(a, dict) and isinstance(b, dict):
            out |= settings_diff(a, b, f"{prefix}{k}.")
        elif a != b:
            out[prefix + k] = (a, b)
    return out
