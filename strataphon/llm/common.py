"""What the training-data operators share: scratch tables, bounded broadcasts, Arrow maps and components.

Scratch tables are Parquet files in the folder that ``spark.checkpoint.dir`` names, which every executor
reaches, so a lost executor never loses an intermediate result.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded_batches, scratch_dir

#: A table is broadcast only when it was counted and its rows times this estimate stay under the bound.
BROADCAST_BYTES = 32 << 20

class Scratch:
    """Intermediate tables in the shared folder; they go with the application, or earlier through ``drop``."""

    def __init__(self, spark: SparkSession, tag: str):
        bounded_batches(spark)
        self.spark, self.root = spark, f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
        self.n, self.paths, self.tables = 0, {}, []
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write and reread: the result's lineage is the written files alone."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.tables.append(out)
        return out

    def deal(self, df: DataFrame, key: str, size: int, name: str) -> DataFrame:
        """Write and reread ``df`` bucketed by ``key``, in buckets of about ``BUCKET_BYTES`` of its ``size`` bytes.

        Joins and groups by ``key`` then move the other side only. The catalog's entry goes at once; the files stay.
        """
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        n = self.buckets(size)
        table = f"scratch_{uuid.uuid4().hex}"
        out = df.repartition(n, key).write.option("path", path).option("compression", "zstd")
        out.format("parquet").bucketBy(n, key).saveAsTable(table)
        found = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")
        self.paths[id(found)] = path
        self.tables.append(found)
        release(self.spark)
        return found

    def buckets(self, size: int) -> int:
        """Buckets in which ``deal`` puts ``size`` bytes."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET_BYTES))

    def drop(self, df: DataFrame) -> None:
        """Remove a table that no later plan reads."""
        if path := self.paths.pop(id(df), None):
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


    def keep(self, *kept: DataFrame) -> None:
        """Remove all tables but ``kept``, which the plans to come read, and the shuffle files of those that went."""
        stay = {id(df) for df in kept}
        for df in self.tables:
            if id(df) not in stay:
                self.drop(df)
        self.tables = [df for df in self.tables if id(df) in stay]
        release(self.spark)


#: Bytes of text in one bucket of a dealt table.
BUCKET_BYTES = 16 << 20


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more; else they stay until the driver
    happens to collect its garbage, which Spark itself forces every half hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_broadcast(
    df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES, more_bytes: str | None = None
) -> DataFrame:
    """``df`` with a broadcast hint if its measured size fits ``limit``; else as it is, and the join shuffles.

    The size is ``row_bytes`` a row, and ``more_bytes``, an SQL expression over a row, summed.
    """
    rows, more = df.agg(F.count(F.lit(1)), F.sum(F.expr(more_bytes)) if more_bytes else F.lit(0)).first()
    return F.broadcast(df) if rows * row_bytes + (more or 0) <= limit else df


_HELD: dict[str, object] = {}


def held(owner: str, make: Callable[[], object]) -> object:
    """What an operator keeps in a Python worker from task to task. Workers outlive operators, so whoever comes next
    drops the memory of the one before."""
    if owner not in _HELD:
        _HELD.clear()
        _HELD[owner] = make()
    return _HELD[owner]


def lean(step: Callable, keep: bool = False) -> Callable:
    """``step`` over Arrow batches; at the end of a task the worker gives back what it doesn't need, and, unless
    ``keep``, what it held."""

    @functools.wraps(step)
    def run(batches):
        try:
            yield from step(batches)
        finally:
            if not keep:
                _HELD.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return run


def raw_texts(column: pa.Array) -> list[np.ndarray]:
    """The UTF-8 bytes of each text, without copies; a null one is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].tolist()
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = column.is_valid().to_pylist() if column.null_count else [True] * len(column)
    return [flat[a:b] if ok else flat[:0] for a, b, ok in zip(at, at[1:], valid)]


def linked_stars(a: np.ndarray, home_ids: np.ndarray, member_ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges from every linked vector of a tile to the smallest id of its component in the tile."""
    out: list[tuple[int, int]] = []
    rows, cols = a.any(axis=1), np.ones(a.shape[1], bool)
    for i in np.flatnonzero(rows):
        if not rows[i]:
            continue
        mine, theirs, front = [i], [], np.array([i])
        rows[i] = False
        while len(front):
            new = np.flatnonzero(a[front].any(axis=0) & cols)
            cols[new] = False
            theirs += new.tolist()
            front = np.flatnonzero(a[:, new].any(axis=1) & rows)
            rows[front] = False
            mine += front.tolist()
        ids = np.unique(np.concatenate([home_ids[mine], member_ids[theirs]]))
        out += [(int(v), int(ids[0])) for v in ids[1:]]
    return out


def pointer_rounds(spark: SparkSession, scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges (a, b)`` as ``(id, component)``, component the smallest id.

    Contraction: each node hooks to its neighbour of smallest hash, pointers are doubled once, edges are
    renamed to the pointers and loops go. Hash order keeps hook chains short, so a path of n nodes takes
    O(log n) rounds. Joins read written tables, so AQE can split a hot node's rows. Nodes without edges
    are absent; no edges give an empty table.
    """
    kind = edges.schema["a"].dataType.simpleString()
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.put(edges, "edges")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("to")).union(edges.select("b", "a"))
        best = both.groupBy("id").agg(F.min(F.struct(F.xxhash64("to").alias("h"), "to")).alias("m"))
        own = F.struct(F.xxhash64("id").alias("h"), F.col("id").alias("to"))
        hook = scratch.put(best.select("id", F.least("m", own)["to"].alias("up")), "hook")
        upper = hook.select(F.col("id").alias("up"), F.col("up").alias("top"))
        hook = scratch.put(hook.join(upper, "up").select("id", F.col("top").alias("up")), "jump")
        hooks.append(hook)
        left = hook.select(F.col("id").alias("a"), F.col("up").alias("ua"))
        right = hook.select(F.col("id").alias("b"), F.col("up").alias("ub"))
        moved = edges.join(left, "a").select("ua", "b").join(right, "b").where("ua <> ub")
        renamed = scratch.put(
            moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges"
        )
        scratch.drop(edges)
        edges = renamed
    if not hooks:
        return spark.createDataFrame([], f"id {kind}, component {kind}")
    top = hooks[-1]
    for hook in reversed(hooks[:-1]):
        upper = top.select(F.col("id").alias("up"), F.col("up").alias("top"))
        top = hook.join(upper, "up", "left").select("id", F.coalesce("top", "up").alias("up"))
    top = scratch.put(top, "tops") if len(hooks) > 1 else top
    least = top.groupBy("up").agg(F.min("id").alias("component"))
    # A root that hooked to itself is in the table; one reached only by pointers is its own smallest at worst.
    return scratch.put(top.join(least, "up").select("id", "component"), "components")
