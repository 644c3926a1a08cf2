"""Uniform sharding with exact shard sizes by a hypergeometric communication matrix.

A uniformly random permutation of n rows, cut into shards of fixed sizes, sends a random number of rows from
each input partition to each shard. Those counts follow a multivariate hypergeometric law. So:

1. count the rows of each input partition;
2. draw the matrix ``counts[partition, shard]`` with the exact row sums (partition sizes) and column sums (shard
   sizes). Nobody holds the matrix: partitions are halved as a tree, each node splits its counts between its halves
   by a seeded hypergeometric draw, and a task walks down to its own row. On its way it adds up the rows of the
   partitions to its left, which gives the place of its first row in each shard;
3. permute each partition locally: its rows take the multiset of shards that the matrix deals it, in random order;
4. exchange the rows by their place, so every task gets an equal share of rows, and a shard may be many tasks;
5. permute again: a keyed permutation of each shard's places turns the place, in order of partitions, into the slot.

The partitions that are counted must be those that are dealt, also when a task runs again. A plain scan of
files has fixed splits (``fixed_splits=True``); any other input is first written to the shared folder. A
partition that doesn't match its count stops the job. All draws are seeded by (seed, node or partition).

What is collected and broadcast is one number for each input partition, 8 MB for a million of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, lean
from .shingles import mix

SHARDS = 24
#: numpy's own sampler takes populations up to this.
NUMPY_LIMIT = 10**9
FEISTEL_ROUNDS = 6


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int, limit: int = NUMPY_LIMIT) -> int:
    """Good ones among ``n`` drawn without replacement, exactly, for populations of any size.

    A large population is thinned: each one is taken with chance n / (good + bad). Given how many were taken, they
    are a uniform subset, so as many as are too many leave, or are still missing join, by a uniform draw that is about as
    small as the root of n.
    """
    if good + bad < limit:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    if 2 * n > good + bad:
        return good - hypergeometric(rng, good, bad, good + bad - n, limit)
    if n <= 64:
        found = 0
        for _ in range(n):
            hit = int(rng.integers(good + bad)) < good
            good, bad, found = good - hit, bad - (not hit), found + hit
        return found
    p = n / (good + bad)
    g, b = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
    if g + b >= n:
        return g - hypergeometric(rng, g, b, g + b - n, limit)
    return g + hypergeometric(rng, good - g, bad - b, n - g - b, limit)


def split(rng: np.random.Generator, columns: list[int], n: int, limit: int = NUMPY_LIMIT) -> list[int]:
    """How many of ``n`` rows drawn without replacement come from each column."""
    out, rest = [], sum(columns)
    for k, size in enumerate(columns):
        rest -= size
        taken = n if k == len(columns) - 1 else hypergeometric(rng, size, rest, n, limit)
        out.append(taken)
        n -= taken
    return out


def shard_sizes(n_rows: int, n_shards: int) -> list[int]:
    return [n_rows // n_shards + (k < n_rows % n_shards) for k in range(n_shards)]


def matrix_row(
    before: np.ndarray, columns: list[int], p: int, seed: int, limit: int = NUMPY_LIMIT
) -> tuple[list[int], list[int]]:
    """(counts, sums of the counts of earlier partitions) of partition ``p`` by shard; ``before[i]`` rows come before i."""
    low, high, counts, first = 0, len(before) - 1, list(columns), [0] * len(columns)
    while high - low > 1:
        mid = (low + high) // 2
        left = split(np.random.default_rng([seed, 0, low, high]), counts, int(before[mid] - before[low]), limit)
        if p < mid:
            high, counts = mid, left
        else:
            low, first, counts = mid, [a + b for a, b in zip(first, left)], [a - b for a, b in zip(counts, left)]
    return counts, first


def permuted(x: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The keyed permutation of 0 .. size - 1 at ``x``, element by element: a Feistel network on the smallest even number
    of bits that holds size, run again where it leaves the range."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 2) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = x.astype(np.uint64), np.flatnonzero(size > 1)
    limit = size.astype(np.uint64)
    while len(todo):
        b, m, k = bits[todo], mask[todo], key[todo]
        left, right = out[todo] >> b, out[todo] & m
        for r in range(FEISTEL_ROUNDS):
            left, right = right, left ^ (mix(right + mix(k + np.uint64(r + 1))) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


def shuffle_into_shards(
    spark: SparkSession, df: DataFrame, n_shards: int = SHARDS, seed: int = 0, fixed_splits: bool = False
) -> DataFrame:
    """``df`` with ``shard int`` and ``slot long`` (0, 1, ... within the shard), uniformly shuffled.

    Every row is kept, nulls and repeated rows included; shard sizes differ by one at most; an empty table
    gives an empty table; fewer rows than shards leave the last shards empty. Rows come out sorted by (shard, slot)
    within partitions of equal numbers of rows. Input columns named ``shard`` or ``slot`` are replaced; any other
    name may occur.
    """
    scratch = Scratch(spark, "shards")
    df = df.drop("shard", "slot")
    keep = df.columns
    df = df.toDF(*[f"c{k}" for k in range(len(keep))])
    if not fixed_splits:
        df = scratch.put(df, "input")
    here = F.spark_partition_id()
    sizes = {r[0]: r[1] for r in df.groupBy(here).agg(F.count(F.lit(1))).collect()}  # a row a partition
    total, parts = sum(sizes.values()), max(sizes, default=0) + 1
    before = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(parts)])]).astype(np.int64)
    columns = shard_sizes(total, n_shards)
    starts = np.concatenate([[0], np.cumsum(columns)[:-1]]).astype(np.int64)
    shared = spark.sparkContext.broadcast(before)
    schema = T.StructType(
        [*df.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("to", T.IntegerType())]
    )
    n_out = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), parts)

    def deal(batches):
        p = TaskContext.get().partitionId()
        before = shared.value
        want = int(before[p + 1] - before[p]) if p < len(before) - 1 else 0
        order, first = np.zeros(0, np.int32), np.zeros(n_shards, np.int64)
        if want:
            counts, first = (np.array(x, np.int64) for x in matrix_row(before, columns, p, seed))
            order = np.repeat(np.arange(n_shards, dtype=np.int32), counts)
            np.random.default_rng([seed, 1, p]).shuffle(order)
        at, size = 0, np.array(columns, np.int64)
        keys = mix(np.arange(1, n_shards + 1, dtype=np.uint64) + mix(np.array([seed], np.int64).view(np.uint64)))
        for batch in batches:
            mine = order[at : at + batch.num_rows]
            at += batch.num_rows
            if at > want:
                break
            by = np.argsort(mine, kind="stable")  # the rows of a shard are numbered as they come
            counts = np.bincount(mine, minlength=n_shards)
            number = np.empty(len(mine), np.int64)
            number[by] = np.arange(len(mine)) - np.repeat(np.cumsum(counts) - counts, counts)
            slot = permuted(first[mine] + number, size[mine], keys[mine])
            first = first + counts
            to = ((starts[mine] + slot) * n_out // max(total, 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(mine, pa.int32()), pa.array(slot), pa.array(to)], schema.names
            )
        if at != want:
            raise ValueError("a partition doesn't hold the rows that were counted")

    sent = df.mapInArrow(lean(deal), schema).repartitionById(n_out, "to")
    return sent.sortWithinPartitions("shard", "slot").drop("to").toDF(*keep, "shard", "slot")


def op2_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law ``rows``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = shuffle_into_shards(spark, docs, fixed_splits=True)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return out.select(
        "doc_id",
        (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
