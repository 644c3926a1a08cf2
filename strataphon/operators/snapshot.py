"""Keyed snapshots without MERGE: upsert, history, dead letters, reconciliation, evolution.

Tables are plain DataFrames. A batch is reduced to one row per key before it meets the snapshot, so the join
is one shuffle of each side on the key; written snapshots bucketed by that key need none.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonb
from ..session import scratch_dir


def last_per_key(batch: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key: the first in ``order``."""
    ranked = batch.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def upsert(current: DataFrame, batch: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The snapshot after inserting or overwriting ``batch`` (one row per key).

    Columns in ``keep`` (ids, creation times) hold on to the current row's value. Both sides have the same columns.
    """
    old, new = current.alias("old"), batch.alias("new")
    on = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    is_new = F.col("_new").isNotNull()
    joined = old.join(batch.withColumn("_new", F.lit(1)).alias("new"), on, "full_outer")
    return joined.select(
        *[
            F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(c)
            if c in keep or c in keys
            else F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in current.columns
        ]
    )


def history_of(current: DataFrame, batch: DataFrame, keys: Sequence[str], documents: Sequence[str], at: Column) -> DataFrame:
    """The current rows that ``batch`` changes in one of ``documents`` (compared as JSON values), with ``archived_at``.

    Texts that are equal as they stand are equal values; only others are parsed, each once.
    """
    changed = None
    for c in documents:
        old, new = F.col(f"old.{c}"), F.col(f"new.{c}")
        one = ~old.eqNullSafe(new) & jsonb.differs(old, new)
        changed = one if changed is None else changed | one
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    batch = batch.select(*dict.fromkeys([*keys, *documents]))
    joined = current.alias("old").join(batch.alias("new"), on).where(changed)
    return joined.select("old.*", at.alias("archived_at"))


def with_new_ids(snapshot: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Rows of null id get the next ids after the highest, in ``order``; ties of ``order`` in any sequence.

    New rows are sorted by ranges and written with their range and place, so that counting and numbering see the same
    ranges; a range's offset, one row each, is joined to its rows.
    """
    spark, kind = snapshot.sparkSession, snapshot.schema[id_column].dataType
    names = [f"c{k}" for k in range(len(snapshot.columns))]
    at = dict(zip(snapshot.columns, names))
    old, new = snapshot.where(F.col(id_column).isNotNull()), snapshot.where(F.col(id_column).isNull())
    top = old.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).first()[0]
    keys = [at[c] for c in order]
    ranged = new.toDF(*names).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    ranged = ranged.withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    path = f"{scratch_dir(spark)}/ids-{uuid.uuid4().hex[:12]}"
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each range
    starts = counts.select("part", (F.coalesce(before, F.lit(0)) + top + 1).alias("start"))
    number = (F.col("start") + F.col("place")).cast(kind)
    numbered = rows.join(F.broadcast(starts), "part").withColumn(at[id_column], number)
    return old.union(numbered.select(*names))


def replay_dead_letters(current: DataFrame, letters: DataFrame, ok: Column, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(snapshot, letters that stay): letters that satisfy ``ok`` are upserted and leave the queue."""
    good = letters.where(F.coalesce(ok, F.lit(False)))
    return upsert(current, good.select(*current.columns), keys), letters.join(good.select(*keys), list(keys), "left_anti")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys with ``in_left`` and ``in_right``; columns of both sides, which must differ in name but for the keys."""
    a, b = left.withColumn("in_left", F.lit(True)), right.withColumn("in_right", F.lit(True))
    joined = a.join(b, list(keys), "full_outer")
    return joined.fillna(False, ["in_left", "in_right"])


def unpivot(df: DataFrame, ids: Sequence[str], branches: dict[str, Column], name: str, value: str) -> DataFrame:
    """One row per branch from one scan: each branch's literal name and value."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in branches.items()])
    return df.select(*ids, F.inline(pairs))


def dedup_by_content(df: DataFrame, content: str, order: Column, hash_name: str = "audio_hash") -> DataFrame:
    """The first row of each content, by its md5: an aggregate that is made in part before the shuffle, so a content
    that a large share of rows has doesn't meet in one task. Rows of null content are one group."""
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), order)
    found = df.groupBy(F.md5(F.col(content).cast("binary")).alias(hash_name)).agg(row.alias("_row"))
    return found.select("_row.*", hash_name)


def recover_stale(states: DataFrame, message: str = "interrupted") -> DataFrame:
    """After a restart, tasks that were waiting or running have failed."""
    stale = F.col("status").isin("PENDING", "RUNNING")
    return states.withColumn("error_message", F.when(stale, message).otherwise(F.col("error_message"))).withColumn(
        "status", F.when(stale, "FAILED").otherwise(F.col("status"))
    )


def admit(states: DataFrame, requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``requests`` with ``run`` and the ``status`` that follows: absent, failed or forced tasks run; others are skipped."""
    seen = states.select(*keys, F.col("status").alias("_status"))
    joined = requests.join(seen, list(keys), "left")
    run = F.col("_status").isNull() | (F.col("_status") == "FAILED") | F.coalesce(F.col("force"), F.lit(False))
    return joined.withColumn("run", run).withColumn("status", F.when(run, "PENDING").otherwise(F.col("_status"))).drop("_status")


def evolve(df: DataFrame, renames: dict[str, str], additions: dict[str, str]) -> DataFrame:
    """Columns renamed, and missing ones added as nulls of the given types."""
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    for name, kind in additions.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def migration_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """A dry run's answer: keys whose ``column`` changes, with both values."""
    new = after.select(*keys, F.col(column).alias("after"))
    joined = before.select(*keys, F.col(column).alias("before")).join(new, list(keys))
    return joined.where(~F.col("before").eqNullSafe(F.col("after")))


def migrate_states(states: DataFrame, keys: Sequence[str], added: dict[str, Column], order: Column) -> DataFrame:
    """State rows under a wider key: a missing column is added, and of rows that then share a key the first in ``order``
    stays. Rows that have all columns are left as they are."""
    lacking = {name: value for name, value in added.items() if name not in states.columns}
    if not lacking:
        return states
    wide = states.withColumns(lacking)
    row = F.min_by(F.struct(*[c for c in wide.columns if c not in keys]), order)
    return wide.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def planned_update(rows: DataFrame, keys: Sequence[str], column: str, value: Column, limit: int | None = None) -> DataFrame:
    """``keys, before, after, outcome`` of an update that is not made yet: ``changed``, ``skipped`` (the same value) or
    ``failed`` (a value that comes out null). ``limit`` takes the first rows by key."""
    rows = rows if limit is None else rows.orderBy(*keys).limit(limit)
    before, after = F.col(column), value.cast(rows.schema[column].dataType)
    outcome = F.when(after.isNull() & before.isNotNull(), "failed").when(before.eqNullSafe(after), "skipped").otherwise("changed")
    return rows.select(*keys, before.alias("before"), after.alias("after"), outcome.alias("outcome"))


def outcomes(plan: DataFrame) -> DataFrame:
    """One row with the number of rows of each outcome."""
    return plan.agg(*[F.count(F.when(F.col("outcome") == k, 1)).alias(k) for k in ("changed", "skipped", "failed")])


def apply_update(rows: DataFrame, plan: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``rows`` with the planned changes."""
    new = plan.where("outcome = 'changed'").select(*keys, F.col("after").alias("_after"), F.lit(True).alias("_new"))
    joined = rows.join(new, list(keys), "left")
    kept = [F.when(F.col("_new"), F.col("_after")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in rows.columns]
    return joined.select(*kept)
