"""Admission, estimates and timeouts on sizes derived from order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import admission as A
from ..session import table
from .registry import query

#: size in bytes, first and last sample of a task; every third line has no range.
_TASKS = """t AS (SELECT l_orderkey, l_linenumber, (l_extendedprice * 1000)::BIGINT AS size,
  CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_partkey * 100 END AS a, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_partkey * 100 + (l_quantity * 441000)::BIGINT END AS b, l_quantity AS qty, l_discount AS disc
  FROM lineitem)"""
_PCM = "CASE WHEN a >= 0 AND b > a THEN (b - a) * 8 ELSE greatest(1048576, trunc(size * 3.5::DOUBLE)::BIGINT) END"
_RAM = f"(trunc(({_PCM}) * 7 * 1.8::DOUBLE)::BIGINT + 1073741824)"


def _tasks(spark, d):
    third = F.col("l_linenumber") % 3 == 0
    start = F.when(third, F.lit(0).cast("long")).otherwise(F.col("l_partkey") * 100)
    length = F.when(third, F.lit(0).cast("long")).otherwise(F.round(F.col("l_quantity") * 441000).cast("long"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 1000).cast("long").alias("size"), start.alias("a"), (start + length).alias("b"),
        "l_quantity", "l_discount",
    )




def _args():
    return F.col("size"), F.col("a"), F.col("b")


@query(f"""WITH {_TASKS} SELECT l_orderkey, l_linenumber,
 greatest(1048576, CASE WHEN b > a THEN trunc((b - a) * 8 * 1.5::DOUBLE)::BIGINT ELSE trunc(size * 3.5::DOUBLE)::BIGINT END) AS shm,
 ({_PCM}) * 7 AS disk, {_RAM} AS ram FROM t""")
def q_estimates(spark, d):
    """Shared memory, disk and RAM of a task."""
    return _tasks(spark, d).select(
        "l_orderkey", "l_linenumber", A.shared_memory_bytes(*_args()).alias("shm"), A.disk_bytes(*_args()).alias("disk"), A.ram_bytes(*_args()).alias("ram")
    )


@query(f"""WITH {_TASKS}, r AS (SELECT *, {_RAM} AS ram, ({_PCM}) * 7 AS disk FROM t),
 m AS (SELECT *, (ram + 2147483648 > trunc((34359738368 - 4294967296) * 0.8::DOUBLE)::BIGINT) AS on_disk FROM r)
SELECT l_orderkey, l_linenumber, CASE WHEN on_disk THEN 'disk' ELSE 'shm' END AS mode, CASE WHEN on_disk THEN 2147483648 ELSE ram END AS ram,
 CASE WHEN on_disk THEN disk ELSE 0 END AS disk FROM m""")
def q_storage_mode(spark, d):
    """In memory, or on disk with a fixed RAM share."""
    gb = lambda n: F.lit(n * A.GIB).cast("long")
    mode = A.storage_mode(A.ram_bytes(*_args()), A.disk_bytes(*_args()), gb(32), gb(4), gb(2))
    return _tasks(spark, d).select("l_orderkey", "l_linenumber", mode.alias("m")).select("l_orderkey", "l_linenumber", "m.mode", "m.ram", "m.disk")


@query(f"""WITH {_TASKS}, c AS (SELECT l_orderkey, l_linenumber, {_RAM} AS ram, disc, qty FROM t),
 k AS (SELECT l_orderkey, l_linenumber, CASE WHEN (qty * 1073741824)::BIGINT < 5368709120 THEN 'disk' WHEN 34359738368 - 4294967296 < ram + 2147483648 THEN 'ram'
  WHEN disc * 1000 >= 90 THEN 'memory_load' WHEN qty * 2 >= 85 THEN 'gpu' WHEN (qty * 134217728)::BIGINT < 2147483648 THEN 'vram' ELSE 'approved' END AS "check" FROM c)
SELECT l_orderkey, l_linenumber, "check" = 'approved' AS go, "check", (CASE WHEN "check" = 'approved' THEN 0 ELSE 20 END)::INTEGER AS wait_s FROM k""")
def q_admission(spark, d):
    """The first failing check decides."""
    gb = lambda n: F.lit(n * A.GIB).cast("long")
    q = F.col("l_quantity")
    g = A.gate(
        disk_free=(q * A.GIB).cast("long"), disk_min=gb(5), mode=F.lit("shm"), task_disk=gb(1), ram_free=gb(32), ram_in_flight=gb(4),
        ram_min=gb(2), task_ram=A.ram_bytes(*_args()), memory_load=F.col("l_discount") * 1000, gpu_util=q * 2, gpu_max=0.85,
        vram_free=(q * 134217728).cast("long"), vram_min=gb(1), task_vram=gb(1),
    )
    return _tasks(spark, d).select("l_orderkey", "l_linenumber", g.alias("g")).select("l_orderkey", "l_linenumber", "g.go", "g.check", "g.wait_s")


@query(f"""WITH {_TASKS} SELECT l_orderkey, l_linenumber, floor(greatest(300.0::DOUBLE, least(7200.0::DOUBLE, 300 + 1.5::DOUBLE *
 (CASE WHEN b > a THEN (b - a) / 44100.0::DOUBLE WHEN size > 0 THEN greatest(600.0::DOUBLE, size / 176400.0::DOUBLE) ELSE 300.0::DOUBLE END))))::BIGINT AS seconds FROM t""")
def q_timeouts(spark, d):
    """Adaptive timeout in whole seconds."""
    return _tasks(spark, d).select("l_orderkey", "l_linenumber", A.adaptive_timeout(*_args()).alias("seconds"))


@query("""SELECT c_custkey, greatest(1, least(floor((c_custkey % 128) * 0.625::DOUBLE / 1.75::DOUBLE)::INTEGER, greatest(1, floor((c_custkey % 32) * 0.8::DOUBLE)::INTEGER))) AS workers FROM customer""")
def q_workers(spark, d):
    """Worker number by RAM and CPU."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", A.worker_count(k % 128, k % 32, 0.625, 0.8, 1.75).alias("workers"))


@query("""SELECT c_custkey, (CASE WHEN c_custkey % 100 >= 50 THEN 1 WHEN (c_custkey % 9) * 1073741824 < 4294967296 AND c_custkey % 9 <> 8 THEN 1 ELSE 2 END)::INTEGER AS slots FROM customer""")
def q_slot_limit(spark, d):
    """One or two slots by GPU load and free memory; null memory is unlimited."""
    k = F.col("c_custkey")
    vram = F.when(k % 9 != 8, (k % 9) * A.GIB)
    return table(spark, d, "customer").select("c_custkey", A.slot_limit((k % 100).cast("double"), vram).alias("slots"))


@query("""SELECT c_custkey, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || ((s % 3600) // 60) || 'm' END AS text,
 round(s * 1000000 / 1073741824::DOUBLE, 4) AS gib FROM (SELECT c_custkey, c_custkey * 37 AS s FROM customer)""")
def q_format_duration(spark, d):
    s = F.col("c_custkey") * 37
    return table(spark, d, "customer").select("c_custkey", A.format_duration(s).alias("text"), F.round(A.gib(s * 1000000), 4).alias("gib"))
