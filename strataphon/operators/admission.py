"""Admission control and resource estimates as pure expressions.

Sizes are bytes as long; null stands for an unknown (unlimited) amount.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB, GIB = 1 << 20, 1 << 30
STEMS = 7
SAMPLE_RATE = 44_100


def ranged(start: Column, end: Column) -> Column:
    return (start >= 0) & (end > start)


def shared_memory_bytes(size: Column, start: Column, end: Column, ratio: float = 3.5) -> Column:
    """Half as much again as the slice's stereo floats, or a multiple of the file; at least 1 MiB."""
    slice_bytes = ((end - start) * 8 * F.lit(1.5)).cast("long")
    file_bytes = (size * F.lit(ratio)).cast("long")
    return F.greatest(F.lit(MIB).cast("long"), F.when(ranged(start, end), slice_bytes).otherwise(file_bytes))


def pcm_bytes(size: Column, start: Column, end: Column) -> Column:
    file_bytes = F.greatest(F.lit(MIB).cast("long"), (size * F.lit(3.5)).cast("long"))
    return F.when(ranged(start, end), (end - start) * 8).otherwise(file_bytes)


def disk_bytes(size: Column, start: Column, end: Column) -> Column:
    return pcm_bytes(size, start, end) * STEMS


def ram_bytes(size: Column, start: Column, end: Column) -> Column:
    return (disk_bytes(size, start, end) * F.lit(1.8)).cast("long") + GIB


def storage_mode(task_ram: Column, task_disk: Column, available: Column, in_flight: Column, minimum: Column,
                 ratio: float = 0.8, fallback: bool = True) -> Column:
    """struct(mode, ram, disk): on disk with 2 GiB of RAM if the task and the minimum exceed the safe share."""
    if not fallback:
        return F.struct(F.lit("shm").alias("mode"), task_ram.alias("ram"), F.lit(0).cast("long").alias("disk"))
    free = F.greatest(F.lit(0).cast("long"), available - in_flight)
    need = task_ram + minimum
    on_disk = (need > (free * F.lit(ratio)).cast("long")) | (free < need)
    return F.struct(
        F.when(on_disk, "disk").otherwise("shm").alias("mode"),
        F.when(on_disk, F.lit(2 * GIB).cast("long")).otherwise(task_ram).alias("ram"),
        F.when(on_disk, task_disk).otherwise(F.lit(0).cast("long")).alias("disk"),
    )


def gate(*, disk_free: Column, disk_min: Column, mode: Column, task_disk: Column, ram_free: Column, ram_in_flight: Column,
         ram_min: Column, task_ram: Column, memory_load: Column, gpu_util: Column, gpu_max: float, vram_free: Column,
         vram_min: Column, task_vram: Column, throttle: bool = True, retry_s: int = 20) -> Column:
    """struct(go, check, wait_s): the first failing check of disk, ram, memory_load, gpu, vram decides."""
    disk_need = disk_min + F.when(mode == "disk", task_disk).otherwise(F.lit(0).cast("long"))
    free = F.greatest(F.lit(0).cast("long"), ram_free - ram_in_flight)
    failed = F.when((disk_need > 0) & (disk_free < disk_need), "disk").when(free < task_ram + ram_min, "ram").when(
        memory_load >= 90, "memory_load"
    )
    if throttle:
        if gpu_max > 0:
            failed = failed.when(gpu_util >= gpu_max * 100, "gpu")
        failed = failed.when((vram_min > 0) & vram_free.isNotNull() & (vram_free < task_vram + vram_min), "vram")
    return F.struct(
        failed.isNull().alias("go"),
        F.coalesce(failed, F.lit("approved")).alias("check"),
        F.when(failed.isNull(), 0).otherwise(retry_s if retry_s > 0 else 20).alias("wait_s"),
    )


def slot_limit(gpu_util: Column, vram_free: Column, capacity: int = 2, dual_util: float = 0.5, dual_vram: int = 4 * GIB) -> Column:
    """2 slots if the GPU is idle enough and has the memory, else 1."""
    if capacity <= 1:
        return F.lit(1)
    busy = (gpu_util >= dual_util * 100) | F.coalesce(vram_free < dual_vram, F.lit(False))
    return F.when(busy, 1).otherwise(2)


def slot_hysteresis(targets: Column, start: int = 1) -> Column:
    """Limits after each of an ordered array of targets: down at once, up after two wishes in a row."""
    state = "struct<limit:int,wishes:int,out:array<int>>"
    first = F.struct(F.lit(start).alias("limit"), F.lit(0).alias("wishes"), F.array().cast("array<int>").alias("out")).cast(state)

    def step(s, t):
        up = t > s["limit"]
        grant = up & (s["wishes"] + 1 >= 2)
        limit = F.when((t < s["limit"]) | grant, t).otherwise(s["limit"])
        wishes = F.when(up & ~grant, s["wishes"] + 1).otherwise(0)
        return F.struct(limit.alias("limit"), wishes.alias("wishes"), F.concat(s["out"], F.array(limit)).alias("out")).cast(state)

    return F.aggregate(targets, first, step)["out"]


def adaptive_timeout(size: Column, start: Column, end: Column, base: int = 300, ratio: float = 1.5, most: int = 7200) -> Column:
    """Whole seconds: base plus a multiple of the track's length, between base and the most."""
    base, ratio, most = base if base > 0 else 300, ratio if ratio > 0 else 1.5, most if most > 0 else 7200
    most = max(most, base)
    length = (
        F.when(end > start, (end - start) / float(SAMPLE_RATE))
        .when(size > 0, F.greatest(F.lit(600.0), size / 176400.0))
        .otherwise(300.0)
    )
    return F.floor(F.greatest(F.lit(float(base)), F.least(F.lit(float(most)), base + length * ratio))).cast("long")


def worker_count(ram_gb: Column, cpus: Column, ram_ratio: float, cpu_ratio: float, worker_gb: float, asked: Column | None = None) -> Column:
    """min(by RAM, by CPU), at least 1; an asked number is held below the RAM limit and 95 % of all RAM."""
    by_ram = F.greatest(F.lit(1), F.floor(ram_gb * min(ram_ratio, 0.95) / worker_gb).cast("int"))
    ceiling = F.floor(ram_gb * 0.95 / worker_gb).cast("int")
    by_cpu = F.greatest(F.lit(1), F.floor(cpus * cpu_ratio).cast("int"))
    free = F.least(by_ram, by_cpu)
    return free if asked is None else F.when(asked <= 0, free).otherwise(F.least(asked, by_ram, ceiling))


def format_duration(seconds: Column) -> Column:
    """``42s``, ``3m 5s`` or ``2h 7m``."""
    s = F.floor(seconds).cast("long")
    return (
        F.when(s < 60, F.format_string("%ds", s))
        .when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60), s % 60))
        .otherwise(F.format_string("%dh %dm", F.floor(s / 3600), F.floor((s % 3600) / 60)))
    )


def gib(size: Column) -> Column:
    return size / float(GIB)
