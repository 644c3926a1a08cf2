"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside cells, components.

Equal vectors of one label are one class first, so copies never make pairs. Centroids are fitted on a bounded
sample (``SAMPLE`` rows of smallest id hash), in two levels, so their number follows the number of vectors up to
the sample's size; every vector is assigned. A pair may straddle cells, so a vector
y is also a guest of each cell c where a partner could be at home: partners x satisfy |x - y| <= r with
r = sqrt(2 - 2 threshold), and x at home in c means x.(c - d) >= 0 for any other centroid d, hence y.(d - c) <= r |d - c|.
The bound is used at either level: among the upper cells, and among the cells of each upper cell where y is.
Within a cell home vectors are multiplied with home and guest vectors in tiles of bounded size, so every link
is found exactly once from either end. A tile sends link counts and a spanning star of each of its
components, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, lean, linked_stars, pointer_rounds
from .vectors import matrix

THRESHOLD = 0.98
SAMPLE = 40_000
CELL_ROWS, FLAT_CELLS = 2048, 64
HOME_BLOCK, MEMBER_BLOCK = 1024, 4096
ASSIGN_ROWS = 2048


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit rows; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centres)
    return centres


class Level:
    """Centroids with the distances between them."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        self.gap = np.sqrt(np.maximum(0.0, 2 - 2 * centres @ centres.T))

    def near(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Home of each unit row, and the matrix of the cells where it is at home or a guest."""
        s = x @ self.centres.T
        home = s.argmax(axis=1)
        near = s.max(axis=1)[:, None] - s <= reach * self.gap[home] * (1 + 1e-9) + 1e-7
        near[np.arange(len(x)), home] = True
        return home, near


class Cells:
    """Two levels of cells, numbered on; one level while there are few."""

    def __init__(self, x: np.ndarray, cells: int):
        upper = cells if cells <= FLAT_CELLS else math.ceil(math.sqrt(cells))
        self.width = x.shape[1]
        self.upper = Level(spherical_kmeans(x, upper))
        self.lower: list[Level] = []
        home = (x @ self.upper.centres.T).argmax(axis=1)
        for k, centre in enumerate(self.upper.centres):
            mine = x[home == k]
            few = 1 if cells <= FLAT_CELLS else min(len(mine), math.ceil(cells * len(mine) / len(x)))
            self.lower.append(Level(spherical_kmeans(mine, few, seed=k + 1) if few > 1 else centre[None]))
        self.first = np.concatenate([[0], np.cumsum([len(c.centres) for c in self.lower])])

    def assign(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, list[list[int]]]:
        """Home of each unit row, and the cells where it is at home or a guest."""
        top, near = self.upper.near(x, reach)
        home, lists = np.zeros(len(x), np.int64), [[] for _ in x]
        for k, level in enumerate(self.lower):
            rows = np.flatnonzero(near[:, k])
            if not len(rows):
                continue
            own, within = level.near(x[rows], reach)
            mine = top[rows] == k
            home[rows[mine]] = self.first[k] + own[mine]
            for r, cell in zip(*np.nonzero(within)):
                lists[rows[r]].append(int(self.first[k] + cell))
        return home, lists


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors (vec_id, embedding, label)``.

    Rows are compared only with rows of an equal label that is not null and of the same length. Vectors that
    are null, zero or hold null or non-finite components link with nothing, nor do rows of null id. Copies
    link with each other and count as links. Rows that repeat an id are rows of their own: each is linked by its own
    vector, and components of one id share their name. An empty table gives an empty table; other columns are ignored.
    """
    scratch = Scratch(spark, "vectors")
    rows = vectors.select("vec_id", "embedding", "label")
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(v))
        & F.exists("embedding", lambda v: v != 0)
    )
    good = rows.where(F.coalesce(usable, F.lit(False)))
    classes = scratch.put(
        good.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("rep", F.xxhash64("label", "embedding")),  # a class's own name; ids may repeat
        "classes",
    )
    n = classes.count()
    sample = (
        classes.select("embedding", F.xxhash64("rep").alias("h")).orderBy("h").limit(SAMPLE).select("embedding").toArrow()
    )
    lengths = pc.list_value_length(sample["embedding"]).to_numpy()
    common = int(np.bincount(lengths).argmax()) if len(lengths) else 0
    kept, x = matrix(sample["embedding"], common) if sample.num_rows else (None, np.zeros((0, 0)))
    cells = min(len(x), max(1, math.ceil(n / CELL_ROWS)))
    shared = spark.sparkContext.broadcast(Cells(unit(x), cells) if len(x) else None)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))

    def assign(batches):
        mid = shared.value
        for batch in batches:
            emb = batch.column(batch.schema.get_field_index("embedding"))
            home = np.zeros(batch.num_rows, np.int32)
            lists: list[list[int]] = [[0]] * batch.num_rows  # another length than the centroids': one cell
            at, x = matrix(emb, mid.width) if mid else (np.zeros(0, np.int64), None)
            for k in range(0, len(at), ASSIGN_ROWS):
                part = at[k : k + ASSIGN_ROWS]
                home[part], own = mid.assign(unit(x[k : k + ASSIGN_ROWS]), reach)
                for r, cells_of in zip(part.tolist(), own):
                    lists[r] = cells_of
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(lists, pa.list_(pa.int32()))],
                ["label", "embedding", "rep", "copies", "home", "cells"],
            )

    label_type = rows.schema["label"].dataType.simpleString()
    element = rows.schema["embedding"].dataType.simpleString()
    placed = classes.select("label", "embedding", "rep", "copies").mapInArrow(
        lean(assign), f"label {label_type}, embedding {element}, rep long, copies long, home int, cells array<int>"
    )
    placed = scratch.put(placed.withColumn("width", F.size("embedding")), "placed")
    key = ["label", "width", "cell"]
    member = placed.select("label", "width", F.explode("cells").alias("cell"), "rep", "copies", "embedding", "home")
    sizes = scratch.put(
        member.groupBy(key).agg(
            F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).cast("int").alias("n_member"),
            F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / HOME_BLOCK).cast("int").alias("n_home"),
        ),
        "sizes",
    )
    member = member.join(sizes, key)
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    hash_of = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    guests = member.where("n_home > 0").select("*", hash_of("n_member").alias("m")).select("*", every("n_home").alias("h"))
    homes = member.where("home = cell").select("*", hash_of("n_home").alias("h")).select("*", every("n_member").alias("m"))
    columns = [*key, "h", "m", "rep", "copies", "embedding"]
    tiles = guests.select(*columns, F.lit(False).alias("at_home")).union(homes.select(*columns, F.lit(True).alias("at_home")))

    def step(table: pa.Table) -> pa.Table:
        at, x = matrix(table["embedding"])
        x = unit(x)
        rep, copies = table["rep"].to_numpy()[at], table["copies"].to_numpy()[at]
        is_home = table["at_home"].to_numpy(zero_copy_only=False)[at].astype(bool)
        a = x[is_home] @ x[~is_home].T >= threshold
        a &= rep[is_home][:, None] != rep[~is_home][None, :]
        count = a @ copies[~is_home]
        some = count > 0
        stars = linked_stars(a, rep[is_home], rep[~is_home]) if some.any() else []
        node = [*rep[is_home][some].tolist(), *[s[0] for s in stars]]
        return pa.table(
            {
                "rep": pa.array(node, pa.int64()),
                "links": pa.array([*count[some].tolist(), *[None] * len(stars)], pa.int64()),
                "to": pa.array([*[None] * int(some.sum()), *[s[1] for s in stars]], pa.int64()),
            }
        )

    found = scratch.put(
        tiles.groupBy(*key, "h", "m").applyInArrow(step, "rep long, links long, to long"), "found"
    )
    counts = scratch.put(
        found.where("links is not null").groupBy("rep").agg(F.sum("links").alias("links")), "counts"
    )
    groups = pointer_rounds(spark, scratch, found.where("to is not null").select(F.col("rep").alias("a"), F.col("to").alias("b")))
    named = classes.join(counts, "rep", "left").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    named = scratch.put(
        named.select(
            "label",
            "embedding",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "named",
    )
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    summary = scratch.put(named.join(names, "component").select("label", "embedding", "n_links", "component_id"), "summary")
    linked = good.join(summary, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked within labels at cosine 0.98."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
