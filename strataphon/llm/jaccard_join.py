"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Global order: n-grams by ascending frequency level, then by hash. The level comes from a counting sketch of
fixed size over all documents; any order is exact, a good one is fast. An n-gram is then one 64-bit number,
its place in the order.

1. One pass makes each document's set size and fingerprint, and the sketch. Equal sets are one class.
2. Candidates: two sets of Jaccard t share an n-gram among the first n - ceil(t n) + 1 of both. Those prefixes
   are dealt by n-gram; an n-gram whose sketch cell stands out by more than ``SPLIT_RUN`` is dealt in parts. Rows
   of one n-gram are a run; its row of least fingerprint is its leader, and every other row is paired with it if size
   and position allow t. In a run of up to ``RUN`` rows all other pairs are noted too; the rows of longer ones are
   kept for step 5.
3. Verification: the mass that two sets' hash histograms have in common bounds their overlap from above; pairs
   that it rules out go. The order is cut into fragments of equal mass. Each candidate's set is cut with it; overlaps
   are counted fragment by fragment, each on its own, and summed per pair. The sum is exact.
4. Links go to connected components in rounds, so that almost no pair within a component is verified: first one
   leader a row, then one pair for each two components, then what still joins different components.
5. Rows of long runs: of a run whose members all lie in one component nothing is left to find. In others, rows
   meet in random buckets of about ``MEET``, pairs of different components are verified, components are renewed,
   and so on, for ``WAVES`` turns or until few pairs are left (``CHEAP`` a row), which are all verified. Where more
   are left, runs, or groups of runs with common rows, are dealt in blocks as in step 6.
6. A class whose component holds a link between any two of its classes has its number of links from them. Components
   with other pairs left are dealt in blocks of about ``BLOCK_SETS`` sets or ``BLOCK_GRAMS`` n-grams; every two blocks
   meet in one task, which counts all their overlaps. The work is quadratic in such a component, the memory bounded.

Copies never make pairs. The sketch is the only thing that is collected; its size is a parameter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded_broadcast, lean, linked_stars, pointer_rounds, raw_texts, release
from .shingles import Shingler

SKETCH_BITS, SKETCH_CHUNKS = 20, 64
FRAGMENTS = 4
#: Cells of the histogram whose common mass bounds an overlap from above.
CELLS = 128
RUN = 32
MEET, CHEAP, WAVES = 16, 32, 1
SPLIT_RUN = 50_000
SEEN = 200_000
BLOCK_SETS, BLOCK_GRAMS = 1024, 1 << 19


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def survey(width: int, bits: int):
    """Documents -> rows (doc_id, text_key, n, fp) and, at the end of a partition, sketch chunks (chunk, counts)."""

    def step(batches):
        shingle, counts = Shingler(width), np.zeros(1 << bits, np.int32)
        for batch in batches:
            n, fp, cells = [], [], []
            for text in raw_texts(batch.column(1)):
                s = shingle(text)
                n.append(len(s))
                fp.append(xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else None)
                cells.append((s >> np.uint64(64 - bits)).astype(np.int64))
            if cells:
                counts += np.bincount(np.concatenate(cells), minlength=1 << bits).astype(np.int32)
            fps = pa.array(np.array([f or 0 for f in fp], np.uint64).view(np.int64), mask=np.array([f is None for f in fp], bool))
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), fps, none.cast(pa.int32()), none.cast(pa.binary())],
                ["doc_id", "text_key", "n", "fp", "chunk", "counts"],
            )
        parts = counts.reshape(SKETCH_CHUNKS, -1)
        used = np.flatnonzero(parts.any(axis=1))
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())],
            ["doc_id", "text_key", "n", "fp", "chunk", "counts"],
        )

    return step


def add_chunks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(raw, np.int32).astype(np.int64)
            sums[chunk] = sums[chunk] + x if chunk in sums else x
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"]
    )


class Order:
    """The global order: level of each sketch cell, and pivots that cut it into fragments of equal mass."""

    def __init__(self, counts: np.ndarray, fragments: int):
        self.shift = np.uint64(64 - (len(counts).bit_length() - 1))
        excess = counts - counts.mean()
        hot = excess > max(SPLIT_RUN, 8 * np.sqrt(counts.mean()))
        self.hot = np.sort(np.flatnonzero(hot))
        self.parts = np.ceil(excess[self.hot] / SPLIT_RUN).astype(np.uint64)
        levels = np.clip(np.floor(8 * np.log2(counts + 1.0)), 0, 255).astype(np.uint64)
        self.levels = levels << np.uint64(56)
        mass = np.bincount(levels.astype(np.int64), weights=counts, minlength=256)
        total, pivots = np.cumsum(mass), []
        for k in range(1, fragments):
            want = total[-1] * k / fragments
            level = int(np.searchsorted(total, want))
            share = (want - (total[level - 1] if level else 0)) / max(mass[min(level, 255)], 1)
            pivots.append((min(level, 255) << 56) | int(min(max(share, 0), 1) * ((1 << 56) - 1)))
        self.pivots = np.array(pivots, np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        cells = (hashes >> self.shift).astype(np.int64)
        return np.sort(self.levels[cells] | (hashes >> np.uint64(8)))

    def salts(self, tokens: np.ndarray, fp: int) -> np.ndarray:
        """0 for n-grams that are dealt as one run, else the part, from 1, in which this set's row goes."""
        out = np.zeros(len(tokens), np.int32)
        if len(self.hot):
            cells = ((tokens << np.uint64(8)) >> self.shift).astype(np.int64)  # a place keeps its hash's upper bits
            at = np.minimum(np.searchsorted(self.hot, cells), len(self.hot) - 1)
            is_hot = self.hot[at] == cells
            out[is_hot] = 1 + (np.uint64(fp) % self.parts[at[is_hot]]).astype(np.int32)
        return out


def required(n, percent: int):
    """Smallest overlap of a set of size n with any set at Jaccard ``percent`` / 100."""
    return (percent * n + 99) // 100


def prefixes(width: int, percent: int, shared):
    """Documents -> rows (token, salt, fp, size) of their prefixes; ``size`` holds set size and position."""

    def step(batches):
        shingle, order, seen = Shingler(width), shared.value, set()
        for batch in batches:
            tokens, salts, fps, sizes = [], [], [], []
            for text in raw_texts(batch.column(1)):
                s = shingle(text)
                if not len(s):
                    continue
                fp = xxhash.xxh3_64_intdigest(s.tobytes())
                if fp in seen:  # a copy in this partition adds nothing
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(fp)
                n = len(s)
                p = n - int(required(n, percent)) + 1
                tokens.append(order(s)[:p])
                salts.append(order.salts(tokens[-1], fp))
                fps.append(np.full(p, fp, np.uint64))
                sizes.append((np.int64(n) << 32) | np.arange(p))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [as_long(np.concatenate(tokens)), pa.array(np.concatenate(salts)), as_long(np.concatenate(fps)), pa.array(np.concatenate(sizes), pa.int64())],
                    ["token", "salt", "fp", "size"],
                )

    return lean(step)


def possible(na, ia, nb, ib, percent: int):
    """Can sets of sizes na, nb whose first common n-gram is at places ia, ib reach the threshold?"""
    most = np.minimum(na - ia, nb - ib)
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * most >= percent * (na + nb))


STAR, ROW, PAIR = 0, 1, 2


def pair_up(percent: int):
    """Rows sorted by (token, salt, fp) -> (x, y): leaders and their rows (STAR), rows of long runs (ROW: token, fp and
    size) and other pairs of short runs (PAIR)."""

    def made(kind, x, y, size=None):
        zero = np.zeros(len(x), np.int64) if size is None else size
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y), pa.array(zero)], ["kind", "x", "y", "size"]
        )

    def flush(token, salt, fp, size, lead: tuple | None):
        """Complete runs, or a further part of one long run that ``lead`` (fp, n, at) leads."""
        n, at = size >> 32, size & 0xFFFFFFFF
        start = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])]))
        length = np.diff(np.concatenate([start, [len(token)]]))
        run, first = np.repeat(length, length), np.repeat(start, length)
        is_long = (run > RUN) | (salt > 0) | (lead is not None)
        here = np.arange(len(token))
        if lead is None:
            j = here[here != first]
            i = first[j]
            ok = (fp[i] != fp[j]) & possible(n[i], at[i], n[j], at[j], percent)
            x, y = fp[i][ok], fp[j][ok]
        else:
            ok = (fp != lead[0]) & possible(lead[1], lead[2], n, at, percent)
            x, y = np.full(ok.sum(), lead[0]), fp[ok]
        stars = np.unique(np.stack([x, y]), axis=1)
        yield made(STAR, stars[0], stars[1])
        rows = np.flatnonzero(is_long)
        yield made(ROW, token[rows], fp[rows], size[rows])
        others = []
        for d in range(1, RUN):
            i = here[:-d] if d < len(here) else here[:0]
            i = i[(first[i] == first[i + d]) & ~is_long[i] & (first[i] != i)] if len(i) else i
            if not len(i):
                break
            ok = (fp[i] != fp[i + d]) & possible(n[i], at[i], n[i + d], at[i + d], percent)
            others.append(np.stack([fp[i][ok], fp[i + d][ok]]))
        if others:
            pairs = np.unique(np.concatenate(others, axis=1), axis=1)
            yield made(PAIR, pairs[0], pairs[1])

    def step(batches):
        rest, lead, group = None, None, None  # the last run, not complete yet; the leader of a part of it that is done
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(rest, cols)]
            token, salt = cols[0], cols[1]
            if not len(token):
                continue
            done = 0
            if lead is not None:
                same = (token == group[0]) & (salt == group[1])
                done = len(token) if same.all() else int(np.argmin(same))
                if done:
                    yield from flush(*[c[:done] for c in cols], lead)
                if done < len(token):
                    lead = None
            if done < len(token):
                tail = (token == token[-1]) & (salt == salt[-1])
                last = 0 if tail.all() else len(token) - int(np.argmin(tail[::-1]))
                last = max(last, done)
                if last > done:
                    yield from flush(*[c[done:last] for c in cols], None)
                done = last
            rest = [c[done:] for c in cols]
            if len(rest[0]) > SPLIT_RUN:  # a run too long to hold: go on from its first row
                size = int(rest[3][0])
                yield from flush(*rest, None)
                lead, group = (rest[2][0], size >> 32, size & 0xFFFFFFFF), (rest[0][0], rest[1][0])
                rest = None
            elif not len(rest[0]):
                rest = None
        if rest is not None:
            yield from flush(*rest, lead)

    return lean(step)


def fragments(width: int, shared):
    """Documents (fp, text) -> rows (fp, n, fragment, tokens): the set of ``n`` n-grams cut along the global order; ``cells``, in the row of
    fragment -1, counts the set's n-grams by hash and is empty for sets too large for it."""

    def step(batches):
        shingle, order = Shingler(width), shared.value
        for batch in batches:
            ids, ns, parts, tokens, cells = [], [], [], [], []
            for fp, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                s = order(shingle(text))
                count = np.bincount((s & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
                ids.append(fp)
                ns.append(len(s))
                parts.append(-1)
                tokens.append(s[:0])
                cells.append(count.tolist() if count.max() < 1 << 15 else [])
                cuts = np.concatenate([[0], np.searchsorted(s, order.pivots), [len(s)]])
                for k in range(len(cuts) - 1):
                    if cuts[k] < cuts[k + 1]:
                        ids.append(fp)
                        ns.append(len(s))
                        parts.append(k)
                        tokens.append(s[cuts[k] : cuts[k + 1]])
                        cells.append(None)
            sizes = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(ns, pa.int64()),
                    pa.array(parts, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(sizes), as_long(flat)),
                    pa.array(cells, pa.list_(pa.int16())),
                ],
                ["fp", "n", "fragment", "tokens", "cells"],
            )

    return lean(step)


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each of ``xs`` with each of ``ys``, all without repeats."""
    tx, ty = np.concatenate(xs), np.concatenate(ys)
    both = np.intersect1d(tx, ty)
    out = np.zeros(len(xs) * len(ys), np.int64)
    if not len(both):
        return out.reshape(len(xs), len(ys))

    def entries(sets, flat):
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        rows, ok = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), both[at] == flat
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], rows[ok][order]

    (cx, rx), (cy, ry) = entries(xs, tx), entries(ys, ty)
    nx, ny = np.bincount(cx, minlength=len(both)), np.bincount(cy, minlength=len(both))
    dense = 64 * nx * ny > len(out)
    place = np.cumsum(dense) - 1
    for low in range(0, int(dense.sum()), 4096):
        a, b = np.zeros((len(xs), 4096), np.float32), np.zeros((len(ys), 4096), np.float32)
        for m, c, r in ((a, cx, rx), (b, cy, ry)):
            mine = dense[c] & (place[c] >= low) & (place[c] < low + 4096)
            m[r[mine], place[c[mine]] - low] = 1
        out += (a @ b.T).astype(np.int64).ravel()
    thin = ~dense[cx]
    cx, rx, start = cx[thin], rx[thin], np.cumsum(ny) - ny
    total = np.cumsum(ny[cx])
    for low in range(0, int(total[-1]) if len(total) else 0, 1 << 22):
        i, j = np.searchsorted(total, [low, low + (1 << 22)], "right")
        j = len(total) if total[-1] <= low + (1 << 22) else j
        n = ny[cx[i:j]]
        y = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[cx[i:j]], n)
        out += np.bincount(np.repeat(rx[i:j], n) * len(ys) + ry[y], minlength=len(out))
    return out.reshape(len(xs), len(ys))


def block_links(width: int, percent: int):
    """Rows (grp, low, high, block, fp, size, text) sorted by the first three -> of each two blocks of a group, rows
    (fp, links) with the numbers of links and rows (fp, to) that span the components."""

    def work(rows, low: int, high: int):
        own = [[r for r in rows if r[0] == k] for k in ((low,) if low == high else (low, high))]
        x, y = own[0], own[-1]
        if not x or not y:
            return
        sets = [[r[3] for r in part] for part in (x, y)]
        n1, n2 = (np.array([len(t) for t in part], np.int64) for part in sets)
        common = overlaps(*sets)
        linked = 100 * common >= percent * (n1[:, None] + n2[None, :] - common)
        if low == high:
            np.fill_diagonal(linked, False)
        f1, f2 = (np.array([r[1] for r in part], np.int64) for part in (x, y))
        out = [(f1, linked @ np.array([r[2] for r in y], np.int64))]
        if low != high:
            out.append((f2, linked.T @ np.array([r[2] for r in x], np.int64)))
        fps, links = (np.concatenate(c) for c in zip(*out))
        stars = np.array(linked_stars(linked, f1, f2), np.int64).reshape(-1, 2)
        none = np.zeros(len(stars), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([fps, stars[:, 0]])),
                pa.array(np.concatenate([links, none])),
                pa.array(np.concatenate([fps, stars[:, 1]]), mask=np.arange(len(fps) + len(stars)) < len(fps)),
            ],
            ["fp", "links", "to"],
        )

    def step(batches):
        shingle, rows, group = Shingler(width), [], None
        for batch in batches:
            texts = raw_texts(batch.column(6))
            for *key, block, fp, size, text in zip(*(c.to_pylist() for c in batch.columns[:6]), texts):
                if key != group:
                    if rows:
                        yield from work(rows, *group[1:])
                    rows, group = [], key
                rows.append((block, fp, size, shingle(text)))
        if rows:
            yield from work(rows, *group[1:])

    return lean(step)


class Join:
    """One run of the join: its scratch tables, the classes with their texts, and what was verified so far."""

    def __init__(self, spark: SparkSession, docs: DataFrame, width: int, percent: int):
        self.spark, self.width, self.percent = spark, width, percent
        self.scratch = Scratch(spark, "jaccard")
        self.docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))

    def survey(self) -> None:
        """``info`` (doc_id, text_key, n, fp) of every row, ``classes`` (fp, n, size and the row that stands for it) and
        the order of n-grams."""
        made = self.docs.mapInArrow(
            survey(self.width, SKETCH_BITS), "doc_id long, text_key long, n long, fp long, chunk int, counts binary"
        )
        made = self.made = self.scratch.put(made, "survey")
        self.info = made.where("n is not null").select("doc_id", "text_key", "n", "fp")
        counts = np.zeros((SKETCH_CHUNKS, (1 << SKETCH_BITS) // SKETCH_CHUNKS), np.int64)
        chunks = made.where("chunk is not null").select("chunk", "counts").repartition("chunk")
        for row in chunks.mapInArrow(add_chunks, "chunk int, counts binary").collect():  # SKETCH_CHUNKS rows
            counts[row.chunk] = np.frombuffer(row.counts, np.int64)
        self.order = self.spark.sparkContext.broadcast(Order(counts.ravel(), FRAGMENTS))
        rows = self.info.where("fp is not null").groupBy("fp", "doc_id", "text_key", "n").agg(F.count(F.lit(1)).alias("same"))
        at = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "same")).alias("at")
        classes = rows.groupBy("fp").agg(at, F.first("n").alias("n"), F.sum("same").alias("size")).select(
            "fp", "size", F.col("at.doc_id").alias("rep"), F.col("at.text_key").alias("rep_key"), F.col("at.same").alias("same"), "n"
        )
        self.classes = self.scratch.put(classes, "classes")

    def candidates(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(pairs of leaders and rows, all pairs, rows of long runs); ``texts`` of the classes that occur in them."""
        keys = self.docs.mapInArrow(prefixes(self.width, self.percent, self.order), "token long, salt int, fp long, size long")
        keys = keys.repartition("token", "salt").sortWithinPartitions("token", "salt", "fp")
        found = self.scratch.put(keys.mapInArrow(pair_up(self.percent), "kind int, x long, y long, size long"), "candidates")
        pairs = found.where(F.col("kind") != ROW).groupBy(F.col("x").alias("a"), F.col("y").alias("b"))
        pairs = self.scratch.put(pairs.agg(F.min("kind").alias("kind")), "pairs")  # x < y throughout
        runs = found.where(F.col("kind") == ROW).select(F.col("x").alias("token"), F.col("y").alias("fp"), "size").distinct()
        runs = self.scratch.put(runs, "runs")
        ids = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(runs.select("fp")).distinct()
        ids = self.scratch.put(ids.join(self.classes, "fp"), "nodes")
        here = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key"))
        texts = self.docs.join(bounded_broadcast(ids, 64), here).select("fp", "n", "size", "same", "text")
        if not ids.where("same > 1").isEmpty():  # the row that stands for a class may be repeated itself
            texts = texts.where("same = 1").union(texts.where("same > 1").dropDuplicates(["fp"]))
        bytes_ = ids.agg(F.sum("n")).first()[0] or 0
        self.texts = self.scratch.deal(texts.drop("same"), "fp", 8 * bytes_, "texts")
        return pairs.where(F.col("kind") == STAR).select("a", "b"), pairs.select("a", "b"), runs

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of fingerprints that reach the threshold."""
        percent, put = self.percent, self.scratch.put
        nodes = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
        texts = self.texts.join(nodes, "fp")
        sets = texts.select("fp", "text").mapInArrow(
            fragments(self.width, self.order), "fp long, n long, fragment int, tokens array<long>, cells array<smallint>"
        )
        sets = put(sets, "fragments")
        bound = sets.where("fragment = -1")
        left = bound.select(F.col("fp").alias("a"), F.col("n").alias("n1"), F.col("cells").alias("c1"))
        right = bound.select(F.col("fp").alias("b"), F.col("n").alias("n2"), F.col("cells").alias("c2"))
        most = F.aggregate(F.zip_with("c1", "c2", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda t, x: t + x)
        may = (F.size("c1") == 0) | (F.size("c2") == 0) | ((100 + percent) * most >= percent * (F.col("n1") + F.col("n2")))
        pairs = pairs.join(left, "a").join(right, "b").where(may).select("a", "b", (F.col("n1") + F.col("n2")).alias("both"))
        pairs = put(pairs, "possible")
        sets = sets.where("fragment >= 0")
        one = sets.select(F.col("fp").alias("a"), "fragment", F.col("tokens").alias("ta"))
        two = sets.select(F.col("fp").alias("b"), "fragment", F.col("tokens").alias("tb"))
        partial = pairs.join(one, "a").join(two, ["b", "fragment"])
        partial = partial.select("a", "b", "both", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"))
        total = partial.groupBy("a", "b", "both").agg(F.sum("common").alias("common"))
        return put(total.where(F.col("common") * (100 + percent) >= percent * F.col("both")).select("a", "b"), "links")

    def blocks(self, members: DataFrame, sizes: DataFrame) -> DataFrame:
        """All links within groups, by pairs of blocks: ``fp, links`` and ``fp, to`` rows. ``members`` (grp, fp)."""
        blocks = F.ceil(F.greatest(F.col("k") / BLOCK_SETS, F.col("grams") / BLOCK_GRAMS)).cast("int")
        sizes = sizes.select("grp", blocks.alias("blocks"))
        sent = self.texts.join(members.join(sizes, "grp"), "fp").select(
            "grp", "fp", "size", "text", "blocks", F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("block")
        )
        sent = sent.withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
        at = ("grp", "low", "high")
        sent = sent.select(F.least("block", "o").alias("low"), F.greatest("block", "o").alias("high"), "grp", "block", "fp", "size", "text")
        sent = sent.select(*at, "block", "fp", "size", "text").repartition(*at).sortWithinPartitions(*at)
        return self.scratch.put(sent.mapInArrow(block_links(self.width, self.percent), "fp long, links long, to long"), "blocks")

    def renamed(self, named: DataFrame | None, links: DataFrame) -> DataFrame:
        """``fp, component`` of every class in a link, after ``links`` joined those of ``named``."""
        if named is None:
            return pointer_rounds(self.spark, self.scratch, links).toDF("fp", "component")
        ends = self.across(links, named).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        moved = pointer_rounds(self.spark, self.scratch, ends).toDF("old", "component")
        kept = named.withColumnRenamed("component", "old").join(moved, "old", "left")
        fresh = moved.join(named.select(F.col("component").alias("old")).distinct(), "old", "left_anti")
        out = kept.select("fp", F.coalesce("component", "old").alias("component"))
        return self.scratch.put(out.union(fresh.select(F.col("old").alias("fp"), "component")), "named")

    def across(self, pairs: DataFrame, named: DataFrame) -> DataFrame:
        """The ``pairs`` (a, b) of different components, with ``ca`` and ``cb``."""
        out = pairs
        for end in ("a", "b"):
            out = out.join(named.select(F.col("fp").alias(end), F.col("component").alias("c" + end)), end, "left")
            out = out.withColumn("c" + end, F.coalesce("c" + end, end))
        return out.where("ca <> cb").select("a", "b", "ca", "cb")

    def link(self) -> None:
        """``links``, a subset of all links that joins what any links join, and ``named``."""
        stars, pairs, runs = self.candidates()
        put = self.scratch.put
        first = put(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "leaders")
        links = self.verified(first)
        named = self.renamed(None, links)
        rest = put(self.across(pairs.join(first, ["a", "b"], "left_anti"), named), "across")
        low, high = F.least("ca", "cb"), F.greatest("ca", "cb")
        some = rest.groupBy(low, high).agg(F.min(F.struct(F.xxhash64("a", "b").alias("h"), "a", "b")).alias("p"))
        some = put(some.select("p.a", "p.b"), "one-each")
        for chosen in (some, None):
            if chosen is None:
                chosen = rest.select("a", "b").join(some, ["a", "b"], "left_anti")
                chosen = put(self.across(chosen, named).select("a", "b"), "others")
            if not chosen.isEmpty():
                more = self.verified(chosen)
                links, named = links.union(more), self.renamed(named, more)
        release(self.spark)
        tried = pairs
        for wave in range(WAVES + 1):
            mixed, rows, cross = self.mixed(runs, named)
            if not rows:
                break
            if cross > CHEAP * rows and wave == WAVES:
                spans = self.blocks(*self.groups(mixed)).where("to is not null")
                more = put(spans.select(F.least("fp", "to").alias("a"), F.greatest("fp", "to").alias("b")).distinct(), "spans")
                named = self.renamed(named, more)  # edges span components and need not be links
                break
            last = cross <= CHEAP * rows
            more = self.met(mixed, wave, last).join(tried, ["a", "b"], "left_anti")
            more = put(more, "met")
            if not more.isEmpty():
                tried = tried.union(more)
                more = self.verified(more)
                links, named = links.union(more), self.renamed(named, more)
            if last:
                break
        self.links, self.named = links, named

    def groups(self, mixed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(members (grp, fp), sizes (grp, k, grams)) of groups that hold the rows of each run together: the runs themselves,
        or what runs with common rows join to, whichever has fewer pairs. Runs of one passage have much the same rows."""
        put = self.scratch.put
        runs = put(mixed.select(F.col("token").alias("grp"), "fp").distinct(), "run-members")
        first = runs.groupBy("grp").agg(F.min("fp").alias("a"))
        edges = runs.join(first, "grp").where("a <> fp").select("a", F.col("fp").alias("b"))
        joined = pointer_rounds(self.spark, self.scratch, edges).select(F.col("component").alias("grp"), F.col("id").alias("fp"))
        best = None
        for members in (runs, joined):
            sizes = members.join(self.classes.select("fp", "n"), "fp").groupBy("grp")
            sizes = put(sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("grams")), "run-sizes")
            pairs = sizes.agg(F.sum(F.col("k").cast("double") * F.col("k"))).first()[0] or 0.0
            if best is None or pairs < best[0]:
                best = pairs, members, sizes
        return best[1], best[2]

    def mixed(self, runs: DataFrame, named: DataFrame) -> tuple[DataFrame, int, int]:
        """(rows of runs with several components, their number, the number of pairs across the largest one)."""
        rows = runs.join(named, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        rows = self.scratch.put(rows, "run-rows")
        sizes = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
        stats = sizes.groupBy("token").agg(
            F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows")
        )
        stats = stats.where("k > 1").select(
            "token",
            F.col("top.component").alias("most"),
            "rows",
            (F.col("rows") * (F.col("rows") - F.col("top.n"))).alias("cross"),
            F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("rows") / MEET)))).cast("long").alias("buckets"),
        )
        stats = self.scratch.put(stats, "mixed")
        n, cross = stats.agg(F.sum("rows"), F.sum("cross")).first()
        return rows.join(stats.drop("rows", "cross"), "token"), n or 0, cross or 0

    def met(self, mixed: DataFrame, wave: int, last: bool) -> DataFrame:
        """Pairs (a, b) of different components that meet in a run: some by chance, or, at ``last``, all."""
        percent = self.percent
        if not last:  # one run of each row: that of least hash, which like rows have in common
            one = F.struct(F.xxhash64("token", F.lit(wave)).alias("h"), "token", "size", "component", "most", "buckets")
            mixed = mixed.groupBy("fp").agg(F.min(one).alias("r")).select("fp", "r.token", "r.size", "r.component", "r.most", "r.buckets")
        mixed = mixed.withColumn("bucket", F.pmod(F.xxhash64("fp", F.lit(wave)), "buckets") if not last else F.lit(0).cast("long"))
        mixed = self.scratch.put(mixed.drop("buckets"), "mixed-rows")
        other = mixed.where("component <> most") if last else mixed
        other = other.select(
            "token", "bucket", F.col("fp").alias("f2"), F.col("size").alias("s2"), F.col("component").alias("c2")
        )
        n1, n2 = F.shiftright("size", 32), F.shiftright("s2", 32)
        rest = F.least(n1 - F.col("size").bitwiseAND(0xFFFFFFFF), n2 - F.col("s2").bitwiseAND(0xFFFFFFFF))
        can = (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * rest >= percent * (n1 + n2))
        out = mixed.join(other, ["token", "bucket"]).where((F.col("component") != F.col("c2")) & can)
        if not last:
            out = out.where("fp < f2")
        return out.select(F.least("fp", "f2").alias("a"), F.greatest("fp", "f2").alias("b")).distinct()

    def counted(self) -> DataFrame:
        """``fp, rep, component, n_links`` of every class."""
        put = self.scratch.put
        self.links = put(self.links.distinct(), "all-links")
        classes = self.classes.join(self.named, "fp", "left")
        classes = put(classes.select("fp", "rep", "n", "size", F.coalesce("component", "fp").alias("component")), "linked")
        per = classes.groupBy("component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("grams")).where("k > 1")
        held = self.links.join(classes.select(F.col("fp").alias("a"), "component"), "a").groupBy("component").agg(F.count(F.lit(1)).alias("m"))
        some = per.join(held, "component", "left").where("2 * coalesce(m, 0) < k * (k - 1)").select(F.col("component").alias("grp"), "k", "grams")
        some = put(some, "open")
        ends = self.links.select(F.col("a").alias("fp"), F.col("b").alias("other")).union(self.links.select("b", "a"))
        ends = ends.join(classes.select("fp", "component"), "fp")
        ends = ends.join(some.select(F.col("grp").alias("component")), "component", "left_anti")
        ends = ends.join(classes.select(F.col("fp").alias("other"), "size"), "other")
        degree = ends.groupBy("fp").agg(F.sum("size").alias("links"))
        if not some.isEmpty():
            members = classes.select(F.col("component").alias("grp"), "fp").join(some.select("grp"), "grp")
            found = self.blocks(members, some).where("to is null")
            degree = degree.union(found.groupBy("fp").agg(F.sum("links").alias("links")))
        classes = classes.join(degree, "fp", "left").withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("size") - 1)
        return put(classes.select("fp", "rep", "component", "n_links"), "counted")


def jaccard_rows(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80, links: bool = True) -> DataFrame:
    """``doc_id, text_key, n_shingles, component, component_id, n_links`` of every row of ``docs (doc_id, text)``.

    As ``jaccard_components``; ``doc_id`` and ``text_key``, the hash of the text, tell rows of one id apart.
    ``component`` names the component by a set's fingerprint, whoever shares its ids, and is null without a set.
    Without ``links`` links are not counted, and there is no column ``n_links``.
    """
    join = Join(spark, docs, width, percent)
    join.survey()
    join.link()
    if not links:
        named = join.info.join(join.named, "fp", "left")
        out = named.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("component", "fp").alias("component"))
        out = join.scratch.put(out, "rows")
        join.scratch.keep(out)
        return out
    classes = join.counted()
    names = classes.groupBy("component").agg(F.min("rep").alias("name"))
    classes = join.scratch.put(classes.join(names, "component").select("fp", "component", "name", "n_links"), "named")
    join.scratch.keep(join.made, classes)
    return join.info.join(classes, "fp", "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        "component",
        F.coalesce("name", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def jaccard_components(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``docs (doc_id, text)``.

    Two rows link if 100 * common >= percent * all of their shingle sets. ``n_links`` counts the
    other rows that a row links with, exact copies and near ones. A null or empty text, or one of blanks, has no set and links with nothing. A row of null doc_id links like
    others but lends no id; its component_id is null if all its component's ids are. Repeated rows are copies.
    Rows of one id and different texts are judged each by its text; components of equal smallest id then bear
    the same component_id. An empty table gives an empty table; other columns are ignored.
    """
    return jaccard_rows(spark, docs, width, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 4-word shingles at 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(spark, docs, width=4, percent=85)
