"""Repeated strings of a fixed length, by a depth-limited most-significant-digit radix sort of suffixes.

A full suffix sort orders suffixes to any depth; here only the first ``window`` symbols count, and suffixes that
turn out to be alone leave the sort after the pass that shows it. Symbols are a text's bytes, or its words, each a
64-bit hash; both kinds go through the passes together. Each pass looks at a longer digit:

1. Content picks the suffixes of the first pass: in every window the ``seed``-symbol string of least hash. Equal
   windows pick the same place, so two equal windows always meet. The first digit is that string.
2. The second digit is all that windows around the pick can cover, ``window - seed`` symbols before it to
   ``window`` after, clipped to the text. If it occurs again, every window around the pick is repeated. A suffix
   whose first digit occurs once, or only with repeated second digits, leaves. Picks are shuffled once, by first digit,
   and sorted: both digits' repeats are told from the rows before and after, at any size by the same plan.
3. What is left lies near the edges of repeats. Of each first digit, the distinct second digits send their
   symbols to one place and are refined to the full depth by ranges of a window's place around the pick. What all
   windows of a range have in common is its core, what they cover together its hull. A core that occurs once ends
   a range: none of its windows is repeated. A hull that occurs again ends it, too: all are. Other ranges are cut
   in ``FAN`` parts each, down to single windows.
4. First digits with more than ``GROUP`` distinct second digits would make such a place large. Theirs take the same
   steps as passes over all texts: ranges are shuffled by core and sorted, and no task holds a first digit's rows.

Positions that a repeated window covers are removed. Texts are dealt once, bucketed by row; lists of places come
to them. A very frequent digit or core passes one task as a sorted stream; the largest thing a task holds is one text, or
one group of bounded size. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
import itertools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held, lean, raw_texts, release
from .shingles import WordHashes, mix

WINDOW = 400
#: A passage of this many words that occurs again is a repeat.
PASSAGE_WORDS = 51
#: Distinct second digits that may meet in one task, and bytes of contexts that are refined at once.
GROUP, SLICE = 1000, 1 << 20
#: Parts into which a range of places is cut.
FAN = 8
BLOCK = 1 << 19
YIELD_BYTES = 4 << 20

_B = np.uint64(0x5851F42D4C957F2D)
_B_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Kind(NamedTuple):
    """What is compared: windows of so many bytes or words, and the length of the first digit."""

    words: bool
    window: int
    seed: int


def kinds(window: int | None, words: int | None) -> tuple[Kind, ...]:
    made = [Kind(w, n, max(1, n // 2)) for w, n in ((False, window), (True, words)) if n]
    return tuple(made)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed; ``words`` caches word hashes."""

    def __init__(self):
        self.up, self.down, self.words = np.ones(1, np.uint64), np.ones(1, np.uint64), WordHashes()

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
                for b in (_B, _B_INVERSE)
            )
        return self.up[:n], self.down[:n]


def prefix_sums(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(S, inverse powers): the hash of b[i:j] is (S[j] - S[i]) * inverse[i]."""
    up, down = held("suffixes", Powers).get(len(b) + 1)
    sums = np.empty(len(b) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_TABLE[b] if b.dtype == np.uint8 else b) * up[:-1], out=sums[1:])
    return sums, down


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best of each ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def picks(b: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, first digits, second digits) of the picked suffixes of one text."""
    if len(b) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    parts = []
    side = 3 * window
    for start in range(0, len(b), BLOCK):
        low, high = max(0, start - side), min(len(b), start + BLOCK + side)
        block = b[low:high]
        if len(block) < window:
            continue
        sums, down = prefix_sums(block)
        h = mix((sums[seed:] - sums[:-seed]) * down[: len(block) - seed + 1])
        reach = window - seed + 1
        least = sliding(h, reach, np.minimum)
        pad = np.zeros(reach - 1, np.uint64)
        most = sliding(np.concatenate([pad, least, pad]), reach, np.maximum)
        at = np.flatnonzero(most == h)
        at = at[(at + low >= start) & (at + low < start + BLOCK)]
        left, right = np.maximum(at - (window - seed), 0), np.minimum(at + window, len(block))
        shape = ((at - left) * (4 * window) + (right - at)).astype(np.uint64)
        span = mix((sums[right] - sums[left]) * down[left] + mix(shape))
        parts.append((at + low, h[at], span))
    return tuple(np.concatenate(p) for p in zip(*parts))


def distinct(seed: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first occurrence, class of each, count of each class) of equal (first, second) digits."""
    _, first, inverse, count = np.unique(seed ^ mix(span), return_index=True, return_inverse=True, return_counts=True)
    return first, inverse, count


def symbols(b: np.ndarray, words: bool) -> np.ndarray:
    """A text's bytes, or the hashes of its words: runs of bytes other than blank and \\t to \\r."""
    if not words:
        return b
    found = b.tobytes().split()
    return np.fromiter(map(held("suffixes", Powers).words.__getitem__, found), np.uint64, len(found))


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


_PICK_SQL = "words boolean, seed long, span long, uid long, pos int, m int"


def survey(plan: tuple[Kind, ...]):
    """Texts (uid, text) -> one row for each distinct second digit of a text; ``m`` counts its places."""

    def made(out):
        words, seed, span, uid, pos, m = (np.concatenate(o) for o in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(words), longs(seed), longs(span), pa.array(uid), pa.array(pos, pa.int32()), pa.array(m, pa.int32())],
            ["words", "seed", "span", "uid", "pos", "m"],
        )

    def step(batches):
        out, size = [], 0
        for batch in batches:
            for uid, b in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                for words, window, seed in plan:
                    if len(b) < (2 * window - 1 if words else window):
                        continue
                    at, h, span = picks(symbols(b, words), window, seed)
                    if not len(at):
                        continue
                    first, _, count = distinct(h, span)
                    n = len(first)
                    out.append((np.full(n, words), h[first], span[first], np.full(n, uid), at[first], count))
                    size += 40 * n
                if size > YIELD_BYTES:
                    yield made(out)
                    out, size = [], 0
        if out:
            yield made(out)

    return lean(step)


def ordered(batches, key: str, most: int = 1 << 16):
    """Batches sorted by ``key`` -> (row before, rows, row after). Rows of equal key come together, up to ``most`` of them."""
    before = rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None and batch.num_rows:
            rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if rest is None:
            continue
        n = cut = rest.num_rows
        if batch is not None:
            keys = rest.column(key).to_numpy()
            start = int(np.searchsorted(keys, keys[-1]))
            cut = start if n - start < most else n - 1
        if cut:
            yield before, rest.slice(0, cut), rest.slice(cut, 1)
            before, rest = rest.slice(cut - 1, 1), rest.slice(cut) if cut < n else None


def equal(before, rows, after, column: str) -> np.ndarray:
    """Of each row and the one after the last: is its value that of the row before it? Nulls equal nothing."""
    parts = [x.column(column) for x in (before, rows, after) if x is not None and x.num_rows]
    x = pa.chunked_array(parts)
    valid, x = x.is_valid().to_numpy(), x.fill_null(0).to_numpy()
    same = (x[1:] == x[:-1]) & valid[1:] & valid[:-1]
    ends = [np.zeros(int(before is None), bool), same, np.zeros(int(not after.num_rows), bool)]
    return np.concatenate(ends)


_MET_SQL = "words boolean, uid long, pos int, c long, seed long"


def meet(batches):
    """Picks sorted by first and second digit -> those whose first digit occurs again; ``c`` is 1 if the second digit
    does not, else 2. ``seed`` is given in one row for each second digit of a first digit that has several.

    A row is decided by those before and after it, so a digit that is very frequent takes no more memory than others.
    """
    first = False  # was the second digit of the row before the first one of its first digit
    for before, rows, after in ordered(batches, "seed", 1):
        seed = equal(before, rows, after, "seed")
        span = seed & equal(before, rows, after, "span")
        start = np.maximum.accumulate(np.where(span[:-1], -1, np.arange(rows.num_rows)))
        firsts = np.where(start < 0, first, ~seed[start])
        first = firsts[-1]
        again = (rows.column("m").to_numpy() > 1) | span[:-1] | span[1:]
        one = np.where(firsts, seed[1:] & ~span[1:], ~span[:-1])
        at = np.flatnonzero(again | seed[:-1] | seed[1:])
        out = rows.take(pa.array(at))
        seeds = pa.array(out.column("seed").to_numpy(), pa.int64(), mask=~one[at])
        yield pa.RecordBatch.from_arrays(
            [*(out.column(x) for x in ("words", "uid", "pos")), pa.array(np.where(again[at], 2, 1), pa.int64()), seeds],
            ["words", "uid", "pos", "c", "seed"],
        )


_CONTEXT = pa.schema(
    [("words", pa.bool_()), ("seed", pa.int64()), ("uid", pa.int64()), ("pos", pa.int32()), ("c", pa.int64()), ("left", pa.int32()), ("bytes", pa.binary())]
)
_CONTEXT_SQL = "words boolean, seed long, uid long, pos int, c long, left int, bytes binary"


def contexts(plan: tuple[Kind, ...]):
    """(uid, text, places) -> rows with the symbols around each place."""
    by = {k.words: k for k in plan}

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CONTEXT)], schema=_CONTEXT)

    def step(batches):
        rows, size = [], 0
        for batch in batches:
            places = batch.column(2)
            at, flat = places.offsets.to_numpy(), places.values
            cols = [flat.field(f).to_numpy(zero_copy_only=False) for f in ("words", "pos", "seed", "c")]
            for k, (uid, b) in enumerate(zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)))):
                part = [c[at[k] : at[k + 1]] for c in cols]
                both = {w: symbols(b, w) for w in np.unique(part[0]).tolist()}
                for words, pos, first, c in zip(*(p.tolist() for p in part)):
                    kind = by[words]
                    low = max(0, pos - (kind.window - kind.seed))
                    raw = both[words][low : pos + kind.window].tobytes()
                    rows.append((words, first, uid, pos, c, pos - low, raw))
                    size += len(raw) + 40
                    if size > YIELD_BYTES:
                        yield made(rows)
                        rows, size = [], 0
        if rows:
            yield made(rows)

    return lean(step)


class Contexts:
    """Contexts of one kind: their columns, all symbols in a row, and where each begins."""

    def __init__(self, batch: pa.RecordBatch, words: bool):
        batch = batch.filter(pc.equal(batch.column("words"), words))
        self.seed, self.uid, self.pos, self.c, self.left = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "uid", "pos", "c", "left")
        )
        parts = raw_texts(batch.column("bytes"))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        self.flat = flat.view(np.uint64) if words else flat
        self.size = np.array([len(p) for p in parts], np.int64) // self.flat.itemsize
        self.base = np.cumsum(self.size) - self.size
        self.sums, self.down = prefix_sums(self.flat)

    def spans(self, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hashes of ``length`` symbols from ``start`` within contexts ``row``."""
        i = self.base[row] + start
        return mix((self.sums[i + length] - self.sums[i]) * self.down[i])


class Ranges(NamedTuple):
    """Ranges of the pick's place d in a window, d0 to d1, of some contexts."""

    row: np.ndarray
    d0: np.ndarray
    d1: np.ndarray

    def of(self, keep: np.ndarray) -> Ranges:
        return Ranges(*(x[keep] for x in self))


def cut(ranges: Ranges, rows: Contexts, kind: Kind) -> Ranges:
    """The ``FAN`` parts of each range, as far as a window of the context lies in them."""
    n = ranges.d1 - ranges.d0 + 1
    width = np.maximum(-(-n // FAN), 1)
    parts = -(-n // width)
    of = np.repeat(np.arange(len(n)), parts)
    d0 = ranges.d0[of] + (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * width[of]
    out = Ranges(ranges.row[of], d0, np.minimum(ranges.d1[of], d0 + width[of] - 1))
    low, high = places(rows, kind)
    return out.of((out.d0 <= high[out.row]) & (out.d1 >= low[out.row]))


def places(rows: Contexts, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest place of the pick in a window that lies in the context."""
    return np.maximum(kind.window - (rows.size - rows.left), 0), np.minimum(rows.left, kind.window - kind.seed)


def whole(rows: Contexts, kind: Kind) -> Ranges:
    row = np.arange(len(rows.size))
    return Ranges(row, np.zeros_like(row), np.full_like(row, kind.window - kind.seed))


def digits(ranges: Ranges, rows: Contexts, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key of the core, key of the hull, is the hull in the context) of each range, with first digit and range in it."""
    row, d0, d1 = ranges
    tag = mix(rows.seed[row].view(np.uint64) + mix((d0 * (2 * kind.window) + d1).astype(np.uint64)))
    core = mix(rows.spans(row, rows.left[row] - d0, kind.window - (d1 - d0)) + tag)
    low, high = places(rows, kind)
    inside = (d0 >= low[row]) & (d1 <= high[row])
    hull = np.zeros(len(row), np.uint64)
    at = np.flatnonzero(inside)
    hull[at] = mix(rows.spans(row[at], rows.left[row[at]] - d1[at], (kind.window + d1 - d0)[at]) + tag[at] + np.uint64(1))
    return core, hull, inside


def slices(batches, group: str | None, symbols_at_once: int = SLICE):
    """Batches cut into pieces of bounded size; rows of equal ``group``, which come sorted, stay together."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()
            batch = batch[0] if batch else rest
        if not batch.num_rows:
            continue
        if group is None:
            cuts = np.arange(batch.num_rows + 1)
        else:
            g = batch.column(group).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
        sizes = pc.binary_length(batch.column("bytes")).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes)])
        start = 0
        for a, b in zip(cuts, cuts[1:]):
            if b > start and total[b] - total[start] >= symbols_at_once:
                yield batch.slice(start, b - start)
                start = int(b)
        rest = batch.slice(start) if start < batch.num_rows else None
    if rest is not None and rest.num_rows:
        yield rest


_COVER_SQL = "words boolean, uid long, a int, b int"


def cover(words: bool, uid, start, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(uid), words)), pa.array(uid, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
        ["words", "uid", "a", "b"],
    )


def counted(key: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The sum of the weights of all rows of equal key, for each row."""
    _, inverse = np.unique(key, return_inverse=True)
    return np.bincount(inverse, weights=weight)[inverse] if len(key) else np.zeros(0)


def merged(uid: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of texts with those that touch or overlap joined."""
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order], end[order]
    text = np.cumsum(np.concatenate([[0], uid[1:] != uid[:-1]])) << 32  # keeps texts apart on one line
    reach = np.maximum.accumulate(end + text)
    first = np.flatnonzero(np.concatenate([[True], (start + text)[1:] > reach[:-1]]))
    last = np.concatenate([first[1:], [len(uid)]]) - 1
    return uid[first], start[first], reach[last] - text[last]


def refine(plan: tuple[Kind, ...]):
    """Contexts sorted by first digit -> intervals that repeated windows cover."""

    def work(batch, kind: Kind):
        rows = Contexts(batch, kind.words)
        ranges, hits = whole(rows, kind), []
        while len(ranges.row):
            ranges = cut(ranges, rows, kind)
            core, hull, inside = digits(ranges, rows, kind)
            weight = np.minimum(rows.c, 2)[ranges.row]
            again = counted(core, weight) > 1
            ranges, core, hull, inside, weight = ranges.of(again), core[again], hull[again], inside[again], weight[again]
            found = inside.copy()
            found[inside] = counted(hull[inside], weight[inside]) > 1
            single = weight == 1  # of the others all is known: they are partners only
            row, d0, d1 = ranges.of(found & single)
            hits.append((rows.uid[row], (rows.pos[row] - d1).astype(np.int64), (rows.pos[row] - d0 + kind.window).astype(np.int64)))
            open_ = single & ~found & (ranges.d1 > ranges.d0)
            ranges = ranges.of((counted(core, open_) > 0) & (ranges.d1 > ranges.d0))
        found = [np.concatenate(x) for x in zip(*hits)] if hits else [[]]
        return cover(kind.words, *merged(*found)) if len(found[0]) else None

    def step(batches):
        for part in slices(batches, "seed"):
            for kind in plan:
                if (made := work(part, kind)) is not None:
                    yield made

    return lean(step)


_RANGE_SQL = "words boolean, uid long, pos int, c long, d0 int, d1 int, core long, hull long"


def range_digits(plan: tuple[Kind, ...]):
    """Contexts, with ``ranges`` after the first pass -> the digits of the parts of their ranges."""

    def step(batches):
        for part in slices(batches, None):
            for kind in plan:
                rows = Contexts(part, kind.words)
                ranges = whole(rows, kind)
                if "ranges" in part.schema.names:
                    lists = part.filter(pc.equal(part.column("words"), kind.words)).column("ranges")
                    of = pc.list_parent_indices(lists).to_numpy()
                    flat = pc.list_flatten(lists)
                    ranges = Ranges(of, *(flat.field(f).to_numpy().astype(np.int64) for f in ("d0", "d1")))
                if not len(ranges.row):
                    continue
                ranges = cut(ranges, rows, kind)
                core, hull, inside = digits(ranges, rows, kind)
                row = ranges.row
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), kind.words)), pa.array(rows.uid[row]), pa.array(rows.pos[row], pa.int32()),
                        pa.array(rows.c[row]), pa.array(ranges.d0, pa.int32()), pa.array(ranges.d1, pa.int32()),
                        longs(core), pa.array(hull.view(np.int64), mask=~inside | (ranges.d0 == ranges.d1)),
                    ],
                    ["words", "uid", "pos", "c", "d0", "d1", "core", "hull"],
                )

    return lean(step)


_SETTLED_SQL = "words boolean, uid long, pos int, c long, d0 int, d1 int, hit boolean, open boolean"


def settle(batches):
    """Digits of ranges sorted by core and hull -> ranges that are found (``hit``) and those to be cut further (``open``):
    all of a core that holds one undecided range; ``c`` is 1 for the undecided ones, 2 for their partners.

    Equal hulls have equal cores, so both are told from the rows before and after. Of cores of more rows than come
    at once, what is found stays as a partner, needed or not.
    """
    for before, rows, after in ordered(batches, "core"):
        core, hull = (equal(before, rows, after, x) for x in ("core", "hull"))
        n = rows.num_rows
        c, d0, d1 = (rows.column(x).to_numpy() for x in ("c", "d0", "d1"))
        shared = core[:-1] | core[1:]
        again = np.where(d0 == d1, shared, core[:-1] & hull[:-1] | core[1:] & hull[1:])  # a window is its own core
        hit, undecided = (c == 1) & again, (c == 1) & ~again & shared & (d1 > d0)
        run = np.cumsum(~core[:-1]) - (not core[0])
        wanted = np.bincount(run, weights=undecided, minlength=run[-1] + 1) > 0
        wanted[0] |= core[0]
        wanted[-1] |= core[n]
        open_ = shared & (d1 > d0) & wanted[run]
        at = np.flatnonzero(hit | open_)
        out = rows.take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [*(out.column(x) for x in ("words", "uid", "pos")), pa.array(np.where(undecided[at], 1, 2), pa.int64()),
             out.column("d0"), out.column("d1"), pa.array(hit[at]), pa.array(open_[at])],
            ["words", "uid", "pos", "c", "d0", "d1", "hit", "open"],
        )


def large_groups(scratch: Scratch, sent: DataFrame, plan: tuple[Kind, ...], kept: list[DataFrame]) -> DataFrame:
    """Intervals of the contexts ``sent``: the steps of ``refine`` as passes, each of which shuffles its ranges once, by
    core. No task holds a first digit's rows.

    A window is at most ``FAN ** passes`` places wide, so the number of passes is fixed. Tables but ``kept`` go meanwhile.
    """
    window = F.element_at(F.create_map(*[x for k in plan for x in (F.lit(k.words), F.lit(k.window))]), F.col("words"))
    sent = scratch.put(sent, "large")
    part, found = sent, []
    while True:
        made = part.mapInArrow(range_digits(plan), _RANGE_SQL).repartition("core").sortWithinPartitions("core", "hull")
        made = scratch.put(made.mapInArrow(lean(settle), _SETTLED_SQL), "ranges")
        hit = made.where("hit")
        hit = hit.select("words", "uid", (F.col("pos") - F.col("d1")).alias("a"), (F.col("pos") - F.col("d0") + window).alias("b"))
        found.append(scratch.put(hit, "hits"))
        scratch.keep(*kept, sent, made, *found)
        left = made.where("open")
        if left.isEmpty():
            break
        # what is known of a context apart from what isn't, dealt as the join needs it; a window's places at most
        left = left.repartition("words", "uid", "pos").groupBy("words", "uid", "pos", "c")
        left = left.agg(F.collect_set(F.struct("d0", "d1")).alias("ranges"))
        part = sent.drop("c").join(left, ["words", "uid", "pos"]).select(*_CONTEXT.names, "ranges")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def repeated(spark: SparkSession, docs: DataFrame, window: int | None = WINDOW, words: int | None = None, group: int = GROUP) -> DataFrame:
    """``docs`` with ``_uid`` and lists of what repeats in each: ``_resolved`` (first places of repeated second digits)
    and ``_found`` (intervals), by bytes and by words. Internal form; ``digest`` and ``strip_repeats`` read it.
    """
    plan, scratch = kinds(window, words), Scratch(spark, "suffixes")
    # the partition keeps one document that is repeated very often from meeting in one bucket
    texts = docs.withColumn("_uid", F.xxhash64(F.spark_partition_id(), "doc_id", "text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = scratch.buckets(size)
    texts = scratch.deal(texts, "_uid", size, "texts")
    rows = texts.select("_uid", "text").mapInArrow(survey(plan), _PICK_SQL)
    # in as many parts as there are buckets: what a task sorts doesn't grow with the input
    rows = rows.repartition(buckets, "seed").sortWithinPartitions("seed", "span")
    met = scratch.put(rows.mapInArrow(lean(meet), _MET_SQL), "met")
    release(spark)
    second = met.where("seed is not null")
    first = second.groupBy("seed").agg(F.min("c").alias("least"), F.count(F.lit(1)).alias("k"))
    first = scratch.put(first.where("least = 1").select("seed", "k"), "open")
    place = second.join(first, "seed").select(
        F.col("uid").alias("_uid"), F.struct("words", "pos", "seed", "c").alias("p"), "k"
    )
    place = scratch.put(place, "places")
    release(spark)

    def sent(part: DataFrame) -> DataFrame:
        lists = part.repartition(buckets, "_uid").groupBy("_uid").agg(F.collect_list("p").alias("places")).hint("shuffle_hash")
        # rows that repeat a document within a partition share its uid; whatever they send twice counts once below
        found = texts.select("_uid", "text").join(lists, "_uid").select("_uid", "text", "places")
        return found.mapInArrow(contexts(plan), _CONTEXT_SQL)

    small = sent(place.where(F.col("k") <= group)).repartition("seed").sortWithinPartitions("seed", "uid", "pos")
    found = scratch.put(small.mapInArrow(refine(plan), _COVER_SQL), "cover")
    scratch.keep(texts, met, place, found)
    large = place.where(F.col("k") > group)
    if not large.isEmpty():
        found = found.union(large_groups(scratch, sent(large), plan, [texts, met, place, found]))
    done = met.where("c > 1").select("words", "uid", F.col("pos").alias("a"), F.lit(None).cast("int").alias("b"))
    parts = done.union(found).withColumnRenamed("uid", "_uid").repartition(buckets, "_uid")  # to the buckets of the texts
    whole, piece = F.col("b").isNull(), F.struct("a", "b")
    lists = parts.groupBy("_uid").agg(
        F.collect_list(F.when(whole & ~F.col("words"), F.col("a"))).alias("_resolved"),
        F.collect_list(F.when(~whole & ~F.col("words"), piece)).alias("_found"),
        F.collect_list(F.when(whole & F.col("words"), F.col("a"))).alias("_w_resolved"),
        F.collect_list(F.when(~whole & F.col("words"), piece)).alias("_w_found"),
    )
    return texts.join(lists.hint("shuffle_hash"), "_uid", "left")


def removed_mask(b: np.ndarray, resolved, found, kind: Kind) -> np.ndarray:
    """Symbols of one text that repeated windows cover."""
    edge = np.zeros(len(b) + 1, np.int64)
    if resolved is not None and len(resolved):
        at, h, span = picks(b, kind.window, kind.seed)
        _, group, _ = distinct(h, span)
        wanted = np.isin(at, np.asarray(resolved))
        at = at[np.isin(group, group[wanted])]
        np.add.at(edge, np.maximum(at - (kind.window - kind.seed), 0), 1)
        np.add.at(edge, np.minimum(at + kind.window, len(b)), -1)
    for f in found or ():
        edge[f["a"]] += 1
        edge[f["b"]] -= 1
    return np.cumsum(edge[:-1]) > 0


def word_bytes(b: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Bytes of one text from the first to the last word of each run of words in ``mask``."""
    blank = np.concatenate([[True], (b == 32) | ((b >= 9) & (b <= 13)), [True]])
    starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    edge = np.zeros(len(b) + 1, np.int64)
    edge[starts[np.flatnonzero(step == 1)]] += 1
    edge[ends[np.flatnonzero(step == -1) - 1]] -= 1
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> int:
    return int(np.count_nonzero(np.diff(np.concatenate([[0], mask.astype(np.int8)])) == 1))


LISTS = ["_resolved", "_found", "_w_resolved", "_w_found"]


def masks(batch: pa.RecordBatch, plan: tuple[Kind, ...]):
    """(bytes, mask of symbols or None for each kind) of each text; None where nothing of it repeats."""
    lists = [batch.column(batch.schema.get_field_index(c)) for c in LISTS]
    for k, b in enumerate(raw_texts(batch.column(batch.schema.get_field_index("text")))):
        own = [x[k].as_py() for x in lists]
        out = {}
        for kind in plan:
            resolved, found = own[2:] if kind.words else own[:2]
            out[kind.words] = removed_mask(symbols(b, kind.words), resolved, found, kind) if resolved or found else None
        yield b, out.get(False), out.get(True)


def digest(found: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, n_passages`` of what ``repeated`` found.

    ``n_passages`` counts the maximal runs of words that repeated passages of ``words`` words cover; they are reported
    only, bytes go by ``window``. It is null without ``words``.
    """
    plan = kinds(window, words)

    def step(batches):
        for batch in batches:
            out = []
            for b, gone, passages in masks(batch, plan):
                kept = b if gone is None else b[~gone]
                n_spans = 0 if gone is None else runs(gone)
                n_passages = None if words is None else 0 if passages is None else runs(passages)
                out.append((len(b), len(b) - len(kept), n_spans, hashlib.sha256(kept.tobytes()).hexdigest(), len(kept), n_passages))
            cols = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "n_passages"],
            )

    return found.select("doc_id", "text", *LISTS).mapInArrow(
        lean(step), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, n_passages long"
    )


def strip_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """``docs`` with every byte removed from ``text`` that a repeated ``window``-byte string covers, or, if ``words``
    is given, a repeated passage of that many words, whatever blanks are between them.

    All occurrences go, the first included; texts are judged as they come in. Bytes of a character that was
    cut in two go with it. A null text stays null, a text shorter than the window as it is. Repeated rows are
    repeats of each other. Rows and columns stay, whatever the columns' names; an empty table gives an empty table.
    """
    own, plan = docs.columns, kinds(window, words)
    safe = docs.toDF(*[c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(own)])
    found = repeated(spark, safe, window, words).select(*safe.columns, *LISTS)
    schema, at = safe.schema, safe.columns.index("text")

    def step(batches):
        for batch in batches:
            column, texts = batch.column(at), []
            for k, (b, gone, passages) in enumerate(masks(batch, plan)):
                if gone is None and passages is None:
                    texts.append(column[k].as_py())
                    continue
                gone = np.zeros(len(b), bool) if gone is None else gone
                if passages is not None:
                    gone |= word_bytes(b, passages)
                texts.append(b[~gone].tobytes().decode("utf-8", "ignore"))
            cols = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns[: len(own)])]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return found.mapInArrow(lean(step), schema).toDF(*own)


def op8_radix_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 400-byte strings; passages of over 50 words that repeat are reported beside them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(repeated(spark, docs, WINDOW, PASSAGE_WORDS), WINDOW, PASSAGE_WORDS)
