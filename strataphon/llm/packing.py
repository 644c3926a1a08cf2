"""Packing documents into token sequences with bounded-space online best fit.

A document's ids (its tokens, then the end id) are cut only where a full sequence ends: full sequences stand
alone, the rest is one piece. Each partition keeps a fixed number of open windows. A piece goes to the window
that it fills best; if it fits none, the fullest is emitted and a new one opens. When a partition ends, its
open windows are leftovers. Their pieces are dealt to ever fewer partitions and packed again, longest first,
until one bounded task is left, which closes all. No stage holds more than ``open_windows`` windows at once
in the first pass and ``merge_windows`` in the merges, and each merge shrinks the leftovers several times.

Tokens: the vocabulary drops white space and never joins across it, so a text's ids are the ids of its chunks
between ASCII white space, in order. Chunks repeat, so a bounded cache holds their ids.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held, lean, raw_texts

SEQUENCE = 4096
END_ID = 2
OPEN_WINDOWS = 64
MERGE_WINDOWS = 1024
CACHE_CHUNKS, CACHE_BYTES = 400_000, 64
GROUP_TEXTS, GROUP_BYTES = 256, 1 << 21
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "ids binary, open boolean"
)
_FIELDS = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary()), ("open", pa.bool_())]
)


class ChunkIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by chunks between ASCII white space.

    A-Z are lower-cased first, as the vocabulary does, unless a special token could be meant. Closing
    punctuation after a letter or digit never joins its word, so it is looked up on its own. Chunks that are
    new in a group of texts are encoded together. Two generations of at most ``CACHE_CHUNKS`` entries keep
    what is frequent and forget the rest.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk. What is one word of lower-case Latin letters needs neither normalising nor splitting, so
        it goes to the merges at once, byte by byte in the vocabulary's letters."""
        out: list[bytes | None] = []
        rest = []
        for c in chunks:
            text = c.decode("utf-8")
            if len(c) <= CACHE_BYTES and _PLAIN.fullmatch(text):
                letters = c.decode("latin-1").translate(_BYTE_LETTERS)
                out.append(_ids_bytes([t.id for t in self.model.tokenize(letters)]))
            else:
                out.append(None)
                rest.append(text)
        made = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        return [_ids_bytes(next(made).ids) if x is None else x for x in out]

    def learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks that ``young`` doesn't hold; long ones are not kept."""
        if len(self.young) > CACHE_CHUNKS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = {c: old[c] for c in chunks if c in old}
        split, missing = [], set()
        for c in chunks:
            if c in found:
                continue
            core = c.rstrip(_CLOSING)
            tail = c[len(core) :]
            if not core or b"<|" in c or not (core[-1:].isalnum() or core.decode("utf-8")[-1].lower().isalpha()):
                core, tail = c, b""
            split.append((c, core, tail))
            missing.update(x for x in (core, tail) if x and x not in young and x not in old)
        missing = sorted(missing)
        known = dict(zip(missing, self.encode(missing)))
        known[b""] = b""
        look = lambda x: known[x] if x in known else young[x] if x in young else old[x]
        found.update((c, look(core) + look(tail)) for c, core, tail in split)
        young.update((c, ids) for part in (known, found) for c, ids in part.items() if len(c) <= CACHE_BYTES)
        return found

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts. Each chunk is looked up once; what is missing is learnt for the group at once."""
        get, split, found, missing = self.young.get, [], [], set()
        for raw in texts:
            chunks = (raw if b"<|" in raw else raw.lower()).split()
            ids = list(map(get, chunks))
            if None in ids:
                missing.update(c for c, i in zip(chunks, ids) if i is None)
            split.append(chunks)
            found.append(ids)
        learnt = self.learn(missing) if missing else {}
        return [
            b"".join([learnt[c] if i is None else i for c, i in zip(chunks, ids)] if None in ids else ids)
            for chunks, ids in zip(split, found)
        ]


#: Punctuation that ends a chunk in ordinary prose; none of it starts a contraction.
_CLOSING = b".,;:!?"
#: Letters that are their own normal form.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> str:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes are themselves, others follow 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(other)) for b in range(256))


_BYTE_LETTERS = _byte_letters()


def _ids_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def chunk_ids(path: str) -> ChunkIds:
    """One cache for each vocabulary in a Python worker."""
    return held(f"packing {path}", lambda: ChunkIds(path))


def grouped(cache: ChunkIds, texts: pa.Array):
    """The ids of each text, encoded in groups of bounded number and size."""
    group, size = [], 0
    for text in raw_texts(texts):
        group.append(text.tobytes())
        size += len(text)
        if len(group) >= GROUP_TEXTS or size >= GROUP_BYTES:
            yield from cache.texts(group)
            group, size = [], 0
    if group:
        yield from cache.texts(group)


class Packer:
    """Windows of ``size`` ids, at most ``windows`` of them open."""

    def __init__(self, size: int, windows: int, first_id: int):
        self.size, self.windows, self.next_id = size, windows, first_id
        self.free: list[tuple[int, int]] = []  # (free ids, sequence), sorted
        self.held: dict[int, list[list]] = {}
        self.done: list[list] = []

    def place(self, piece: list) -> None:
        """``piece``: [doc_id, start, length, crc, doc_tokens, ids]."""
        length = piece[2]
        if length < self.size:
            at = bisect_left(self.free, (length, -1))
            if at < len(self.free):
                free, seq = self.free.pop(at)
                self.held[seq].append([*piece[:5], seq, self.size - free, piece[5], False])
                if free > length:
                    insort(self.free, (free - length, seq))
                else:
                    self.done += self.held.pop(seq)
                return
            if len(self.free) >= self.windows:
                _, seq = self.free.pop(0)
                self.done += self.held.pop(seq)
        seq, self.next_id = self.next_id, self.next_id + 1
        row = [*piece[:5], seq, 0, piece[5], False]
        if length < self.size:
            self.held[seq] = [row]
            insort(self.free, (self.size - length, seq))
        else:
            self.done.append(row)

    def take(self) -> list[list]:
        out, self.done = self.done, []
        return out

    def close(self, leave_open: bool) -> list[list]:
        out = self.take()
        for rows in self.held.values():
            out += [[*r[:8], leave_open] for r in rows]
        self.free, self.held = [], {}
        return out


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)] if rows else [pa.array([], f.type) for f in _FIELDS],
        schema=_FIELDS,
    )


def _first_id(round_no: int) -> int:
    return (round_no << 56) | (TaskContext.get().partitionId() << 32)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
    merge_windows: int = MERGE_WINDOWS,
    with_ids: bool = True,
) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, ``with_ids``,
    ``ids`` (little-endian unsigned 32-bit bytes).

    A null or empty text has the end id alone; a null or repeated doc_id is packed like any other row. An
    empty table gives no piece. Other columns are ignored. Sequence ids are unique, not gapless.
    """
    scratch = Scratch(spark, "packing")

    def first(batches):
        cache, packer = chunk_ids(tokenizer), Packer(size, open_windows, _first_id(0))
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), grouped(cache, batch.column(1))):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, size):
                    ids = raw[4 * start : 4 * (start + size)]
                    packer.place(
                        [doc_id, start, len(ids) // 4, zlib.crc32(ids), total, ids if with_ids else None]
                    )
                if len(packer.done) > 2000:
                    yield _batch(packer.take())
        yield _batch(packer.close(True))

    def merge(round_no, last):
        def step(batches):
            packer = Packer(size, 1 << 62 if last else merge_windows, _first_id(round_no))
            for batch in batches:
                names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")
                for piece in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                    packer.place(list(piece))
                if packer.done:
                    yield _batch(packer.take())
            yield _batch(packer.close(not last))

        return step

    rows = scratch.put(docs.select("doc_id", "text").mapInArrow(lean(first, keep=True), SCHEMA), "pieces")
    parts, round_no = [rows.where("not open")], 0
    left = rows.where("open")
    while True:
        round_no += 1
        n = left.select("sequence_id").distinct().count()
        if not n:
            break
        tasks = math.ceil(n / (4 * merge_windows))
        dealt = left.repartition(tasks, F.xxhash64("sequence_id", "offset")) if tasks > 1 else left.coalesce(1)
        dealt = dealt.sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
        rows = scratch.put(dealt.mapInArrow(lean(merge(round_no, tasks == 1)), SCHEMA), "merged")
        parts.append(rows.where("not open"))
        left = rows.where("open")
        if tasks == 1:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.drop("open") if with_ids else out.drop("open", "ids")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(spark, docs, default_tokenizer(), with_ids=False)
