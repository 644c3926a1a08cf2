"""Audio files: listing, FLAC metadata blocks, FLAC and WAV samples, content hashes.

Files come through Spark's binaryFile reader, so any store that Spark reads will do. Batches on their way to Python
are bounded by bytes, and a file is taken from its batch one at a time.
"""

from __future__ import annotations

import hashlib
import struct

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded_batches
from . import flac

INFO = (
    "path string, sample_rate int, channels int, bits_per_sample int, total_samples long, duration_sec double, bitrate double, "
    "file_size_bytes long, md5 string, tags map<string,array<string>>, cuesheet string, cue_tracks array<struct<track:int,start:long>>"
)


def list_files(spark: SparkSession, root: str, suffix: str = "flac", limit: int | None = None) -> DataFrame:
    """``path, length, modificationTime`` of all files below ``root``; the suffix in any case. Contents are not read."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    files = files.select("path", "length", "modificationTime")
    return files if limit is None else files.orderBy("path").limit(limit)


def read_files(spark: SparkSession, root: str, suffix: str = "flac") -> DataFrame:
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "length", "content")


def orphans(files: DataFrame, now: Column, hours: float) -> DataFrame:
    """Files older than ``hours``."""
    return files.where(F.col("modificationTime") < now - F.make_dt_interval(secs=F.lit(hours * 3600.0)))


def header_md5(content: Column) -> Column:
    """MD5 of the raw samples as the file's first metadata block has it; null without that block or with zeros there."""
    block = (F.substring(content, 1, 4) == F.lit(b"fLaC")) & (F.hex(F.substring(content, 5, 1)).isin("00", "80"))
    digest = F.lower(F.hex(F.substring(content, 27, 16)))
    return F.when(block & (F.length(content) >= 42) & (digest != "0" * 32), digest)


def flac_blocks(content: bytes):
    """(type, body) of each metadata block; raises on another file type."""
    if content[:4] != b"fLaC":
        raise ValueError("not a FLAC file")
    at, last = 4, False
    while not last and at + 4 <= len(content):
        head = content[at]
        last, size = bool(head & 0x80), int.from_bytes(content[at + 1 : at + 4], "big")
        yield head & 0x7F, content[at + 4 : at + 4 + size]
        at += 4 + size


def vorbis_comments(body: bytes) -> dict[str, list[str]]:
    """Comments by lower-case name, all values kept in order."""
    out: dict[str, list[str]] = {}
    size = struct.unpack_from("<I", body)[0]
    at = 4 + size
    for _ in range(struct.unpack_from("<I", body, at)[0]):
        at += 4
        size = struct.unpack_from("<I", body, at)[0]
        name, mark, value = body[at + 4 : at + 4 + size].decode("utf-8", "replace").partition("=")
        at += size
        if mark:
            out.setdefault(name.lower(), []).append(value)
    return out


def flac_info(content: bytes) -> dict:
    """Stream properties, comments and cue sheet (text comment, else the block's track starts)."""
    out = {"tags": {}, "cuesheet": None, "cue_tracks": []}
    for kind, body in flac_blocks(content):
        if kind == 0:
            bits = int.from_bytes(body[10:18], "big")
            out |= {
                "sample_rate": bits >> 44, "channels": (bits >> 41 & 7) + 1, "bits_per_sample": (bits >> 36 & 31) + 1,
                "total_samples": bits & (1 << 36) - 1, "md5": body[18:34].hex() if any(body[18:34]) else None,
            }
        elif kind == 4:
            out["tags"] = vorbis_comments(body)
            out["cuesheet"] = (out["tags"].get("cuesheet") or [None])[0]
        elif kind == 5:
            at = 396
            for _ in range(body[395]):
                offset, number, points = int.from_bytes(body[at : at + 8], "big"), body[at + 8], body[at + 35]
                first = [body[at + 36 + 12 * k : at + 48 + 12 * k] for k in range(points)]
                start = offset + next((int.from_bytes(p[:8], "big") for p in first if p[8] == 1), 0)
                if 0 < number < 100:
                    out["cue_tracks"].append({"track": number, "start": start})
                at += 36 + 12 * points
    if "sample_rate" not in out:
        raise ValueError("no stream block")
    return out


_INFO_FIELDS = pa.schema(
    [("path", pa.string()), ("sample_rate", pa.int32()), ("channels", pa.int32()), ("bits_per_sample", pa.int32()), ("total_samples", pa.int64()),
     ("duration_sec", pa.float64()), ("bitrate", pa.float64()), ("file_size_bytes", pa.int64()), ("md5", pa.string()),
     ("tags", pa.map_(pa.string(), pa.list_(pa.string()))), ("cuesheet", pa.string()),
     ("cue_tracks", pa.list_(pa.struct([("track", pa.int32()), ("start", pa.int64())])))]
)


def read_flac_info(files: DataFrame) -> DataFrame:
    """Properties of each file of ``files (path, length, content)``; files that don't parse have nulls."""
    bounded_batches(files.sparkSession)

    def step(batches):
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                path, length, content = (c[k].as_py() for c in batch.columns)
                try:
                    info = flac_info(content or b"")
                except (ValueError, IndexError, struct.error):
                    info = {}
                row = {"path": path, "file_size_bytes": length, **info}
                if info.get("sample_rate"):
                    row["duration_sec"] = info["total_samples"] / info["sample_rate"]
                    row["bitrate"] = 8 * length / row["duration_sec"] if row["duration_sec"] else None
                row["tags"] = list(info["tags"].items()) if info else None
                out.append(row)
            cols = [pa.array([r.get(f.name) for r in out], f.type) for f in _INFO_FIELDS]
            yield pa.RecordBatch.from_arrays(cols, schema=_INFO_FIELDS)

    return files.select("path", "length", "content").mapInArrow(step, INFO)


def wav_form(content: bytes) -> tuple[int, int, int, int, int, int]:
    """(format code, channels, rate, bits, first byte, end) of the samples of a PCM or float WAV file, the extensible form
    included."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, None
    while at + 8 <= len(content):
        name, size = content[at : at + 4], struct.unpack_from("<I", content, at + 4)[0]
        if name == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", content, at + 8)
            if code == 0xFFFE and size >= 40:
                code = struct.unpack_from("<H", content, at + 32)[0]
            form = code, channels, rate, bits
        elif name == b"data" and form:
            return *form, at + 8, min(at + 8 + size, len(content))
        at += 8 + size + size % 2
    raise ValueError("no samples")


def wav_samples(content: bytes) -> tuple[int, np.ndarray]:
    """(rate, samples (n, channels) float32) of a WAV file."""
    code, channels, rate, bits, start, end = wav_form(content)
    return rate, pcm_to_float(content[start:end], bits, code == 3, channels)


#: Seconds of a recording that are decoded at once.
BLOCK_SECONDS = 2


def sample_blocks(content: bytes, start: int = 0, end: int | None = None) -> tuple[int, Iterator[tuple[bytes, np.ndarray]]]:
    """(rate, blocks) of a FLAC or WAV file: (raw little-endian sample bytes, float32 samples (n, channels)) from ``start``
    up to ``end``, a few seconds or one frame at once. Raises ValueError on other or damaged files."""
    if content[:4] == b"fLaC":
        _, rate, _, bits, _ = flac.stream(content)

        def made():
            for x in flac.blocks(content, start, end):
                yield flac.pcm(x, bits), (x / float(1 << (bits - 1))).astype(np.float32)

        return rate, made()
    code, channels, rate, bits, first, stop = wav_form(content)
    size = channels * bits // 8

    def cut():
        high = stop if end is None else min(stop, first + end * size)
        for at in range(first + start * size, high, BLOCK_SECONDS * rate * size):
            raw = content[at : min(high, at + BLOCK_SECONDS * rate * size)]
            yield raw, pcm_to_float(raw, bits, code == 3, channels)

    return rate, cut()


def pcm_to_float(raw: bytes, bits: int, is_float: bool, channels: int) -> np.ndarray:
    """Little-endian samples in [-1, 1), one column a channel; a cut last frame is dropped."""
    width = bits // 8
    raw = raw[: len(raw) // (width * channels) * width * channels]
    if is_float:
        x = np.frombuffer(raw, f"<f{width}").astype(np.float32)
    elif bits == 24:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / float(1 << 23)).astype(np.float32)
    elif bits in (16, 32):
        x = (np.frombuffer(raw, f"<i{width}") / float(1 << (bits - 1))).astype(np.float32)
    elif bits == 8:
        x = ((np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128).astype(np.float32)
    else:
        raise ValueError(f"{bits} bits a sample")
    return x.reshape(-1, channels)


def read_slices(files: DataFrame, rate: int = 44_100) -> DataFrame:
    """(path, content[, start, end]) -> ``path, audio_hash, sr, y, error``: a slice's mono waveform at ``rate``.

    FLAC and WAV by their first bytes. The hash is the md5 of the slice's raw sample bytes. A file that can't be decoded
    has an ``error`` and nulls. Decoding goes by blocks; the mono waveform, which the row holds, is the largest thing.
    """
    from ..functions.dsp import polyphase

    bounded_batches(files.sparkSession)
    has_range = {"start", "end"} <= set(files.columns)
    columns = ["path", "content", *(["start", "end"] if has_range else [])]

    def one(content, start=0, end=None):
        sr, parts = sample_blocks(content or b"", start or 0, end)
        digest, mono = hashlib.md5(), []
        for raw, x in parts:
            digest.update(raw)
            mono.append(x.mean(axis=1, dtype=np.float64).astype(np.float32))
        y = np.concatenate(mono) if mono else np.zeros(0, np.float32)
        if sr != rate and len(y):
            g = np.gcd(sr, rate)
            y = polyphase(y.astype(float), rate // g, sr // g).astype(np.float32)
        return digest.hexdigest(), rate, y, None

    def step(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                path, *rest = (c[k].as_py() for c in batch.columns)
                try:
                    made = one(*rest)
                except (ValueError, IndexError, struct.error, ZeroDivisionError) as e:
                    made = None, None, None, str(e) or type(e).__name__
                types = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.float32()), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip((path, *made), types)], ["path", "audio_hash", "sr", "y", "error"]
                )

    return files.select(*columns).mapInArrow(step, "path string, audio_hash string, sr int, y array<float>, error string")


def wav_file(x: np.ndarray, rate: int) -> bytes:
    """A 16-bit WAV file of whole-number samples (n, channels)."""
    data, channels = flac.pcm(x, 16), x.shape[1]
    form = struct.pack("<HHIIHH", 1, channels, rate, rate * channels * 2, channels * 2, 16)
    return b"RIFF" + struct.pack("<I", len(data) + 36) + b"WAVEfmt " + struct.pack("<I", 16) + form + b"data" + struct.pack("<I", len(data)) + data


def audio_files(rows: DataFrame, rate: int = 44_100) -> DataFrame:
    """``rows (path, samples array<int>, comments map<string,string>, kind)`` as mono 16-bit files ``path, length, content``.

    ``kind`` is ``wav`` or names the predictor of a FLAC file: ``verbatim``, ``fixed`` or ``linear``.
    """
    bounded_batches(rows.sparkSession)

    def step(batches):
        for batch in batches:
            paths, contents = batch.column(0), []
            for samples, comments, kind in zip(*(c.to_pylist() for c in batch.columns[1:])):
                x = np.array(samples, np.int64)[:, None]
                contents.append(wav_file(x, rate) if kind == "wav" else flac.encode(x, rate, 16, kind, comments=dict(comments or [])))
            sizes = pa.array([len(c) for c in contents], pa.int64())
            yield pa.RecordBatch.from_arrays([paths, sizes, pa.array(contents, pa.binary())], ["path", "length", "content"])

    return rows.select("path", "samples", "comments", "kind").mapInArrow(step, "path string, length long, content binary")
