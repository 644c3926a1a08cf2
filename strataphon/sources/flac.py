"""FLAC samples in plain Python and numpy, after the published format (RFC 9639), and a plain encoder.

``blocks`` decodes frame by frame, so a slice of a long recording needs the memory of one frame. Within a frame the place
of every Rice code is found by one pass over the ones of the bit stream; their low bits, fixed predictors and
channel decorrelation are vectorised.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from operator import mul

import numpy as np

BLOCK = 4096
WINDOW = 1 << 15
# Fixed values of the format: block sizes and sample sizes by code.
_SIZES = {1: 192, **{k: 576 << (k - 2) for k in range(2, 6)}, **{k: 256 << (k - 8) for k in range(8, 16)}}
_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


class Damaged(ValueError):
    """The stream doesn't follow the format."""


class Bits:
    """The bits of ``data``; reading past the end raises IndexError."""

    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8))
        places = np.where(self.bits == 1, np.arange(len(self.bits)), len(self.bits))
        self.next_one = np.minimum.accumulate(places[::-1])[::-1].tolist()
        self.at = 0

    def take(self, n: int) -> int:
        if self.at + n > len(self.bits):
            raise IndexError
        out = 0
        for b in self.bits[self.at : self.at + n].tolist():
            out = out << 1 | b
        self.at += n
        return out

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (1 << n) if n and x >> (n - 1) else x

    def unary(self) -> int:
        one = self.next_one[self.at]
        if one >= len(self.bits):
            raise IndexError
        n, self.at = one - self.at, one + 1
        return n

    def fields(self, starts: np.ndarray, width: int) -> np.ndarray:
        """Unsigned fields of ``width`` bits at ``starts``."""
        if len(starts) and starts[-1] + width > len(self.bits):
            raise IndexError
        out = np.zeros(len(starts), np.int64)
        for j in range(width):
            out = out << 1 | self.bits[starts + j]
        return out

    def run(self, n: int, width: int) -> np.ndarray:
        """``n`` signed numbers of ``width`` bits in a row."""
        out = self.fields(self.at + width * np.arange(n), width)
        self.at += n * width
        return np.where(out >> (width - 1) == 1, out - (1 << width), out) if width else out

    def rice(self, n: int, k: int) -> np.ndarray:
        ones, at, following, end = [], self.at, self.next_one, len(self.bits)
        for _ in range(n):
            one = following[at]
            if one + k >= end:
                raise IndexError
            ones.append(one)
            at = one + 1 + k
        ones = np.array(ones, np.int64)
        starts = np.concatenate([[self.at], ones[:-1] + 1 + k]) if n else ones
        value = (ones - starts) << k | self.fields(ones + 1, k)
        self.at = at
        return (value >> 1) ^ -(value & 1)


def residual(b: Bits, size: int, order: int) -> np.ndarray:
    method = b.take(2)
    if method > 1:
        raise Damaged("unknown residual coding")
    width = 5 if method else 4
    parts = b.take(4)
    out = []
    for k in range(1 << parts):
        n = (size >> parts) - (order if k == 0 else 0)
        parameter = b.take(width)
        if parameter == (1 << width) - 1:
            bits = b.take(5)
            out.append(b.run(n, bits) if bits else np.zeros(n, np.int64))
        else:
            out.append(b.rice(n, parameter))
    return np.concatenate(out)


def subframe(b: Bits, size: int, bits: int) -> np.ndarray:
    if b.take(1):
        raise Damaged("no subframe")
    kind = b.take(6)
    wasted = b.unary() + 1 if b.take(1) else 0
    bits -= wasted
    if kind == 0:
        out = np.full(size, b.signed(bits), np.int64)
    elif kind == 1:
        out = b.run(size, bits)
    elif 8 <= kind <= 12:
        order = kind - 8
        warm = b.run(order, bits)
        out = residual(b, size, order)
        for level in range(order - 1, -1, -1):  # each sum undoes one difference
            last = np.diff(warm, level)[-1]
            out = last + np.cumsum(out)
        out = np.concatenate([warm, out])
    elif kind >= 32:
        order = kind - 31
        warm = b.run(order, bits)
        precision, shift = b.take(4) + 1, b.signed(5)
        weights = b.run(order, precision)[::-1].tolist()
        samples = warm.tolist()
        for k, r in enumerate(residual(b, size, order).tolist()):
            samples.append(r + (sum(map(mul, weights, samples[k:])) >> shift))
        out = np.array(samples, np.int64)
    else:
        raise Damaged("reserved subframe")
    return out << wasted


def frame(data: bytes, stream_bits: int) -> tuple[np.ndarray, int]:
    """(samples (n, channels), bytes of the frame) of the frame that ``data`` begins with."""
    b = Bits(data)
    if b.take(15) != 0x7FFC:
        raise Damaged("no frame")
    b.take(1)
    size_code, rate_code, channel_code, bits_code = b.take(4), b.take(4), b.take(4), b.take(3)
    b.take(1)
    first = b.take(8)
    for _ in range(max(0, 7 - (first ^ 0xFF).bit_length()) if first >= 0x80 else 0):
        b.take(8)  # the frame's number goes on
    size = _SIZES.get(size_code) or (b.take(8 if size_code == 6 else 16) + 1)
    if rate_code in (12, 13, 14):
        b.take(8 if rate_code == 12 else 16)
    b.take(8)
    bits = _BITS.get(bits_code, stream_bits)
    channels = 2 if channel_code >= 8 else channel_code + 1
    side = {8: 1, 9: 0, 10: 1}.get(channel_code)
    x = [subframe(b, size, bits + (k == side)) for k in range(channels)]
    if channel_code == 8:
        x[1] = x[0] - x[1]
    elif channel_code == 9:
        x[0] = x[0] + x[1]
    elif channel_code == 10:
        mid = x[0] << 1 | x[1] & 1
        x = [(mid + x[1]) >> 1, (mid - x[1]) >> 1]
    return np.stack(x, axis=1), (b.at + 7) // 8 + 2


def stream(content: bytes) -> tuple[int, int, int, int, int]:
    """(first byte of the frames, rate, channels, bits a sample, samples)."""
    if content[:4] != b"fLaC":
        raise Damaged("not a FLAC file")
    at, last, found = 4, False, None
    while not last:
        last, kind, size = content[at] >> 7, content[at] & 0x7F, int.from_bytes(content[at + 1 : at + 4], "big")
        if kind == 0:
            word = int.from_bytes(content[at + 14 : at + 22], "big")
            found = word >> 44, (word >> 41 & 7) + 1, (word >> 36 & 31) + 1, word & (1 << 36) - 1
        at += 4 + size
    if found is None:
        raise Damaged("no stream block")
    return at, *found


def blocks(content: bytes, start: int = 0, end: int | None = None) -> Iterator[np.ndarray]:
    """Whole-number samples (n, channels) from ``start`` up to ``end``, frame by frame."""
    at, _, _, bits, _ = stream(content)
    place = 0
    while at < len(content) and (end is None or place < end):
        window = WINDOW
        while True:
            try:
                x, used = frame(content[at : at + window], bits)
                break
            except IndexError:
                if at + window >= len(content):
                    raise Damaged("the stream ends within a frame") from None
                window *= 4
        low, high = max(0, start - place), len(x) if end is None else min(len(x), end - place)
        if low < high:
            yield x[low:high]
        at, place = at + used, place + len(x)


def pcm(x: np.ndarray, bits: int) -> bytes:
    """Little-endian sample bytes."""
    width = (bits + 7) // 8
    if width == 3:
        return np.ascontiguousarray(x.astype("<i4")).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return x.astype(f"<i{width}").tobytes()


class Writer:
    """Bits in the order of the stream."""

    def __init__(self):
        self.parts: list[str] = []

    def put(self, x: int, n: int) -> None:
        self.parts.append(format(x & (1 << n) - 1, f"0{n}b") if n else "")

    def data(self) -> bytes:
        text = "".join(self.parts)
        text += "0" * (-len(text) % 8)
        return int(text or "0", 2).to_bytes(len(text) // 8, "big")


def checksum(data: bytes, polynomial: int, width: int) -> int:
    c, top, mask = 0, 1 << (width - 1), (1 << width) - 1
    for byte in data:
        c ^= byte << (width - 8)
        for _ in range(8):
            c = ((c << 1) ^ polynomial if c & top else c << 1) & mask
    return c


def _put_residual(w: Writer, x: np.ndarray) -> None:
    folded = np.where(x < 0, -2 * x - 1, 2 * x)
    k = min(14, max(0, int(np.log2(folded.mean() + 1)))) if len(x) else 0
    w.put(0, 2)
    w.put(0, 4)
    w.put(k, 4)
    for v in folded.tolist():
        w.parts.append("0" * (v >> k) + "1")
        w.put(v, k)


def _put_subframe(w: Writer, x: np.ndarray, bits: int, kind: str) -> None:
    if (x == x[0]).all():
        w.put(0, 8)
        w.put(int(x[0]), bits)
    elif kind == "verbatim" or len(x) < 4:
        w.put(1 << 1, 8)
        for v in x.tolist():
            w.put(v, bits)
    elif kind == "fixed":
        w.put(10 << 1, 8)
        for v in x[:2].tolist():
            w.put(v, bits)
        _put_residual(w, np.diff(x, 2))
    else:  # a linear predictor: 2 a - b, as weights of 8 bits shifted by 5
        w.put(33 << 1, 8)
        for v in x[:2].tolist():
            w.put(v, bits)
        w.put(7, 4)
        w.put(5, 5)
        w.put(64, 8)
        w.put(-32, 8)
        _put_residual(w, x[2:] - 2 * x[1:-1] + x[:-2])


def encode(x: np.ndarray, rate: int, bits: int = 16, kind: str = "fixed", block: int = BLOCK, comments: dict[str, str] | None = None) -> bytes:
    """A FLAC file of whole-number samples (n, channels); ``kind`` names the predictor. Stereo is stored as mid and side."""
    import hashlib

    n, channels = x.shape
    head = struct.pack(">HH", block, block) + bytes(6)
    word = rate << 44 | (channels - 1) << 41 | (bits - 1) << 36 | n
    head += word.to_bytes(8, "big") + hashlib.md5(pcm(x, bits)).digest()
    texts = [f"{k}={v}".encode() for k, v in (comments or {}).items()]
    body = struct.pack("<I", 0) + struct.pack("<I", len(texts)) + b"".join(struct.pack("<I", len(t)) + t for t in texts)
    out = [b"fLaC", bytes([0]), len(head).to_bytes(3, "big"), head, bytes([0x84]), len(body).to_bytes(3, "big"), body]
    for number, at in enumerate(range(0, n, block)):
        part = x[at : at + block].astype(np.int64)
        w = Writer()
        w.put(0x7FFC, 15)
        w.put(0, 1)
        w.put(7, 4)
        w.put(0, 4)
        w.put(10 if channels == 2 else channels - 1, 4)
        w.put(0, 4)
        w.parts.append("".join(format(c, "08b") for c in chr(number).encode()))
        w.put(len(part) - 1, 16)
        w.put(checksum(w.data(), 0x07, 8), 8)
        if channels == 2:
            side = part[:, 0] - part[:, 1]
            _put_subframe(w, part.sum(axis=1) >> 1, bits, kind)
            _put_subframe(w, side, bits + 1, kind)
        else:
            for c in range(channels):
                _put_subframe(w, part[:, c], bits, kind)
        made = w.data()
        out += [made, checksum(made, 0x8005, 16).to_bytes(2, "big")]
    return b"".join(out)
