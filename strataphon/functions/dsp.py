"""Spectral features of one waveform, in numpy, from published definitions.

Frames are 2048 samples, 512 apart, zero-padded around the ends, under a periodic Hann window. ``Signal`` computes
shared intermediates (spectrogram, mel bands, onset envelope) once and on demand. Nothing here knows Spark.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

import numpy as np

FFT, HOP = 2048, 512
POINTS = 32


def resample_points(x: np.ndarray, n: int = POINTS) -> np.ndarray:
    if len(x) == 0:
        return np.zeros(n)
    return np.interp(np.linspace(0, 1, n), np.linspace(0, 1, len(x)), x)


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def framed(y: np.ndarray, size: int = FFT, hop: int = HOP, centre: bool = True) -> np.ndarray:
    """(frames, size) view; at least one frame."""
    if centre:
        y = np.pad(y, size // 2)
    if len(y) < size:
        y = np.pad(y, (0, size - len(y)))
    return np.lib.stride_tricks.sliding_window_view(y, size)[::hop]


def magnitudes(y: np.ndarray, size: int = FFT, hop: int = HOP, centre: bool = True) -> np.ndarray:
    """(bins, frames) magnitudes, float32."""
    return np.abs(np.fft.rfft(framed(y, size, hop, centre) * hann(size), axis=1)).T.astype(np.float32)


def hz_to_mel(f):
    """Linear below 1 kHz, logarithmic above (Slaney)."""
    f = np.asarray(f, float)
    return np.where(f < 1000, 3 * f / 200, 15 + 27 * np.log(np.maximum(f, 1e-9) / 1000) / np.log(6.4))


def mel_to_hz(m):
    m = np.asarray(m, float)
    return np.where(m < 15, 200 * m / 3, 1000 * np.exp(np.log(6.4) * (m - 15) / 27))


@lru_cache(maxsize=16)
def mel_bank(sr: int, size: int, bands: int) -> np.ndarray:
    """Triangles of equal area on the mel scale, (bands, bins)."""
    edge = mel_to_hz(np.linspace(hz_to_mel(0), hz_to_mel(sr / 2), bands + 2))
    f = np.linspace(0, sr / 2, size // 2 + 1)
    up = (f - edge[:-2, None]) / (edge[1:-1] - edge[:-2])[:, None]
    down = (edge[2:, None] - f) / (edge[2:] - edge[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edge[2:] - edge[:-2]))[:, None]


def decibels(power: np.ndarray, ref: float = 1.0, top: float | None = 80.0) -> np.ndarray:
    db = 10 * np.log10(np.maximum(1e-10, power)) - 10 * np.log10(max(1e-10, ref))
    return np.maximum(db, db.max() - top) if top is not None and db.size else db


@lru_cache(maxsize=4)
def dct_matrix(rows: int, n: int) -> np.ndarray:
    """Orthonormal DCT-II."""
    k, i = np.arange(rows)[:, None], np.arange(n)
    out = np.sqrt(2 / n) * np.cos(np.pi * k * (2 * i + 1) / (2 * n))
    out[0] /= np.sqrt(2)
    return out


@lru_cache(maxsize=16)
def chroma_bank(sr: int, size: int) -> np.ndarray:
    """Gaussian weights of bins for 12 pitch classes (A = 440 Hz), favouring the middle octaves."""
    f = np.arange(1, size // 2 + 1) * sr / size
    pitch = 12 * np.log2(f / 440.0) + 9  # in semitones, C = 0
    width = np.maximum(1.0, 12 * np.log2((f + sr / size) / f))
    away = (pitch[None] - np.arange(12)[:, None] + 6) % 12 - 6
    w = np.exp(-0.5 * (2 * away / width) ** 2)
    w /= np.maximum(np.linalg.norm(w, axis=0), 1e-12)
    w *= np.exp(-0.5 * ((pitch / 12 - 0.25) / 2) ** 2)
    return np.hstack([np.zeros((12, 1)), w])


def shannon_bits(x: np.ndarray) -> float:
    x = np.abs(np.asarray(x, float))
    s = x.sum()
    if s < 1e-10:
        return 0.0
    p = x / s
    return float(-(p * np.log2(p + 1e-10)).sum())


def moments(x: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """Skewness and excess kurtosis in float32; 0 where the deviation is at most 1e-8."""
    x = x.astype(np.float32)
    c = x - x.mean(axis=axis, keepdims=True)
    sd = np.sqrt((c * c).mean(axis=axis))
    safe = np.where(sd > 1e-8, sd, 1)
    skew = (c**3).mean(axis=axis) / (safe**3 + np.float32(1e-12))
    kurt = (c**4).mean(axis=axis) / (safe**4 + np.float32(1e-12)) - 3
    return np.where(sd > 1e-8, skew, 0), np.where(sd > 1e-8, kurt, 0)


def analytic(y: np.ndarray) -> np.ndarray:
    n = len(y)
    h = np.zeros(n)
    h[0] = 1
    h[1 : (n + 1) // 2] = 2
    if n % 2 == 0:
        h[n // 2] = 1
    return np.fft.ifft(np.fft.fft(y) * h)


def local_peaks(x: np.ndarray, height: float | None = None, prominence: float | None = None) -> np.ndarray:
    """Places of local maxima (the middle of a flat top), filtered by height and prominence."""
    x = np.asarray(x, float)
    if len(x) < 3:
        return np.zeros(0, int)
    change = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1], [True]]))
    start, end = change[:-1], change[1:] - 1
    level = x[start]
    inner = (start > 0) & (end < len(x) - 1)
    rise = np.concatenate([[False], level[1:] > level[:-1]])
    fall = np.concatenate([level[:-1] > level[1:], [False]])
    found = (start + end)[inner & rise & fall] // 2
    if height is not None:
        found = found[x[found] >= height]
    if prominence is not None:
        keep = []
        for p in found:
            left = np.flatnonzero(x[:p] > x[p])
            right = np.flatnonzero(x[p + 1 :] > x[p])
            low_l = x[left[-1] if len(left) else 0 : p + 1].min()
            low_r = x[p : p + 1 + (right[0] if len(right) else len(x))].min()
            keep.append(x[p] - max(low_l, low_r) >= prominence)
        found = found[np.array(keep, bool)] if len(found) else found
    return found


def nap(y: np.ndarray, sr: int) -> float:
    """Normalised autocorrelation peak at lags of 50 to 500 Hz."""
    n = len(y)
    if n < 2:
        return 0.0
    size = 1 << (2 * n - 1).bit_length()
    r = np.fft.irfft(np.abs(np.fft.rfft(np.asarray(y, float), size)) ** 2, size)[:n]
    part = r[max(1, sr // 500) : min(n, sr // 50)]
    return float(np.clip(part.max() / r[0], 0, 1)) if r[0] >= 1e-9 and len(part) else 0.0


def yin(y: np.ndarray, sr: int, low: float = 65.406, high: float = 2093.005, threshold: float = 0.1) -> np.ndarray:
    """Fundamental of each frame by the cumulative mean normalised difference; 0 where none is found."""
    short, long = int(sr // high), min(int(np.ceil(sr / low)), FFT // 2)
    frames = framed(y)
    half = FFT // 2
    x = frames.astype(float)
    spec = np.fft.rfft(x, 2 * FFT, axis=1)
    part = np.fft.rfft(x[:, :half], 2 * FFT, axis=1)
    cross = np.fft.irfft(spec * part.conj(), axis=1)[:, : long + 1]
    squares = np.cumsum(np.pad(x**2, ((0, 0), (1, 0))), axis=1)
    energy = squares[:, half : half + long + 1] - squares[:, : long + 1]
    d = energy[:, :1] + energy - 2 * cross
    mean = np.cumsum(d[:, 1:], axis=1) / np.arange(1, long + 1)
    norm = np.hstack([np.ones((len(d), 1)), d[:, 1:] / np.maximum(mean, 1e-12)])
    out = np.zeros(len(d))
    for k, row in enumerate(norm):
        if energy[k, 0] < 1e-9:
            continue
        below = np.flatnonzero(row[short:long] < threshold)
        if not len(below):
            continue
        t = short + below[0]
        while t + 1 < long and row[t + 1] < row[t]:
            t += 1
        a, b, c = row[t - 1], row[t], row[min(t + 1, long)]
        bend = a - 2 * b + c
        out[k] = sr / (t + (0.5 * (a - c) / bend if abs(bend) > 1e-12 else 0))
    return out


def polyphase(y: np.ndarray, up: int, down: int = 1, half: int = 10) -> np.ndarray:
    """Rational resampling with a Kaiser-windowed sinc."""
    top = max(up, down)
    n = 2 * half * top + 1
    t = np.arange(n) - half * top
    taps = np.sinc(t / top) / top * np.kaiser(n, 5.0) * up
    taps *= up / taps.sum()
    wide = np.zeros(len(y) * up)
    wide[::up] = y
    size = 1 << (len(wide) + n).bit_length()
    full = np.fft.irfft(np.fft.rfft(wide, size) * np.fft.rfft(taps, size), size)
    return full[half * top : half * top + len(wide)][::down]


class Signal:
    """A mono waveform with its shared intermediates."""

    def __init__(self, y, sr: int, stem: str = "mix"):
        y = np.nan_to_num(np.asarray(y, dtype=np.float32), nan=0.0, posinf=0.0, neginf=0.0)
        if y.ndim == 2:  # channels may be on either axis; the shorter one is taken
            y = y.mean(axis=0 if y.shape[0] <= y.shape[1] else 1)
        self.y, self.sr, self.stem = y, int(sr), stem

    @cached_property
    def spectrogram(self):
        return magnitudes(self.y)

    @cached_property
    def power(self):
        return self.spectrogram.astype(float) ** 2

    @cached_property
    def freqs(self):
        return np.linspace(0, self.sr / 2, FFT // 2 + 1)

    @cached_property
    def mel(self):
        return mel_bank(self.sr, FFT, 128) @ self.power

    @cached_property
    def chroma(self):
        c = chroma_bank(self.sr, FFT) @ self.power
        top = c.max(axis=0, keepdims=True)
        return np.where(top > 1e-12, c / np.maximum(top, 1e-12), 0)

    @cached_property
    def chroma_cqt(self):
        """Constant-Q chroma from long frames: Gaussian bands of a semitone, folded to pitch classes."""
        size = 8192
        p = magnitudes(self.y, size).astype(float)
        f = np.arange(1, size // 2 + 1) * self.sr / size
        centre = 32.703 * 2 ** (np.arange(84) / 12)
        centre = centre[centre < self.sr / 2]
        w = np.exp(-0.5 * (np.log2(f[None] / centre[:, None]) * 12 / 0.5) ** 2)
        bands = w @ p[1:]
        folded = np.zeros((12, p.shape[1]))
        np.add.at(folded, np.arange(len(centre)) % 12, bands)
        top = folded.max(axis=0, keepdims=True)
        return np.where(top > 1e-12, folded / np.maximum(top, 1e-12), 0)

    @cached_property
    def onset(self):
        """Mean rise of the mel bands in dB from frame to frame."""
        db = decibels(self.mel, max(float(self.mel.max()), 1e-10) if self.mel.max() > 0 else 1.0)
        return np.concatenate([[0.0], np.maximum(0, np.diff(db, axis=1)).mean(axis=0)])

    @cached_property
    def tempogram(self):
        """Local autocorrelation of the onset envelope over 384 frames, (lags, frames), each frame's maximum 1."""
        size = 384
        x = framed(self.onset, size, 1)[: len(self.onset)] * hann(size)
        r = np.fft.irfft(np.abs(np.fft.rfft(x, 2 * size, axis=1)) ** 2, axis=1)[:, :size].T
        top = np.abs(r).max(axis=0, keepdims=True)
        return np.where(top > 1e-12, r / np.maximum(top, 1e-12), 0)

    @cached_property
    def tempo(self) -> float:
        """Lag of strongest mean autocorrelation under a log-normal prior around 120 per minute."""
        if self.onset.max(initial=0) <= 0:
            return 0.0
        r = self.tempogram.mean(axis=1)
        bpm = 60 * self.sr / (HOP * np.arange(1, len(r)))
        prior = np.exp(-0.5 * np.log2(bpm / 120) ** 2)
        score = np.where(bpm < 320, r[1:], 0) * prior
        return float(bpm[np.argmax(score)]) if score.max() > 0 else 0.0

    @cached_property
    def beats(self) -> np.ndarray:
        """Beat times by dynamic programming: onset strength against deviation from the tempo's period."""
        if self.tempo <= 0:
            return np.zeros(0)
        period = 60 * self.sr / (HOP * self.tempo)
        local = self.onset / max(self.onset.std(ddof=1) if len(self.onset) > 1 else 1.0, 1e-9)
        smooth = np.exp(-0.5 * (np.arange(-int(period), int(period) + 1) * 32 / period) ** 2)
        local = np.convolve(local, smooth, "same")[: len(local)]
        back = np.arange(-round(2 * period), -max(1, round(period / 2)) + 1)
        cost = -100 * np.log(-back / period) ** 2
        total, link, begun = local.copy(), np.full(len(local), -1), False
        for i in range(len(local)):
            at = i + back
            score = np.where(at >= 0, total[np.maximum(at, 0)], 0) + cost
            k = int(np.argmax(score))
            total[i] = local[i] + score[k]
            begun = begun or local[i] >= 0.01 * local.max()
            link[i] = at[k] if begun and at[k] >= 0 else -1
        best = local_peaks(total)
        i = int(best[np.flatnonzero(total[best] >= 0.5 * np.median(total[best]))[-1]]) if len(best) else int(np.argmax(total))
        path = []
        while i >= 0:
            path.append(i)
            i = link[i]
        return np.array(path[::-1]) * HOP / self.sr

    @cached_property
    def centroid(self):
        s = self.spectrogram.astype(float)
        total = s.sum(axis=0)
        return (self.freqs[:, None] * s).sum(axis=0) / np.where(total > 0, total, 1)

    @cached_property
    def rms(self):
        return np.sqrt((framed(self.y).astype(float) ** 2).mean(axis=1))


def dynamics(s: Signal) -> dict:
    energy = float((s.y.astype(float) ** 2).mean()) if len(s.y) else 0.0
    peak, root = float(np.abs(s.y).max(initial=0)), energy**0.5
    db = decibels(s.rms**2, max(float(s.rms.max()), 1e-5) ** 2)
    return {
        "energy": energy, "crest_factor": peak / root if root >= 1e-9 else 0.0, "rms_mean": float(s.rms.mean()),
        "rms_std": float(s.rms.std()), "rms_peak": float(s.rms.max()), "rms_min": float(s.rms.min()),
        "rms_median": float(np.median(s.rms)), "rms_entropy": shannon_bits(s.rms), "rms": resample_points(s.rms),
        "dynamic_range": resample_points(db),
    }


def spectral_shape(s: Signal) -> dict:
    m = s.spectrogram.astype(float)
    total = np.where(m.sum(axis=0) > 0, m.sum(axis=0), 1)
    band = np.sqrt(((s.freqs[:, None] - s.centroid) ** 2 * m).sum(axis=0) / total)
    cum = np.cumsum(m, axis=0)
    rolloff = s.freqs[(cum >= 0.85 * cum[-1]).argmax(axis=0)]
    p = np.maximum(1e-10, s.power)
    flat = np.exp(np.log(p).mean(axis=0)) / p.mean(axis=0)
    sign = framed(s.y) >= 0
    zcr = (sign[:, 1:] != sign[:, :-1]).sum(axis=1) / FFT
    edges = np.concatenate([[0], 200 * 2.0 ** np.arange(7)])
    contrast = []
    for low, high in zip(edges[:-1], np.minimum(edges[1:], s.sr / 2)):
        part = np.sort(m[(s.freqs >= low) & (s.freqs <= high)], axis=0)
        k = max(1, round(0.02 * len(part)))
        contrast.append(float((decibels(part[-k:].mean(axis=0), top=None) - decibels(part[:k].mean(axis=0), top=None)).mean()) if len(part) else 0.0)
    return {
        "centroid_mean": float(s.centroid.mean()), "centroid_std": float(s.centroid.std()), "centroid_peak": float(s.centroid.max()),
        "centroid_min": float(s.centroid.min()), "centroid_median": float(np.median(s.centroid)),
        "centroid_entropy": shannon_bits(s.centroid), "centroid": resample_points(s.centroid),
        "centroid_delta": resample_points(np.diff(s.centroid, prepend=s.centroid[:1])), "bandwidth": float(band.mean()),
        "rolloff_mean": float(rolloff.mean()), "rolloff_std": float(rolloff.std()), "rolloff": resample_points(rolloff),
        "flatness": float(flat.mean()), "zcr_mean": float(zcr.mean()), "zcr_std": float(zcr.std()), "zcr": resample_points(zcr),
        "contrast_bands": np.array(contrast),
    }


def timbre(s: Signal) -> dict:
    c = dct_matrix(13, 128) @ decibels(s.mel)
    rows = np.stack([resample_points(r) for r in c])
    return {
        "mfccs": c.mean(axis=1), "mfcc_std": c.std(axis=1), "mfcc_entropy": np.array([shannon_bits(r) for r in c]), "mfcc": rows.ravel(),
    }


def tonnetz(chroma: np.ndarray) -> np.ndarray:
    """Six coordinates on the circles of fifths, minor thirds and major thirds."""
    c = chroma / np.maximum(np.abs(chroma).sum(axis=0, keepdims=True), 1e-12)
    angle = np.pi * np.outer([7 / 6, 3 / 2, 2 / 3], np.arange(12))
    base = np.concatenate([[r * np.sin(a), r * np.cos(a)] for r, a in zip((1.0, 1.0, 0.5), angle)])
    return base @ c


def tonal(s: Signal) -> dict:
    t = tonnetz(s.chroma)
    per_frame = np.array([shannon_bits(c) for c in s.chroma.T])
    return {
        "chroma_mean": s.chroma.mean(axis=1), "chroma_std": s.chroma.std(axis=1), "chroma_peak": s.chroma.max(axis=1),
        "chroma_entropy": resample_points(per_frame), "chroma": np.stack([resample_points(r) for r in s.chroma]).ravel(),
        "chroma_cqt_mean": s.chroma_cqt.mean(axis=1), "tonnetz_mean": t.mean(axis=1), "tonnetz_std": t.std(axis=1),
        "tonnetz_delta": np.abs(np.diff(t, axis=1, prepend=t[:, :1])).mean(axis=1),
        "tonnetz_norm": resample_points(np.linalg.norm(t, axis=0)), "tonnetz": np.stack([resample_points(r) for r in t]).ravel(),
    }


def rhythm(s: Signal) -> dict:
    o = s.onset
    ac = np.correlate(o, o, "full")[len(o) - 1 :][:POINTS]
    skew, kurt = moments(o, 0)
    g = s.tempogram
    return {
        "bpm": s.tempo, "beats": s.beats, "onset_mean": float(o.mean()), "onset_std": float(o.std()), "onset_max": float(o.max()),
        "onset_percentiles": np.percentile(o, [25, 50, 75]), "onset_crest": float(o.max() / max(np.sqrt((o**2).mean()), 1e-9)),
        "onset_autocorrelation": ac / max(ac.max(), 1e-9), "onset_skew": float(skew), "onset_kurtosis": float(kurt),
        "onset": resample_points(o), "tempogram_mean": float(g.mean()), "tempogram_std": float(g.std()),
        "tempogram_peak": float(g.max()), "tempogram_entropy": shannon_bits(g.mean(axis=1)), "tempogram": resample_points(g.mean(axis=0)),
    }


def voice(s: Signal) -> dict:
    value = nap(s.y, s.sr)
    db = 10 * np.log10(value / (1 - value)) if 1e-4 < value < 0.9999 else (-40.0 if value <= 1e-4 else 40.0)
    f0 = np.zeros(0)
    if s.stem == "vocals":
        f0 = yin(s.y, s.sr)
        f0 = f0 if (f0 > 0).any() else np.zeros(len(f0))
    cpp = cepstral_prominence(s.y, s.sr)
    mean = float(cpp.mean()) if len(cpp) else 0.0
    return {
        "nap": value, "hnr_db": float(db), "vocal_f0": resample_points(f0) if s.stem == "vocals" else np.zeros(0),
        "cpp_mean": mean, "cpp_std": float(cpp.std()) if len(cpp) else 0.0, "cpp": resample_points(cpp),
        "breathiness": float(1 / (1 + np.exp(np.clip(mean - 6, -50, 50)))) if len(cpp) else 0.0,
    }


def cepstral_prominence(y: np.ndarray, sr: int, most: int = 300) -> np.ndarray:
    """Height of the cepstral peak at 60 to 500 Hz over a line fit, for evenly chosen frames."""
    if len(y) < FFT:
        return np.zeros(0)
    frames = framed(y, centre=False)
    frames = frames[:: max(1, len(frames) // most)]
    log = np.log(np.abs(np.fft.rfft(frames * np.hanning(FFT), axis=1)) + 1e-10)
    c = np.fft.rfft(log, axis=1).real
    low, high = int(sr / 500), min(int(sr / 60), c.shape[1] - 1)
    if low >= high:
        return np.zeros(len(c))
    part, x = c[:, low:high], np.arange(low, high, dtype=float)
    dx = x - x.mean()
    slope = (part * dx).sum(axis=1) / max((dx**2).sum(), 1e-12)
    at = part.argmax(axis=1)
    return np.maximum(0, part.max(axis=1) - (part.mean(axis=1) + slope * dx[at]))


def statistics(s: Signal) -> dict:
    skew, kurt = moments(s.spectrogram, 0)
    y = s.y[::10].astype(float)
    if len(y) > 1:
        z = analytic(y)
        env, rate = np.abs(z), np.diff(np.unwrap(np.angle(z))) / (2 * np.pi) * s.sr / 10
        rate = np.append(rate, rate[-1])
    else:
        env = rate = np.zeros(1)
    spectral = np.array([len(local_peaks(c, height=0.01)) for c in s.spectrogram.T], float)
    step = max(1, len(s.onset) // POINTS)
    temporal = np.array([len(local_peaks(s.onset[i * step : (i + 1) * step], prominence=0.1)) for i in range(POINTS)], float)
    out = {}
    for name, x in (("skewness", skew), ("kurtosis", kurt), ("hilbert_env", env), ("hilbert_freq", rate), ("peaks_spectral", spectral), ("peaks_temporal", temporal)):
        out |= {f"{name}_mean": float(x.mean()), f"{name}_std": float(x.std()), f"{name}_peak": float(x.max()), f"{name}_min": float(x.min()), name: resample_points(x)}
    return out


def tensor(s: Signal) -> dict:
    """Peak of the averaged spectrum, spectral flux (sample deviation) and the sub-bass envelope."""
    n = FFT if len(s.y) >= FFT else max(len(s.y), 2)
    psd = (magnitudes(s.y, n, max(1, n // 2), centre=False).astype(float) ** 2).mean(axis=1)
    flux = np.sqrt((np.diff(s.spectrogram.astype(float), axis=1) ** 2).sum(axis=0))
    f = np.fft.rfftfreq(max(len(s.y), 1), 1 / s.sr)
    low = np.fft.irfft(np.fft.rfft(s.y) * ((f >= 20) & (f <= 60)), len(s.y)) if len(s.y) > 1 else np.zeros(2)
    return {
        "psd_peak_freq": float(np.linspace(0, s.sr / 2, len(psd))[psd.argmax()]), "flux_mean": float(flux.mean()) if len(flux) else 0.0,
        "flux_std": float(flux.std(ddof=1)) if len(flux) > 1 else 0.0, "subbass_env_mean": float(np.abs(analytic(low)).mean()),
    }


def psychoacoustics(s: Signal) -> dict:
    """Bark loudness, sharpness (acum), roughness from envelope modulation around 70 Hz, and tonality."""
    bark = np.clip(26.81 / (1 + 1960 / (s.freqs + 1e-6)) - 0.53, 0, 24)
    band = np.minimum(bark.astype(int), 24)
    power = np.stack([s.power[band == b].sum(axis=0) for b in range(24)])
    loud = 0.08 * np.maximum(power / 1.001e-9, 1) ** 0.23
    z, mean = np.arange(1, 25.0), loud.mean(axis=1)
    steep = np.where(z >= 14, 0.00012 * z**4 - 0.0056 * z**3 + 0.1 * z**2 - 0.79 * z + 3.43, 1)
    sharp = 0.11 * (mean * steep * z).sum() / mean.sum() if mean.sum() >= 1e-9 else 0.0
    rough = 0.0
    if len(s.onset) >= 16:
        m = np.abs(np.fft.rfft(s.onset))
        ratio = np.fft.rfftfreq(len(s.onset), HOP / s.sr) / 70
        rough = 10 * (m * ratio / (1 + ratio**2)).sum() / (m.sum() + 1e-9)
    average = s.spectrogram.mean(axis=1)
    tone = np.log10(max(float(average.max()), 1e-12) / (float(np.median(average)) + 1e-9))
    return {
        "sharpness": float(np.clip(sharp, 0, 5)), "roughness": float(np.clip(rough, 0, 5)), "tonality": float(np.clip(tone, 0, 3)),
        "specific_loudness": resample_points(loud.mean(axis=0)),
    }


def similarity(features: np.ndarray) -> np.ndarray:
    """Cosine similarity of frames (columns), within [0, 1]."""
    x = features / np.maximum(np.linalg.norm(features, axis=0, keepdims=True), 1e-9)
    return np.clip(x.T @ x, 0, 1)


def novelty(ssm: np.ndarray, size: int = 16) -> np.ndarray:
    """Checkerboard correlation along the diagonal under a Gaussian taper, scaled to 1."""
    half, n = size // 2, len(ssm)
    side = np.where(np.arange(size) < half, 1.0, -1.0) * np.exp(-0.5 * np.linspace(-2, 2, size) ** 2)
    out = np.zeros(n)
    for i in range(half, n - half):
        out[i] = side @ ssm[i - half : i + half, i - half : i + half] @ side
    out = np.maximum(0, out)
    return out / out.max() if out.max(initial=0) > 1e-9 else out


def structure(s: Signal, most: int = 1500) -> dict:
    """Chorus span, steepest rise and complexity. Frames are thinned to ``most`` before the quadratic matrix."""
    seconds = len(s.y) / s.sr if s.sr else 0.0
    if seconds < 1:
        return {"chorus_start": 0.0, "chorus_end": 0.0, "drop_position": 0.0, "complexity": 0.0, "novelty": np.zeros(POINTS)}
    step = -(-s.chroma.shape[1] // most)
    curve = novelty(similarity(np.vstack([s.chroma, s.centroid])[:, ::step]))
    env, n = s.rms[::step][: len(curve)], len(curve)
    per = seconds / n
    drop = int(np.argmax(np.diff(s.rms, prepend=s.rms[:1]))) * seconds / len(s.rms)
    low, high, wide = int(n * 0.25), int(n * 0.85), int(15 / per)
    mid = low + int(np.argmax(env[low:high])) if low < high and len(env) >= n else None
    span = (max(0, mid - wide), min(n, mid + wide)) if mid is not None else (int(n * 0.35), int(n * 0.55))
    return {
        "chorus_start": span[0] * per, "chorus_end": span[1] * per, "drop_position": float(drop), "complexity": float(curve.std() * 10),
        "novelty": resample_points(curve),
    }


def quality(s: Signal) -> dict:
    """High-frequency cut-off, true peak, loudness and its range."""
    cutoff, steep, fake = s.sr / 2, 0.0, False
    if s.sr >= 32000:
        db = 10 * np.log10(s.power.mean(axis=1) + 1e-12)
        f, d = s.freqs[s.freqs >= 10000], db[s.freqs >= 10000]
        slope = np.diff(d) / (np.diff(f) + 1e-6)
        k = int(slope.argmin())
        cutoff, steep = float(f[k]), float(abs(slope[k]) * f[k] * np.log(2))
        fake = (s.sr >= 88200 and cutoff <= 23000 and steep > 40) or (s.sr >= 44100 and cutoff <= 16000 and steep > 50)
    peak = -100.0
    top = float(np.abs(s.y).max(initial=0))
    if top >= 1e-9:
        block = min(len(s.y), 44100)
        a = max(0, int(np.abs(s.y).argmax()) - block // 2)
        peak = float(np.clip(20 * np.log10(np.abs(polyphase(s.y[a : a + block].astype(float), 4)).max() + 1e-12), -100, 10))
    lufs, lra = loudness(s.y.astype(float), s.sr)
    return {"cutoff_hz": cutoff, "cutoff_steepness": steep, "is_fake_hires": bool(fake), "true_peak_db": peak, "lufs": lufs, "loudness_range": lra}


def loudness(y: np.ndarray, sr: int) -> tuple[float, float]:
    """Gated loudness of 400 ms blocks every 100 ms (not K-weighted), and P95 - P10 of the kept blocks."""
    if not len(y) or sr <= 0:
        return -70.0, 0.0
    size, hop = int(sr * 0.4), int(sr * 0.1)
    if len(y) < size:
        return float(np.clip(10 * np.log10((y**2).mean() + 1e-24) - 0.691, -70, 0)), 0.0
    sums = np.concatenate([[0], np.cumsum(y**2)])
    p = (sums[size::hop] - sums[:-size:hop][: len(sums[size::hop])]) / size
    p = p[p > 10 ** ((-70 + 0.691) / 10)]
    if not len(p):
        return -70.0, 0.0
    kept = p[p > 0.1 * p.mean()]
    level = 10 * np.log10(kept + 1e-12) - 0.691
    q = np.percentile(level, [10, 95])
    return float(np.clip(10 * np.log10(kept.mean() + 1e-12) - 0.691, -70, 0)), float(max(0, q[1] - q[0]))


def log_mel_patches(y: np.ndarray, sr: int, patches: int = 64) -> np.ndarray:
    """(patches, 128, 96): at 16 kHz, 512/256 frames, 96 bands, log10(1e4 m + 1), a patch each 62 frames, evenly thinned or tiled."""
    if sr != 16000:
        y = np.interp(np.arange(int(len(y) * 16000 / sr)) * sr / 16000, np.arange(len(y)), y) if len(y) else y
    m = np.log10(1e4 * (mel_bank(16000, 512, 96) @ magnitudes(y, 512, 256).astype(float) ** 2) + 1).T
    if len(m) < 128:
        m = np.pad(m, ((0, 128 - len(m)), (0, 0)))
    all_ = np.stack([m[i : i + 128] for i in range(0, len(m) - 127, 62)])
    at = np.linspace(0, len(all_) - 1, patches).astype(int) if len(all_) >= patches else np.arange(patches) % len(all_)
    return all_[at].astype(np.float32)
