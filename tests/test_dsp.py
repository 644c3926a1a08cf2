"""Spectral features on signals whose answers are known."""

import numpy as np
import pytest

from strataphon.functions import dsp
from strataphon.operators import features

SR = 44_100
T = np.arange(SR * 2) / SR


def sine(f, amplitude=0.5):
    return (amplitude * np.sin(2 * np.pi * f * T)).astype(np.float32)


def test_sine():
    s = dsp.Signal(sine(440), SR)
    shape = dsp.spectral_shape(s)
    assert abs(shape["centroid_median"] - 440) < 40
    assert abs(shape["zcr_mean"] - 2 * 440 / SR) < 1e-3
    assert dsp.nap(s.y, SR) > 0.95
    assert abs(dsp.dynamics(s)["energy"] - 0.125) < 1e-3
    assert abs(dsp.dynamics(s)["crest_factor"] - 2**0.5) < 1e-2
    assert abs(dsp.tensor(s)["psd_peak_freq"] - 440) < 25
    assert s.chroma.mean(axis=1).argmax() == 9
    assert s.chroma_cqt.mean(axis=1).argmax() == 9


def test_yin_only_for_vocals():
    assert abs(np.median(dsp.yin(sine(220), SR)[5:-5]) - 220) < 1
    assert len(dsp.voice(dsp.Signal(sine(220), SR, "bass"))["vocal_f0"]) == 0
    assert abs(np.median(dsp.voice(dsp.Signal(sine(220), SR, "vocals"))["vocal_f0"]) - 220) < 1


def test_silence():
    s = dsp.Signal(np.zeros(SR), SR)
    out = features.product([p.extractor for p in features.plugins({n: True for n in features.REGISTRY})]).run(s)
    assert out["nap"] == 0 and out["bpm"] == 0 and out["lufs"] == -70 and out["true_peak_db"] == -100
    assert all(np.isfinite(np.asarray(v, float)).all() for v in out.values())


def test_click_train_tempo():
    y = np.zeros(SR * 8, np.float32)
    y[:: SR // 2] = 1.0  # 120 a minute
    y = np.convolve(y, np.hanning(200), "same").astype(np.float32)
    s = dsp.Signal(y, SR)
    assert abs(s.tempo - 120) < 3
    assert abs(np.median(np.diff(s.beats)) - 0.5) < 0.03


def test_stereo_axes():
    a = np.stack([sine(440), sine(440)])
    assert np.allclose(dsp.Signal(a, SR).y, dsp.Signal(a.T, SR).y)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64])
def test_resample_ends(n):
    x = np.arange(n, dtype=float)
    out = dsp.resample_points(x)
    assert len(out) == 32
    if n:
        assert out[0] == x[0] and out[-1] == x[-1]


def test_peaks():
    assert dsp.local_peaks(np.array([0, 1, 0, 2, 2, 0, 3])).tolist() == [1, 3]
    assert dsp.local_peaks(np.array([0, 1, 0.9, 2, 0]), prominence=0.5).tolist() == [3]
    assert dsp.local_peaks(np.array([0, 0.005, 0, 2, 0]), height=0.01).tolist() == [3]


def test_polyphase_true_peak():
    # A sine sampled off its crests: the samples stay below 1, the true peak is 1.
    y = np.sin(2 * np.pi * 11025 * T + np.pi / 4)
    assert abs(dsp.quality(dsp.Signal(y.astype(np.float32), SR))["true_peak_db"]) < 0.2


def test_loudness_of_sine():
    lufs, lra = dsp.loudness(sine(1000, 0.5).astype(float), SR)
    assert abs(lufs - (10 * np.log10(0.125) - 0.691)) < 0.01 and lra < 0.01


def test_band_stems_add_up():
    y = np.random.default_rng(0).standard_normal(4096)
    stems = features.band_stems(y, 8000)
    assert len(stems) == 7
    assert np.allclose(sum(v for k, v in stems.items() if k != "mix"), y, atol=1e-5)


def test_registry():
    assert [p.name for p in features.plugins()][:2] == ["dynamics", "spectral"]
    assert "quality" not in [p.name for p in features.plugins()]
    with pytest.raises(KeyError):
        features.plugins({"nothing": True})


def test_extract_documents(spark):
    df = spark.createDataFrame([(1, "mix", 8000, [0.1, -0.1] * 4000), (1, "bass", 8000, [0.0] * 100), (2, "mix", 8000, None)], "id long, stem string, sr int, y array<float>")
    out = features.extract(df, {n: n == "dynamics" for n in features.REGISTRY})
    rows = {(r.id, r.stem): r for r in out.collect()}
    assert abs(rows[1, "mix"].scalars["energy"] - 0.01) < 1e-6
    assert len(rows[1, "mix"].sequences["rms"]) == 32
    assert rows[2, "mix"].scalars == {}
    import json

    docs = {r.id: json.loads(r.features) for r in features.document(out, ["id"]).collect()}
    assert "energy" in docs[1]["mix"]["scalars"] and "bass" in docs[1]["demucs"]
