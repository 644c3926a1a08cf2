"""Feature extraction per (track, stem): a registry of extractors and one Arrow pass over waveforms.

All extractors of a row share one ``Signal``, so its spectrogram, mel bands and onset envelope are computed once.
Only the asked families run. One waveform is one row; batches are bounded by bytes, so memory holds few of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dsp
from ..session import bounded_batches


@dataclass(frozen=True)
class Extractor:
    """A step from a signal to named values; steps combine by ``*`` (both results) and ``map``."""

    run: Callable[[dsp.Signal], dict]

    @staticmethod
    def pure(value: dict) -> Extractor:
        return Extractor(lambda _: dict(value))

    def map(self, f: Callable[[dict], dict]) -> Extractor:
        return Extractor(lambda s: f(self.run(s)))

    def __mul__(self, other: Extractor) -> Extractor:
        return Extractor(lambda s: self.run(s) | other.run(s))


def product(steps: Iterable[Extractor]) -> Extractor:
    out = Extractor.pure({})
    for step in steps:
        out = out * step
    return out


@dataclass(order=True)
class Plugin:
    priority: int
    name: str
    extractor: Extractor = field(compare=False)
    enabled: bool = field(default=True, compare=False)


REGISTRY: dict[str, Plugin] = {}


def register(name: str, priority: int, enabled: bool = True):
    """Decorator: register a function from a signal to named values as a family of features."""

    def add(function):
        REGISTRY[name] = Plugin(priority, name, Extractor(function), enabled)
        return function

    return add


def plugins(switches: dict[str, bool] | None = None) -> list[Plugin]:
    """Enabled families by priority; ``switches`` override the defaults. Unknown names raise."""
    switches = switches or {}
    if unknown := set(switches) - set(REGISTRY):
        raise KeyError(f"no such feature family: {sorted(unknown)}")
    return sorted(p for p in REGISTRY.values() if switches.get(p.name, p.enabled))


for _priority, (_name, _function, _on) in enumerate(
    (
        ("dynamics", dsp.dynamics, True),
        ("spectral", dsp.spectral_shape, True),
        ("tonal", dsp.tonal, True),
        ("rhythm", dsp.rhythm, True),
        ("timbre", dsp.timbre, True),
        ("voice", dsp.voice, True),
        ("statistics", dsp.statistics, True),
        ("tensor", dsp.tensor, True),
        ("psychoacoustics", dsp.psychoacoustics, False),
        ("structure", dsp.structure, False),
        ("quality", dsp.quality, False),
    )
):
    register(_name, 10 * (_priority + 1), _on)(_function)


#: Rows that go out at once.
ROWS = 64


def widened(df: DataFrame, columns: list[str], ddl: str) -> T.StructType:
    """Schema of some columns and of new ones."""
    return T.StructType([*df.select(*columns).schema.fields, *T.StructType.fromDDL(ddl).fields])


def clean(value):
    """Document form: arrays as lists, NaN and infinities as null."""
    if isinstance(value, np.ndarray):
        return [clean(v) for v in value.tolist()]
    if isinstance(value, (float, np.floating)):
        return float(value) if np.isfinite(value) else None
    return value.item() if isinstance(value, np.generic) else value


def waves(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's samples, without copies; None for a null or empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [flat[i:j] if ok and i < j else None for i, j, ok in zip(at, at[1:], valid)]


def mapped(df: DataFrame, column: str, make: Callable, ddl: str, types: list[pa.DataType], more: list[str] = ()) -> DataFrame:
    """``df`` without ``column``, a list of samples, and with new columns ``ddl``: ``make(samples, *more values)`` gives the
    rows, tuples of them, for one row. Batches are bounded by bytes, and rows go out as soon as ``ROWS`` are made."""
    bounded_batches(df.sparkSession)
    rest = [c for c in df.columns if c != column]
    schema = widened(df, rest, ddl)
    df = df.select(*rest, column)

    def step(batches):
        for batch in batches:
            others = [batch.column(rest.index(c)).to_pylist() for c in more]
            made, source = [], []
            for k, y in enumerate(waves(batch.column(len(rest)))):
                for row in make(y, *(c[k] for c in others)):
                    made.append(row)
                    source.append(k)
                if len(made) >= ROWS or (k + 1 == batch.num_rows and made):
                    kept = batch.select(rest).take(pa.array(source, pa.int64()))
                    new = [pa.array([r[j] for r in made], t) for j, t in enumerate(types)]
                    yield pa.RecordBatch.from_arrays([*kept.columns, *new], schema.names)
                    made, source = [], []

    return df.mapInArrow(step, schema)


def extract(df: DataFrame, switches: dict[str, bool] | None = None, samples: str = "y", rate: str = "sr", stem: str = "stem") -> DataFrame:
    """``df`` without its waveform, with ``scalars map<string,double>`` and ``sequences map<string,array<double>>``.

    A null or empty waveform has empty maps. Booleans are 0 or 1.
    """
    chosen = product([p.extractor for p in plugins(switches)])

    def make(y, sr, name):
        found = chosen.run(dsp.Signal(np.asarray(y, np.float32), int(sr), name)) if y is not None else {}
        found = {k: clean(v) for k, v in found.items()}
        scalars = [(k, None if v is None else float(v)) for k, v in found.items() if not isinstance(v, list)]
        yield scalars, [(k, v) for k, v in found.items() if isinstance(v, list) and v]

    types = [pa.map_(pa.string(), pa.float64()), pa.map_(pa.string(), pa.list_(pa.float64()))]
    return mapped(df, samples, make, "scalars map<string,double>, sequences map<string,array<double>>", types, [rate, stem])


def document(df: DataFrame, keys: list[str]) -> DataFrame:
    """One JSON document per track: ``mix`` and, under ``demucs``, each other stem."""
    body = F.struct("scalars", "sequences")
    by = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("stem", body))).alias("m"))
    rest = F.map_filter("m", lambda k, _: k != "mix")
    return by.select(*keys, F.to_json(F.struct(F.col("m")["mix"].alias("mix"), rest.alias("demucs"))).alias("features"))


def band_stems(y: np.ndarray, sr: int) -> dict[str, np.ndarray]:
    """A deterministic stand-in for a separation model: six frequency bands that add up to the mix."""
    edges = [0, 120, 300, 700, 1800, 5000, np.inf]
    names = ["bass", "drums", "other", "piano", "guitar", "vocals"]
    spec, f = np.fft.rfft(y), np.fft.rfftfreq(len(y), 1 / sr)
    out = {n: np.fft.irfft(spec * ((f >= a) & (f < b)), len(y)).astype(np.float32) for n, a, b in zip(names, edges, edges[1:])}
    return {"mix": np.asarray(y, np.float32)} | out


def separate(df: DataFrame, model: Callable[[np.ndarray, int], dict[str, np.ndarray]] = band_stems) -> DataFrame:
    """(keys..., sr, y) -> one row a stem, none for a null or empty waveform. ``model`` is pluggable; a failing track fails
    the job."""
    def make(y, sr):
        for name, part in model(np.asarray(y, np.float32), int(sr)).items() if y is not None else ():
            yield name, np.asarray(part, np.float32)

    return mapped(df, "y", make, "stem string, y array<float>", [pa.string(), pa.list_(pa.float32())], ["sr"])


def classify(df: DataFrame, classes: dict[str, list[str]], model: Callable[[np.ndarray, str], np.ndarray] | None = None) -> DataFrame:
    """(keys..., sr, y) -> ``predictions map<string,double>`` keyed ``model_class`` in lower case.

    The default model is a deterministic stand-in: a softmax over fixed projections of the mean patch.
    """

    def stub(patch: np.ndarray, name: str) -> np.ndarray:
        seed = np.frombuffer(name.encode().ljust(8, b"_")[:8], np.uint32)
        z = np.random.default_rng(seed).standard_normal((len(classes[name]), patch.size)) @ patch / np.sqrt(patch.size)
        e = np.exp(z - z.max())
        return e / e.sum()

    head = model or stub
    def make(y, sr):
        if y is None:
            yield ([],)
            return
        patch = dsp.log_mel_patches(np.asarray(y, float), int(sr)).mean(axis=(0, 1))
        yield ([(f"{n}_{c}".lower(), float(p)) for n, cs in classes.items() for c, p in zip(cs, head(patch, n))],)

    return mapped(df, "y", make, "predictions map<string,double>", [pa.map_(pa.string(), pa.float64())], ["sr"])
