"""Harmonicity, keys, chords, groove and loudness as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import arrays as A

# Note names, and the published Krumhansl-Schmuckler key profiles.
NOTES = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
MAJOR_PROFILE = [6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88]
MINOR_PROFILE = [6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17]


def triads() -> dict[str, list[int]]:
    """Pitch classes of the 24 major and minor triads, names in alphabetical order."""
    found = {}
    for root, name in enumerate(NOTES):
        found[name] = [root, (root + 4) % 12, (root + 7) % 12]
        found[name + "m"] = [root, (root + 3) % 12, (root + 7) % 12]
    return dict(sorted(found.items()))


def hnr_db(nap: Column, variant: str = "sql") -> Column:
    """Harmonics-to-noise ratio in dB of a normalised autocorrelation peak.

    ``sql``: at most 0 gives -40, else clamped to [1e-4, 0.9999] and rounded to 4 places. ``core``: +-40 beyond
    the clamp. ``jig``: clamped, -40 only at or below 0, not rounded. Null stays null.
    """
    p = F.least(F.lit(0.9999), F.greatest(F.lit(1e-4), nap))
    db = 10.0 * F.log10(p / (1.0 - p))
    if variant == "sql":
        out = F.when(nap <= 0, -40.0).otherwise(F.round(db, 4))
    elif variant == "core":
        out = F.when(nap <= 1e-4, -40.0).when(nap >= 0.9999, 40.0).otherwise(db)
    else:
        out = F.when(nap <= 0, -40.0).otherwise(db)
    return F.when(nap.isNotNull(), out)


def nap_from_hnr(db: Column, variant: str = "sql") -> Column:
    """The inverse. ``sql``: beyond +-30 dB exactly 1 or 0, rounded to 6 places. ``jig``: the same cut-off on dB / 10,
    not rounded. ``core``: clipped to +-40 dB."""
    ratio = lambda x: F.pow(F.lit(10.0), x / 10.0)
    if variant == "sql":
        out = F.when(db > 30, 1.0).when(db < -30, 0.0).otherwise(F.round(ratio(db) / (1.0 + ratio(db)), 6))
    elif variant == "jig":
        out = F.when(db / 10.0 > 30, 1.0).when(db / 10.0 < -30, 0.0).otherwise(ratio(db) / (1.0 + ratio(db)))
    else:
        clipped = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), db))
        out = ratio(clipped) / (1.0 + ratio(clipped))
    return F.when(db.isNotNull(), out)


def migrate_harmonicity(value: Column, nap: Column, db: Column) -> Column:
    """struct(nap, hnr_db) of an old scalar that held either: in [0, 1] it is a NAP, else a dB value."""
    is_nap = value.between(0, 1)
    return F.when(
        is_nap & (nap.isNull() | db.isNull()), F.struct(value.alias("nap"), hnr_db(value).alias("hnr_db"))
    ).when(
        ~is_nap & nap.isNull(), F.struct(nap_from_hnr(value).alias("nap"), value.alias("hnr_db"))
    ).otherwise(F.struct(nap.alias("nap"), db.alias("hnr_db")))


def bark(hz: Column) -> Column:
    """Critical band rate by Traunmüller's formula, within [0, 24]."""
    z = 26.81 / (1.0 + 1960.0 / (hz + 1e-6)) - 0.53
    return F.greatest(F.lit(0.0), F.least(F.lit(24.0), z))


def _unit(values: list[float]) -> list[float]:
    size = sum(v * v for v in values) ** 0.5
    return [v / size for v in values]


def key_candidates() -> list[tuple[str, str, list[float]]]:
    """(key, scale, unit profile) in the order of preference: all major keys, then all minor ones."""
    return [
        (NOTES[k], scale, _unit([profile[(j - k) % 12] for j in range(12)]))
        for scale, profile in (("major", MAJOR_PROFILE), ("minor", MINOR_PROFILE))
        for k in range(12)
    ]


def key_estimate(chroma: Column) -> Column:
    """struct(key, scale, strength): the first best match of a 12-value mean chroma with the 24 key profiles."""
    score = lambda c, n: F.array(*[A.dot(c, F.array(*map(F.lit, p))) / n for _, _, p in key_candidates()])
    names = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(s).alias("scale")) for k, s, _ in key_candidates()])

    def best(scores):
        name = F.get(names, A.argmax(scores))
        return F.struct(name["key"].alias("key"), name["scale"].alias("scale"), F.array_max(scores).alias("strength"))

    size = F.when(A.norm(chroma) > 0, A.norm(chroma)).otherwise(1.0)
    return A.let(A.let(size, lambda n: score(chroma, n)), best)


def chord_index(frame: Column) -> Column:
    """Number of the first best triad of a 12-value frame; a silent frame is the first chord C."""
    shapes = list(triads().values())

    def best(top):
        part = lambda k: F.get(frame, F.lit(k)) / top
        scores = F.array(*[part(s[0]) + part(s[1]) + part(s[2]) for s in shapes])
        return F.when(top > 0, A.let(scores, A.argmax)).otherwise(list(triads()).index("C"))

    return A.let(A.peak(frame), best)


def chord_name(index: Column) -> Column:
    return F.get(F.array(*map(F.lit, triads())), index)


def dominant_pitch(chroma: Column) -> Column:
    return F.get(F.array(*map(F.lit, NOTES)), A.argmax(chroma))


def groove(beats: Column) -> Column:
    """struct(swing_ratio, syncopation_index, groove_class) of beat times; under four beats: 1, 0, straight."""

    def of(gaps):
        even, odd = F.filter(gaps, lambda _, i: i % 2 == 0), F.filter(gaps, lambda _, i: i % 2 == 1)
        swing = A.let(A.mean(odd), lambda m: F.when(m > 0, A.mean(even) / m).otherwise(1.0))
        kind = lambda s: F.when(s > 1.4, "shuffle").when(s > 1.15, "swing").otherwise("straight")
        return A.let(
            swing,
            lambda s: F.struct(s.alias("swing_ratio"), variation(gaps).alias("syncopation_index"), kind(s).alias("groove_class")),
        )

    few = F.struct(F.lit(1.0).alias("swing_ratio"), F.lit(0.0).alias("syncopation_index"), F.lit("straight").alias("groove_class"))
    return F.when(F.size(beats) < 4, few).otherwise(A.let(beat_gaps(beats), of))


def beat_gaps(beats: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(beats) - 1), lambda i: F.get(beats, i) - F.get(beats, i - 1))


def variation(gaps: Column) -> Column:
    """Coefficient of variation; 0 for a mean of 0."""
    return A.let(A.mean(gaps), lambda m: F.when(m > 0, A.std(gaps) / m).otherwise(0.0))


def beat_regularity(beats: Column) -> Column:
    """1 - min(1, coefficient of variation of the gaps); null under four beats."""
    return F.when(F.size(beats) >= 4, 1.0 - F.least(F.lit(1.0), A.let(beat_gaps(beats), variation)))


def beat_stability(beats: Column) -> Column:
    """As regularity, but 0 under four beats."""
    return F.coalesce(beat_regularity(beats), F.lit(0.0))


def gated_loudness(blocks: Column) -> Column:
    """struct(lufs, range) of mean-square blocks: absolute gate -70, relative gate at a tenth of the mean, P95 - P10."""
    level = lambda p: -0.691 + 10.0 * F.log10(p + 1e-12)

    def of(kept):
        span = lambda levels: A.percentile(levels, 0.95) - A.percentile(levels, 0.10)
        return F.struct(
            F.when(F.size(kept) > 0, level(A.mean(kept))).otherwise(-70.0).alias("lufs"),
            F.when(F.size(kept) > 0, A.let(F.transform(kept, level), span)).otherwise(0.0).alias("range"),
        )

    gate = lambda loud: A.let(A.mean(loud) * 0.1, lambda floor: F.filter(loud, lambda p: p > floor))
    return A.let(A.let(F.filter(blocks, lambda p: level(p) > -70.0), gate), of)
