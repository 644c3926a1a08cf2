"""Spectral operators that need numpy: SQL can't express them, tests hold them against analytic signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features
from ..session import table
from .registry import query

_FAMILIES = list(features.REGISTRY)


def _tracks(spark, d):
    """Each embedding repeated to a second of sound at 8 kHz. A small file is one task; its rows are dealt before they grow."""
    y = F.flatten(F.array_repeat("embedding", 125))
    rows = table(spark, d, "embeddings").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.select("vec_id", F.lit("vocals").alias("stem"), F.lit(8000).alias("sr"), y.cast("array<float>").alias("y"))


def _family(name):
    def run(spark, d):
        only = {f: f == name for f in _FAMILIES}
        out = features.extract(_tracks(spark, d), only)
        scalars = F.transform_values("scalars", lambda _, v: F.round(v, 6))
        return out.select("vec_id", F.to_json(scalars).alias("scalars"), F.size("sequences").alias("n_sequences"))

    run.__name__ = f"q_features_{name}"
    run.__doc__ = f"The feature family {name}."
    return run


for _name in _FAMILIES:
    query()(_family(_name))


@query()
def q_separate(spark, d):
    """Stems of each track and their energies."""
    rows = features.separate(_tracks(spark, d).select("vec_id", "sr", "y"))
    energy = F.aggregate("y", F.lit(0.0), lambda a, x: a + x * x)
    return rows.select("vec_id", "stem", F.round(energy, 4).alias("energy"))


@query()
def q_classify(spark, d):
    """Class probabilities of a stand-in ensemble."""
    classes = {"gender": ["male", "female"], "danceability": ["danceable", "not_danceable"]}
    rows = features.classify(_tracks(spark, d).select("vec_id", "sr", "y"), classes)
    return rows.select("vec_id", F.explode("predictions").alias("class", "p"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 p AS (SELECT vec_id, e, list_transform(range(0, 65), lambda n: coalesce(list_sum(list_transform(e[1 : n], lambda x: x * x)), 0.0)) AS sq,
   list_transform(range(0, 64), lambda j: ((e[(j + 63) % 64 + 1] >= 0) <> (e[j + 1] >= 0))::INTEGER) AS d FROM v),
 q AS (SELECT *, list_transform(range(0, 64), lambda n: coalesce(list_sum(d[2 : n + 1]), 0)) AS dq, list_sum(d) AS dt FROM p),
 f AS (SELECT vec_id, e, sq, dq, dt, unnest(range(0, 16)) AS k FROM q),
 g AS (SELECT vec_id, e, sq, dq, dt, k, greatest(0, 512 * k - 1024) AS lo, least(8000, 512 * k + 1024) AS hi, greatest(0, 512 * k - 1023) AS s0, least(8000, 512 * k + 1023) AS s1 FROM f),
 r AS (SELECT vec_id, sqrt(((hi // 64 - lo // 64) * sq[65] + sq[hi % 64 + 1] - sq[lo % 64 + 1]) / 2048) AS rms,
   ((least(s1, 7999) // 64) * dt + dq[least(s1, 7999) % 64 + 1] - CASE WHEN s0 < 2 THEN 0 ELSE ((s0 - 1) // 64) * dt + dq[(s0 - 1) % 64 + 1] END
    + CASE WHEN s0 = 0 THEN (e[1] < 0)::INTEGER ELSE 0 END + CASE WHEN s1 = 8000 THEN (e[64] < 0)::INTEGER ELSE 0 END) / 2048.0::DOUBLE AS zcr FROM g),
 t AS (SELECT vec_id, sum(rms) AS total FROM r GROUP BY 1)
SELECT vec_id, round(avg(rms), 5) AS rms_mean, round(stddev_pop(rms), 5) AS rms_std, round(max(rms), 5) AS rms_peak, round(min(rms), 5) AS rms_min, round(median(rms), 5) AS rms_median,
 round(-sum(rms / total * log2(rms / total + 1e-10::DOUBLE)), 5) AS rms_entropy, round(avg(zcr), 5) AS zcr_mean, round(stddev_pop(zcr), 5) AS zcr_std FROM r JOIN t USING (vec_id) GROUP BY 1""")
def q_frame_levels(spark, d):
    """Levels and zero crossings of frames, from the feature pass."""
    only = {f: f in ("dynamics", "spectral") for f in _FAMILIES}
    out = features.extract(_tracks(spark, d), only)
    names = ["rms_mean", "rms_std", "rms_peak", "rms_min", "rms_median", "rms_entropy", "zcr_mean", "zcr_std"]
    return out.select("vec_id", *[F.round(F.col("scalars")[n], 5).alias(n) for n in names])


@query("""WITH s AS (SELECT vec_id, embedding, unnest(['mix', 'bass', 'drums', 'other', 'piano', 'guitar', 'vocals']) AS stem FROM embeddings),
 m AS (SELECT vec_id, round(125 * list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 2) AS energy FROM embeddings)
SELECT vec_id, count(*) AS stems, any_value(energy) AS mix_energy, any_value(energy) AS parts_energy FROM s JOIN m USING (vec_id) GROUP BY 1""")
def q_stem_sums(spark, d):
    """Separated stems add up to the mix: in number, and, since bands don't overlap, in energy."""
    rows = features.separate(_tracks(spark, d).select("vec_id", "sr", "y"))
    energy = F.aggregate("y", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    part = F.col("stem") != "mix"
    return rows.select("vec_id", "stem", energy.alias("en")).groupBy("vec_id").agg(
        F.count(F.lit(1)).alias("stems"), F.round(F.max(F.when(~part, F.col("en"))), 2).alias("mix_energy"),
        F.round(F.sum(F.when(part, F.col("en"))), 2).alias("parts_energy"),
    )
