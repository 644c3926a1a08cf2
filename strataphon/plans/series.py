"""Array and time-series operators as expressions, on embeddings as sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import music
from ..session import table
from .registry import query

_E = "list_transform(embedding, lambda x: x::DOUBLE)"


def _vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", A.doubles(F.col("embedding")).alias("e"))


def _rounded(a, places):
    return F.transform(a, lambda x: F.round(x, places))


@query(f"""WITH t AS (SELECT vec_id, {_E} AS e FROM embeddings), p AS (SELECT vec_id, e, i, i * 63 / 31.0::DOUBLE AS pt FROM t, unnest(range(32)) u(i)),
 q AS (SELECT vec_id, i, e[least(floor(pt), 63)::INTEGER + 1] AS lo, e[least(floor(pt)::INTEGER + 1, 63) + 1] AS hi, pt - floor(pt) AS f FROM p)
SELECT vec_id, i::INTEGER AS i, round(lo + (hi - lo) * f, 5) AS v FROM q""")
def q_resample32(spark, d):
    """Linear interpolation to 32 points."""
    return _vectors(spark, d).select("vec_id", F.posexplode(_rounded(A.resample(F.col("e")), 5)).alias("i", "v"))


@query(f"""WITH t AS (SELECT vec_id, unnest({_E}) AS x FROM embeddings)
SELECT vec_id, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(max(abs(x)), 6) AS peak, round(max(x), 6) AS top, round(min(x), 6) AS low, round(median(x), 6) AS mid,
 round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.75), 6) AS p75 FROM t GROUP BY 1""")
def q_array_stats(spark, d):
    """Statistics of arrays without unnesting."""
    e = F.col("e")
    parts = {
        "mean": A.mean(e), "std": A.std(e), "peak": A.peak(e), "top": F.array_max(e), "low": F.array_min(e),
        "mid": A.percentile(e, 0.5), "p25": A.percentile(e, 0.25), "p75": A.percentile(e, 0.75),
    }
    return _vectors(spark, d).select("vec_id", *[F.round(v, 6).alias(k) for k, v in parts.items()])


@query(f"""WITH t AS (SELECT vec_id, unnest(list_transform({_E}, lambda x: abs(x))) AS x FROM embeddings), s AS (SELECT vec_id, x, sum(x) OVER (PARTITION BY vec_id) AS t FROM t)
SELECT vec_id, round(sum(-(x / t) * log2(x / t + 1e-10::DOUBLE)), 5) AS entropy FROM s GROUP BY 1""")
def q_entropy(spark, d):
    return _vectors(spark, d).select("vec_id", F.round(A.entropy(F.col("e")), 5).alias("entropy"))


@query(f"""WITH t AS (SELECT vec_id, unnest({_E}) AS x FROM embeddings), m AS (SELECT vec_id, x - avg(x) OVER (PARTITION BY vec_id) AS c FROM t)
SELECT vec_id, round(avg(c*c*c) / pow(avg(c*c), 1.5), 5) AS skew, round(avg(c*c*c*c) / pow(avg(c*c), 2) - 3, 5) AS kurt FROM m GROUP BY 1""")
def q_series_moments(spark, d):
    e = F.col("e")
    return _vectors(spark, d).select("vec_id", F.round(A.skewness(e), 5).alias("skew"), F.round(A.kurtosis(e), 5).alias("kurt"))


@query(f"""WITH t AS (SELECT vec_id, label, vec_id % 7 = 0 AS mix, list_sum(list_transform({_E}, lambda x: x * x)) AS en FROM embeddings)
SELECT vec_id, CASE WHEN NOT mix THEN round((en + 1e-10::DOUBLE) / (sum(en) FILTER (WHERE NOT mix) OVER (PARTITION BY label) + 2e-10::DOUBLE), 8) END AS ratio FROM t""")
def q_energy_ratio(spark, d):
    """Share of a stem in its track's energy, the mix left out; the sums are aggregated first, so a hot group does not meet
    in one task."""
    mix, e = F.col("vec_id") % 7 == 0, F.col("e")
    rows = _vectors(spark, d).select("vec_id", "label", mix.alias("mix"), A.dot(e, e).alias("en"))
    sums = rows.where("not mix").groupBy("label").agg(F.sum("en").alias("s"))
    out = rows.join(sums, rows["label"].eqNullSafe(sums["label"]), "left")
    ratio = F.round((F.col("en") + 1e-10) / (F.col("s") + 2e-10), 8)
    return out.select("vec_id", F.when(~F.col("mix"), ratio).alias("ratio"))


@query(f"""WITH t AS (SELECT vec_id, {_E} AS e FROM embeddings)
SELECT vec_id, round((SELECT sum(((e[i] >= 0) <> (e[i-1] >= 0))::INTEGER) FROM unnest(range(2, 65)) u(i)) / 63.0::DOUBLE, 6) AS zcr,
 round(CASE WHEN sqrt(list_avg(list_transform(e, lambda x: x * x))) < 1e-9 THEN 0 ELSE list_max(list_transform(e, lambda x: abs(x))) / sqrt(list_avg(list_transform(e, lambda x: x * x))) END, 5) AS crest,
 round(list_avg(list_transform(e, lambda x: x * x)), 6) AS energy FROM t""")
def q_zcr_crest(spark, d):
    """Zero crossings, crest factor and energy."""
    e = F.col("e")
    return _vectors(spark, d).select(
        "vec_id", F.round(A.zero_crossing_rate(e), 6).alias("zcr"), F.round(A.crest(e), 5).alias("crest"), F.round(A.energy(e), 6).alias("energy")
    )


@query(f"""WITH t AS (SELECT vec_id, {_E} AS e FROM embeddings), k AS (SELECT vec_id, lag, (SELECT sum(e[i] * e[i + lag]) FROM unnest(range(1, 65 - lag)) u(i)) AS r,
 list_sum(list_transform(e, lambda x: x * x)) AS z FROM t, unnest(range(2, 16)) v(lag))
SELECT vec_id, round(greatest(0, least(1, max(r) / max(z))), 6) AS nap FROM k GROUP BY 1""")
def q_autocorr_nap(spark, d):
    """Normalised autocorrelation peak."""
    nap = A.normalised_autocorrelation_peak(F.col("e"), 2, 16)
    return _vectors(spark, d).select("vec_id", F.round(nap, 6).alias("nap"))


_PROFILES = ", ".join(
    f"({i}, '{k}', '{s}', [{', '.join(f'{x!r}::DOUBLE' for x in p)}])" for i, (k, s, p) in enumerate(music.key_candidates())
)


@query(f"""WITH p(i, key, scale, w) AS (VALUES {_PROFILES}), t AS (SELECT vec_id, list_transform(embedding[1:12], lambda x: abs(x::DOUBLE)) AS c FROM embeddings),
 s AS (SELECT vec_id, i, key, scale, list_inner_product(c, w) / sqrt(list_inner_product(c, c)) AS v FROM t, p),
 r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS n FROM s)
SELECT vec_id, key, scale, round(v, 5) AS strength FROM r WHERE n = 1""")
def q_key_estimate(spark, d):
    """Key and scale of a mean chroma by 24 profiles."""
    chroma = F.transform(F.slice("e", 1, 12), lambda x: F.abs(x))
    rows = _vectors(spark, d).select("vec_id", music.key_estimate(chroma).alias("k"))
    return rows.select("vec_id", "k.key", "k.scale", F.round("k.strength", 5).alias("strength"))


_TRIADS = ", ".join(f"({i}, '{n}', {s})" for i, (n, s) in enumerate(music.triads().items()))


@query(f"""WITH p(i, name, s) AS (VALUES {_TRIADS}), t AS (SELECT vec_id, f, list_transform(embedding[12*f+1:12*f+12], lambda x: abs(x::DOUBLE)) AS c FROM embeddings, unnest(range(5)) u(f)),
 v AS (SELECT vec_id, f, i, name, (c[s[1]+1] / list_max(c)) + (c[s[2]+1] / list_max(c)) + (c[s[3]+1] / list_max(c)) AS v FROM t, p), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id, f ORDER BY v DESC, i) AS n FROM v)
SELECT vec_id, f::INTEGER AS frame, name AS chord FROM r WHERE n = 1""")
def q_chord_sequence(spark, d):
    """Best triad of each frame."""
    mags = F.transform("e", lambda x: F.abs(x))
    chords = F.transform(A.frames(mags, 12), lambda f: music.chord_name(music.chord_index(f)))
    return _vectors(spark, d).select("vec_id", F.posexplode(chords).alias("frame", "chord"))


@query("""SELECT vec_id, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][list_position(embedding[1:12], list_max(embedding[1:12]))] AS pitch FROM embeddings""")
def q_dominant_pitch(spark, d):
    return _vectors(spark, d).select("vec_id", music.dominant_pitch(F.slice("e", 1, 12)).alias("pitch"))


_BEATS = """b AS (SELECT user_id, list(epoch_us(ts) / 1e6::DOUBLE ORDER BY ts) AS b FROM events GROUP BY 1),
 g AS (SELECT user_id, i, b[i + 2] - b[i + 1] AS gap, len(b) AS n FROM b, unnest(range(len(b) - 1)) u(i))"""


def _beats(spark, d):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(seconds)).alias("b"))


@query(f"""WITH {_BEATS}, s AS (SELECT user_id, max(n) AS n, avg(gap) FILTER (WHERE i % 2 = 0) / avg(gap) FILTER (WHERE i % 2 = 1) AS swing, stddev_pop(gap) / avg(gap) AS cv FROM g GROUP BY 1)
SELECT user_id, CASE WHEN n < 4 THEN 1.0::DOUBLE ELSE round(swing, 5) END AS swing, CASE WHEN n < 4 THEN 0.0::DOUBLE ELSE round(cv, 5) END AS sync,
 CASE WHEN n < 4 THEN 'straight' WHEN swing > 1.4 THEN 'shuffle' WHEN swing > 1.15 THEN 'swing' ELSE 'straight' END AS groove FROM s""")
def q_groove(spark, d):
    """Swing and syncopation of beat times."""
    rows = _beats(spark, d).where(F.size("b") > 1).select("user_id", music.groove(F.col("b")).alias("g"))
    return rows.select("user_id", F.round("g.swing_ratio", 5).alias("swing"), F.round("g.syncopation_index", 5).alias("sync"), F.col("g.groove_class").alias("groove"))


@query(f"""WITH {_BEATS} SELECT user_id, CASE WHEN max(n) >= 4 THEN round(1 - least(1, stddev_pop(gap) / avg(gap)), 5) END AS regularity,
 CASE WHEN max(n) >= 4 THEN round(1 - least(1, stddev_pop(gap) / avg(gap)), 5) ELSE 0 END AS stability FROM g GROUP BY 1""")
def q_beat_regularity(spark, d):
    rows = _beats(spark, d).where(F.size("b") > 1)
    return rows.select("user_id", F.round(music.beat_regularity(F.col("b")), 5).alias("regularity"), F.round(music.beat_stability(F.col("b")), 5).alias("stability"))


@query(f"""WITH t AS (SELECT vec_id, unnest(list_transform({_E}, lambda x: x * x)) AS p FROM embeddings), a AS (SELECT * FROM t WHERE -0.691 + 10 * log10(p + 1e-12::DOUBLE) > -70),
 k AS (SELECT *, avg(p) OVER (PARTITION BY vec_id) * 0.1::DOUBLE AS floor FROM a), r AS (SELECT vec_id, p, -0.691::DOUBLE + 10 * log10(p + 1e-12::DOUBLE) AS l FROM k WHERE p > floor)
SELECT vec_id, round(-0.691::DOUBLE + 10 * log10(avg(p) + 1e-12::DOUBLE), 5) AS lufs, round(quantile_cont(l, 0.95) - quantile_cont(l, 0.10), 5) AS range FROM r GROUP BY 1""")
def q_lufs_gate(spark, d):
    """Gated loudness and its range."""
    blocks = F.transform("e", lambda x: x * x)
    rows = _vectors(spark, d).select("vec_id", music.gated_loudness(blocks).alias("g"))
    return rows.select("vec_id", F.round("g.lufs", 5).alias("lufs"), F.round("g.range", 5).alias("range"))


@query("""WITH f AS (SELECT vec_id, i, list_transform(embedding[8*i+1:8*i+8], lambda x: x::DOUBLE) AS w FROM embeddings, unnest(range(8)) u(i))
SELECT a.vec_id, a.i::INTEGER AS i, b.i::INTEGER AS j, round(greatest(0, least(1, list_inner_product(a.w, b.w) / sqrt(list_inner_product(a.w, a.w) * list_inner_product(b.w, b.w)))), 5) AS s
FROM f a JOIN f b ON a.vec_id = b.vec_id AND a.i < b.i""")
def q_ssm_pairs(spark, d):
    """Self-similarity of a sequence's frames, within its row."""
    f = F.col("f")
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(6)),
            lambda i: F.transform(F.sequence(i + 1, F.lit(7)), lambda j: F.struct(i.alias("i"), j.alias("j"))),
        )
    )
    rows = _vectors(spark, d).select("vec_id", A.frames(F.col("e"), 8).alias("f")).select("vec_id", "f", F.inline(pairs))
    a, b = F.get(f, F.col("i")), F.get(f, F.col("j"))
    cosine = A.dot(a, b) / F.sqrt(A.dot(a, a) * A.dot(b, b))
    return rows.select("vec_id", "i", "j", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)), 5).alias("s"))


@query("""SELECT vec_id, i::INTEGER AS i, CASE WHEN (vec_id + i) % 3 < 2 THEN 0.0::DOUBLE ELSE round(embedding[i+1]::DOUBLE, 6) END AS v FROM embeddings, unnest(range(4)) u(i)""")
def q_nan_policy(spark, d):
    """NaN and infinities become 0 where numbers are needed."""
    bad = F.transform(
        F.slice("e", 1, 4),
        lambda x, i: F.when((F.col("vec_id") + i) % 3 == 0, F.lit(float("nan"))).when((F.col("vec_id") + i) % 3 == 1, F.lit(float("inf"))).otherwise(x),
    )
    return _vectors(spark, d).select("vec_id", F.posexplode(_rounded(A.finite(bad), 6)).alias("i", "v"))


@query(f"""WITH t AS (SELECT vec_id, {_E} AS e FROM embeddings) SELECT vec_id, i::INTEGER AS i, round(CASE WHEN i = 0 THEN 0.0::DOUBLE ELSE e[i+1] - e[i] END, 6) AS delta FROM t, unnest(range(64)) u(i)""")
def q_delta_series(spark, d):
    return _vectors(spark, d).select("vec_id", F.posexplode(_rounded(A.deltas(F.col("e")), 6)).alias("i", "delta"))


@query(f"""WITH t AS (SELECT vec_id, {_E} AS e FROM embeddings) SELECT vec_id, i::INTEGER AS i, round((e[i+1] + e[i+33]) / 2, 6) AS mono FROM t, unnest(range(32)) u(i)""")
def q_downmix(spark, d):
    """Two channels to their mean."""
    mono = A.downmix(F.slice("e", 1, 32), F.slice("e", 33, 32))
    return _vectors(spark, d).select("vec_id", F.posexplode(_rounded(mono, 6)).alias("i", "mono"))


@query(f"""WITH t AS (SELECT vec_id, {_E} AS e FROM embeddings), r AS (SELECT vec_id, lag, (SELECT sum(e[i] * e[i + lag]) FROM unnest(range(1, 65 - lag)) u(i)) AS r FROM t, unnest(range(0, 32)) v(lag))
SELECT vec_id, lag::INTEGER AS lag, round(r / max(r) OVER (PARTITION BY vec_id), 5) AS ac FROM r""")
def q_onset_autocorr(spark, d):
    """Autocorrelation at 32 lags over its maximum."""
    r = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: A.autocorrelation(F.col("e"), k))
    rows = _vectors(spark, d).select("vec_id", r.alias("r"))
    return rows.select("vec_id", F.posexplode(F.transform("r", lambda x: F.round(x / F.array_max("r"), 5))).alias("lag", "ac"))


@query("""SELECT p_partkey, round(greatest(0, least(24, 26.81::DOUBLE / (1 + 1960.0::DOUBLE / (p_retailprice * 10 + 1e-6::DOUBLE)) - 0.53)), 5) AS bark FROM part""")
def q_bark(spark, d):
    """Critical band rate of a frequency."""
    return table(spark, d, "part").select("p_partkey", F.round(music.bark(F.col("p_retailprice") * 10), 5).alias("bark"))
