"""Harmonicity conversions in their three variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import music
from ..session import table
from .registry import query

_LINES = "FROM lineitem"


def _nap(spark, d):
    # Discounts times ten less a half reach beyond both ends of [0, 1].
    nap = F.col("l_discount") * 15 - 0.25
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", nap.alias("nap"))


def _db(spark, d):
    db = F.col("l_quantity") * 16 - 400
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", db.alias("db"))


def _hnr(variant):
    def run(spark, d):
        return _nap(spark, d).select("l_orderkey", "l_linenumber", F.round(music.hnr_db(F.col("nap"), variant), 4).alias("hnr_db"))

    run.__name__ = f"q_hnr_db_{variant}"
    run.__doc__ = f"NAP to dB, variant {variant}."
    return run


def _inverse(variant):
    def run(spark, d):
        return _db(spark, d).select("l_orderkey", "l_linenumber", F.round(music.nap_from_hnr(F.col("db"), variant), 6).alias("nap"))

    run.__name__ = f"q_nap_inverse_{variant}"
    run.__doc__ = f"dB to NAP, variant {variant}."
    return run


_CLAMPED = "10 * log10(least(0.9999::DOUBLE, greatest(0.0001::DOUBLE, nap)) / (1 - least(0.9999::DOUBLE, greatest(0.0001::DOUBLE, nap))))"
_FORWARD = {
    "sql": f"CASE WHEN nap <= 0 THEN -40.0::DOUBLE ELSE {_CLAMPED} END",
    "core": f"CASE WHEN nap <= 0.0001 THEN -40.0::DOUBLE WHEN nap >= 0.9999 THEN 40.0::DOUBLE ELSE {_CLAMPED} END",
    "jig": f"CASE WHEN nap <= 0 THEN -40.0::DOUBLE ELSE {_CLAMPED} END",
}
_BACK = "pow(10::DOUBLE, x / 10) / (1 + pow(10::DOUBLE, x / 10))"
_BACKWARD = {
    "sql": "CASE WHEN db > 30 THEN 1.0::DOUBLE WHEN db < -30 THEN 0.0::DOUBLE ELSE " + _BACK.replace("x", "db") + " END",
    "jig": "CASE WHEN db / 10 > 30 THEN 1.0::DOUBLE WHEN db / 10 < -30 THEN 0.0::DOUBLE ELSE " + _BACK.replace("x", "db") + " END",
    "core": _BACK.replace("x", "least(40::DOUBLE, greatest(-40::DOUBLE, db))"),
}
for _v in ("sql", "core", "jig"):
    query(
        f"WITH t AS (SELECT l_orderkey, l_linenumber, l_discount * 15 - 0.25::DOUBLE AS nap {_LINES}) "
        f"SELECT l_orderkey, l_linenumber, round({_FORWARD[_v]}, 4) AS hnr_db FROM t"
    )(_hnr(_v))
    query(
        f"WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity * 16 - 400 AS db {_LINES}) "
        f"SELECT l_orderkey, l_linenumber, round({_BACKWARD[_v]}, 6) AS nap FROM t"
    )(_inverse(_v))


@query(f"""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_tax * 10 ELSE l_quantity - 60 END AS v,
  CASE WHEN l_linenumber % 3 = 0 THEN 0.5::DOUBLE END AS nap0, CASE WHEN l_linenumber % 3 = 0 THEN 0.0::DOUBLE END AS db0 {_LINES}),
c AS (SELECT *, least(0.9999::DOUBLE, greatest(0.0001::DOUBLE, v)) AS p FROM t)
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN v BETWEEN 0 AND 1 AND (nap0 IS NULL OR db0 IS NULL) THEN v
       WHEN NOT (v BETWEEN 0 AND 1) AND nap0 IS NULL THEN CASE WHEN v > 30 THEN 1.0::DOUBLE WHEN v < -30 THEN 0.0::DOUBLE ELSE
         pow(10::DOUBLE, v / 10) / (1 + pow(10::DOUBLE, v / 10)) END
       ELSE nap0 END, 6) AS nap,
  round(CASE WHEN v BETWEEN 0 AND 1 AND (nap0 IS NULL OR db0 IS NULL) THEN CASE WHEN v <= 0 THEN -40.0::DOUBLE ELSE 10 * log10(p / (1 - p)) END
       WHEN NOT (v BETWEEN 0 AND 1) AND nap0 IS NULL THEN v ELSE db0 END, 4) AS hnr_db
FROM c
""")
def q_hnr_migration(spark, d):
    """Old scalars that hold a NAP or a dB value, brought to both."""
    line = F.col("l_linenumber")
    value = F.when(line % 2 == 0, F.col("l_tax") * 10).otherwise(F.col("l_quantity") - 60)
    nap, db = F.when(line % 3 == 0, F.lit(0.5)), F.when(line % 3 == 0, F.lit(0.0))
    out = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", music.migrate_harmonicity(value, nap, db).alias("m")
    )
    return out.select("l_orderkey", "l_linenumber", F.round("m.nap", 6).alias("nap"), F.round("m.hnr_db", 4).alias("hnr_db"))
