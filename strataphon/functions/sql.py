"""SQL functions for analysts who write SQL: inlined by Catalyst, so they cost nothing over the expressions."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "calc_hnr_db": (
        "nap DOUBLE",
        "CASE WHEN nap IS NULL THEN NULL WHEN nap <= 0 THEN -40.0D ELSE "
        "round(10 * log10(least(0.9999D, greatest(1e-4D, nap)) / (1 - least(0.9999D, greatest(1e-4D, nap)))), 4) END",
    ),
    "calc_nap_from_hnr_db": (
        "db DOUBLE",
        "CASE WHEN db IS NULL THEN NULL WHEN db > 30 THEN 1.0D WHEN db < -30 THEN 0.0D ELSE "
        "round(pow(10D, db / 10) / (1 + pow(10D, db / 10)), 6) END",
    ),
}


def register(spark: SparkSession) -> None:
    for name, (argument, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS DOUBLE RETURN {body}")
