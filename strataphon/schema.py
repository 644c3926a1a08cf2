"""Schemas of the stored tables as DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TRACK = (
    "audio_hash string, filepath string, filename string, track_number int, album_artist string, album string, artist string, "
    "title string, meta string, features string, predictions string"
)
TABLES = {
    "library_current": f"id bigint, {_TRACK}, collected_at timestamp, analyzed_at timestamp",
    "library_history": f"history_id bigint, library_id bigint, {_TRACK}, collected_at timestamp, analyzed_at timestamp, archived_at timestamp",
    "task_state": "file_path string, track_number int, status string, error_message string, updated_at timestamp",
    "failed_payloads": f"{_TRACK}, failed_at timestamp",
    "stem_wave": "track_id string, stem string, sr int, y array<float>",
    "cue_row": "file_id string, total_samples bigint, sr int, cue_text string",
    "tag_row": "filepath string, tags map<string,array<string>>",
    "metric_sample": "ts timestamp, name string, labels map<string,string>, value double",
}
STATUSES = ["PENDING", "RUNNING", "COMPLETED", "FAILED"]
STEMS = ["mix", "bass", "drums", "vocals", "other", "guitar", "piano"]


def struct(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], struct(name))
