"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from . import admission, documents, extension, files, harmonicity, series, spectral, state, streams, tagging, telemetry  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
