"""Registered queries (name → Spark DataFrame builder) and their DuckDB oracles."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import q_ingest, q_batches, q_models, q_scoring, q_stream  # noqa: F401,E401  (modules register their queries)
