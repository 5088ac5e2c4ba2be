"""Quayside: bring relational tables into a Parquet lake with Spark DataFrames."""

from quayside.errors import (
    JobNotFound,
    LandingMissing,
    QuaysideError,
    SchemaConflict,
    UnsupportedLayout,
)

__all__ = [
    "JobNotFound",
    "LandingMissing",
    "QuaysideError",
    "SchemaConflict",
    "UnsupportedLayout",
]
