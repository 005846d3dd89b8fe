"""Upload validation (B1-B3, H6). Column checks are plan-time, no job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockroute.config import MIN_UPLOAD_ROWS
from stockroute.sources.schemas import UPLOAD_REQUIRED


def missing_columns(df: DataFrame, required=None) -> list[str]:
    """H6/B1: required columns absent from the frame, in contract order."""
    names = [n for n, _ in UPLOAD_REQUIRED] if required is None else list(required)
    have = set(df.columns)
    return [c for c in names if c not in have]


def validate_upload(df: DataFrame, min_rows: int = MIN_UPLOAD_ROWS) -> tuple[bool, str]:
    """B1/B2: (ok, message). The row check reads at most ``min_rows`` rows."""
    missing = missing_columns(df)
    if missing:
        return False, f"columns not found: {', '.join(missing)}"
    if df.limit(min_rows).count() < min_rows:
        return False, f"fewer than {min_rows} rows"
    return True, ""
