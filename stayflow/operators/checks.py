"""Checks of a table's columns and contents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"{what} lacks columns {missing}")


def require_none(bad: DataFrame, message: str, examples: int = 5) -> None:
    """Raise with a few rows of ``bad`` if there are any."""
    rows = bad.limit(examples).collect()
    if rows:
        raise ValueError(f"{message}: {[r.asDict() for r in rows]}")
