"""Schema checks made on the driver, before any job starts."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class MissingColumns(ValueError):
    """The table lacks columns that the operator needs."""


def require_columns(df: DataFrame, names: Iterable[str] = (), min_cols: int = 0,
                    what: str = "table") -> DataFrame:
    """S-03: return df unchanged, or raise with the columns that are missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"{what}: missing column(s) {missing}; it has {df.columns}")
    if len(df.columns) < min_cols:
        raise MissingColumns(f"{what}: {len(df.columns)} column(s), at least {min_cols} needed; "
                             "is the separator right?")
    return df
