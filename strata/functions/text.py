"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(column: str | Column) -> Column:
    """Strip surrounding spaces; a string that is then empty becomes NULL (tabs are kept)."""
    return F.nullif(F.trim(column), F.lit(""))


def split_list(text: str | None) -> list[str]:
    """``"a, b"`` -> ``["a", "b"]``; used for the comma lists of the config table."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]
