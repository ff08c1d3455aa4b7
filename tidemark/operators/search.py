"""The search surface (B-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip_accents


def faceted(
    df: DataFrame,
    *,
    text: tuple[str, str] | None = None,
    one_of: dict[str, list] | None = None,
    holds: dict[str, object] | None = None,
    between: dict[str, tuple] | None = None,
) -> DataFrame:
    """B-01: rows that meet every facet: text contains, value in a list, array holds, value in a closed range."""
    for column, values in (one_of or {}).items():
        df = df.filter(F.col(column).isin(*values))
    for column, (lo, hi) in (between or {}).items():
        df = df.filter(F.col(column).between(lo, hi))
    for column, value in (holds or {}).items():
        df = df.filter(F.array_contains(column, value))
    if text:
        df = df.filter(F.contains(F.lower(strip_accents(F.col(text[0]))), F.lit(text[1].lower())))
    return df
