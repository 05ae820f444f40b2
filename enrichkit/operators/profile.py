"""Per-field value counts in one pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.records import quoted


def value_counts(
    df: DataFrame,
    cols: list[str] | None = None,
    min_count: int = 2,
    include_nulls: bool = True,
    field_col: str = "field",
    value_col: str = "val",
    count_col: str = "count",
) -> DataFrame:
    """``(field, val, count)`` for every value of every column seen ``min_count`` times or more.

    All columns are counted in a single scan: the rows are unpivoted to (field, value)
    pairs and aggregated once, with the partial (map-side) aggregate collapsing repeated
    values, hot ones included, before the shuffle. Values are compared as text; null is
    a value of its own unless ``include_nulls=False``.
    """
    cols = list(cols or df.columns)
    text = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in cols])
    pairs = text.unpivot([], [quoted(c) for c in cols], field_col, value_col)
    if not include_nulls:
        pairs = pairs.where(F.col(value_col).isNotNull())
    counts = pairs.groupBy(field_col, value_col).agg(F.count(F.lit(1)).alias(count_col))
    return counts.where(F.col(count_col) >= min_count)


def map_value_counts(
    df: DataFrame,
    map_col: str,
    min_count: int = 2,
    field_col: str = "field",
    value_col: str = "val",
    count_col: str = "count",
) -> DataFrame:
    """Value counts over schemaless documents held as a ``map<string, string>`` column:
    every key present in any document is a field."""
    pairs = df.select(F.explode(F.col(map_col)).alias(field_col, value_col))
    counts = pairs.groupBy(field_col, value_col).agg(F.count(F.lit(1)).alias(count_col))
    return counts.where(F.col(count_col) >= min_count)
