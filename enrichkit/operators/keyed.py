"""Keep one row per key: the last by given order columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` for each key (what a keyed store keeps
    when the same key is written several times in that order).

    An aggregate (``max`` of a struct) instead of a ranking window: the partial aggregate
    reduces a hot key on the map side, so no task receives all rows of one key. Rows that
    tie on ``order_cols`` are ordered by their remaining columns, so the result is the same
    on every run.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    ordered = F.struct(
        F.struct(*[F.col(f"`{c}`") for c in order_cols]).alias("o"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("r"),
    )
    best = df.groupBy(*keys).agg(F.max(ordered).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.r.`{c}`").alias(c) for c in others])
