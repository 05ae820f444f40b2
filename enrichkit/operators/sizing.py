"""Measured size bounds for the small side of a join.

A side is broadcast only after one aggregate pass has counted its rows and bytes;
the bound is Spark's own ``spark.sql.autoBroadcastJoinThreshold`` unless given.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}
_ROW_OVERHEAD = 16
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def _parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", text)
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS.get(m.group(2).lower() or "b", 1)


def broadcast_limit(df: DataFrame) -> int:
    """Bound for broadcasting a measured side, in bytes (-1 = never broadcast).

    ``enrichkit.broadcast.maxBytes`` when set, else Spark's
    ``spark.sql.autoBroadcastJoinThreshold``. The separate setting lets a cluster allow
    larger broadcasts for sides this package measures exactly, without raising Spark's
    threshold for sides it only estimates.
    """
    conf = df.sparkSession.conf
    own = conf.get("enrichkit.broadcast.maxBytes", None)
    return _parse_bytes(own if own else conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))


def _width(field: T.StructField):
    dt = field.dataType
    for kind, width in _FIXED_WIDTH.items():
        if isinstance(dt, kind):
            return F.lit(width)
    c = F.col(f"`{field.name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))


def row_width(df: DataFrame, cols: list[str] | None = None):
    """Column expression: the payload bytes of one row (fixed widths plus text lengths)."""
    wanted = set(cols) if cols is not None else None
    width = F.lit(_ROW_OVERHEAD)
    for f in df.schema.fields:
        if wanted is None or f.name in wanted:
            width = width + _width(f)
    return width


def measure(df: DataFrame) -> Size:
    """Exact row count and payload bytes of ``df`` in one aggregate job."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_width(df)).alias("bytes")).first()
    return Size(int(row["rows"]), int(row["bytes"] or 0))


def within_limit(df: DataFrame, size: Size, max_bytes: int | None = None) -> bool:
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    return limit >= 0 and size.bytes <= limit


def fits_broadcast(df: DataFrame, max_bytes: int | None = None, size: Size | None = None) -> bool:
    """True when ``df`` is measured (or ``size`` says it is) within the broadcast bound."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit < 0:
        return False
    return (size or measure(df)).bytes <= limit
