"""Whole-row and record-shape helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def quoted(name: str) -> str:
    """A column name as a reference that may hold dots and backticks."""
    return "`" + name.replace("`", "``") + "`"


def row_json(df: DataFrame, ignore_null_fields: bool = True) -> Column:
    """The whole row as one JSON object (field names = column names, in order).

    Null fields are left out by default; ``ignore_null_fields=False`` writes them as null.
    """
    options = {"ignoreNullFields": "true" if ignore_null_fields else "false"}
    return F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]), options)


def row_text(df: DataFrame, sep: str = ",", style: str = "row", null_text: str = "null") -> Column:
    """The whole row as one line of text.

    ``style="row"`` gives ``[v1,v2,...]`` (nulls as ``null_text``), ``style="plain"`` gives
    ``v1,v2,...`` with nulls as empty fields.
    """
    if style == "row":
        parts = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit(null_text)) for c in df.columns]
        return F.concat(F.lit("["), F.concat_ws(sep, *parts), F.lit("]"))
    if style == "plain":
        parts = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in df.columns]
        return F.concat_ws(sep, *parts)
    raise ValueError(f"unknown style {style!r}")


def null_to_empty(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace nulls by '' in the given (default: all string) columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.coalesce(F.col(quoted(c)), F.lit("")) for c in cols})


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def pick_field(c: Column | str, key: str, json_text: bool = False) -> Column:
    """One field of a map column, or of a JSON object held as text (``json_text=True``)."""
    c = F.col(c) if isinstance(c, str) else c
    if json_text:
        c = F.from_json(c, "map<string,string>")
    return c.getItem(key)
