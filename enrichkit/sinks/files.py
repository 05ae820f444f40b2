"""File, document and catalogue writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from enrichkit.functions.records import row_text
from enrichkit.operators.keyed import keep_last
from enrichkit.sources.files import CSV_OPTIONS


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = False,
    mode: str = "errorifexists",
    multiline: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """Write CSV; by default without header and failing when ``path`` exists.

    ``read_csv`` with ``options={"lineSep": "\\n"}`` reads every value back as it was. A text with a line break fails the write
    unless ``multiline`` is set, which the reader must set as well.
    """
    if not multiline:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        df = df.withColumns({c: _one_line(c) for c in texts}) if texts else df
    given = CSV_OPTIONS | (options or {})
    df.write.mode(mode).options(**given).option("header", str(header).lower()).csv(path)


def _one_line(name: str) -> Column:
    c = F.col(f"`{name}`")
    broken = F.raise_error(F.lit(f"line break in column {name}: write and read with multiline=True"))
    return F.when(c.contains("\n") | c.contains("\r"), broken).otherwise(c)


def write_text(
    df: DataFrame,
    path: str,
    *,
    style: str = "row",
    sep: str = ",",
    mode: str = "errorifexists",
) -> None:
    """Write one text line per row (``[v1,v2,...]`` by default, see ``row_text``)."""
    df.select(row_text(df, sep, style).alias("value")).write.mode(mode).text(path)


def write_documents(
    df: DataFrame,
    resource: str,
    *,
    fmt: str = "json",
    mode: str = "append",
    options: dict[str, str] | None = None,
) -> None:
    """Write rows as documents through any DataFrame sink (JSON lines by default; a
    search-index connector's format name and options when its jar is present)."""
    df.write.format(fmt).mode(mode).options(**(options or {})).save(resource)


def keyed_overwrite(
    df: DataFrame,
    path: str,
    key: str | list[str],
    order_cols: list[str],
    *,
    fmt: str = "parquet",
) -> None:
    """Replace the store at ``path`` with one row per key, the last by ``order_cols``
    (drop-and-recreate load where a repeated key keeps its last row)."""
    keep_last(df, key, order_cols).write.mode("overwrite").format(fmt).save(path)


def create_table_as(
    df: DataFrame,
    name: str,
    *,
    limit: int | None = None,
    order_by: list[str] | None = None,
    path: str | None = None,
    mode: str = "errorifexists",
    fmt: str = "parquet",
) -> DataFrame:
    """``CREATE TABLE name AS SELECT ... [ORDER BY ...] [LIMIT n]``; returns the table.

    ``order_by`` with ``limit`` is a top-k (per-partition top-k, then a merge of the
    k-row lists), so no task sees more than k rows per input partition. Without an
    order the rows kept by ``limit`` are whichever come first. With ``path`` the table's
    files go there (an external table in shared storage).
    """
    out = df
    if order_by:
        out = out.orderBy(*[F.col(c) for c in order_by])
    if limit is not None:
        out = out.limit(limit)
    writer = out.write.mode(mode).format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
