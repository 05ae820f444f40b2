"""File and catalogue readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from enrichkit.functions.records import lower_columns


CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Stands for an empty unquoted field, so that '' stays apart from null.
_NO_TEXT = "\x00"


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool = False,
    schema: StructType | str | None = None,
    names: list[str] | None = None,
    lowercase_columns: bool = False,
    multiline: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV with or without a header row.

    Quotes inside a quoted field are doubled, blanks are kept, an empty field is null and a
    quoted empty one is an empty text. ``multiline`` allows line breaks in quoted fields; such
    a file cannot be split, so one task reads it whole: keep its files small. Line ends are
    found by the reader, and CR LF inside a text becomes LF; for files with LF line ends, such
    as ``write_csv`` makes, ``options={"lineSep": "\\n"}`` keeps both apart.

    ``schema`` types the columns (no inference pass over the data); ``names`` renames
    positional columns of a headerless file; ``lowercase_columns`` lower-cases header names.
    Without a schema every column is a string, as in the file.
    """
    given = CSV_OPTIONS | {"nullValue": _NO_TEXT, "emptyValue": "", "multiLine": str(multiline).lower()} | (options or {})
    reader = spark.read.options(**given).option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if names is not None:
        df = df.toDF(*names)
    if lowercase_columns:
        df = lower_columns(df)
    return df


def read_documents(
    spark: SparkSession,
    resource: str,
    *,
    fmt: str = "json",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read a document collection through any DataFrame source.

    ``fmt`` names the source (``json`` for JSON-lines files; a search-index connector's
    format name when its jar is on the classpath), ``options`` are passed through.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(resource)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table (metastore or session catalogue)."""
    return spark.table(name)
