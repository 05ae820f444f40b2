"""Message-bus records (key, value) -> typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_values_to_rows(
    df: DataFrame,
    schema: StructType | str,
    value_col: str = "value",
    keep: list[str] | None = None,
) -> DataFrame:
    """Parse JSON text in ``value_col`` with a declared schema.

    The message key and other transport columns are dropped unless listed in ``keep``.
    Parsing is PERMISSIVE: a record lacking a field gets null for it, and text that is
    not JSON gives a row of nulls instead of failing the batch.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), schema, {"mode": "PERMISSIVE"})
    return df.select(*(keep or []), parsed.alias("__rec")).select(*(keep or []), "__rec.*")


def json_values_to_records(
    df: DataFrame, fields: dict[str, str], value_col: str = "value", record: str = "record", keep: list[str] | None = None
) -> DataFrame:
    """JSON objects without a declared schema: ``record`` holds all fields of an object, whatever
    they are, as a map from name to ``VARIANT``; ``fields`` names some to read out, with their
    types (null where a record lacks one or it cannot be read as that type).

    Text that is not a JSON object has a null ``record`` and null fields.
    """
    parsed = df.select(*(keep or []), F.try_parse_json(F.col(value_col).cast("string")).alias("__variant"))
    objects = parsed.withColumn(record, F.expr("try_cast(__variant AS map<string, variant>)"))
    read = [F.try_variant_get("__variant", f"$['{name}']", kind).alias(name) for name, kind in fields.items()]
    return objects.select(*(keep or []), record, *[F.when(F.col(record).isNotNull(), c).alias(n) for c, n in zip(read, fields)])
