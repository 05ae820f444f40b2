"""Reading the input tables and keeping Arrow batches small."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Bound the bytes of an Arrow batch that goes to Python (rows alone are bounded by
    default, and some texts are very long). A smaller setting of the session stays."""
    if int(spark.conf.get(_BATCH_BYTES, str(2**31 - 1))) > limit:
        spark.conf.set(_BATCH_BYTES, str(limit))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
