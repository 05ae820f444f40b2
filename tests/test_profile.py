from pyspark.sql import functions as F

from enrichkit.operators.profile import map_value_counts, value_counts
from tests.conftest import rows


def test_value_counts_all_fields_nulls_and_threshold(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, None), ("b", 1, "x"), ("a", 1, "y")], "s string, n int, t string"
    )
    got = rows(value_counts(df))
    assert got == [("n", "1", 3), ("s", "a", 3), ("t", None, 2)]
    assert rows(value_counts(df, include_nulls=False)) == [("n", "1", 3), ("s", "a", 3)]
    assert ("s", "b", 1) in rows(value_counts(df, ["s"], min_count=1))


def test_value_counts_hot_value(spark):
    df = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"))
    assert rows(value_counts(df)) == [("v", "hot", 3000)]


def test_map_value_counts(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"a": "1"},), ({"b": "3"},)], "doc map<string,string>")
    assert rows(map_value_counts(df, "doc")) == [("a", "1", 2)]
