import pytest
from pyspark.sql import functions as F

from enrichkit.operators.joins import hot_keys, skew_aware_join
from enrichkit.operators.sizing import fits_broadcast, measure
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    # key 7 holds a third of all rows; keys 1000.. have no partner
    return spark.range(0, 6000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1100).alias("k")
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def test_measure_and_bound(spark, lookup):
    size = measure(lookup)
    assert size.rows == 1000 and size.bytes > 16000
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_bytes=100)


def test_hot_keys(skewed):
    assert [r[0] for r in hot_keys(skewed, ["k"], min_rows=100).collect()] == [7]
    # an even share of the shuffle partitions: only the key with a third of the rows is above it
    assert [r[0] for r in hot_keys(skewed, ["k"]).collect()] == [7]
    assert hot_keys(skewed.where("k <> 7"), ["k"]) is None


def test_every_hot_key_is_found(spark):
    many = spark.range(0, 6000).select((F.col("id") % 300).alias("k"))
    assert hot_keys(many, ["k"], min_rows=20).count() == 300
    assert hot_keys(many.where("k < 0"), ["k"]) is None


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(
    "kwargs",
    [
        {},  # broadcast
        {"max_broadcast_bytes": 0, "hot_key_rows": 10**9},  # plain shuffle join
        {"max_broadcast_bytes": 0, "hot_key_rows": 100},  # hot keys split, hot part by salting
    ],
)
def test_skew_aware_join_equals_plain_join(skewed, lookup, how, kwargs):
    expected = rows(skewed.join(lookup, "k", how), "id", "k", "v")
    got = rows(skew_aware_join(skewed, lookup, ["k"], how, **kwargs), "id", "k", "v")
    assert got == expected


def test_hot_part_broadcast_when_small(spark, skewed, lookup):
    # whole lookup over the bound, its hot rows (one key) within it
    got = rows(skew_aware_join(skewed, lookup, ["k"], "inner", max_broadcast_bytes=200, hot_key_rows=100), "id", "k", "v")
    assert got == rows(skewed.join(lookup, "k"), "id", "k", "v")


def test_extra_condition(spark, skewed, lookup):
    cond = F.col("id") > F.col("v")
    expected = rows(skewed.join(lookup, "k").where(cond), "id", "k", "v")
    for kwargs in ({}, {"max_broadcast_bytes": 0, "hot_key_rows": 100}):
        assert rows(skew_aware_join(skewed, lookup, ["k"], "inner", cond, **kwargs), "id", "k", "v") == expected


def test_left_join_null_keys_bypass_the_shuffle(spark, lookup):
    big = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1100).alias("k")
    )
    expected = rows(big.join(lookup, "k", "left"), "id", "k", "v")
    for kwargs in ({"max_broadcast_bytes": 0, "hot_key_rows": 10**9}, {"max_broadcast_bytes": 0, "hot_key_rows": 50}):
        assert rows(skew_aware_join(big, lookup, ["k"], "left", **kwargs), "id", "k", "v") == expected


def test_hot_key_detection_defaults(spark, skewed, lookup):
    from enrichkit.operators.joins import _detect_by_default

    assert not _detect_by_default(skewed)  # AQE's skew split is on in the test session
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert _detect_by_default(skewed)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    expected = rows(skewed.join(lookup, "k"), "id", "k", "v")
    got = rows(skew_aware_join(skewed, lookup, ["k"], max_broadcast_bytes=0, detect_hot_keys=True, hot_key_rows=100), "id", "k", "v")
    assert got == expected


def test_own_broadcast_bound(spark, lookup):
    spark.conf.set("enrichkit.broadcast.maxBytes", "100b")
    try:
        assert not fits_broadcast(lookup)
    finally:
        spark.conf.unset("enrichkit.broadcast.maxBytes")
    assert fits_broadcast(lookup)


def test_a_side_over_the_bound_is_not_broadcast_by_an_estimate(spark):
    """Spark's estimate does not see what an explode adds."""
    small = spark.range(0, 4).select(F.explode(F.sequence(F.lit(0), F.lit(499))).alias("k"), F.col("id").alias("v"))
    big = spark.range(0, 2000).select((F.col("id") % 700).alias("k"), "id")
    for how in ("inner", "left"):
        out = skew_aware_join(big, small.withColumn("k", F.col("k").cast("bigint")), ["k"], how, max_broadcast_bytes=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert out.where("v is not null").count() == 1500 * 4
