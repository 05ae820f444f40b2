"""The Bloom filter before shuffled joins."""

from pyspark.sql import functions as F

from enrichkit.operators.blocklist import dns_alerts, parse_matching_dns
from enrichkit.operators.bloom import bloom_filter, possible_matches
from enrichkit.plans import fixtures as fx
from tests.conftest import SMALL


def test_no_key_is_lost_and_few_others_pass(spark):
    keys = spark.range(0, 20_000).select(F.concat(F.lit("k"), "id").alias("k"))
    bloom = bloom_filter(keys, "k", 20_000)
    assert possible_matches(keys, "k", bloom).count() == 20_000
    others = spark.range(50_000, 150_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("__w9"))
    passed = possible_matches(others, "k", bloom)
    assert passed.columns == ["k", "__w9"] and passed.count() < 2_000


def test_a_smaller_bound_gives_fewer_bits_and_then_none(spark):
    keys = spark.range(0, 5_000).select(F.col("id").cast("string").alias("k"))
    tight = bloom_filter(keys, "k", 5_000, max_bytes=5_000)
    assert tight.n_blocks < bloom_filter(keys, "k", 5_000).n_blocks
    assert possible_matches(keys, "k", tight).count() == 5_000
    assert bloom_filter(keys, "k", 5_000, max_bytes=1_000) is None


def test_null_keys_and_an_empty_table(spark):
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in possible_matches(keys, "k", bloom_filter(keys, "k", 1)).collect()] == ["a"]
    assert possible_matches(keys, "k", bloom_filter(keys.limit(0), "k", 0)).count() == 0


def test_only_possible_matches_reach_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else Spark broadcasts the small test list itself
    spark.conf.set("enrichkit.broadcast.maxBytes", "10m")
    try:
        _check_shuffled_rows(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("enrichkit.broadcast.maxBytes")


def _check_shuffled_rows(spark):
    messages, listing = fx.dns_messages(spark, SMALL), fx.domain_list(spark, SMALL)
    alerts = dns_alerts(messages, listing, max_broadcast_bytes=0)
    rows = alerts.collect()
    plan = alerts._jdf.queryExecution().executedPlan()
    text = plan.toString().split("Initial Plan")[0]
    assert "__block" in text and "Exchange hashpartitioning(domain" in text
    # Rows written by the shuffle of the lookups: the alerts and some that passed by chance.
    shuffled = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange" and "message" in node.output().toString():
            shuffled.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    lines = parse_matching_dns(messages).count()
    assert len(shuffled) == 1 and len(rows) <= shuffled[0] <= len(rows) + 0.02 * lines
    assert sorted(map(tuple, rows)) == sorted(map(tuple, dns_alerts(messages, listing).collect()))
