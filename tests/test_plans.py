"""Plan-shape checks: the physical plans the scale design relies on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from enrichkit.operators.keyed import keep_last
from enrichkit.operators.ranges import range_lookup
from enrichkit.plans import fixtures as fx
from tests.conftest import SMALL

Q = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucket_lookup_is_a_broadcast_hash_join(spark):
    p = plan(Q["ip_range_bucket"](spark, SMALL))
    assert "BroadcastHashJoin" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    # the key side is not shuffled: the only exchange is the broadcast of the ranges
    assert "Exchange hashpartitioning" not in p


def test_prefix_lookup_is_map_only(spark):
    p = plan(Q["ip_prefix_expand"](spark, SMALL))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    # exchanges appear only under the broadcast (grouping the small range table)
    main = p.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main


def test_blocklist_join_broadcasts_the_reduced_list(spark):
    p = plan(Q["dns_blocklist_join"](spark, SMALL))
    assert re.search(r"BroadcastHashJoin \[domain#\d+\]", p)
    assert "collect_list" not in p and "Exchange hashpartitioning" not in p  # counted per host and pinned before the join


def test_value_counts_one_shuffle_with_partial_aggregate(spark):
    p = plan(Q["value_counts"](spark, SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "partial_count" in p and "Expand" in p


def test_keep_last_combines_before_the_shuffle(spark):
    p = plan(keep_last(fx.keyed_rows(spark, SMALL), "key", ["l_linenumber"]))
    before_exchange = p.split("Exchange hashpartitioning")[1]
    assert "partial_max" in before_exchange
    assert "Window" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(Q["value_count_one_field"](spark, SMALL))
    assert "ReadSchema: struct<event_type:string>" in p
    p = plan(Q["ip_range_bucket"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p


def test_overlapping_ranges_need_no_python(spark):
    for name in ("ip_range_overlaps", "ip_range_overlaps_large", "range_wide_overlaps", "ip_prefix_overlaps"):
        assert "Pandas" not in (p := plan(Q[name](spark, SMALL))) and "NestedLoopJoin" not in p


def test_prefix_lookup_probes_six_times_at_most(spark):
    """All 33 prefix lengths: six probes of one pinned table."""
    lengths = spark.range(33).select((F.col("id") * 0).alias("s"), (F.lit(2) ** (32 - F.col("id")) - 1).cast("bigint").alias("e"), F.col("id").alias("n"))
    found = range_lookup(spark.createDataFrame([(0,), (1,), (1 << 31,), (1 << 32,)], "k bigint"), lengths, "k", start="s", end="e", strategy="prefix", how="left")
    assert plan(found).split("Initial Plan")[0].count("BroadcastHashJoin") <= 6
    assert {r.k: r.n for r in found.collect()} == {0: 32, 1: 31, 1 << 31: 0, 1 << 32: None}
