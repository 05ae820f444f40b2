import pytest
from pyspark.sql import functions as F

from enrichkit.operators.ids import dense_ids, get_or_create_ids, missing_keys
from enrichkit.session import scratch_path
from tests.conftest import rows

EVENTS = [("e1", "kiwi"), ("e2", "plum"), ("e3", "kiwi"), ("e4", "fig"), ("e5", "lime"), ("e6", "fig"), ("e7", "kiwi"),
          ("e8", "pear"), ("e9", "plum")]
KNOWN = [("kiwi", "id-77"), ("lime", "id-12"), ("date", "id-30")]


@pytest.fixture()
def events(spark):
    return spark.createDataFrame(EVENTS, "id string, pid string")


@pytest.fixture()
def store(spark):
    path = scratch_path(spark, "test_lookup")
    spark.createDataFrame(KNOWN, "pid string, deid string").write.parquet(path)
    return path


def test_uuid_mode_properties(spark, events, store):
    lookup = spark.read.parquet(store)
    enriched, created = get_or_create_ids(events, lookup, "pid", mode="uuid", store_path=store)
    got = rows(enriched, "id", "pid", "deid")
    assert len(got) == len(EVENTS)  # no event lost
    by_pid = {}
    for _, pid, deid in got:
        by_pid.setdefault(pid, set()).add(deid)
    assert all(len(v) == 1 for v in by_pid.values())  # one id per key
    for pid, deid in KNOWN:  # existing ids unchanged
        assert by_pid.get(pid, {deid}) == {deid}
    new = dict(rows(created, "pid", "deid"))
    assert sorted(new) == ["fig", "pear", "plum"]
    assert all(by_pid[p] == {d} for p, d in new.items())  # the stored ids are the ones used
    assert len(set(new.values())) == 3
    # a second run finds every key and creates nothing
    again, created2 = get_or_create_ids(events, spark.read.parquet(store), "pid", mode="uuid", store_path=store)
    assert created2.count() == 0
    assert rows(again, "id", "pid", "deid") == got
    assert spark.read.parquet(store).count() == 6


def test_hash_mode_is_repeatable(spark, events):
    lookup = spark.createDataFrame(KNOWN, "pid string, deid string")
    a, _ = get_or_create_ids(events, lookup, "pid", mode="hash", salt="s|")
    b, _ = get_or_create_ids(events, lookup, "pid", mode="hash", salt="s|")
    assert rows(a) == rows(b)
    assert rows(a.where(F.col("pid") == "fig"), "deid")[0][0] == spark.range(1).select(
        F.sha2(F.lit("s|fig"), 256)).first()[0]


def test_dense_ids_gap_free_in_key_order(spark):
    keys = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    keys = keys.unionByName(keys.limit(100))  # duplicates get one id
    got = rows(dense_ids(keys, "k", num_partitions=7), "k", "seq_id")
    assert [i for _, i in got] != []
    by_key = sorted(got)
    assert [i for _, i in sorted(by_key, key=lambda r: r[0])] == list(range(1, 5001))


def test_sequence_continues_after_existing(spark, events):
    existing = spark.createDataFrame([("kiwi", 1), ("lime", 2)], "pid string, seq_id bigint")
    enriched, created = get_or_create_ids(events, existing, "pid", mode="sequence", out="seq_id")
    assert rows(created) == [("fig", 3), ("pear", 4), ("plum", 5)]
    assert len(rows(enriched)) == len(EVENTS)


def test_missing_keys_drops_null_and_known(spark):
    events = spark.createDataFrame([("1", "a"), ("2", None), ("3", "b"), ("4", "b")], "id string, pid string")
    lookup = spark.createDataFrame([("a", "x")], "pid string, deid string")
    assert rows(missing_keys(events, lookup, "pid")) == [("b",)]


def test_every_event_stays_once(spark):
    events = spark.createDataFrame([("e1", "k1"), ("e2", None), ("e3", "k2")], "id string, pid string")
    lookup = spark.createDataFrame([("k1", "old-b"), ("k1", "old-a")], "pid string, deid string")
    out, new = get_or_create_ids(events, lookup, "pid", mode="hash", salt="s")
    got = {r.id: r.deid for r in out.collect()}
    assert out.count() == 3 and got["e1"] == "old-a" and got["e2"] is None and got["e3"]
    assert [r.pid for r in new.collect()] == ["k2"]


def test_sequence_ids_stay_after_the_store_grew(spark, tmp_path):
    store = str(tmp_path / "store")
    spark.createDataFrame([("a", 1), ("b", 2)], "pid string, deid bigint").write.parquet(store)
    events = spark.createDataFrame([("a",), ("c",), ("d",)], "pid string")
    out, new = get_or_create_ids(events, spark.read.parquet(store), "pid", mode="sequence", store_path=store)
    want = {"a": 1, "c": 3, "d": 4}
    assert {r.pid: r.deid for r in out.collect()} == want
    assert {r.pid: r.deid for r in new.collect()} == {"c": 3, "d": 4}
    assert {r.pid: r.deid for r in spark.read.parquet(store).collect()} == want | {"b": 2}


def test_hash_mode_needs_a_salt(spark, events):
    lookup = spark.createDataFrame(KNOWN, "pid string, deid string")
    with pytest.raises(ValueError, match="salt"):
        get_or_create_ids(events, lookup, "pid", mode="hash")
