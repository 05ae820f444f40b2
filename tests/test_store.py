"""The keyed table in buckets, and substitute ids on a stream."""

import pytest
from pyspark.sql import functions as F

from enrichkit.operators import store as store_module
from enrichkit.operators.ids import get_or_create_ids
from enrichkit.operators.store import KeyedTable
from enrichkit.session import scratch_path
from enrichkit.streaming.ids import create_id_store, id_batches, start_id_stream
from tests.conftest import rows

SCHEMA = "k string, v bigint"


def table(spark, n_buckets=8):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(spark, scratch_path(spark, "keyed_test"), "k", schema, n_buckets)


def load(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def files(df):
    return set(df.inputFiles())


def test_a_merge_writes_the_touched_buckets_only(spark):
    t = table(spark)
    assert t.version() == 0 and t.read().count() == 0
    assert t.merge(load(spark, [(f"k{i}", i) for i in range(200)] + [(None, 1)])) == 1
    before = files(t.read())
    assert t.merge(load(spark, [("k7", 70), ("k7", 71), ("new", 5)]), ["v"]) == 2
    after = files(t.read())
    changed = {f.rsplit("bucket=", 1)[1].split("/")[0] for f in after - before}
    assert 1 <= len(changed) <= 2 and len(before & after) >= 6
    want = {f"k{i}": i for i in range(200)} | {"k7": 71, "new": 5}
    assert dict(rows(t.read())) == want
    t.merge(load(spark, []))
    assert t.version() == 3 and dict(rows(t.read())) == want


def test_reads_open_buckets_with_wanted_keys_only(spark, monkeypatch):
    t = table(spark, 32)
    t.merge(load(spark, [(f"k{i}", i) for i in range(500)]))
    keys = load(spark, [("k1", 0), ("k2", 0), ("k1", 0), ("nowhere", 0), (None, 0)]).select("k")
    found = t.rows_of(keys)
    assert rows(found) == [("k1", 1), ("k2", 2)] and len(files(found)) <= 3 < len(files(t.read()))
    assert rows(t.enrich(keys)) == [(None, None), ("k1", 1), ("k1", 1), ("k2", 2), ("nowhere", None)]
    assert t.rows_of(keys.limit(0)).count() == 0
    monkeypatch.setattr(store_module, "FEW_KEYS", 1)
    joined = t.rows_of(keys)
    assert rows(joined) == [("k1", 1), ("k2", 2)] and len(files(joined)) <= 3


def test_a_stopped_load_leaves_nothing_and_a_second_writer_fails(spark, monkeypatch):
    t = table(spark)
    t.merge(load(spark, [("a", 1)]))

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", stop)
        with pytest.raises(OSError):
            t.merge(load(spark, [("a", 2), ("b", 2)]))
    assert rows(t.read()) == [("a", 1)]
    with monkeypatch.context() as m:  # both writers saw version 1
        m.setattr(KeyedTable, "version", lambda self: 1)
        t.merge(load(spark, [("b", 3)]))
        with pytest.raises(RuntimeError):
            t.merge(load(spark, [("c", 4)]))
    assert rows(t.read()) == [("a", 1), ("b", 3)]


EVENTS = [("e1", "kiwi"), ("e2", None), ("e3", "plum"), ("e4", "fig"), ("e5", "plum"), ("e6", "kiwi"), ("e7", "date")]


def run_stream(spark, root, mode):
    events = spark.readStream.schema("id string, pid string").option("maxFilesPerTrigger", 1).json(f"{root}/in")
    q = start_id_stream(
        events, store_path=f"{root}/store", out_path=f"{root}/out", checkpoint_location=f"{root}/ckpt", key="pid",
        mode=mode, salt="s", trigger={"availableNow": True},
    )
    q.awaitTermination()
    return rows(spark.read.parquet(f"{root}/out").select("id", "pid", "deid")), rows(spark.read.parquet(f"{root}/store").select("pid", "deid"))


@pytest.mark.parametrize("mode", ["hash", "uuid", "sequence"])
def test_stream_creates_each_id_once(spark, mode):
    root = scratch_path(spark, "id_stream_test")
    known = [("kiwi", 41 if mode == "sequence" else "known-1")]
    lookup = spark.createDataFrame(known, "pid string, deid " + ("bigint" if mode == "sequence" else "string"))
    create_id_store(lookup, f"{root}/store", "pid")
    events = spark.createDataFrame(EVENTS, "id string, pid string")
    events.repartition(3, "id").write.json(f"{root}/in")
    out, store = run_stream(spark, root, mode)
    assert sorted(i for i, _, _ in out) == [i for i, _ in EVENTS]
    ids = dict(store)
    assert len(ids) == len(store) == len(set(ids.values())) == 4 and ids["kiwi"] == known[0][1]
    assert all(d == ids.get(p) for _, p, d in out)
    if mode == "hash":
        batch, _ = get_or_create_ids(events, lookup, "pid", mode="hash", salt="s")
        assert out == rows(batch.select("id", "pid", "deid"))
    if mode == "sequence":
        assert sorted(ids.values()) == [41, 42, 43, 44]
    assert run_stream(spark, root, mode) == (out, store)  # a restart adds nothing


def test_a_batch_that_runs_again_keeps_its_ids(spark):
    root = scratch_path(spark, "id_replay")
    create_id_store(spark.createDataFrame([], "pid string, deid string"), f"{root}/store", "pid")
    assign = id_batches(f"{root}/store", f"{root}/out", "pid", mode="uuid")
    batch = spark.createDataFrame(EVENTS, "id string, pid string")
    assign(batch, 0)
    first = rows(spark.read.parquet(f"{root}/out").select("id", "deid"))
    assign(batch, 0)
    assert rows(spark.read.parquet(f"{root}/out").select("id", "deid")) == first


def test_the_lookup_is_exchanged_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = spark.createDataFrame([("kiwi", "x")], "pid string, deid string")
        keys = spark.createDataFrame(EVENTS, "id string, pid string").select("pid").distinct()
        found = keys.join(lookup, "pid", "left").groupBy("pid").agg(F.min("deid"))
        text = found._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 2  # the keys once, the lookup once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
