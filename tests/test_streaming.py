import json

import pandas as pd
import pytest

from enrichkit.operators.blocklist import MALWARE_LIST_SCHEMA, dns_alerts, dns_rejects
from enrichkit.plans import fixtures as fx
from enrichkit.session import scratch_path
from enrichkit.sinks import write_csv
from enrichkit.sources import read_csv
from enrichkit.sources.messages import json_values_to_records, json_values_to_rows
from enrichkit.streaming import alert_values, foreach_batch_sink, message_rejects, read_messages, start_dns_alert_stream
from enrichkit.streaming.dns import record_alert_values
from tests.conftest import SMALL, rows

SCHEMA = "event_id bigint, message string"


def _alert_rows(df):
    return rows(df.select("event_id", "domain", "listing_count"))


def _setup(spark):
    root = scratch_path(spark, "stream_test")
    fx.dns_json_values(spark, SMALL).repartition(3).write.text(f"{root}/in")
    write_csv(fx.domain_list(spark, SMALL), f"{root}/list")
    return root, read_csv(spark, f"{root}/list", schema=MALWARE_LIST_SCHEMA)


def _run(spark, root, listing, as_json=False, max_broadcast_bytes=None):
    messages = read_messages(spark, fmt="text", path=f"{root}/in", options={"maxFilesPerTrigger": "1"})
    q = start_dns_alert_stream(
        messages, listing, checkpoint_location=f"{root}/ckpt", message_schema=SCHEMA,
        sink_format="text" if as_json else "parquet", path=f"{root}/out", trigger={"availableNow": True},
        as_json=as_json, max_broadcast_bytes=max_broadcast_bytes,
    )
    q.awaitTermination()
    return q


@pytest.mark.parametrize("bound", [None, 0])
def test_stream_equals_batch_and_restart_adds_nothing(spark, bound):
    root, listing = _setup(spark)
    q = _run(spark, root, listing, max_broadcast_bytes=bound)
    assert len(q.recentProgress) >= 3  # one micro-batch per file
    batch = dns_alerts(fx.dns_messages(spark, SMALL), fx.domain_list(spark, SMALL))
    written = spark.read.parquet(f"{root}/out")
    assert written.columns == batch.columns  # whatever the list's size
    first = _alert_rows(written)
    assert first == _alert_rows(batch) and len(first) > 0
    _run(spark, root, listing, max_broadcast_bytes=bound)  # restart from the checkpoint: no new input, no new rows
    assert _alert_rows(spark.read.parquet(f"{root}/out")) == first


def test_stream_json_values(spark):
    root, listing = _setup(spark)
    _run(spark, root, listing, as_json=True)
    got = sorted(r[0] for r in spark.read.text(f"{root}/out").collect())
    batch = alert_values(dns_alerts(fx.dns_messages(spark, SMALL), fx.domain_list(spark, SMALL)))
    assert got == sorted(r[0] for r in batch.collect())


def test_foreach_batch_sink_is_idempotent_per_epoch(spark):
    root, _ = _setup(spark)
    writer = foreach_batch_sink(f"{root}/out")
    batch = spark.createDataFrame([(1, "a")], "id bigint, v string")
    writer(batch, 0)
    writer(batch, 0)  # replayed epoch replaces its folder
    writer(batch, 1)
    assert spark.read.parquet(f"{root}/out").count() == 2


def test_records_without_message_do_not_stop_parsing(spark):
    df = spark.createDataFrame([('{"event_id": 1}',), ('{"event_id": 2, "message": "x"}',), ("not json",)], "value string")
    parsed = json_values_to_rows(df, SCHEMA)
    assert rows(parsed) == [(None, None), (1, None), (2, "x")]
    assert rows(dns_rejects(parsed), "event_id", "reason") == [(None, "no message"), (1, "no message"), (2, "unparsed line")]


def test_rejects_keep_the_raw_record_and_say_why(spark):
    values = [(None,), ("not json",), ('{"event_id": 2}',), ('{"event_id": 3, "message": "x"}',),
              ('{"event_id": 4, "message": "d: reply a.example is 1.2.3.4"}',), ("",),
              ('{"event_id": "x", "message": "d: reply a.example is 1.2.3.4"}',), ('{"event_id": "x"}',)]
    df = spark.createDataFrame(values, "value string")
    assert dict(rows(message_rejects(df, SCHEMA))) == {
        None: "no record",
        "": "no message",
        "not json": "broken record",
        '{"event_id": 2}': "no message",
        '{"event_id": 3, "message": "x"}': "unparsed line",
        '{"event_id": "x", "message": "d: reply a.example is 1.2.3.4"}': "field lost",
        '{"event_id": "x"}': "broken record",
    }
    # What is reported as lost altogether is in no alert.
    kept = json_values_to_rows(df, SCHEMA).where("message LIKE 'd: reply%'")
    assert rows(kept) == [(None, "d: reply a.example is 1.2.3.4"), (4, "d: reply a.example is 1.2.3.4")]


def test_alert_fields_win_over_message_fields_of_their_name(spark):
    df = spark.createDataFrame(
        [(1, "d: reply a.technology is 1.2.3.4", "mine", "mine")], "event_id bigint, message string, address string, listing_count string"
    )
    entry = ("d", "a.technology/x", "-", "-", "listed", "-", "0", "0", "-")
    listing = spark.createDataFrame([entry, entry], MALWARE_LIST_SCHEMA)
    out = dns_alerts(df, listing)
    assert out.columns == ["event_id", "message", "query_type", "domain", "address", "listing_count"]
    assert rows(out, "event_id", "domain", "address", "listing_count") == [(1, "a.technology", "1.2.3.4", 2)]
    assert rows(dns_alerts(df, listing, max_tld=6), "event_id") == []


def test_unparsed_lines_never_meet_hostless_entries(spark):
    msgs = spark.createDataFrame([(1, "not a dns line"), (2, None)], SCHEMA)
    listing = spark.createDataFrame(
        [("d", "-", "-", "-", "no host", "-", "0", "0", "-")], MALWARE_LIST_SCHEMA
    )
    assert dns_alerts(msgs, listing).count() == 0  # '' = '' would have matched


def test_the_default_trigger_runs_batch_after_batch(spark):
    """Two-second micro-batches over files that arrive while the stream runs."""
    root, listing = _setup(spark)
    (spark.read.text(f"{root}/in").coalesce(1).write.text(f"{root}/live"))
    messages = read_messages(spark, fmt="text", path=f"{root}/live", options={"maxFilesPerTrigger": "1"})
    q = start_dns_alert_stream(
        messages, listing, checkpoint_location=f"{root}/live_ckpt", message_schema=SCHEMA, sink_format="parquet",
        path=f"{root}/live_out", as_json=False,
    )
    try:
        q.processAllAvailable()
        for _ in range(2):
            spark.read.text(f"{root}/in").coalesce(1).write.mode("append").text(f"{root}/live")
            q.processAllAvailable()
        batches = [p for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    starts = sorted(pd.Timestamp(p["timestamp"]) for p in batches)
    assert len(batches) == 3 and all(b - a > pd.Timedelta(seconds=1) for a, b in zip(starts, starts[1:]))
    alerts = dns_alerts(fx.dns_messages(spark, SMALL), fx.domain_list(spark, SMALL)).count()
    assert spark.read.parquet(f"{root}/live_out").count() == 3 * alerts


def test_records_of_any_shape_keep_all_fields(spark):
    line = "d: reply a.example is 1.2.3.4"
    values = [
        ('{"message": "%s", "deep": {"a": [1, {"b": null}]}, "domain": "mine"}' % line,),
        ('{"message": "%s", "n": 2.5}' % line,), ('{"n": 1}',), ('{"message": 7}',), ("[1]",), ("not json",), ("",), (None,),
    ]
    df = spark.createDataFrame(values, "value string")
    records = json_values_to_records(df, {"message": "string"})
    listing = spark.createDataFrame([("d", "a.example/x", "-", "-", "listed", "-", "0", "0", "-")], MALWARE_LIST_SCHEMA)
    got = [json.loads(r.value) for r in record_alert_values(dns_alerts(records, listing)).collect()]
    own = {"message": line, "query_type": "reply", "domain": "a.example", "address": "1.2.3.4", "listing_count": 1}
    want = [own | {"deep": {"a": [1, {"b": None}]}}, own | {"n": 2.5}]
    assert len(got) == 2 and all(w in got for w in want)
    reasons = {r.value: r.reason for r in message_rejects(df, None).collect()}
    assert reasons == {'{"n": 1}': "no message", '{"message": 7}': "unparsed line", "[1]": "broken record", "not json": "broken record",
                       "": "broken record", None: "no record"}
