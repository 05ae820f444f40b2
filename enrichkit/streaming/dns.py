"""DNS messages from a message bus, matched against the bad-domain list as a stream.

One streaming plan for the life of the query: read (key, value) records, parse the JSON
value with a declared schema (a record without ``message`` gets null instead of stopping
the batch), parse the DNS line, join the static list (counted per host and pinned once; broadcast
when its measured size allows), and write each alert as a JSON value. The checkpoint makes the query
restartable: a file sink is exactly-once, a Kafka sink at-least-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from enrichkit.functions.records import row_json
from enrichkit.functions.text import DEFAULT_MAX_TLD, dns_line_matches
from enrichkit.operators.blocklist import dns_alerts
from enrichkit.sources.messages import json_values_to_records, json_values_to_rows

# The message field holding the DNS line, the topic alerts go to, and the
# 2-second micro-batch interval.
MESSAGE_SCHEMA = "message string"
ALERT_TOPIC = "dnsMalware"
DEFAULT_TRIGGER = {"processingTime": "2 seconds"}
_BROKEN = "__broken"
_RECORD = "record"


def read_messages(
    spark: SparkSession,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of message values as text in column ``value``.

    ``fmt="kafka"`` takes the usual options (``kafka.bootstrap.servers``, ``subscribe``
    with a comma-separated topic list, ...) and drops the message key; ``fmt="text"``
    reads new files under ``path``, one message per line.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    raw = reader.load(path) if path is not None else reader.load()
    return raw.selectExpr("CAST(value AS STRING) AS value")


def alert_values(alerts: DataFrame, ignore_null_fields: bool = True) -> DataFrame:
    """Alerts as message records: the whole row as a JSON object in ``value``."""
    return alerts.select(row_json(alerts, ignore_null_fields).alias("value"))


def record_alert_values(alerts: DataFrame, record: str = _RECORD) -> DataFrame:
    """Alerts over records without a declared schema as message records: all fields of the record
    and those of the alert as a JSON object in ``value`` (a field of the record that is called
    like one of the alert's gives way)."""
    added = [c for c in alerts.columns if c not in (record, "message")]
    names = ", ".join(f"'{c}'" for c in added)
    own = F.expr(f"map_filter(`{record}`, (k, v) -> k NOT IN ({names}))")
    new = F.create_map(*[x for c in added for x in (F.lit(c), F.col(f"`{c}`").cast("variant"))])
    return alerts.select(F.to_json(F.map_concat(own, new)).alias("value"))


def start_dns_alert_stream(
    messages: DataFrame,
    listing: DataFrame,
    *,
    checkpoint_location: str,
    message_schema: StructType | str | None = MESSAGE_SCHEMA,
    sink_format: str = "kafka",
    sink_options: dict[str, str] | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    as_json: bool = True,
    query_name: str | None = None,
    normalize: bool = False,
    max_tld: int = DEFAULT_MAX_TLD,
    max_broadcast_bytes: int | None = None,
) -> StreamingQuery:
    """Start the alert stream. ``messages`` is a stream with a ``value`` column (see
    ``read_messages``); ``listing`` is the static list with its raw fields.

    For Kafka pass ``sink_options={"kafka.bootstrap.servers": ..., "topic": ALERT_TOPIC}``.
    ``trigger`` defaults to 2-second micro-batches.

    The list is counted per host and pinned once. Its size decides only how the join runs
    (broadcast, or salted shuffle over the bound): columns, sink, options and the meaning of
    ``path`` are the same. Records that cannot be matched go to ``start_dns_reject_stream``; one
    with a field that is not of its declared type is matched without that field and reported too.
    ``message_schema=None`` takes records with any fields: each alert has all of its record's,
    with ``as_json`` beside its own, else in the column ``record``.
    """
    if message_schema is None:
        rows = json_values_to_records(messages, {"message": "string"})
    else:
        rows = json_values_to_rows(messages, message_schema)
    alerts = dns_alerts(
        rows, listing, normalize=normalize, max_tld=max_tld, max_broadcast_bytes=max_broadcast_bytes
    )
    as_values = record_alert_values if message_schema is None else alert_values
    return _start(
        as_values(alerts) if as_json else alerts,
        checkpoint_location, sink_format, sink_options, path, trigger, query_name,
    )


def _start(out, checkpoint_location, sink_format, sink_options, path, trigger, query_name) -> StreamingQuery:
    writer = out.writeStream.format(sink_format).options(**(sink_options or {})).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint_location).trigger(**(trigger or DEFAULT_TRIGGER))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start(path) if path is not None else writer.start()


def message_rejects(
    messages: DataFrame, message_schema: StructType | str | None = MESSAGE_SCHEMA, message_col: str = "message"
) -> DataFrame:
    """``value`` (the raw text) and ``reason`` of each record that cannot be matched as a whole,
    batch or stream: ``no record`` (null), ``broken record`` (not JSON of the declared schema, and
    its message is lost), ``no message`` (the field is absent or null), ``unparsed line``, and
    ``field lost``: another field is not of its declared type. Only the last kind goes through the
    match as well, without that field, so it may stand in the alerts too. ``message_schema=None``:
    any JSON object is a record."""
    if message_schema is None:
        read = json_values_to_records(messages, {message_col: "string"}, keep=["value"])
        why = (
            F.when(F.col("value").isNull(), "no record")
            .when(F.col(_RECORD).isNull(), "broken record")
            .when(F.col(message_col).isNull(), "no message")
            .when(~dns_line_matches(message_col), "unparsed line")
        )
        return read.select("value", why.alias("reason")).where(F.col("reason").isNotNull())
    declared = StructType.fromDDL(message_schema) if isinstance(message_schema, str) else message_schema
    schema = StructType([*declared.fields, StructField(_BROKEN, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = messages.select("value", F.from_json("value", schema, options).alias("__rec"))
    message = F.col("__rec")[message_col]
    broken = F.col("__rec")[_BROKEN].isNotNull()
    reason = (
        F.when(F.col("value").isNull(), "no record")
        .when(message.isNull(), F.when(broken, "broken record").otherwise("no message"))
        .when(~dns_line_matches(message), "unparsed line")
        .when(broken, "field lost")
    )
    return parsed.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


def start_dns_reject_stream(
    messages: DataFrame,
    *,
    checkpoint_location: str,
    message_schema: StructType | str | None = MESSAGE_SCHEMA,
    sink_format: str = "json",
    sink_options: dict[str, str] | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the stream of ``message_rejects``, beside the alert stream with a checkpoint of
    its own. A Kafka sink gets each reject as a JSON ``value``."""
    out = message_rejects(messages, message_schema)
    if sink_format == "kafka":
        out = out.select(row_json(out).alias("value"))
    return _start(out, checkpoint_location, sink_format, sink_options, path, trigger, query_name)


def foreach_batch_sink(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for sinks without a streaming writer.

    Each micro-batch goes to its own ``epoch_id=<n>`` folder in overwrite mode, so a
    batch replayed after a failure replaces its earlier output instead of adding to it.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/epoch_id={epoch_id}")

    return write
