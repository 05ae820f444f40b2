"""Whole jobs, one call each: what each sample program of the reference does, end to end.

Each job reads its inputs through the package's sources, runs the operators and writes
through the sinks; they are compositions, not new operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from enrichkit.functions.records import lower_columns
from enrichkit.functions.text import DEFAULT_MAX_TLD
from enrichkit.operators.blocklist import MALWARE_LIST_SCHEMA, clean_domain_list
from enrichkit.operators.geo import geo_enrich
from enrichkit.operators.ids import get_or_create_ids
from enrichkit.operators.keyed import keep_last
from enrichkit.operators.profile import value_counts
from enrichkit.sinks.files import create_table_as, write_documents, write_text
from enrichkit.sources.files import read_csv, read_documents
from enrichkit.sources.split_csv import read_split_csv
from enrichkit.streaming.dns import MESSAGE_SCHEMA, read_messages, start_dns_alert_stream


def geo_enrich_files(
    ips: DataFrame,
    blocks_path: str,
    names_path: str,
    ip_col: str,
    *,
    how: str = "inner",
    strategy: str = "bucket",
) -> DataFrame:
    """IP rows + a headed CIDR blocks CSV (``network, geoname_id, ...``) + a headed names
    CSV (``geoname_id, ..., country_name``) -> rows with block and name columns."""
    spark = ips.sparkSession
    blocks = read_csv(spark, blocks_path, header=True)
    names = read_csv(spark, names_path, header=True)
    return geo_enrich(ips, blocks, names, ip_col, how=how, strategy=strategy)


def value_counts_index(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fmt: str = "json",
    schema: str | None = None,
    read_options: dict[str, str] | None = None,
    write_options: dict[str, str] | None = None,
    min_count: int = 2,
    mode: str = "append",
) -> DataFrame:
    """Documents -> ``(field, val, count)`` for values seen ``min_count`` times or more,
    appended to the target collection (a second run appends the counts again, as the
    reference job does). Returns the counts."""
    docs = read_documents(spark, source, fmt=fmt, schema=schema, options=read_options)
    counts = value_counts(docs, min_count=min_count)
    write_documents(counts, target, fmt=fmt, mode=mode, options=write_options)
    return counts


def deid_events_to_text(
    events: DataFrame,
    store_path: str,
    text_path: str,
    *,
    key: str = "pid",
    mode: str = "uuid",
    out: str = "deid",
    salt: str = "",
    store_format: str = "parquet",
) -> DataFrame:
    """Events -> events with the substitute id of their key (existing ids from the store,
    new ones created and appended to it) -> one ``[v1,v2,...]`` text line per event.
    The store must exist (an empty table with ``key`` and ``out`` is fine)."""
    spark = events.sparkSession
    lookup = spark.read.format(store_format).load(store_path)
    enriched, _ = get_or_create_ids(
        events, lookup, key, mode=mode, out=out, salt=salt, store_path=store_path, store_format=store_format
    )
    write_text(enriched, text_path)
    return enriched


def load_keyed_index(
    spark: SparkSession,
    csv_path: str,
    target: str,
    key: str,
    *,
    fmt: str = "parquet",
    multiline: bool = False,
    line_end: str | None = None,
) -> DataFrame:
    """A headed CSV, names lower-cased, loaded into a recreated keyed store where a key
    seen again keeps its last row in file order; returns two stored rows as a check.

    A ``multiline`` file is read by one task, which finds its line ends; with ``line_end``, the
    one that its files have, it is read by splits (see ``read_split_csv``)."""
    # Partitions need not follow the files' order: a row's place is its file, its block of the
    # file, and its number within the split (the low bits of the increasing id).
    if multiline and line_end is not None:
        df = lower_columns(read_split_csv(spark, csv_path, header=True, line_end=line_end, place="__place"))
        order = ["__place"]
    else:
        df = read_csv(spark, csv_path, header=True, lowercase_columns=True, multiline=multiline)
        place = {
            "__file": F.col("_metadata.file_path"),
            "__block": F.col("_metadata.file_block_start"),
            "__pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
        df, order = df.withColumns(place), list(place)
    last = keep_last(df, key, order).drop(*order)
    last.write.format(fmt).mode("overwrite").save(target)
    stored = spark.read.format(fmt).load(target)
    return stored.limit(2)


def report_table(
    spark: SparkSession,
    source_table: str,
    target_table: str,
    *,
    limit: int = 10,
    order_by: list[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """``CREATE TABLE target AS SELECT * FROM source [ORDER BY ..] LIMIT n``."""
    return create_table_as(spark.table(source_table), target_table, limit=limit, order_by=order_by, path=path)


def dns_alert_job(
    spark: SparkSession,
    *,
    list_path: str,
    checkpoint_location: str,
    source_format: str = "kafka",
    source_options: dict[str, str] | None = None,
    source_path: str | None = None,
    sink_format: str = "kafka",
    sink_options: dict[str, str] | None = None,
    sink_path: str | None = None,
    trigger: dict | None = None,
    message_schema: StructType | str | None = MESSAGE_SCHEMA,
    listings_path: str | None = None,
    normalize: bool = False,
    max_tld: int = DEFAULT_MAX_TLD,
    max_broadcast_bytes: int | None = None,
):
    """The DNS alert stream end to end: the bad-domain list (headerless CSV, nine fields),
    messages from a stream source (Kafka topics by default, ``subscribe`` in
    ``source_options``), alerts as JSON values to the sink (Kafka by default, ``topic`` in
    ``sink_options``). All fields of ``message_schema`` stay in the alerts, with
    ``message_schema=None`` all fields of each record, whatever they are. With
    ``listings_path`` the cleaned list is written there, one row per entry with its
    ``domain``, to look up an alert's entries. Returns the running query."""
    listing = read_csv(spark, list_path, schema=MALWARE_LIST_SCHEMA)
    if listings_path is not None:
        entries = clean_domain_list(listing, max_tld=max_tld, normalize=normalize)
        entries.write.mode("overwrite").parquet(listings_path)
    messages = read_messages(spark, fmt=source_format, path=source_path, options=source_options)
    return start_dns_alert_stream(
        messages,
        listing,
        checkpoint_location=checkpoint_location,
        sink_format=sink_format,
        sink_options=sink_options,
        path=sink_path,
        trigger=trigger,
        message_schema=message_schema,
        normalize=normalize,
        max_tld=max_tld,
        max_broadcast_bytes=max_broadcast_bytes,
    )
