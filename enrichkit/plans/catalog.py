"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the generated tables (through ``fixtures``) in full and runs the
package's operators on them; ``oracle_sql`` holds the matching DuckDB statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.functions.net import ipv4_to_long
from enrichkit.functions.records import null_to_empty, pick_field
from enrichkit.functions.text import first_domain
from enrichkit.operators.addresses import address_lookup
from enrichkit.operators.blocklist import (
    MALWARE_LIST_FIELDS,
    MALWARE_LIST_SCHEMA,
    clean_domain_list,
    dns_alerts,
    dns_rejects,
    parse_dns,
    parse_matching_dns,
)
from enrichkit.operators.geo import geo_enrich
from enrichkit.operators.ids import dense_ids, distinct_keys, get_or_create_ids, hash_ids, missing_keys
from enrichkit.operators.joins import skew_aware_join
from enrichkit.operators.profile import map_value_counts, value_counts
from enrichkit.operators.ranges import cidr_ranges, range_lookup, store_ranges, with_match_status
from enrichkit.operators.store import KeyedTable
from enrichkit.session import scratch_path
from enrichkit.sinks.files import create_table_as, keyed_overwrite, write_csv, write_documents, write_text
from enrichkit.sources.files import read_csv, read_documents
from enrichkit.sources.split_csv import read_split_csv
from enrichkit.plans import fixtures as fx
from enrichkit.plans.jobs import (
    deid_events_to_text,
    dns_alert_job,
    geo_enrich_files,
    load_keyed_index,
    value_counts_index,
)
from enrichkit.plans import oracle as o
from enrichkit.sources.messages import json_values_to_rows
from enrichkit.streaming.dns import (
    alert_values,
    foreach_batch_sink,
    read_messages,
    start_dns_alert_stream,
    start_dns_reject_stream,
)
from enrichkit.streaming.ids import create_id_store, start_id_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --- DNS lines and the bad-domain list -------------------------------------------------


@register(
    "dns_line_fields",
    o.with_ctes(["dns_parsed"], "SELECT event_id, query_type, domain, address FROM dns_parsed"),
)
def dns_line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dns(fx.dns_messages(spark, sf_dir)).select("event_id", "query_type", "domain", "address")


@register(
    "extract_domain",
    "SELECT page_id, split_part(split_part(url, '/', 3), ':', 1) AS domain FROM pages",
)
def extract_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", first_domain("url").alias("domain"))


@register(
    "clean_domain_list",
    o.with_ctes(["clean_list"], "SELECT description, domain FROM clean_list"),
)
def clean_domain_list_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_domain_list(fx.domain_list(spark, sf_dir)).select("description", "domain")


_ALERT_COLS = ["event_id", "message", "query_type", "domain", "address", "listing_count"]
_ALERTS_SQL = o.with_ctes(
    ["alerts"],
    f"SELECT {', '.join(_ALERT_COLS)} FROM alerts",
)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dns_alerts(fx.dns_messages(spark, sf_dir), fx.domain_list(spark, sf_dir))


@register("dns_blocklist_join", _ALERTS_SQL)
def dns_blocklist_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


@register("dns_blocklist_join_large", _ALERTS_SQL)
def dns_blocklist_join_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with no list small enough to broadcast: a Bloom filter of it goes first."""
    return dns_alerts(fx.dns_messages(spark, sf_dir), fx.domain_list(spark, sf_dir), max_broadcast_bytes=0)


@register(
    "dns_long_tld",
    o.with_ctes(
        ["alerts"],
        "SELECT event_id, domain, listing_count FROM alerts",
        extra={
            "hosts": """SELECT page_id, regexp_replace(regexp_extract(url, '^https?://([^/:?#]+)', 1),
                               '[^.]+$', 'technology') AS h FROM pages"""
        },
    ),
)
def dns_long_tld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts over hosts with a top-level domain of ten letters, in the lines and in the list."""
    messages = fx.dns_messages(spark, sf_dir, "technology")
    alerts = dns_alerts(messages, fx.domain_list(spark, sf_dir, "technology"))
    return alerts.select("event_id", "domain", "listing_count")


@register(
    "null_to_empty",
    o.with_ctes(["dns_messages"], "SELECT event_id, coalesce(message, '') AS message FROM dns_messages"),
)
def null_to_empty_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_to_empty(fx.dns_messages(spark, sf_dir), ["message"])


@register("dns_json_parse", o.with_ctes(["dns_messages"], "SELECT event_id, message FROM dns_messages"))
def dns_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_values_to_rows(fx.dns_json_values(spark, sf_dir), "event_id bigint, message string")


@register(
    "dns_rejects",
    o.with_ctes(
        ["dns_parsed"],
        """SELECT event_id, message,
                  CASE WHEN message IS NULL THEN 'no message' ELSE 'unparsed line' END AS reason
           FROM dns_parsed WHERE message IS NULL OR domain = ''""",
    ),
)
def dns_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dns_rejects(fx.dns_messages(spark, sf_dir))


@register(
    "alert_json",
    o.with_ctes(
        ["alerts"],
        """SELECT CAST(to_json({'event_id': event_id, 'message': message, 'query_type': query_type,
                  'domain': domain, 'address': address, 'listing_count': listing_count}) AS VARCHAR) AS value
           FROM alerts""",
    ),
)
def alert_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_values(_alerts(spark, sf_dir))


# --- IP addresses, CIDR blocks and the range lookup ------------------------------------

RANGE_COLS = ["event_id", "ipn", "s", "e", "plen", "geoname_id"]


def _range_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks as a range table parsed from their CIDR text: (geoname_id, s, e, plen)."""
    return cidr_ranges(fx.block_networks(spark, sf_dir), "network", "s", "e", "plen").drop("network")


def _ip_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.ip_text(spark, sf_dir).select("event_id", ipv4_to_long("ip").alias("ipn"))


def _lookup(spark: SparkSession, sf_dir: str, strategy: str, how: str = "inner") -> DataFrame:
    return range_lookup(
        _ip_keys(spark, sf_dir), _range_table(spark, sf_dir), "ipn",
        start="s", end="e", strategy=strategy, how=how,
    )


_RANGE_SQL = o.with_ctes(
    ["ips", "blocks"],
    """SELECT i.event_id, i.ipn, b.s, b.e, b.plen, CAST(b.geoname_id AS VARCHAR) AS geoname_id
       FROM ips i JOIN blocks b ON i.ipn BETWEEN b.s AND b.e""",
)


@register("ipv4_to_long", o.with_ctes(["ips"], "SELECT event_id, ipn FROM ips"))
def ipv4_to_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ip_keys(spark, sf_dir)


@register(
    "cidr_ranges",
    o.with_ctes(["blocks"], "SELECT s, e, plen, CAST(geoname_id AS VARCHAR) AS geoname_id FROM blocks"),
)
def cidr_ranges_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _range_table(spark, sf_dir).select("s", "e", "plen", "geoname_id")


@register("ip_range_bucket", _RANGE_SQL)
def ip_range_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "bucket").select(*RANGE_COLS)


@register("ip_range_stored", _RANGE_SQL)
def ip_range_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucket lookup against a range table parsed once and stored."""
    stored = store_ranges(fx.block_networks(spark, sf_dir), scratch_path(spark, "ranges"), "network", "s", "e", "plen")
    return range_lookup(_ip_keys(spark, sf_dir), stored, "ipn", start="s", end="e").select(*RANGE_COLS)


@register("ip_range_between", _RANGE_SQL)
def ip_range_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "between").select(*RANGE_COLS)


@register("ip_prefix_expand", _RANGE_SQL)
def ip_prefix_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "prefix").select(*RANGE_COLS)


@register("ip_range_pandas_udf", _RANGE_SQL)
def ip_range_pandas_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "pandas").select(*RANGE_COLS)


_NESTED_SQL = o.with_ctes(
    ["ips", "nested_blocks"],
    """SELECT event_id, ipn, s, e, plen, geoname_id FROM (
         SELECT i.event_id, i.ipn, b.s, b.e, b.plen, b.geoname_id, row_number() OVER (
           PARTITION BY i.event_id ORDER BY b.s DESC, b.e, b.geoname_id DESC) AS place
         FROM ips i LEFT JOIN nested_blocks b ON i.ipn BETWEEN b.s AND b.e)
       WHERE place = 1""",
)


def _nested_lookup(spark: SparkSession, sf_dir: str, strategy: str, bound: int | None = None) -> DataFrame:
    """Overlapping and equal ranges: the innermost one, of equal ones that with the greatest columns."""
    ranges = cidr_ranges(fx.nested_networks(spark, sf_dir), "network", "s", "e", "plen").drop("network")
    out = range_lookup(
        _ip_keys(spark, sf_dir), ranges, "ipn", start="s", end="e",
        strategy=strategy, how="left", max_broadcast_bytes=bound,
    )
    return out.select(*RANGE_COLS)


@register("ip_range_overlaps", _NESTED_SQL)
def ip_range_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_lookup(spark, sf_dir, "bucket")


@register("ip_range_overlaps_large", _NESTED_SQL)
def ip_range_overlaps_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with no range table small enough to broadcast."""
    return _nested_lookup(spark, sf_dir, "bucket", 0)


@register("ip_prefix_overlaps", _NESTED_SQL)
def ip_prefix_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_lookup(spark, sf_dir, "prefix")


@register("ip_prefix_overlaps_large", _NESTED_SQL)
def ip_prefix_overlaps_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_lookup(spark, sf_dir, "prefix", 0)


@register("ip_pandas_overlaps", _NESTED_SQL)
def ip_pandas_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_lookup(spark, sf_dir, "pandas")


_WIDE_COLS = ["event_id", "k", "s", "e", "name"]


@register(
    "range_wide",
    o.with_ctes(
        ["wide_keys", "wide_ranges"],
        """SELECT event_id, k, s, e, name FROM wide_keys LEFT JOIN wide_ranges ON k BETWEEN s AND e""",
    ),
)
def range_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint ranges of one key to more than 2^40 keys."""
    keys, ranges = fx.wide_keys(spark, sf_dir), fx.wide_ranges(spark, sf_dir)
    return range_lookup(keys, ranges, "k", start="s", end="e", how="left").select(*_WIDE_COLS)


_WIDE_NESTED_SQL = o.with_ctes(
    ["wide_keys", "wide_nested"],
    """SELECT event_id, k, s, e, name FROM (
         SELECT event_id, k, s, e, name, row_number() OVER (PARTITION BY event_id ORDER BY s DESC, e, name DESC) AS place
         FROM wide_keys LEFT JOIN wide_nested ON k BETWEEN s AND e) WHERE place = 1""",
)


def _wide_nested(spark: SparkSession, sf_dir: str, strategy: str, bound: int | None = None) -> DataFrame:
    """The same with ranges around them that cross, nest and repeat, one over all keys."""
    out = range_lookup(
        fx.wide_keys(spark, sf_dir), fx.wide_nested(spark, sf_dir), "k", start="s", end="e", how="left",
        strategy=strategy, max_broadcast_bytes=bound,
    )
    return out.select(*_WIDE_COLS)


@register("range_wide_overlaps", _WIDE_NESTED_SQL)
def range_wide_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_nested(spark, sf_dir, "bucket")


@register("range_wide_overlaps_large", _WIDE_NESTED_SQL)
def range_wide_overlaps_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with no range table small enough to broadcast."""
    return _wide_nested(spark, sf_dir, "bucket", 0)


@register("range_wide_pandas", _WIDE_NESTED_SQL)
def range_wide_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_nested(spark, sf_dir, "pandas")


@register(
    "ip_mixed_networks",
    o.with_ctes(
        ["mixed_keys", "mixed_blocks"],
        """SELECT event_id, name FROM (
             SELECT event_id, name, row_number() OVER (PARTITION BY event_id ORDER BY plen DESC, name DESC) AS place
             FROM mixed_keys k LEFT JOIN mixed_blocks b ON k.family = b.family AND k.k BETWEEN b.s AND b.e)
           WHERE place = 1""",
    ),
)
def ip_mixed_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPv4 and IPv6 texts of several spellings against nested networks of both kinds."""
    looked = address_lookup(fx.mixed_addresses(spark, sf_dir), fx.mixed_networks(spark, sf_dir), "ip", how="left")
    return looked.select("event_id", "name")


@register(
    "ip_lookup_status_invalid",
    o.with_ctes(
        ["ips", "blocks"],
        """SELECT i.event_id, CASE WHEN i.event_id % 3 <> 0 THEN i.ipn END AS ipn,
                  CASE WHEN i.event_id % 3 <> 0 THEN CAST(b.geoname_id AS VARCHAR) END AS geoname_id,
                  CASE WHEN i.event_id % 3 = 0 THEN 'invalid'
                       WHEN b.s IS NOT NULL THEN 'matched'
                       WHEN i.ipn < (SELECT min(s) FROM blocks) THEN 'below'
                       ELSE 'gap' END AS match_status
           FROM ips i LEFT JOIN blocks b ON i.ipn BETWEEN b.s AND b.e""",
    ),
)
def ip_lookup_status_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the addresses is no address; the range table is over the broadcast bound."""
    eid = F.col("event_id")
    text = F.when(eid % 6 == 0, F.lit(None)).when(eid % 3 == 0, F.concat("ip", F.lit(".7"))).otherwise(F.col("ip"))
    keys = fx.ip_text(spark, sf_dir).select("event_id", ipv4_to_long(text).alias("ipn"))
    ranges = _range_table(spark, sf_dir)
    looked = range_lookup(keys, ranges, "ipn", start="s", end="e", how="left", max_broadcast_bytes=0)
    return with_match_status(looked, ranges, "ipn", start="s").select("event_id", "ipn", "geoname_id", "match_status")


@register(
    "ip_lookup_status",
    o.with_ctes(
        ["ips", "blocks"],
        """SELECT i.event_id, i.ipn, CAST(b.geoname_id AS VARCHAR) AS geoname_id,
                  CASE WHEN b.s IS NOT NULL THEN 'matched'
                       WHEN i.ipn < (SELECT min(s) FROM blocks) THEN 'below'
                       ELSE 'gap' END AS match_status
           FROM ips i LEFT JOIN blocks b ON i.ipn BETWEEN b.s AND b.e""",
    ),
)
def ip_lookup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = _range_table(spark, sf_dir)
    looked = range_lookup(_ip_keys(spark, sf_dir), ranges, "ipn", start="s", end="e", how="left")
    return with_match_status(looked, ranges, "ipn", start="s").select("event_id", "ipn", "geoname_id", "match_status")


@register(
    "geo_country_join",
    o.with_ctes(
        ["ips", "blocks", "countries"],
        f"""SELECT i.event_id, {o.quad('i.ipn')} AS ip,
                   {o.quad('b.s')} || '/' || CAST(b.plen AS VARCHAR) AS network,
                   c.geoname_id, c.country_name, c.continent_name
            FROM ips i JOIN blocks b ON i.ipn BETWEEN b.s AND b.e
            JOIN countries c ON c.geoname_id = CAST(b.geoname_id AS VARCHAR)""",
    ),
)
def geo_country_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = geo_enrich(fx.ip_text(spark, sf_dir), fx.block_networks(spark, sf_dir), fx.countries(spark, sf_dir), "ip")
    return out.select("event_id", "ip", "network", "geoname_id", "country_name", "continent_name")


# --- Per-field value counts -------------------------------------------------------------


@register(
    "value_count_one_field",
    """SELECT 'event_type' AS field, event_type AS val, count(*) AS count
       FROM events GROUP BY event_type HAVING count(*) > 1""",
)
def value_count_one_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(fx.table(spark, sf_dir, "events"), ["event_type"])


@register(
    "value_counts",
    o.with_ctes(
        ["documents_map"],
        """SELECT field, val, count(*) AS count FROM (
             SELECT 'event_type' AS field, event_type AS val FROM documents_map
             UNION ALL SELECT 'user_id', user_id FROM documents_map
             UNION ALL SELECT 'props', props FROM documents_map)
           GROUP BY field, val HAVING count(*) > 1""",
    ),
)
def value_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(fx.documents_map(spark, sf_dir))


@register(
    "value_counts_dotted_names",
    o.with_ctes(
        ["documents_map"],
        """SELECT field, val, count(*) AS count FROM (
             SELECT 'event.type' AS field, event_type AS val FROM documents_map
             UNION ALL SELECT 'user.id', user_id FROM documents_map)
           GROUP BY field, val HAVING count(*) > 1""",
    ),
)
def value_counts_dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields whose names hold dots, as in search documents."""
    docs = fx.documents_map(spark, sf_dir)
    return value_counts(docs.select(F.col("event_type").alias("event.type"), F.col("user_id").alias("user.id")))


@register("map_field_pick", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def map_field_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", pick_field("props", "k", json_text=True).alias("k"))


# --- Substitute ids ---------------------------------------------------------------------


@register("distinct_keys", o.with_ctes(["patient_events"], "SELECT DISTINCT pid FROM patient_events"))
def distinct_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(fx.patient_events(spark, sf_dir), "pid")


@register(
    "deid_lookup_existing",
    o.with_ctes(
        ["patient_events", "deid_lookup"],
        "SELECT e.id, e.pid, l.deid FROM patient_events e LEFT JOIN deid_lookup l ON e.pid = l.pid",
    ),
)
def deid_lookup_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, lookup = fx.patient_events(spark, sf_dir), fx.deid_lookup(spark, sf_dir)
    return skew_aware_join(events, lookup, ["pid"], "left")


_MISSING = """SELECT DISTINCT pid FROM patient_events e
              WHERE NOT EXISTS (SELECT 1 FROM deid_lookup l WHERE l.pid = e.pid)"""
_NEW_IDS = f"SELECT pid, sha256('salt|' || pid) AS deid FROM ({_MISSING})"


@register("deid_missing_keys", o.with_ctes(["patient_events", "deid_lookup"], _MISSING))
def deid_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_keys(fx.patient_events(spark, sf_dir), fx.deid_lookup(spark, sf_dir), "pid")


@register("deid_hash_ids", o.with_ctes(["patient_events", "deid_lookup"], _NEW_IDS))
def deid_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = missing_keys(fx.patient_events(spark, sf_dir), fx.deid_lookup(spark, sf_dir), "pid")
    return hash_ids(missing, "pid", fx.NEW_ID_SALT)


@register(
    "deid_new_mappings",
    o.with_ctes(["patient_events", "deid_lookup"], f"SELECT * FROM deid_lookup UNION ALL {_NEW_IDS}"),
)
def deid_new_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup store after a get-or-create run: a copy of the lookup plus appended ids."""
    store = scratch_path(spark, "deid_store")
    fx.deid_lookup(spark, sf_dir).write.parquet(store)
    lookup = spark.read.parquet(store)
    get_or_create_ids(
        fx.patient_events(spark, sf_dir), lookup, "pid", mode="hash", salt=fx.NEW_ID_SALT, store_path=store
    )
    return spark.read.parquet(store).select("pid", "deid")


@register(
    "deid_get_or_create",
    o.with_ctes(
        ["patient_events", "deid_lookup"],
        f"""SELECT e.id, e.pid, m.deid FROM patient_events e
            JOIN (SELECT * FROM deid_lookup UNION ALL {_NEW_IDS}) m ON e.pid = m.pid""",
    ),
)
def deid_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, lookup = fx.patient_events(spark, sf_dir), fx.deid_lookup(spark, sf_dir)
    enriched, _ = get_or_create_ids(events, lookup, "pid", mode="hash", salt=fx.NEW_ID_SALT)
    return enriched.select("id", "pid", "deid")


@register(
    "deid_null_keys",
    o.with_ctes(
        ["patient_events_with_nulls", "deid_lookup"],
        """SELECT e.id, e.pid, coalesce(l.deid, sha256('salt|' || e.pid)) AS deid
           FROM patient_events_with_nulls e LEFT JOIN deid_lookup l ON e.pid = l.pid""",
    ),
)
def deid_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a key stay, without an id."""
    events, lookup = fx.patient_events_with_nulls(spark, sf_dir), fx.deid_lookup(spark, sf_dir)
    return get_or_create_ids(events, lookup, "pid", mode="hash", salt=fx.NEW_ID_SALT)[0].select("id", "pid", "deid")


@register(
    "deid_duplicate_lookup",
    o.with_ctes(
        ["patient_events", "deid_lookup_doubled"],
        """SELECT e.id, e.pid, coalesce(l.deid, sha256('salt|' || e.pid)) AS deid
           FROM patient_events e
           LEFT JOIN (SELECT pid, min(deid) AS deid FROM deid_lookup_doubled GROUP BY pid) l ON e.pid = l.pid""",
    ),
)
def deid_duplicate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup with two ids a key: each event still comes once, with the smaller id."""
    events, lookup = fx.patient_events(spark, sf_dir), fx.deid_lookup_doubled(spark, sf_dir)
    return get_or_create_ids(events, lookup, "pid", mode="hash", salt=fx.NEW_ID_SALT)[0].select("id", "pid", "deid")


@register(
    "sequence_ids",
    o.with_ctes(
        ["patient_events"],
        "SELECT pid, row_number() OVER (ORDER BY pid) AS seq_id FROM (SELECT DISTINCT pid FROM patient_events)",
    ),
)
def sequence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_ids(fx.patient_events(spark, sf_dir), "pid")


@register(
    "sequence_ids_continue",
    o.with_ctes(
        ["patient_events", "keys", "known"],
        """SELECT * FROM known UNION ALL
           SELECT pid, (SELECT count(*) FROM known) + row_number() OVER (ORDER BY pid) AS seq_id
           FROM keys WHERE pid NOT IN (SELECT pid FROM known)""",
        extra={
            "keys": "SELECT DISTINCT pid FROM patient_events",
            "known": """SELECT pid, row_number() OVER (ORDER BY pid) AS seq_id
                        FROM keys WHERE CAST(pid AS BIGINT) % 3 = 0""",
        },
    ),
)
def sequence_ids_continue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from an earlier run (every third key) are kept; new keys continue after them."""
    events = fx.patient_events(spark, sf_dir)
    earlier = dense_ids(events.where(F.col("pid").cast("bigint") % 3 == 0), "pid")
    _, created = get_or_create_ids(events, earlier, "pid", mode="sequence", out="seq_id")
    return earlier.unionByName(created)


@register(
    "deid_sequence_store",
    o.with_ctes(
        ["patient_events", "keys", "known", "numbered"],
        """SELECT e.id, e.pid, n.seq_id, (SELECT count(*) FROM numbered) AS stored
           FROM patient_events e JOIN numbered n ON e.pid = n.pid""",
        extra={
            "keys": "SELECT DISTINCT pid FROM patient_events",
            "known": """SELECT pid, row_number() OVER (ORDER BY pid) AS seq_id
                        FROM keys WHERE CAST(pid AS BIGINT) % 3 = 0""",
            "numbered": """SELECT * FROM known UNION ALL
                           SELECT pid, (SELECT count(*) FROM known) + row_number() OVER (ORDER BY pid) AS seq_id
                           FROM keys WHERE pid NOT IN (SELECT pid FROM known)""",
        },
    ),
)
def deid_sequence_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned ids, read after the lookup's own store has grown by the new ones."""
    events, store = fx.patient_events(spark, sf_dir), scratch_path(spark, "sequence_store")
    dense_ids(events.where(F.col("pid").cast("bigint") % 3 == 0), "pid").write.parquet(store)
    enriched, _ = get_or_create_ids(
        events, spark.read.parquet(store), "pid", mode="sequence", out="seq_id", store_path=store
    )
    stored = spark.read.parquet(store).select(F.count(F.lit(1))).scalar()
    return enriched.select("id", "pid", "seq_id", stored.alias("stored"))


def _stream_ids(spark: SparkSession, sf_dir: str, mode: str) -> tuple[DataFrame, DataFrame]:
    """The patient events, with null keys, as a stream of four files; rows with ids, and the store."""
    root = scratch_path(spark, "id_stream")
    fx.patient_events_with_nulls(spark, sf_dir).repartition(4, "id").write.json(f"{root}/in")
    lookup = fx.deid_lookup(spark, sf_dir)
    out = "deid"
    if mode == "sequence":
        lookup, out = dense_ids(lookup, "pid"), "seq_id"
    create_id_store(lookup, f"{root}/store", "pid", out)
    events = spark.readStream.schema("id string, pid string").option("maxFilesPerTrigger", 1).json(f"{root}/in")
    start_id_stream(
        events, store_path=f"{root}/store", out_path=f"{root}/out", checkpoint_location=f"{root}/checkpoint",
        key="pid", mode=mode, out=out, salt=fx.NEW_ID_SALT, trigger={"availableNow": True},
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("id", "pid", out), spark.read.parquet(f"{root}/store").select("pid", out)


@register("stream_deid_get_or_create", ORACLE["deid_null_keys"])
def stream_deid_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Get-or-create on a stream: the rows of the batch run."""
    return _stream_ids(spark, sf_dir, "hash")[0]


@register(
    "stream_deid_sequence",
    o.with_ctes(
        ["patient_events_with_nulls", "deid_lookup"],
        """SELECT count(*) AS keys, min(n) AS least, max(n) AS greatest, count(DISTINCT n) AS ids
           FROM (SELECT row_number() OVER () AS n FROM (
             SELECT pid FROM deid_lookup UNION SELECT pid FROM patient_events_with_nulls WHERE pid IS NOT NULL))""",
    ),
)
def stream_deid_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sequence on a stream: the stored ids are 1 to the number of keys, without gaps or repeats
    (which key gets which new id depends on the order of the files)."""
    store = _stream_ids(spark, sf_dir, "sequence")[1]
    return store.agg(
        F.countDistinct("pid").alias("keys"), F.min("seq_id").alias("least"),
        F.max("seq_id").alias("greatest"), F.countDistinct("seq_id").alias("ids"),
    )


# --- Files, documents and tables ----------------------------------------------------------


@register("csv_round_trip", "SELECT * FROM nation")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = fx.table(spark, sf_dir, "nation")
    path = scratch_path(spark, "nation_csv")
    write_csv(nation, path)
    return read_csv(spark, path, schema=nation.schema)


@register("documents_csv_round_trip", "SELECT * FROM documents")
def documents_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and blanks through CSV and back."""
    docs = fx.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents_csv")
    write_csv(docs, path, multiline=True)
    return read_csv(spark, path, schema=docs.schema, multiline=True, options={"lineSep": "\n"})


@register("documents_csv_in_splits", "SELECT * FROM documents")
def documents_csv_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts, their files with headers read split by split."""
    docs = fx.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents_csv")
    write_csv(docs, path, header=True, multiline=True)
    return read_split_csv(spark, path, schema=docs.schema, header=True)


@register("csv_header_scan", "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region")
def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "region_csv")
    write_csv(fx.table(spark, sf_dir, "region"), path, header=True)
    return read_csv(spark, path, header=True)


@register("csv_lowercase_columns", "SELECT * FROM supplier")
def csv_lowercase_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose header is upper case; names are lowered on read, then typed by name."""
    supplier = fx.table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier_csv")
    write_csv(supplier.toDF(*[c.upper() for c in supplier.columns]), path, header=True)
    df = read_csv(spark, path, header=True, lowercase_columns=True)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in supplier.schema.fields])


@register("json_documents_scan", "SELECT event_id, user_id, event_type, value, props FROM events")
def json_documents_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "events").drop("ts")
    path = scratch_path(spark, "events_json")
    write_documents(docs, path, fmt="json", mode="errorifexists")
    return read_documents(spark, path, fmt="json", schema=docs.schema)


@register(
    "text_dump",
    "SELECT '[' || concat_ws(',', n_nationkey, n_name, n_regionkey) || ']' AS value FROM nation",
)
def text_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "nation_text")
    write_text(fx.table(spark, sf_dir, "nation"), path)
    return spark.read.text(path)


_SOME_NULLS = "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status"


@register("orders_csv_header_scan", f"SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {_SOME_NULLS} FROM orders")
def orders_csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header scan over a growing table with nulls."""
    path = scratch_path(spark, "orders_csv")
    write_csv(fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", _SOME_NULLS), path, header=True)
    return read_csv(spark, path, header=True)


@register(
    "orders_text_dump",
    f"""SELECT '[' || o_orderkey || ',' || o_custkey || ',' || coalesce(status, 'null') || ']' AS value
        FROM (SELECT o_orderkey, o_custkey, {_SOME_NULLS} FROM orders)""",
)
def orders_text_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text dump over a growing table with nulls."""
    path = scratch_path(spark, "orders_text")
    write_text(fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", _SOME_NULLS), path)
    return spark.read.text(path)


@register(
    "keyed_overwrite_keep_last",
    o.with_ctes(
        ["keyed_rows"],
        """SELECT key, l_linenumber, l_partkey, l_suppkey, v FROM (
             SELECT *, row_number() OVER (PARTITION BY key
                       ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
             FROM keyed_rows) WHERE rn = 1""",
    ),
)
def keyed_overwrite_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "keyed_store")
    keyed_overwrite(fx.keyed_rows(spark, sf_dir), path, "key", ["l_linenumber", "l_partkey", "l_suppkey"])
    return spark.read.parquet(path)


@register(
    "keyed_merge",
    """SELECT l_orderkey AS key, l_linenumber AS n, CASE WHEN l_orderkey % 10 = 3 THEN -v ELSE v END AS v FROM (
         SELECT l_orderkey, l_linenumber, l_quantity AS v, row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_linenumber DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1
       UNION ALL SELECT -o_orderkey, 0, 1 FROM orders WHERE o_orderkey % 10 = 3""",
)
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one keyed table: all line items, then for the orders that end in 3 changed
    rows and rows with new keys."""
    rows = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("v")
    )
    store = KeyedTable(spark, scratch_path(spark, "keyed_table"), "key", rows.schema)
    store.merge(rows, ["n"])
    changed = rows.where(F.col("key") % 10 == 3).withColumn("v", -F.col("v"))
    fresh = fx.table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 10 == 3)
    fresh = fresh.select((-F.col("o_orderkey")).alias("key"), F.lit(0).alias("n"), F.lit(1).alias("v"))
    # Of equal line numbers the least negative, which was the smallest quantity: order by its opposite.
    store.merge(changed.withColumn("w", -F.col("v")).unionByName(fresh.withColumn("w", F.lit(0))), ["n", "w"])
    return store.read()


@register("deid_point_reads", ORACLE["deid_lookup_existing"])
def deid_point_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup as a keyed table, from which only buckets with wanted keys are read."""
    lookup = fx.deid_lookup(spark, sf_dir)
    store = KeyedTable(spark, scratch_path(spark, "deid_table"), "pid", lookup.schema)
    store.merge(lookup)
    return store.enrich(fx.patient_events(spark, sf_dir)).select("id", "pid", "deid")


@register(
    "keyed_index_csv_job",
    """SELECT CAST(o_custkey AS VARCHAR) AS recordid, CAST(o_orderkey AS VARCHAR) AS n,
              'say ""' || o_orderkey || '", ' || chr(10) || ' twice ' AS note
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def keyed_index_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed load over several headed CSV files in order, of unequal size, with quotes and
    line breaks; the whole store is read back."""
    root = scratch_path(spark, "keyed_job")
    key = F.col("o_orderkey")
    orders = fx.table(spark, sf_dir, "orders")
    files = max(4, orders.count() // 500_000)  # a task sorts and writes a file
    orders = orders.repartitionByRange(files, F.sqrt(key), key).sortWithinPartitions(key)
    rows = orders.select(
        F.col("o_custkey").alias("RecordId"),
        key.alias("N"),
        F.concat(F.lit('say ""'), key.cast("string"), F.lit('", \n twice ')).alias("Note"),
    )
    write_csv(rows, f"{root}/in", header=True, multiline=True)
    load_keyed_index(spark, f"{root}/in", f"{root}/store", "recordid", multiline=True, line_end="\n")
    return spark.read.parquet(f"{root}/store")


@register("ctas_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def ctas_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "report_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    path = scratch_path(spark, name)
    create_table_as(fx.table(spark, sf_dir, "orders"), name, limit=10, order_by=["o_orderkey"], path=path)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return spark.read.parquet(path)


# --- Streams ------------------------------------------------------------------------------

STREAM_MESSAGE_SCHEMA = "event_id bigint, message string"


def _message_files(spark: SparkSession, sf_dir: str, root: str, files: int = 4) -> str:
    """The DNS messages as JSON text files: the records a stream source delivers."""
    path = f"{root}/in"
    fx.dns_json_values(spark, sf_dir).repartition(files).write.text(path)
    return path


def _stream_alerts(spark: SparkSession, sf_dir: str, max_broadcast_bytes: int | None = None) -> DataFrame:
    root = scratch_path(spark, "dns_stream")
    source = _message_files(spark, sf_dir, root)
    write_csv(fx.domain_list(spark, sf_dir), f"{root}/list")
    query = start_dns_alert_stream(
        read_messages(spark, fmt="text", path=source, options={"maxFilesPerTrigger": "1"}),
        read_csv(spark, f"{root}/list", schema=MALWARE_LIST_SCHEMA),
        checkpoint_location=f"{root}/checkpoint",
        message_schema=STREAM_MESSAGE_SCHEMA,
        sink_format="parquet",
        path=f"{root}/out",
        trigger={"availableNow": True},
        as_json=False,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("stream_dns_alerts", _ALERTS_SQL)
def stream_dns_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert stream over file-delivered messages (one file per micro-batch), the list
    read from a headerless CSV, alerts written to parquet and read back."""
    return _stream_alerts(spark, sf_dir)


@register("stream_dns_alerts_large_list", _ALERTS_SQL)
def stream_dns_alerts_large_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with no list small enough to broadcast."""
    return _stream_alerts(spark, sf_dir, max_broadcast_bytes=0)


@register(
    "stream_dns_rejects",
    o.with_ctes(
        ["dns_raw"],
        """SELECT value, CASE WHEN event_id % 19 = 0 THEN 'broken record'
                              WHEN message IS NULL THEN 'no message' ELSE 'unparsed line' END AS reason
           FROM dns_raw WHERE event_id % 19 = 0 OR message IS NULL OR domain = ''""",
    ),
)
def stream_dns_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of records that cannot be matched: raw text and reason."""
    root = scratch_path(spark, "dns_rejects")
    fx.dns_raw_values(spark, sf_dir).repartition(4).write.text(f"{root}/in")
    query = start_dns_reject_stream(
        read_messages(spark, fmt="text", path=f"{root}/in", options={"maxFilesPerTrigger": "1"}),
        checkpoint_location=f"{root}/checkpoint",
        message_schema=STREAM_MESSAGE_SCHEMA,
        path=f"{root}/out",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return spark.read.schema("value string, reason string").json(f"{root}/out")


def _alert_job(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The alert job over records with a further field; the folders of alerts and listings."""
    root = scratch_path(spark, "dns_job")
    fx.dns_raw_values(spark, sf_dir).repartition(4).write.text(f"{root}/in")
    write_csv(fx.domain_list(spark, sf_dir), f"{root}/list")
    dns_alert_job(
        spark,
        list_path=f"{root}/list",
        checkpoint_location=f"{root}/checkpoint",
        source_format="text",
        source_path=f"{root}/in",
        sink_format="text",
        sink_path=f"{root}/out",
        trigger={"availableNow": True},
        message_schema="event_id bigint, host string, message string",
        listings_path=f"{root}/listings",
    ).awaitTermination()
    return f"{root}/out", f"{root}/listings"


@register(
    "dns_alert_job",
    o.with_ctes(
        ["alerts"],
        f"""SELECT {', '.join(_ALERT_COLS)}, 'ns' || event_id % 7 AS host
            FROM alerts WHERE event_id % 19 <> 0""",
    ),
)
def dns_alert_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert job end to end: JSON records in, JSON alerts out with all of their fields."""
    schema = "event_id bigint, host string, message string, query_type string, domain string, address string, listing_count bigint"
    return spark.read.schema(schema).json(_alert_job(spark, sf_dir)[0])


@register(
    "dns_alert_job_any_fields",
    o.with_ctes(
        ["alerts"],
        f"""SELECT {', '.join(_ALERT_COLS)}, CASE WHEN event_id % 2 = 0 THEN 'ns' || event_id % 7 END AS host,
                   CASE WHEN event_id % 3 = 0 THEN event_id % 3600 END AS ttl,
                   CASE WHEN event_id % 5 = 0 THEN 'c' || event_id % 11 END AS client_name,
                   CASE WHEN event_id % 5 = 0 THEN event_id % 100 END AS client_port
            FROM alerts WHERE event_id % 19 <> 0""",
    ),
)
def dns_alert_job_any_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert job over records with differing fields and no declared schema: all of a record's
    fields are in its alert."""
    root = scratch_path(spark, "dns_any_job")
    fx.dns_any_values(spark, sf_dir).repartition(4).write.text(f"{root}/in")
    write_csv(fx.domain_list(spark, sf_dir), f"{root}/list")
    dns_alert_job(
        spark, list_path=f"{root}/list", checkpoint_location=f"{root}/checkpoint", source_format="text",
        source_path=f"{root}/in", sink_format="text", sink_path=f"{root}/out", trigger={"availableNow": True}, message_schema=None,
    ).awaitTermination()
    schema = """event_id bigint, message string, query_type string, domain string, address string, listing_count bigint,
                host string, ttl bigint, client struct<name: string, port: bigint>"""
    alerts = spark.read.schema(schema).json(f"{root}/out")
    return alerts.select(*_ALERT_COLS, "host", "ttl", F.col("client.name").alias("client_name"), F.col("client.port").alias("client_port"))


@register(
    "dns_alert_listings",
    o.with_ctes(["clean_list"], f"SELECT domain, {', '.join(MALWARE_LIST_FIELDS)} FROM clean_list"),
)
def dns_alert_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert job's second output: the list entries by domain."""
    return spark.read.parquet(_alert_job(spark, sf_dir)[1]).select("domain", *MALWARE_LIST_FIELDS)


@register(
    "stream_foreach_batch_sink",
    o.with_ctes(["dns_parsed"], "SELECT event_id, query_type, domain, address FROM dns_parsed WHERE domain <> ''"),
)
def stream_foreach_batch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed DNS lines streamed through ``foreachBatch`` into per-epoch folders."""
    root = scratch_path(spark, "dns_batches")
    source = _message_files(spark, sf_dir, root)
    messages = read_messages(spark, fmt="text", path=source, options={"maxFilesPerTrigger": "1"})
    parsed = parse_matching_dns(json_values_to_rows(messages, STREAM_MESSAGE_SCHEMA))
    query = (
        parsed.select("event_id", "query_type", "domain", "address")
        .writeStream.foreachBatch(foreach_batch_sink(f"{root}/out"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "query_type", "domain", "address")


# --- Whole jobs ---------------------------------------------------------------------------


@register(
    "geo_enrich_csv_job",
    o.with_ctes(
        ["ips", "blocks", "countries"],
        f"""SELECT i.event_id, {o.quad('i.ipn')} AS ip,
                   {o.quad('b.s')} || '/' || CAST(b.plen AS VARCHAR) AS network,
                   c.geoname_id, c.country_name, c.continent_name
            FROM ips i JOIN blocks b ON i.ipn BETWEEN b.s AND b.e
            JOIN countries c ON c.geoname_id = CAST(b.geoname_id AS VARCHAR)""",
    ),
)
def geo_enrich_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geo job over files: blocks and country names as headed CSV files."""
    root = scratch_path(spark, "geo_job")
    write_csv(fx.block_networks(spark, sf_dir), f"{root}/blocks", header=True)
    write_csv(fx.countries(spark, sf_dir), f"{root}/names", header=True)
    out = geo_enrich_files(fx.ip_text(spark, sf_dir), f"{root}/blocks", f"{root}/names", "ip")
    return out.select("event_id", "ip", "network", "geoname_id", "country_name", "continent_name")


@register("value_counts_index_job", ORACLE["value_counts"])
def value_counts_index_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value-count job over documents: JSON documents in, counts appended to an index."""
    root = scratch_path(spark, "counts_job")
    write_documents(fx.documents_map(spark, sf_dir), f"{root}/docs", mode="errorifexists")
    value_counts_index(
        spark, f"{root}/docs", f"{root}/counts", schema="event_type string, user_id string, props string"
    )
    return read_documents(spark, f"{root}/counts", schema="field string, val string, count bigint")


@register(
    "deid_text_job",
    o.with_ctes(
        ["patient_events", "deid_lookup"],
        f"""SELECT '[' || e.id || ',' || e.pid || ',' || m.deid || ']' AS value FROM patient_events e
            JOIN (SELECT * FROM deid_lookup UNION ALL {_NEW_IDS}) m ON e.pid = m.pid""",
    ),
)
def deid_text_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The de-identification job: events get ids from a store (new ones appended), and are
    dumped as text lines."""
    root = scratch_path(spark, "deid_job")
    fx.deid_lookup(spark, sf_dir).write.parquet(f"{root}/store")
    deid_events_to_text(
        fx.patient_events(spark, sf_dir), f"{root}/store", f"{root}/text", mode="hash", salt=fx.NEW_ID_SALT
    )
    return spark.read.text(f"{root}/text")


@register(
    "map_value_counts",
    """SELECT field, val, count(*) AS count FROM (
         SELECT k AS field, json_extract_string(props, '$."' || k || '"') AS val
         FROM (SELECT props, unnest(json_keys(props)) AS k FROM events))
       GROUP BY field, val HAVING count(*) > 1""",
)
def map_value_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts over schemaless documents: every key of every document is a field."""
    docs = fx.table(spark, sf_dir, "events").select(F.from_json("props", "map<string,string>").alias("doc"))
    return map_value_counts(docs, "doc")
