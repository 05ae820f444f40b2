"""DNS log parsing and the match of looked-up domains against a list of bad domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.text import DEFAULT_MAX_TLD, clean_domain, dns_fields, dns_line_matches
from enrichkit.operators.bloom import bloom_filter, possible_matches
from enrichkit.operators.joins import skew_aware_join
from enrichkit.operators.sizing import fits_broadcast, measure
from enrichkit.session import ensure_checkpoint_dir

# Field order of the malware domain list (CSV without header). The second
# field is the listed domain, called ``listed_domain`` here so that ``domain`` can hold the
# cleaned host name used for the match.
MALWARE_LIST_FIELDS = [
    "date",
    "listed_domain",
    "ip",
    "reverse",
    "description",
    "registrant",
    "asn",
    "inactive",
    "country",
]
_ALERT_FIELDS = ("query_type", "domain", "address", "listing_count")
STREAM_SALT_BUCKETS = 8
MALWARE_LIST_SCHEMA = ", ".join(f"{f} string" for f in MALWARE_LIST_FIELDS)


def parse_dns(messages: DataFrame, message_col: str = "message") -> DataFrame:
    """Add ``query_type``, ``domain`` and ``address`` parsed from a DNS log line."""
    return messages.withColumns(dns_fields(F.col(message_col)))


def parse_matching_dns(messages: DataFrame, message_col: str = "message") -> DataFrame:
    """Only the lines the DNS pattern matches, parsed (a matching line's domain is never
    ''): the match test runs in the filter, so each kept line costs one more search."""
    matching = messages.where(dns_line_matches(F.col(message_col)))
    return matching.withColumns(dns_fields(F.col(message_col), assume_match=True))


def clean_domain_list(
    listing: DataFrame,
    primary: str = "listed_domain",
    fallback: str = "reverse",
    placeholder: str = "-",
    max_tld: int = DEFAULT_MAX_TLD,
    normalize: bool = False,
) -> DataFrame:
    """Add the list entry's host name as ``domain`` and keep entries that have one.

    The host comes from ``primary``, or from ``fallback`` when ``primary`` is the
    placeholder; entries without a host name ('' or null) cannot match and are dropped.
    """
    domain = clean_domain(F.col(primary), F.col(fallback), placeholder, max_tld)
    if normalize:
        domain = F.lower(domain)
    return listing.withColumn("domain", domain).where(F.col("domain") != F.lit(""))


def listed_domains(listing: DataFrame, normalize: bool = False, max_tld: int = DEFAULT_MAX_TLD) -> DataFrame:
    """One row per listed host: ``domain`` and ``listing_count``, the entries naming it.

    Counting the list per host before the join (with map-side combine, so a host listed very
    often is no hot group) keeps the join one-to-one: an alert per matching lookup, never one
    row per (lookup, list entry) pair. The entries themselves are ``clean_domain_list``: one
    row per entry, to be joined by ``domain`` where they are wanted.
    """
    cleaned = clean_domain_list(listing, max_tld=max_tld, normalize=normalize)
    return cleaned.groupBy("domain").agg(F.count(F.lit(1)).alias("listing_count"))


def _matchable(messages: DataFrame, message_col: str, normalize: bool) -> DataFrame:
    parsed = parse_matching_dns(messages, message_col)
    if normalize:
        parsed = parsed.withColumn("domain", F.lower(F.col("domain")))
    return parsed


def dns_alerts(
    messages: DataFrame,
    listing: DataFrame,
    *,
    message_col: str = "message",
    normalize: bool = False,
    max_tld: int = DEFAULT_MAX_TLD,
    max_broadcast_bytes: int | None = None,
    max_filter_bytes: int | None = None,
) -> DataFrame:
    """One alert per DNS lookup whose domain is on the list, batch or stream.

    Columns: the message columns (a message field called like one of the following gives way
    to it), ``query_type``, ``domain``, ``address`` and ``listing_count``. ``listing`` holds
    the raw list fields; it is cleaned and counted per host here. Lines that do not parse and
    entries without a host never match (they would otherwise meet on '' = '').

    The list's size changes only how the join runs. The counted list is pinned once in the
    shared folder. Within the broadcast bound it is broadcast. Over it a Bloom filter of its
    domains (bounded by ``max_filter_bytes``, the session's broadcast bound by default) is
    broadcast instead, and only lookups that pass it are shuffled: a batch then takes the
    skew-aware join, and a stream, where skewed partitions are not split at run time, a salted
    shuffle join.
    """
    listed = listed_domains(listing, normalize, max_tld)
    first = [c for c in messages.columns if c not in _ALERT_FIELDS]
    parsed = _matchable(messages.select(*[F.col(f"`{c}`") for c in messages.columns if c in first]), message_col, normalize)
    ensure_checkpoint_dir(listing.sparkSession)
    listed = listed.checkpoint(eager=True)
    size = measure(listed)
    if fits_broadcast(listed, max_broadcast_bytes, size):
        joined = parsed.join(F.broadcast(listed), "domain", "inner")
    else:
        bloom = bloom_filter(listed, "domain", size.rows, max_bytes=max_filter_bytes)
        likely = parsed if bloom is None else possible_matches(parsed, "domain", bloom)
        if messages.isStreaming:
            joined = _salted_stream_join(likely, listed)
        else:
            joined = skew_aware_join(likely, listed, ["domain"], "inner", max_broadcast_bytes=max_broadcast_bytes, small_size=size)
    return joined.select(*[F.col(f"`{c}`") for c in first], *_ALERT_FIELDS)


def _salted_stream_join(parsed: DataFrame, listed: DataFrame) -> DataFrame:
    """Shuffle join of a stream with a list too big to broadcast, every domain spread over
    ``enrichkit.skew.streamSaltBuckets`` tasks so that one looked up very often fills none.

    The salt is a hash of the whole message, so a retried task deals its rows alike. The list,
    one narrow row per host, is copied once per salt and stored already partitioned.
    """
    spark = parsed.sparkSession
    buckets = int(spark.conf.get("enrichkit.skew.streamSaltBuckets", str(STREAM_SALT_BUCKETS)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = listed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    salted = salted.repartition(parts, "domain", "__salt").checkpoint(eager=True)
    salt = F.pmod(F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in parsed.columns]))), F.lit(buckets))
    return parsed.withColumn("__salt", salt.cast("int")).join(salted, ["domain", "__salt"], "inner")


def dns_rejects(messages: DataFrame, message_col: str = "message") -> DataFrame:
    """Messages that cannot be matched: no message at all, or a line that does not parse."""
    parsed = parse_dns(messages, message_col)
    reason = F.when(F.col(message_col).isNull(), F.lit("no message")).when(
        F.col("domain") == F.lit(""), F.lit("unparsed line")
    )
    return parsed.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        *messages.columns, "reason"
    )
