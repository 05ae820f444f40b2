"""DataFrame -> DataFrame operators: lookups, range joins, value counts, ids, keep-last."""

from enrichkit.operators.blocklist import clean_domain_list, dns_alerts, dns_rejects, listed_domains, parse_dns
from enrichkit.operators.geo import geo_enrich
from enrichkit.operators.ids import dense_ids, distinct_keys, get_or_create_ids, hash_ids, missing_keys, uuid_ids
from enrichkit.operators.joins import skew_aware_join
from enrichkit.operators.keyed import keep_last
from enrichkit.operators.profile import map_value_counts, value_counts
from enrichkit.operators.ranges import cidr_ranges, range_lookup, store_ranges, with_match_status
from enrichkit.operators.sizing import fits_broadcast, measure

__all__ = [
    "cidr_ranges",
    "clean_domain_list",
    "dense_ids",
    "distinct_keys",
    "dns_alerts",
    "dns_rejects",
    "fits_broadcast",
    "geo_enrich",
    "get_or_create_ids",
    "hash_ids",
    "keep_last",
    "listed_domains",
    "map_value_counts",
    "measure",
    "missing_keys",
    "parse_dns",
    "range_lookup",
    "skew_aware_join",
    "store_ranges",
    "uuid_ids",
    "value_counts",
    "with_match_status",
]
