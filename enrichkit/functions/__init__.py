"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from enrichkit.functions.net import cidr_end, cidr_prefix_len, cidr_start, ipv4_to_long, long_to_ipv4
from enrichkit.functions.records import lower_columns, null_to_empty, pick_field, row_json, row_text
from enrichkit.functions.text import DNS_LINE_PATTERN, clean_domain, dns_fields, domain_pattern, first_domain

__all__ = [
    "DNS_LINE_PATTERN",
    "cidr_end",
    "cidr_prefix_len",
    "cidr_start",
    "clean_domain",
    "dns_fields",
    "domain_pattern",
    "first_domain",
    "ipv4_to_long",
    "long_to_ipv4",
    "lower_columns",
    "null_to_empty",
    "pick_field",
    "row_json",
    "row_text",
]
