"""Text extraction: DNS log lines and host names, as ``regexp_extract`` expressions.

The patterns avoid look-around so that the same text runs on Java regex (Spark)
and RE2 (the SQL oracle) with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The DNS line layout is "<time> <process>: <type> <domain> <word> <address>",
# e.g. "Mar  3 04:05:06 resolver[17]: reply cdn.shop.example.org is 203.0.113.8".
# Groups: 1 = query type, 2 = domain, 3 = address (without the leading blank). The word and
# the address may be missing, and the type where its two blanks are left.
DNS_LINE_PATTERN = r"^.*?:(?:\s+([/\w\[\]]+)|\s)\s+(\S+)(?:\s+(?:\w+(?:\s+|$))?(.*))?$"

# A host name is one or more labels of 1-63 letters, digits or inner hyphens,
# each followed by a dot, then a top-level domain of 2 to ``max_tld`` letters (default 63, the longest label).
_LABEL = r"[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\."
DEFAULT_MAX_TLD = 63


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def domain_pattern(max_tld: int = DEFAULT_MAX_TLD) -> str:
    return f"({_LABEL})+[A-Za-z]{{2,{max_tld}}}"


# Java's ``$`` may stop before one final line terminator; group 3 (``.*``) never holds one.
_LINE_ENDS = "\n\r\u0085\u2028\u2029"
_FIELDS = ("query_type", "domain", "address")


def dns_line_matches(message: Column | str) -> Column:
    """True when the DNS line pattern matches (null for a null message)."""
    return _col(message).rlike(DNS_LINE_PATTERN)


def dns_fields(message: Column | str, assume_match: bool = False) -> dict[str, Column]:
    """Query type, domain and address of a DNS log line ('' when the line does not match).

    ``assume_match=True`` is for rows already filtered by ``dns_line_matches``: one
    pattern search then yields all three groups (the anchored match is rewritten to
    ``g1 g2 g3`` and split in three; groups 1 and 2 hold no whitespace, group 3 is the
    rest). Those fields are never null, and are marked so (``coalesce``): a join on
    ``domain`` then infers no ``isnotnull`` filter that would repeat the search. On
    unfiltered rows three ``regexp_extract`` calls are cheaper than a match test plus the
    rewrite.
    """
    m = _col(message)
    if not assume_match:
        return {name: F.regexp_extract(m, DNS_LINE_PATTERN, i + 1) for i, name in enumerate(_FIELDS)}
    parts = F.split(F.regexp_replace(m, DNS_LINE_PATTERN, "$1 $2 $3"), " ", 3)
    groups = [F.get(parts, 0), F.get(parts, 1), F.rtrim(F.get(parts, 2), F.lit(_LINE_ENDS))]
    return {name: F.coalesce(g, F.lit("")) for name, g in zip(_FIELDS, groups)}


def first_domain(c: Column | str, max_tld: int = DEFAULT_MAX_TLD) -> Column:
    """First host name found in free text or a URL ('' when there is none)."""
    return F.regexp_extract(_col(c), domain_pattern(max_tld), 0)


def clean_domain(
    primary: Column | str,
    fallback: Column | str,
    placeholder: str = "-",
    max_tld: int = DEFAULT_MAX_TLD,
) -> Column:
    """Host name of ``primary``, or of ``fallback`` when ``primary`` is the placeholder."""
    primary, fallback = _col(primary), _col(fallback)
    return F.when(primary == F.lit(placeholder), first_domain(fallback, max_tld)).otherwise(
        first_domain(primary, max_tld)
    )
