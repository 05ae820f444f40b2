"""DuckDB SQL for the registered queries: the independent check of every result.

Each query is written against the pre-registered views (region, nation, customer, part,
orders, lineitem, events, pages, ...). The derived inputs of ``fixtures.py`` are spelled
here again in DuckDB's dialect as CTEs.
"""

from __future__ import annotations

_QUAD = (
    "CAST({x} // 16777216 AS VARCHAR) || '.' || CAST({x} // 65536 % 256 AS VARCHAR) || '.' || "
    "CAST({x} // 256 % 256 AS VARCHAR) || '.' || CAST({x} % 256 AS VARCHAR)"
)

CTES: dict[str, str] = {
    "hosts": "SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS h FROM pages",
    # The fields are those that the line is made of, not what a pattern finds in it.
    "dns_parts": """
        SELECT e.event_id, h.h,
          CASE WHEN e.event_id % 17 = 0 THEN 'none' WHEN e.event_id % 13 = 0 THEN 'odd' ELSE 'line' END AS kind,
          CASE WHEN e.event_id % 23 = 0 THEN ''
               ELSE CASE e.event_id % 4 WHEN 0 THEN 'reply' WHEN 1 THEN 'cached' WHEN 2 THEN 'query[A]' ELSE 'forwarded' END
          END AS query_word,
          CASE e.event_id % 4 WHEN 0 THEN 'is' WHEN 1 THEN 'is' WHEN 2 THEN 'from' ELSE 'to' END AS link,
          CASE WHEN e.event_id % 29 = 0 THEN ''
               ELSE '10.0.' || CAST(e.event_id % 256 AS VARCHAR) || '.' || CAST(e.user_id % 256 AS VARCHAR) END AS tail
        FROM events e JOIN hosts h ON h.page_id = e.event_id % (SELECT count(*) FROM pages)""",
    "dns_parsed": """
        SELECT event_id,
          CASE kind WHEN 'none' THEN NULL WHEN 'odd' THEN 'not a dns line'
               ELSE 'Jan 22 15:26:31 dnsmasq[' || CAST(9000 + event_id % 100 AS VARCHAR) || ']: ' || query_word || ' ' || h
                 || CASE WHEN tail = '' THEN '' ELSE ' ' || link || ' ' || tail END
          END AS message,
          CASE kind WHEN 'none' THEN NULL WHEN 'odd' THEN '' ELSE query_word END AS query_type,
          CASE kind WHEN 'none' THEN NULL WHEN 'odd' THEN '' ELSE h END AS domain,
          CASE kind WHEN 'none' THEN NULL WHEN 'odd' THEN '' ELSE tail END AS address
        FROM dns_parts""",
    "dns_messages": "SELECT event_id, message FROM dns_parsed",
    "domain_list": """
        SELECT '2018/01/22_00:00' AS date,
          CASE WHEN page_id % 3 = 0 THEN '-' ELSE h || '/x.php' END AS listed_domain,
          '-' AS ip,
          CASE WHEN page_id % 5 = 0 THEN '-' ELSE h END AS reverse,
          'listed page ' || CAST(page_id AS VARCHAR) AS description,
          '-' AS registrant, '0' AS asn, '0' AS inactive, '-' AS country
        FROM hosts WHERE page_id % 7 = 0""",
    "clean_list": """
        SELECT * FROM (SELECT *, CASE WHEN listed_domain <> '-' THEN split_part(listed_domain, '/', 1) WHEN reverse = '-' THEN '' ELSE reverse END AS domain
                       FROM domain_list) WHERE domain <> ''""",
    "listed": """
        SELECT domain, count(*) AS listing_count FROM clean_list GROUP BY domain""",
    "dns_raw": """
        SELECT *, CASE WHEN event_id % 19 = 0 THEN left(whole, 12) ELSE whole END AS value
        FROM (SELECT *, '{"event_id":' || event_id || ',"host":"ns' || event_id % 7 || '"'
                || CASE WHEN message IS NULL THEN '' ELSE ',"message":"' || message || '"' END || '}' AS whole
              FROM dns_parsed)""",
    "alerts": """
        SELECT d.event_id, d.message, d.query_type, d.domain, d.address, l.listing_count
        FROM dns_parsed d JOIN listed l ON d.domain = l.domain
        WHERE d.domain <> ''""",
    "ips": "SELECT event_id, (event_id * 2654435761) % 268435456 AS ipn FROM events",
    "blocks": """
        SELECT 16777216 + p_partkey * 131072 AS s,
               16777216 + p_partkey * 131072 + CAST(pow(2, 32 - (15 + p_size % 10)) AS BIGINT) - 1 AS e,
               CAST(15 + p_size % 10 AS INTEGER) AS plen,
               p_partkey % 25 AS geoname_id
        FROM part""",
    "nested_blocks": """
        SELECT s, e, plen, CAST(geoname_id AS VARCHAR) AS geoname_id FROM blocks
        UNION ALL
        SELECT s // w * w AS s, s // w * w + w - 1 AS e, plen - 4 AS plen, CAST(geoname_id + 100 AS VARCHAR) AS geoname_id
        FROM (SELECT *, CAST(pow(2, 36 - plen) AS BIGINT) AS w FROM blocks)""",
    "wide_keys": "SELECT event_id, ((event_id * 2654435761) % 268435456) * 16777216 + event_id AS k FROM events",
    "wide_ranges": """
        SELECT p_partkey::BIGINT * 2199023255552 AS s,
          p_partkey::BIGINT * 2199023255552 + CASE WHEN p_size % 10 = 0 THEN 0 WHEN p_size % 10 < 4 THEN p_size::BIGINT * 1000
                                                   ELSE 1099511627776 + p_size END AS e,
          'part ' || p_partkey AS name
        FROM part""",
    "wide_nested": """
        SELECT s, e, name FROM wide_ranges
        UNION ALL SELECT s // 35184372088832 * 35184372088832, s // 35184372088832 * 35184372088832 + 35184372088831, name || ' group'
        FROM wide_ranges
        UNION ALL SELECT s + 549755813888, s + 3298534883328, name || ' cross' FROM wide_ranges
        UNION ALL SELECT 0, 4611686018427387905, 'all'""",
    # Addresses and networks as 128-bit numbers; the prefix 2001:db8::/32 in front.
    "mixed_keys": """
        SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 4 ELSE 6 END AS family,
          CASE event_id % 3 WHEN 0 THEN ipn::HUGEINT
            WHEN 1 THEN 536939960::HUGEINT * 79228162514264337593543950336 + (ipn // 65536)::HUGEINT * 1208925819614629174706176
                        + (ipn % 65536)::HUGEINT * 18446744073709551616 + event_id % 7
            ELSE 536939960::HUGEINT * 79228162514264337593543950336 + (ipn // 65536)::HUGEINT * 1208925819614629174706176
                        + (ipn % 65536)::HUGEINT * 4294967296 + event_id % 7 * 256 + event_id % 251 END AS k
        FROM ips""",
    "mixed_first": """
        SELECT 'part ' || p_partkey || ' short' AS name, CASE WHEN p_size % 2 = 0 THEN 48 ELSE 52 + p_size % 13 END AS plen,
          536939960::HUGEINT * 79228162514264337593543950336 + (p_partkey % 4096)::HUGEINT * 1208925819614629174706176
            + CASE WHEN p_size % 2 = 0 THEN 0 ELSE (p_partkey::HUGEINT * 37 % 65536) * 18446744073709551616 END AS first
        FROM part
        UNION ALL
        SELECT 'part ' || p_partkey || ' long', 81 + p_size % 30,
          536939960::HUGEINT * 79228162514264337593543950336 + (p_partkey % 4096)::HUGEINT * 1208925819614629174706176
            + (p_partkey::HUGEINT * 31 % 65536) * 4294967296
        FROM part""",
    "mixed_blocks": """
        SELECT 4 AS family, 'block ' || s AS name, plen::INTEGER AS plen, s::HUGEINT AS s, e::HUGEINT AS e FROM blocks
        UNION ALL
        SELECT 6, name, plen::INTEGER, first // w * w, first // w * w + w - 1
        FROM (SELECT *, 1::HUGEINT << (128 - plen)::INTEGER AS w FROM mixed_first)""",
    "patient_events_with_nulls": """
        SELECT id, CASE WHEN CAST(id AS BIGINT) % 5 <> 0 THEN pid END AS pid FROM patient_events""",
    "deid_lookup_doubled": """
        SELECT pid, deid FROM deid_lookup UNION ALL SELECT pid, sha256('salt|' || pid) AS deid FROM deid_lookup""",
    "countries": """
        SELECT CAST(n_nationkey AS VARCHAR) AS geoname_id, n_name AS country_name, r_name AS continent_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "documents_map": "SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, props FROM events",
    "patient_events": "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS pid FROM orders",
    "deid_lookup": """
        SELECT CAST(c_custkey AS VARCHAR) AS pid, sha256('old|' || CAST(c_custkey AS VARCHAR)) AS deid
        FROM customer WHERE c_custkey % 3 = 0""",
    "keyed_rows": """
        SELECT l_orderkey AS key, l_linenumber, l_partkey, l_suppkey, l_quantity AS v FROM lineitem""",
}

# Which CTEs each CTE needs (dependencies first when emitted).
_DEPS: dict[str, list[str]] = {
    "dns_parts": ["hosts"],
    "dns_messages": ["dns_parsed"],
    "domain_list": ["hosts"],
    "dns_parsed": ["dns_parts"],
    "clean_list": ["domain_list"],
    "dns_raw": ["dns_parsed"],
    "listed": ["clean_list"],
    "nested_blocks": ["blocks"],
    "wide_nested": ["wide_ranges"],
    "mixed_keys": ["ips"],
    "mixed_blocks": ["blocks", "mixed_first"],
    "patient_events_with_nulls": ["patient_events"],
    "deid_lookup_doubled": ["deid_lookup"],
    "alerts": ["dns_parsed", "listed"],
}


def quad(x: str) -> str:
    return _QUAD.format(x=x)


def with_ctes(needed: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding ``needed`` CTEs (and their dependencies) before ``body``."""
    defs = dict(CTES)
    defs.update(extra or {})
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in _DEPS.get(name, []):
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    parts = [f"{name} AS ({defs[name]})" for name in order]
    return "WITH " + ",\n".join(parts) + "\n" + body
