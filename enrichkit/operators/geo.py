"""Geo-enrichment of IP text: CIDR blocks -> range lookup -> country names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.net import ipv4_to_long
from enrichkit.operators.joins import check_names, skew_aware_join
from enrichkit.operators.ranges import cidr_ranges, range_lookup

_IPN = "__ipn"


def geo_enrich(
    df: DataFrame,
    blocks: DataFrame,
    names: DataFrame,
    ip_col: str,
    *,
    network_col: str = "network",
    geoname_col: str = "geoname_id",
    how: str = "inner",
    strategy: str = "bucket",
    end_inclusive: bool = True,
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """Add block and name columns to rows holding IPv4 text in ``ip_col``.

    ``blocks`` holds CIDR text in ``network_col`` and ``geoname_col``; ``names`` is keyed by
    ``geoname_col``. With ``how="inner"`` rows without a block or a name are dropped.
    A name that stands in two of the three tables, the key aside, raises a ``ValueError``.
    """
    check_names(blocks, names, [geoname_col])
    check_names(df, names, [])
    ranges = cidr_ranges(blocks, network_col, "__start", "__end", "__plen")
    keyed = df.withColumn(_IPN, ipv4_to_long(F.col(ip_col)))
    looked = range_lookup(
        keyed,
        ranges,
        _IPN,
        start="__start",
        end="__end",
        strategy=strategy,
        how=how,
        end_inclusive=end_inclusive,
        max_broadcast_bytes=max_broadcast_bytes,
    ).drop(_IPN, "__start", "__end", "__plen")
    out = skew_aware_join(looked, names, [geoname_col], how, max_broadcast_bytes=max_broadcast_bytes)
    front = [c for c in df.columns] + [c for c in blocks.columns if c not in df.columns]
    return out.select(*front, *[c for c in out.columns if c not in front])
