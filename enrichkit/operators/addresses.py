"""Addresses of both kinds, IPv4 and IPv6: parsing, CIDR networks, lookup.

An address is its family (4 or 6) and two bigints: ``hi`` and ``lo``, the upper and lower 64 bits
(an IPv4 address is in ``lo``). An IPv4 address that is written as an IPv6 one (``::ffff:1.2.3.4``)
is the IPv4 address, and a network of such addresses is the IPv4 network; networks of one family
hold no addresses of the other.

Networks are aligned, so a 128-bit lookup falls into 64-bit ones:

- IPv4 and IPv6 networks of up to 64 bits are ranges of one bigint, ``lo`` or ``hi``, and go to
  ``range_lookup``;
- of longer ones, those around an address share its ``hi``. Only distinct addresses whose ``hi``
  has such networks are probed, once for each prefix length present, by an equi-join.

Network tables over the broadcast bound are searched at once instead, all kinds in one order of
family, ``hi`` and ``lo`` (see ``chunks``); only distinct texts are parsed, after a shuffle, and
the found networks are joined back by the text.

The longest prefix wins, of equal networks that with the greatest columns, in their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.functions.net import ipv4_to_long, shl, shr
from enrichkit.operators.chunks import innermost
from enrichkit.operators.joins import check_names, skew_aware_join
from enrichkit.operators.ranges import range_lookup
from enrichkit.operators.sizing import fits_broadcast
from enrichkit.session import ensure_checkpoint_dir

_LEAST, _MOST = -(2**63), 2**63 - 1
_MAPPED = 0xFFFF  # the 32 bits before an IPv4 address in its IPv6 form
_HEX_GROUP = "^[0-9a-f]{1,4}$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, whose expression stands in the plan once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _groups(half: Column) -> Column:
    return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))


def _hex_of(text: Column) -> Column:
    """The 32 hex digits of a lower-case IPv6 text, null if it is none."""

    def without_tail(quad: Column) -> Column:
        # A dotted tail stands for the last two groups of four digits.
        tail = F.lower(F.concat_ws(":", F.hex(F.shiftright(quad, 16)), F.hex(quad.bitwiseAND(0xFFFF))))
        dotted = F.when(quad.isNotNull(), F.concat(F.regexp_extract(text, "^(.*:)[^:]*$", 1), tail))
        return F.when(F.contains(text, F.lit(".")), dotted).otherwise(text)

    def filled(halves: Column, left: Column, right: Column) -> Column:
        n = F.size(left) + F.size(right)
        fits = F.when(F.size(halves) == 2, n <= 7).otherwise((F.size(halves) == 1) & (n == 8))
        return F.when(fits, F.concat(left, F.array_repeat(F.lit("0"), F.lit(8) - n), right))

    def digits(groups: Column) -> Column:
        valid = F.forall(groups, lambda g: g.rlike(_HEX_GROUP))
        return F.when(valid, F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))

    def joined(halves: Column) -> Column:
        right = F.when(F.size(halves) == 2, _groups(F.get(halves, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        return _let(
            _groups(F.get(halves, F.lit(0))),
            lambda a: _let(right, lambda b: _let(filled(halves, a, b), digits)),
        )

    quad = ipv4_to_long(F.substring_index(text, ":", -1))
    return _let(quad, lambda q: _let(F.split(without_tail(q), "::", -1), joined))


def _parsed(text: Column) -> Column:
    """Struct of ``v6`` (written with colons), ``hi`` and ``lo``; both null if malformed."""

    def half(x: Column, start: int) -> Column:
        return F.conv(F.substring(x, start, 16), 16, -10).cast("bigint")

    def long_form(x: Column) -> Column:
        return F.struct(F.lit(True).alias("v6"), half(x, 1).alias("hi"), half(x, 17).alias("lo"))

    def short_form(x: Column) -> Column:
        return F.struct(F.lit(False).alias("v6"), F.when(x.isNotNull(), F.lit(0).cast("bigint")).alias("hi"), x.alias("lo"))

    def either(t: Column) -> Column:
        return F.when(F.contains(t, F.lit(":")), _let(_hex_of(t), long_form)).otherwise(_let(ipv4_to_long(t), short_form))

    return _let(F.lower(text), either)


def _is_mapped(a: Column) -> Column:
    return a["v6"] & (a["hi"] == 0) & (F.shiftright(a["lo"], 32) == _MAPPED)


def _address(text: Column) -> Column:
    """Struct of an address's family, ``hi`` and ``lo``."""

    def placed(a: Column) -> Column:
        four = F.struct(F.lit(4).alias("f"), F.lit(0).cast("bigint").alias("hi"), a["lo"].bitwiseAND(0xFFFFFFFF).alias("lo"))
        six = F.struct(F.lit(6).alias("f"), a["hi"].alias("hi"), a["lo"].alias("lo"))
        return F.when(a["lo"].isNotNull(), F.when(~a["v6"] | _is_mapped(a), four).otherwise(six))

    return _let(_parsed(text), placed)


def _network(text: Column) -> Column:
    """Struct of a network's family, prefix length, ``hi`` and ``lo``."""
    zero = F.lit(0).cast("bigint")

    def cleared(c: Column, bits: Column) -> Column:
        """``c`` with its lowest ``bits`` bits cleared (64 and more: all)."""
        return F.when(bits >= 64, zero).when(bits <= 0, c).otherwise(shl(shr(c, bits), bits))

    def placed(a: Column, n: Column) -> Column:
        mapped = _is_mapped(a) & (n >= 96)
        four = F.when(~a["v6"], n).when(mapped, n - 96)
        v4 = F.struct(F.lit(4).alias("f"), four.alias("p"), zero.alias("hi"),
                      cleared(a["lo"].bitwiseAND(0xFFFFFFFF), F.lit(32) - four).alias("lo"))
        v6 = F.struct(F.lit(6).alias("f"), n.alias("p"), cleared(a["hi"], F.lit(64) - n).alias("hi"),
                      cleared(a["lo"], F.lit(128) - n).alias("lo"))
        valid = a["lo"].isNotNull() & n.between(F.lit(0), F.when(a["v6"], 128).otherwise(32))
        return F.when(valid, F.when(~a["v6"] | mapped, v4).otherwise(v6))

    def cut(parts: Column) -> Column:
        bits = F.when(F.size(parts) == 2, F.get(parts, F.lit(1)).try_cast("int"))
        return _let(_parsed(F.get(parts, F.lit(0))), lambda a: _let(bits, lambda n: placed(a, n)))

    return _let(F.split(text, "/", -1), cut)


def _with_fields(df: DataFrame, parsed: Column, fields: dict[str, str]) -> DataFrame:
    check_names(df, df.select(*[F.lit(0).alias(c) for c in fields.values()]), [])
    named = df.withColumn("__parsed", parsed)
    return named.withColumns({new: F.col(f"__parsed.{f}") for f, new in fields.items()}).drop("__parsed")


def parse_addresses(df: DataFrame, text_col: str, family: str = "family", hi: str = "hi", lo: str = "lo") -> DataFrame:
    """Add an address's family (4, 6), ``hi`` and ``lo``; all null if the text is no address.

    IPv6 texts may be in either case, shortened by one ``::`` and end in dotted form; a zone
    (``%eth0``) is not an address. Blanks around a text make it none.
    """
    return _with_fields(df, _address(F.col(f"`{text_col}`")), {"f": family, "hi": hi, "lo": lo})


def parse_networks(
    df: DataFrame, network_col: str, family: str = "family", plen: str = "prefix_len", hi: str = "hi", lo: str = "lo"
) -> DataFrame:
    """Add a CIDR network's family, prefix length and first address; all null if malformed.
    Host bits that are set are cleared."""
    return _with_fields(df, _network(F.col(f"`{network_col}`")), {"f": family, "p": plen, "hi": hi, "lo": lo})


def address_lookup(
    df: DataFrame,
    networks: DataFrame,
    address_col: str,
    network_col: str = "network",
    *,
    how: str = "inner",
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows of ``df`` with the columns of the innermost network that holds their address.

    ``how="inner"`` drops rows without one (texts that are no address among them), ``how="left"``
    keeps them with nulls. Networks that are malformed hold nothing. A column on both sides raises.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    check_names(df, networks, [])
    own = [F.col(f"`{c}`") for c in df.columns]
    row = F.struct(*[F.col(f"`{c}`") for c in networks.columns])
    # Equal rows count once, and the parse is spread over the shuffle's tasks, however few files there are.
    rows = networks.select(row.alias("__row"), F.col(f"`{network_col}`").alias("__net")).distinct()
    nets = parse_networks(rows, "__net", "__nf", "__np", "__nhi", "__nlo")
    nets = nets.where(F.col("__nf").isNotNull())
    # Pinned: three kinds of networks are taken from one parse.
    ensure_checkpoint_dir(df.sparkSession)
    nets = nets.select("__nf", "__np", "__nhi", "__nlo", "__row").checkpoint(eager=True)
    if not fits_broadcast(nets, max_broadcast_bytes):
        found = _searched(df.select(F.col(f"`{address_col}`").alias("__text")), nets).select(
            F.col("__text").alias(address_col), F.col("__row").alias("__found"))
        out = skew_aware_join(df, found.checkpoint(eager=True), [address_col], how, max_broadcast_bytes=max_broadcast_bytes)
        return out.select(*own, *[F.col(f"__found.`{c}`").alias(c) for c in networks.columns])
    out = parse_addresses(df, address_col, "__af", "__ahi", "__alo")
    out = out.withColumns({"__k4": F.when(F.col("__af") == 4, F.col("__alo")), "__k6": F.when(F.col("__af") == 6, F.col("__ahi"))})

    four = nets.where(F.col("__nf") == 4).select(
        F.col("__nlo").alias("__s4"), F.col("__nlo").bitwiseOR(_free_bits(32)).alias("__e4"), F.col("__row").alias("__r4"))
    every = F.col("__np") == 0  # bigints are signed: all of them lie between the least and the most
    six = nets.where((F.col("__nf") == 6) & (F.col("__np") <= 64)).select(
        F.when(every, F.lit(_LEAST)).otherwise(F.col("__nhi")).alias("__s6"),
        F.when(every, F.lit(_MOST)).otherwise(F.col("__nhi").bitwiseOR(_free_bits(64))).alias("__e6"),
        F.col("__row").alias("__r6"))
    out = range_lookup(out, four, "__k4", start="__s4", end="__e4", how="left", max_broadcast_bytes=max_broadcast_bytes)
    out = range_lookup(out, six, "__k6", start="__s6", end="__e6", how="left", max_broadcast_bytes=max_broadcast_bytes)
    longer = _longer(out, nets.where((F.col("__nf") == 6) & (F.col("__np") > 64)), max_broadcast_bytes)
    hits = [F.col("__r6"), F.col("__r4")]
    if longer is not None:
        out = out.withColumn("__l6", F.when(F.col("__af") == 6, F.col("__alo")))
        out = skew_aware_join(out, longer, ["__k6", "__l6"], "left", max_broadcast_bytes=max_broadcast_bytes)
        hits.insert(0, F.col("__r128"))
    out = out.withColumn("__found", F.coalesce(*hits))
    if how == "inner":
        out = out.where(F.col("__found").isNotNull())
    return out.select(*own, *[F.col(f"__found.`{c}`").alias(c) for c in networks.columns])


def _free_bits(bits: int) -> Column:
    """The bits after a network's prefix, of ``bits``, set (up to 63 of them)."""
    return F.bitwise_not(shl(F.lit(-1).cast("bigint"), F.lit(bits) - F.col("__np")))


def _searched(texts: DataFrame, nets: DataFrame) -> DataFrame:
    """``(.., __text, __row)``: the innermost network of each distinct text that has one."""
    points = parse_addresses(texts.where(F.col("__text").isNotNull()).distinct(), "__text", "__af", "__ahi", "__alo")
    points = points.where(F.col("__af").isNotNull())
    p, hi, lo = F.col("__np"), F.col("__nhi"), F.col("__nlo")
    four, short = F.col("__nf") == 4, (F.col("__nf") == 6) & (F.col("__np") <= 64)

    # bigints are signed: of a network of no bits all lie between the least and the most.
    first_hi = F.when(short & (p == 0), F.lit(_LEAST)).otherwise(hi)
    last_hi = F.when(short & (p == 0), F.lit(_MOST)).when(short, hi.bitwiseOR(_free_bits(64))).otherwise(hi)
    first_lo = F.when(short, F.lit(_LEAST)).otherwise(lo)
    last_lo = F.when(four, lo.bitwiseOR(_free_bits(32))).when(short, F.lit(_MOST)).otherwise(lo.bitwiseOR(_free_bits(128)))
    ranges = nets.select(F.col("__nf").alias("__ef"), "__nf", first_hi.alias("__shi"), first_lo.alias("__slo"),
                         last_hi.alias("__ehi"), last_lo.alias("__elo"), "__row")
    return innermost(points, ranges, ["__af", "__ahi", "__alo"], ["__nf", "__shi", "__slo"], ["__ef", "__ehi", "__elo"],
                     "__row", carry=("__text",))


def _longer(keys: DataFrame, nets: DataFrame, max_broadcast_bytes: int | None) -> DataFrame | None:
    """``(__k6, __l6, __r128)``: the innermost network of over 64 bits of each distinct address
    that has one; None without such networks."""
    levels = [r.lv for r in nets.select((F.lit(128) - F.col("__np")).alias("lv")).distinct().collect()]  # 64 at most
    if not levels:
        return None
    lv, at = F.lit(128) - F.col("__np"), shr("__nlo", F.lit(128) - F.col("__np"))
    places = nets.groupBy(F.col("__nhi").alias("__k6"), lv.alias("__lv"), at.alias("__at")).agg(F.max("__row").alias("__row"))
    ends = nets.select(F.col("__nhi").alias("__k6")).distinct()
    found = keys.where(F.col("__k6").isNotNull()).select("__k6", F.col("__alo").alias("__l6"))
    found = skew_aware_join(found, ends, ["__k6"], "inner", max_broadcast_bytes=max_broadcast_bytes).distinct()
    probes = found.withColumn("__lv", F.explode(F.lit(sorted(levels)).cast("array<int>")))
    probes = probes.withColumn("__at", shr("__l6", F.col("__lv")))
    held = skew_aware_join(probes, places, ["__k6", "__lv", "__at"], "inner", max_broadcast_bytes=max_broadcast_bytes)
    best = held.groupBy("__k6", "__l6").agg(F.max(F.struct((-F.col("__lv")).alias("n"), F.col("__row").alias("r"))).alias("b"))
    # Pinned: measured and joined.
    return best.select("__k6", "__l6", F.col("b.r").alias("__r128")).checkpoint(eager=True)
