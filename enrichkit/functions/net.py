"""IPv4 and CIDR text <-> integer conversions as Spark column expressions.

All expressions are null-safe and never raise under ANSI mode: malformed input
gives null, which the range lookup reports as ``invalid``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOTTED_QUAD = r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"
_BYTE_MASK = 255


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shl(c: Column | str, bits: Column | int) -> Column:
    """``c << bits`` where ``bits`` may be a column."""
    return F.call_function("shiftleft", _col(c), bits if isinstance(bits, Column) else F.lit(bits))


def shr(c: Column | str, bits: Column | int) -> Column:
    """``c >> bits`` (arithmetic) where ``bits`` may be a column."""
    return F.call_function("shiftright", _col(c), bits if isinstance(bits, Column) else F.lit(bits))


def ipv4_to_long(c: Column | str) -> Column:
    """Dotted-quad IPv4 text -> bigint in [0, 2^32), null when malformed.

    One split and one fold over the parts: the input appears twice in the expression,
    so a computed input is not inlined many times over; an octet above 255 makes the
    fold's result null.
    """
    c = _col(c)

    def step(acc: Column, part: Column) -> Column:
        octet = part.try_cast("bigint")
        return acc * 256 + F.when(octet <= 255, octet)

    return F.when(c.rlike(_DOTTED_QUAD), F.aggregate(F.split(c, r"\."), F.lit(0).cast("bigint"), step))


def long_to_ipv4(c: Column | str) -> Column:
    """bigint in [0, 2^32) -> dotted-quad text."""
    c = _col(c).cast("bigint")
    return F.concat_ws(
        ".",
        *[F.shiftright(c, s).bitwiseAND(_BYTE_MASK).cast("string") for s in (24, 16, 8)],
        c.bitwiseAND(_BYTE_MASK).cast("string"),
    )


def cidr_prefix_len(c: Column | str) -> Column:
    """``a.b.c.d/n`` -> n as int when 0 <= n <= 32, else null."""
    c = _col(c)
    plen = F.substring_index(c, "/", -1).try_cast("int")
    return F.when(c.contains("/") & plen.between(0, 32), plen)


def cidr_start(c: Column | str) -> Column:
    """First address of a CIDR network (host bits cleared), as bigint."""
    c = _col(c)
    addr = ipv4_to_long(F.substring_index(c, "/", 1))
    host_bits = F.lit(32) - cidr_prefix_len(c)
    return shl(shr(addr, host_bits), host_bits)


def cidr_end(c: Column | str) -> Column:
    """Last address of a CIDR network, as bigint."""
    c = _col(c)
    host_bits = F.lit(32) - cidr_prefix_len(c)
    return cidr_start(c) + shl(F.lit(1).cast("bigint"), host_bits) - F.lit(1)
