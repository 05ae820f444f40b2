"""Addresses of both kinds against Python's ipaddress module."""

import ipaddress
import random

import pytest

from enrichkit.operators.addresses import address_lookup, parse_addresses, parse_networks
from tests.conftest import rows

MASK = 2**64 - 1
BAD = [None, "", ":", "::", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::8", "::1:2:3:4:5:6:7:8", "12345::",
       "g::", "1.2.3", "1.2.3.256", "::1.2.3.256", "::1.2.3", "1.2.3.4::", "fe80::1%eth0", " ::1", "1:2:3:4:5:6:7:1.2.3.4", "::ffff:1.2.3.4",
       "0:0:0:0:0:FFFF:0102:0304", "1:2:3:4:5:6:1.2.3.4", "::0", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "8000::", "0.0.0.0", "255.255.255.255",
       "1:", ":1", "1:2:3:4:5:6:7:", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "::1:2:3:4:5:6:7", ".", "1.2.3.4:", "a.b::"]


def parsed(text):
    """(family, value) by the ipaddress module, or None."""
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    if "%" in str(text):
        return None
    a = a.ipv4_mapped or a if a.version == 6 else a
    return a.version, int(a)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def made_addresses(seed, n):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        if pick.random() < 0.3:
            out.append(str(ipaddress.IPv4Address(pick.getrandbits(6) << 26 | pick.getrandbits(12))))
            continue
        value = (pick.choice([0x2001, 0, 0xFE80, 0xFFFF]) << 112) | (pick.getrandbits(3) << 80) | (pick.getrandbits(4) << 60) | pick.getrandbits(7) << pick.choice([0, 30, 50])
        a = ipaddress.IPv6Address(value)
        out.append(pick.choice([str(a), a.exploded, str(a).upper()]))
    return out


def test_parse_as_ipaddress(spark):
    texts = BAD + made_addresses(1, 500)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, ip string")
    for r in parse_addresses(df, "ip").collect():
        want = parsed(r.ip)
        got = None if r.family is None else (r.family, ((r.hi & MASK) << 64) | (r.lo & MASK))
        assert got == want, (r.ip, got, want)
        assert (r.hi is None) == (r.lo is None) == (r.family is None)


def test_networks_as_ipaddress(spark):
    pick = random.Random(2)
    texts = [f"{a}/{pick.randrange(0, 33 if ':' not in a else 129)}" for a in made_addresses(3, 400)]
    texts += ["::/0", "0.0.0.0/0", "::ffff:1.2.3.4/120", "::ffff:1.2.3.4/95", "::ffff:0:0/96", "1.2.3.4", "1.2.3.4/33", "::/129", "::/-1", "::/", "/8", "1::/3/4", None]
    df = spark.createDataFrame([(t,) for t in texts], "network string")
    for r in parse_networks(df, "network").collect():
        try:
            net = ipaddress.ip_network(r.network, strict=False) if r.network and "/" in r.network else None
        except ValueError:
            net = None
        if net is None:
            assert r.family is None and r.prefix_len is None, r
            continue
        want = (net.version, net.prefixlen, int(net[0]))
        if net.version == 6 and net.prefixlen >= 96 and net[0].ipv4_mapped:
            want = (4, net.prefixlen - 96, int(net[0].ipv4_mapped))
        assert (r.family, r.prefix_len, ((r.hi & MASK) << 64) | (r.lo & MASK)) == want, r


@pytest.mark.parametrize(("bound", "every"), [(None, True), (0, False)])
def test_lookup_against_all_networks(spark, bound, every):
    pick = random.Random(5)
    ips = made_addresses(6, 300) + BAD
    lengths = [30, 48, 64, 65, 100, 124, 128]
    nets = [f"{a}/{pick.choice([0, 6, 22, 32] if ':' not in a else lengths)}" for a in made_addresses(7, 150)]
    nets = [n for n in nets if every or not n.endswith("/0")] + (["::/0"] if every else []) + ["no network", "1::/200", None]
    table = [(f"n{i % 40}", n) for i, n in enumerate(nets)] * 2
    df = spark.createDataFrame(list(enumerate(ips)), "id int, ip string")
    known = [(name, n, ipaddress.ip_network(n, strict=False)) for name, n in table if n and "/" in n and not n.endswith("/200")]
    want = []
    for i, ip in enumerate(ips):
        a = parsed(ip)
        best = None
        for name, n, net in known:
            if a and net.version == a[0] and a[1] >> (net.max_prefixlen - net.prefixlen) == int(net[0]) >> (net.max_prefixlen - net.prefixlen):
                best = max(best or (-1,), (net.prefixlen, name, n))
        want.append((i, best[1] if best else None, best[2] if best else None))
    blocks = spark.createDataFrame(table, "name string, network string")
    got = address_lookup(df, blocks, "ip", how="left", max_broadcast_bytes=bound).select("id", "name", "network")
    assert sorted(map(tuple, got.collect())) == want
    inner = address_lookup(df, blocks, "ip", max_broadcast_bytes=bound).select("id", "name", "network")
    assert sorted(map(tuple, inner.collect())) == [w for w in want if w[1]]


def test_lookup_of_nothing_and_clashes(spark):
    none = spark.createDataFrame([], "ip string")
    blocks = spark.createDataFrame([("x", "::/0")], "name string, network string")
    assert rows(address_lookup(none, blocks, "ip", how="left")) == []
    one = spark.createDataFrame([("::1",), (None,)], "ip string")
    assert rows(address_lookup(one, blocks.limit(0), "ip", how="left")) == [(None, None, None), ("::1", None, None)]
    with pytest.raises(ValueError, match="both sides"):
        address_lookup(one.withColumnRenamed("ip", "network"), blocks, "network")


def test_networks_over_the_bound_are_searched_at_once(spark, monkeypatch):
    """No lookup by kind, no probe by prefix length: networks of all lengths, in many chunks."""
    def by_kind(*_, **__):
        raise AssertionError("a lookup for each kind")

    monkeypatch.setattr("enrichkit.operators.addresses.range_lookup", by_kind)
    monkeypatch.setattr("enrichkit.operators.chunks._CHUNK_ROWS", 25)
    pick = random.Random(9)
    at = [*made_addresses(10, 120), "8000::", "7fff::1", "::1", "255.255.255.255"]
    nets = [f"{a}/{pick.randrange(1, 129 if ':' in a else 33)}" for a in at] + ["::/0", "0.0.0.0/0", "::/1", "8000::/1", "8000::/65"]
    ips = [*made_addresses(11, 200), *at, *at, *[a.upper() for a in at], *BAD]
    known = [(n, parsed(n.split("/")[0])[0], ipaddress.ip_network(n, strict=False)) for n in nets]
    known = [(n, f, net.prefixlen - (96 if f != net.version else 0), int(net[0]) & (MASK >> 32 if f == 4 else 2**128 - 1))
             for n, f, net in known if f == net.version or net.prefixlen >= 96]

    def best(ip):
        a = parsed(ip)
        held = [(p, n) for n, f, p, first in known if a and f == a[0] and a[1] >> ((32 if f == 4 else 128) - p) == first >> ((32 if f == 4 else 128) - p)]
        return max(held)[1] if held else None

    df = spark.createDataFrame(list(enumerate(ips)), "id int, ip string")
    got = address_lookup(df, spark.createDataFrame([(n,) for n in nets], "network string"), "ip", how="left", max_broadcast_bytes=0)
    assert [r.network for r in got.orderBy("id").collect()] == [best(ip) for ip in ips]
