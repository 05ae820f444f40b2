import random

import pytest
from pyspark.sql import functions as F

from enrichkit.functions import ipv4_to_long
from enrichkit.operators.geo import geo_enrich
from enrichkit.operators.ranges import _bucketed_ranges, _search_paths, cidr_ranges, range_lookup, ranges_overlap, with_match_status
from tests.conftest import rows

STRATEGIES = ["bucket", "between", "prefix", "pandas"]


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame(
        [("1.1.4.0/22", "100"), ("8.8.8.0/24", "200"), ("9.0.0.0/8", "300"), ("10.0.0.0/31", "400")],
        "network string, geoname_id string",
    )


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(
        [("100", "AU", "Oceania"), ("200", "US", "North America")],
        "geoname_id string, country_name string, continent_name string",
    )


def test_geo_enrich_reference_sample(spark, blocks, names):
    ips = spark.createDataFrame([("1.1.4.4",), ("8.8.8.8",)], "test_ip string")
    out = geo_enrich(ips, blocks, names, "test_ip")
    assert rows(out, "test_ip", "country_name") == [("1.1.4.4", "AU"), ("8.8.8.8", "US")]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_last_address_inclusive_or_exclusive(spark, blocks, strategy):
    ips = spark.createDataFrame([("10.0.0.0",), ("10.0.0.1",), ("8.8.8.255",)], "ip string")
    keyed = ips.withColumn("ipn", ipv4_to_long("ip"))
    ranges = cidr_ranges(blocks)
    inclusive = range_lookup(keyed, ranges, "ipn", strategy=strategy)
    assert rows(inclusive, "ip") == [("10.0.0.0",), ("10.0.0.1",), ("8.8.8.255",)]
    exclusive = range_lookup(keyed, ranges, "ipn", strategy=strategy, end_inclusive=False)
    assert rows(exclusive, "ip") == [("10.0.0.0",)]


def test_match_status(spark, blocks):
    ips = spark.createDataFrame([("0.0.0.1",), ("1.1.4.4",), ("2.0.0.0",), ("255.1.1.1",), ("bad",)], "ip string")
    keyed = ips.withColumn("ipn", ipv4_to_long("ip"))
    ranges = cidr_ranges(blocks)
    looked = range_lookup(keyed, ranges, "ipn", how="left")
    out = with_match_status(looked, ranges, "ipn")
    assert rows(out, "ip", "geoname_id", "match_status") == [
        ("0.0.0.1", None, "below"),
        ("1.1.4.4", "100", "matched"),
        ("2.0.0.0", None, "gap"),
        ("255.1.1.1", None, "gap"),
        ("bad", None, "invalid"),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_overlapping_blocks_innermost_wins(spark, strategy):
    blocks = spark.createDataFrame(
        [("10.0.0.0/8", "outer"), ("10.1.0.0/16", "mid"), ("10.1.2.0/24", "inner"), ("10.0.0.0/16", "first16")],
        "network string, geoname_id string",
    )
    ranges = cidr_ranges(blocks)
    assert ranges_overlap(ranges, "start_ip", "end_ip")
    ips = spark.createDataFrame([("10.1.2.3",), ("10.1.9.9",), ("10.9.9.9",), ("10.0.0.5",), ("11.0.0.0",)], "ip string")
    keyed = ips.withColumn("ipn", ipv4_to_long("ip"))
    out = range_lookup(keyed, ranges, "ipn", strategy=strategy, how="left")
    assert rows(out, "ip", "geoname_id") == [
        ("10.0.0.5", "first16"),
        ("10.1.2.3", "inner"),
        ("10.1.9.9", "mid"),
        ("10.9.9.9", "outer"),
        ("11.0.0.0", None),
    ]


@pytest.mark.parametrize("strategy, bound, bits", [
    ("bucket", None, 16), ("bucket", 0, 6), ("bucket", None, 3), ("between", None, 8), ("pandas", None, 16), ("pandas", 0, 5),
])
@pytest.mark.parametrize("end_inclusive", [True, False])
def test_overlapping_ranges_agree_with_brute_force(spark, strategy, bound, bits, end_inclusive):
    """Crossing, nested, equal, empty and null ranges; keys on every border, null and repeated."""
    rnd = random.Random(bits)
    ranges = []
    for i in range(150):
        s = rnd.randrange(0, 900)
        ranges.append((s, s + rnd.choice([-3, 0, 1, 5, 40, 300]), f"g{rnd.randrange(40)}"))
    ranges += [(None, 5, "n"), (7, None, "n"), (100, 1000, None)]
    keys = [(i, k) for i, k in enumerate([None, None, *range(-2, 1300), 50, 50])]

    def best(k):
        hits = [(s, -e, g is not None, g or "", (s, e, g)) for s, e, g in ranges
                if k is not None and s is not None and e is not None and s <= k <= (e if end_inclusive else e - 1)]
        return max(hits)[-1] if hits else (None, None, None)

    want = {i: best(k) for i, k in keys}
    keys_df = spark.createDataFrame(keys, "id int, ipn bigint")
    ranges_df = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, g string")
    for how in ("left", "inner"):
        out = range_lookup(keys_df, ranges_df, "ipn", strategy=strategy, how=how, max_broadcast_bytes=bound,
                           bucket_bits=bits, group_bits=bits, end_inclusive=end_inclusive).collect()
        got = {r.id: (r.start_ip, r.end_ip, r.g) for r in out}
        assert len(out) == len(got)
        assert got == {i: v for i, v in want.items() if how == "left" or v[0] is not None}


def test_overlaps_do_not_shuffle_the_keys(spark):
    ranges = spark.createDataFrame([(0, 99, "a"), (10, 19, "b")], "start_ip bigint, end_ip bigint, g string")
    keys = spark.range(0, 200).select(F.col("id").alias("ipn"))
    out = range_lookup(keys, ranges, "ipn", how="left")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "Exchange rangepartitioning" not in plan and "Aggregate" not in plan
    assert out.where("g = 'b'").count() == 10 and out.where("g = 'a'").count() == 90


def test_prefix_leaves_out_networks_that_do_not_parse(spark):
    nets = spark.createDataFrame([("10.0.0.0/8", "a"), ("nonsense", "b"), (None, "c")], "network string, g string")
    keys = spark.createDataFrame([(167837953,), (None,)], "ipn bigint")
    for bound in (None, 0):
        out = range_lookup(keys, cidr_ranges(nets), "ipn", strategy="prefix", how="left", max_broadcast_bytes=bound)
        assert sorted((r.ipn or 0, r.g) for r in out.collect()) == [(0, None), (167837953, "a")]


def _random_blocks(rnd, n):
    """Disjoint random CIDR blocks in a 2^24 address window."""
    out, used = [], set()
    while len(out) < n:
        plen = rnd.randint(12, 32)
        size = 1 << (32 - plen)
        start = rnd.randrange(0, 1 << 24) // size * size
        if any(not (start + size - 1 < s or e < start) for s, e in used):
            continue
        used.add((start, start + size - 1))
        out.append((start, start + size - 1, plen, f"g{len(out)}"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_all_strategies_agree_with_brute_force(spark, seed):
    rnd = random.Random(seed)
    blocks = _random_blocks(rnd, 60)
    ips = [(i, rnd.randrange(0, 1 << 24)) for i in range(3000)]
    ips += [(3000 + i, s) for i, (s, _, _, _) in enumerate(blocks[:20])]
    ips += [(4000 + i, e) for i, (_, e, _, _) in enumerate(blocks[:20])]
    expected = sorted(
        (i, ip, g) for i, ip in ips for s, e, _, g in blocks if s <= ip <= e
    )
    ips_df = spark.createDataFrame(ips, "id bigint, ipn bigint")
    ranges = spark.createDataFrame(blocks, "start_ip bigint, end_ip bigint, prefix_len int, g string")
    for strategy in STRATEGIES:
        got = rows(range_lookup(ips_df, ranges, "ipn", strategy=strategy), "id", "ipn", "g")
        assert got == expected, strategy
    # the shuffled join path (range table over the broadcast bound) and a narrow bucket width
    got = rows(range_lookup(ips_df, ranges, "ipn", max_broadcast_bytes=0, bucket_bits=8), "id", "ipn", "g")
    assert got == expected


def test_hot_bucket_is_split(spark):
    """A third of the keys fall in one bucket; the shuffled plan splits it off."""
    ranges = spark.createDataFrame([(0, 999, "a"), (5000, 5999, "b")], "start_ip bigint, end_ip bigint, g string")
    keys = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(17)).otherwise(F.col("id") * 3).alias("ipn")
    )
    expected = sorted(
        (i, ip, "a" if ip <= 999 else "b")
        for i, ip in ((i, 17 if i % 3 == 0 else i * 3) for i in range(3000))
        if ip <= 999 or 5000 <= ip <= 5999
    )
    spark.conf.set("enrichkit.skew.hotKeyRows", "100")
    spark.conf.set("enrichkit.skew.detectHotKeys", "true")
    try:
        got = rows(range_lookup(keys, ranges, "ipn", max_broadcast_bytes=0, bucket_bits=4), "id", "ipn", "g")
    finally:
        spark.conf.unset("enrichkit.skew.hotKeyRows")
        spark.conf.unset("enrichkit.skew.detectHotKeys")
    assert got == expected


def test_stored_ranges_give_the_same_lookup(spark, blocks):
    from enrichkit.operators.ranges import store_ranges
    from enrichkit.session import scratch_path

    bad = spark.createDataFrame([("not a network", "999")], "network string, geoname_id string")
    rejects = scratch_path(spark, "rejected_ranges")
    stored = store_ranges(blocks.unionByName(bad), scratch_path(spark, "stored_ranges"), rejects_path=rejects)
    assert rows(spark.read.parquet(rejects)) == [("not a network", "999")]
    assert stored.count() == 4  # the unparsable row is not stored
    ips = spark.createDataFrame([("1.1.4.4",), ("8.8.8.8",), ("7.7.7.7",)], "ip string").withColumn("ipn", ipv4_to_long("ip"))
    direct = range_lookup(ips, cidr_ranges(blocks), "ipn", how="left")
    assert rows(range_lookup(ips, stored, "ipn", how="left")) == rows(direct)


@pytest.mark.parametrize("order", [1, -1])
@pytest.mark.parametrize("strategy, bound", [("bucket", None), ("bucket", 0), ("between", None), ("prefix", None), ("prefix", 0)])
def test_equal_ranges_resolve_alike_in_every_form(spark, strategy, bound, order):
    nets = [("10.0.0.0/24", v) for v in ("5", "9", "1")][::order]
    ranges = cidr_ranges(spark.createDataFrame(nets, "network string, g string")).drop("network")
    keys = spark.createDataFrame([(1, 167772163), (2, None), (3, 5)], "id int, ipn bigint")
    out = range_lookup(keys, ranges, "ipn", strategy=strategy, how="left", max_broadcast_bytes=bound)
    assert sorted((r.id, r.g) for r in out.collect()) == [(1, "9"), (2, None), (3, None)]


def test_between_raises_over_the_bound(spark, blocks):
    keys = spark.createDataFrame([(1,)], "ipn bigint")
    with pytest.raises(ValueError, match="bound"):
        range_lookup(keys, cidr_ranges(blocks), "ipn", strategy="between", max_broadcast_bytes=0)


def test_invalid_keys_stay_out_of_the_shuffle(spark, blocks):
    keys = spark.createDataFrame([(None,), (134744072,), (None,)], "ipn bigint")
    for how, n in (("inner", 1), ("left", 3)):
        out = range_lookup(keys, cidr_ranges(blocks), "ipn", how=how, max_broadcast_bytes=0)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert str(-(2**63)) not in plan and "isnotnull" in plan.lower()
        assert out.count() == n


# ---- ranges of any width


def innermost(k, ranges, inclusive=True):
    held = [r for r in ranges if r[0] is not None and r[1] is not None and r[0] <= k <= (r[1] if inclusive else r[1] - 1)]
    return max(held, key=lambda r: (r[0], -r[1], r[2]))[2] if held else None


LEAST, MOST = -(2**63), 2**63 - 1
WIDE = [(LEAST, MOST, "all"), (0, 2**62, "upper"), (0, 2**62, "upper twin"), (2**40, 2**41 - 1, "aligned"), (2**40 + 5, 2**60, "crossing"),
        (-7, 7, "around zero"), (7, 7, "one"), (MOST, MOST, "last"), (LEAST, LEAST, "first"), (9, 8, "empty"), (None, 5, "open")]
POINTS = [LEAST, LEAST + 1, -8, -7, -1, 0, 6, 7, 8, 2**40 - 1, 2**40, 2**40 + 5, 2**41 - 1, 2**41, 2**60, 2**60 + 1, 2**62, 2**62 + 1, MOST - 1, MOST]


@pytest.mark.parametrize("strategy, bound", [("bucket", None), ("bucket", 0), ("prefix", None), ("pandas", None)])
@pytest.mark.parametrize("inclusive", [True, False])
def test_ranges_of_any_width(spark, strategy, bound, inclusive):
    ranges = WIDE
    keys = spark.createDataFrame([(k,) for k in [*POINTS, None]], "k bigint")
    table = spark.createDataFrame(ranges, "s bigint, e bigint, name string")
    out = range_lookup(keys, table, "k", start="s", end="e", strategy=strategy, how="left", end_inclusive=inclusive, max_broadcast_bytes=bound)
    assert {r.k: r.name for r in out.collect()} == {k: innermost(k, ranges, inclusive) for k in POINTS} | {None: None}


@pytest.mark.parametrize("bound", [None, 0])
def test_disjoint_ranges_of_several_widths(spark, bound):
    rng = random.Random(3)
    ends = sorted(rng.sample(range(0, 2**20), 40) + [2**20 + (x << 30) for x in rng.sample(range(2**12), 40)] + [2**50, 2**58, 2**61, 2**62])
    ranges = [(a, b - 1, str(a)) for a, b in zip(ends[::2], ends[1::2])]
    keys = [x + d for x in ends for d in (-1, 0, 1)]
    out = range_lookup(
        spark.createDataFrame([(k,) for k in sorted(set(keys))] + [(None,)], "k bigint"),
        spark.createDataFrame(ranges, "s bigint, e bigint, name string"),
        "k", start="s", end="e", how="left", max_broadcast_bytes=bound,
    )
    assert not ranges_overlap(spark.createDataFrame(ranges, "s bigint, e bigint, name string"), "s", "e")
    assert {r.k: r.name for r in out.collect()} == {k: innermost(k, ranges) for k in keys} | {None: None}


@pytest.mark.parametrize("seed", range(3))
def test_crossing_ranges_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    space = rng.choice([60, 5000, 2**45])
    ranges = []
    for i in range(120):
        a = rng.randrange(-space, space)
        ranges.append((a, a + rng.choice([0, 1, space // 50, space // 3]), f"r{i}"))
    keys = sorted({rng.randrange(-space, 2 * space) for _ in range(200)} | {r[0] for r in ranges} | {r[1] + 1 for r in ranges})
    k = spark.createDataFrame([(x,) for x in keys], "k bigint")
    r = spark.createDataFrame(ranges, "s bigint, e bigint, name string")
    assert ranges_overlap(r, "s", "e")
    want = {x: innermost(x, ranges) for x in keys}
    for bound in (None, 0):
        out = range_lookup(k, r, "k", start="s", end="e", how="left", max_broadcast_bytes=bound)
        assert {x.k: x.name for x in out.collect()} == want


def test_a_wide_range_over_narrow_ones_is_an_overlap(spark):
    schema = "s bigint, e bigint"
    assert ranges_overlap(spark.createDataFrame([(0, 9), (2**50, 2**50 + 3), (20, 2**50)], schema), "s", "e")
    assert not ranges_overlap(spark.createDataFrame([(0, 9), (2**50, 2**50 + 3), (20, 2**50 - 1)], schema), "s", "e")


def test_halving_probes_few_levels():
    for n, depth in ((1, 1), (10, 4), (33, 6), (64, 7)):
        steps, marks = _search_paths(list(range(n, 0, -1)))
        assert len(steps) == depth and set(marks) == set(range(1, n + 1))
        assert all(len(w) < depth and all(x > level for x in w) for level, w in marks.items())


def test_clashing_names_raise(spark, blocks, names):
    ips = spark.createDataFrame([("1.1.4.4", "mine")], "ip string, country_name string")
    with pytest.raises(ValueError, match="country_name"):
        geo_enrich(ips, blocks, names, "ip")
    with pytest.raises(ValueError, match="note"):
        geo_enrich(ips.drop("country_name"), blocks.withColumn("note", F.lit(1)), names.withColumn("note", F.lit(1)), "ip")


def test_a_wide_range_stands_in_few_buckets(spark):
    """Ranges of 2^40 keys and more stood in 257 buckets each."""
    rows = [(i << 50, (i << 50) + 2**w + i) for i, w in enumerate([0, 10, 20, 24, 30, 32, 39, 40, 41, 48, 49])]
    pieces = _bucketed_ranges(spark.createDataFrame(rows, "s bigint, e bigint"), "s", "e", 16, True)
    assert max(r["count"] for r in pieces.groupBy("s").count().collect()) <= 18
    assert pieces.groupBy("s").count().count() == len(rows)


@pytest.mark.parametrize("strategy, inclusive", [("bucket", True), ("prefix", True), ("prefix", False)])
def test_ranges_over_the_bound_are_not_cut_into_blocks(spark, monkeypatch, strategy, inclusive):
    def cut(*_):
        raise AssertionError("up to 126 blocks a range")

    monkeypatch.setattr("enrichkit.operators.ranges._aligned_blocks", cut)
    monkeypatch.setattr("enrichkit.operators.chunks._CHUNK_ROWS", 8)
    rng = random.Random(8)
    ranges = [(a, a + rng.choice([1, 5, 2**20, 2**50]), f"r{i}") for i in range(90) for a in [rng.randrange(-(2**50), 2**50)]]
    ranges += [(-(2**50), 2**51, "all"), (-(2**50), 2**51, "all twin")]
    keys = sorted({x + d for r in ranges for x in r[:2] for d in (-1, 0, 1)})
    out = range_lookup(
        spark.createDataFrame([(k,) for k in keys] + [(None,)], "k bigint"),
        spark.createDataFrame(ranges, "s bigint, e bigint, name string"),
        "k", start="s", end="e", how="left", strategy=strategy, end_inclusive=inclusive, max_broadcast_bytes=0,
    )
    assert {r.k: r.name for r in out.collect()} == {k: innermost(k, ranges, inclusive) for k in keys} | {None: None}
