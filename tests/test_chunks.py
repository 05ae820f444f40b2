import random

import pytest
from pyspark.sql import functions as F

from enrichkit.operators import chunks
from enrichkit.operators.ranges import range_lookup


def crossing(rng, n, space):
    """Ranges that cross and nest, many over all, many with one begin or one end, some equal."""
    out = []
    for i in range(n):
        a = rng.randrange(-space, space)
        b = a + rng.choice([0, 1, space // 50, space, 3 * space])
        out.append([(a, b, f"r{i}"), (-space, b, f"r{i}"), (a, 2 * space, f"r{i}"), (0, space // 9, f"r{i}")][i % 5 % 4])
    return [r for r in out if r[0] <= r[1]]


def innermost(k, ranges):
    held = [r for r in ranges if r[0] <= k <= r[1]]
    return max(held, key=lambda r: (r[0], -r[1], r[2]))[2] if held else None


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(chunks, "_CHUNK_ROWS", 15)


@pytest.mark.parametrize("seed, space, bits", [(1, 300, 0), (2, 2**45, 0), (3, 5000, 6), (4, 2**61, 40)])
def test_pandas_over_many_chunks_equals_brute_force(spark, small_chunks, seed, space, bits):
    rng = random.Random(seed)
    ranges = crossing(rng, 300, space)
    keys = sorted({rng.randrange(-space, 2 * space) for _ in range(300)} | {r[0] for r in ranges} | {r[1] + 1 for r in ranges})
    out = range_lookup(
        spark.createDataFrame([(k,) for k in [*keys, keys[0]]] + [(None,)], "k bigint"),
        spark.createDataFrame(ranges, "s bigint, e bigint, name string"),
        "k", start="s", end="e", how="left", strategy="pandas", group_bits=bits,
    ).collect()
    assert len(out) == len(keys) + 2
    assert {r.k: r.name for r in out} == {k: innermost(k, ranges) for k in keys} | {None: None}


def test_wide_and_heavy_ranges_do_not_add_up(spark, small_chunks):
    """A thousand ranges over nearly all keys, a thousand with one begin, a thousand with one end."""
    n = 1000
    rows = [(i, 10**9 - i, f"w{i}") for i in range(n)] + [(5 * 10**8, 6 * 10**8 + 10**5 * i, f"s{i}") for i in range(n)]
    rows += [(10**5 * i, 4 * 10**8, f"e{i}") for i in range(n)]
    ranges = spark.createDataFrame(rows, "s bigint, e bigint, name string")
    points = spark.range(0, 10**9, 10**6).select(F.col("id").alias("k"))
    keys, pieces = chunks.deal(points, ranges, ["k"], ["s"], ["e"], "name")
    count = keys.groupBy(chunks.CHUNK).count().count()
    sizes = [r["count"] for r in pieces.groupBy(chunks.CHUNK).count().collect()]
    assert count > 20 and sum(sizes) <= 2 * len(rows) + len(sizes) and max(sizes) < 400
    found = {r.k: r.name for r in chunks.innermost(points, ranges, ["k"], ["s"], ["e"], "name").collect()}
    want = {k: innermost(k, rows) for k in range(0, 10**9, 10**6)}
    assert found == {k: v for k, v in want.items() if v}


def test_positions_of_several_columns(spark, small_chunks):
    rng = random.Random(5)
    low, high = -(2**63), 2**63 - 1
    at = lambda: (rng.choice([4, 6]), rng.choice([low, -3, 0, 9, high]), rng.choice([low, -1, 0, 7, 2**40, high]))
    ranges = [(min(p), max(p), f"r{i}") for i in range(200) for p in [(at(), at())]]
    points = [at() for _ in range(300)]
    def order(r):
        return r[0], tuple(-x for x in r[1]), r[2]

    held = {p: [r for r in ranges if r[0] <= p <= r[1]] for p in points}
    want = {p: max(h, key=order)[2] for p, h in held.items() if h}
    one = "a bigint, b bigint, c bigint"
    table = spark.createDataFrame([(*s, *e, n) for s, e, n in ranges], "sa bigint, sb bigint, sc bigint, ea bigint, eb bigint, ec bigint, name string")
    found = chunks.innermost(spark.createDataFrame(points, one), table, ["a", "b", "c"], ["sa", "sb", "sc"], ["ea", "eb", "ec"], "name")
    assert {(r.a, r.b, r.c): r.name for r in found.collect()} == want
