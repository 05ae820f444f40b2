"""Range lookup: find, for each key, the range ``[start, end]`` that contains it.

Spark plans a join on ``key BETWEEN start AND end`` as a nested loop. Two forms avoid it:

- Disjoint ranges: an equi-join on buckets. A range stands in each bucket of ``2^bits`` keys
  that it touches, a key in its own, and the join keeps pairs that pass the range test. A range
  that would stand in more than ``_MOST_BUCKETS`` buckets takes a coarser width (8 bits more, as
  often as needed), so ranges of any width are copied a bounded number of times; each width
  present is one join.
- Overlapping ranges: aligned blocks. Every range is the union of at most 126 blocks of
  ``2^level`` keys that begin at a multiple of their size; a CIDR network is one. Of a block's
  ranges the innermost stays, and a block inside others takes the innermost of all. The widest
  to the narrowest level are searched by halving: a block leaves a mark at each wider level
  where the search for it turns to the narrower side, so ``log2(levels + 1)`` probes (6 for
  all IPv4 prefix lengths) find the narrowest block that holds a key. This is the form for range
  tables within the broadcast bound; larger ones are dealt over chunks of the keys and searched
  there in sorted order (see ``chunks``).

Whether ranges overlap is checked, not assumed. The innermost range wins: greatest start, then
smallest end; for CIDR blocks this is the longest prefix. Of equal ranges the one with the
greatest other columns, taken in their order, wins in every strategy. The range side is
broadcast when its measured size allows, and the keys are then not shuffled at all; otherwise
the join is shuffled with hot keys split off (see ``joins.skew_aware_join``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from enrichkit.functions.net import cidr_prefix_len, ipv4_to_long, shl, shr
from enrichkit.operators.chunks import CHUNK, deal, innermost
from enrichkit.operators.joins import skew_aware_join
from enrichkit.operators.sizing import Size, fits_broadcast, row_width, within_limit
from enrichkit.session import ensure_checkpoint_dir

STRATEGIES = ("bucket", "between", "prefix", "pandas")
_BUCKET, _WIDTH, _FROM, _TO = "__bucket", "__width", "__from", "__to"
_LEVEL, _NET, _WIN, _FOUND = "__level", "__net", "__win", "__found"
# Bucket of a null key: below every real bucket (x >> bits >= -2^(63 - bits) for bigint x).
_NO_BUCKET = -(2**63)
# A range stands in so many buckets of its width plus one at most.
_MOST_BUCKETS = 16
_STEP_BITS = 8


def cidr_ranges(
    df: DataFrame,
    network_col: str = "network",
    start: str = "start_ip",
    end: str = "end_ip",
    plen: str = "prefix_len",
) -> DataFrame:
    """Add first address, last address and prefix length of a CIDR text column.

    Computed in steps over named columns, so the optimizer keeps each parse once
    instead of inlining it into every later use.
    """
    c = F.col(network_col)
    out = df.withColumns({"__addr": ipv4_to_long(F.substring_index(c, "/", 1)), plen: cidr_prefix_len(c)})
    out = out.withColumn("__host_bits", F.lit(32) - F.col(plen))
    out = out.withColumn(start, shl(shr(F.col("__addr"), F.col("__host_bits")), F.col("__host_bits")))
    out = out.withColumn(end, F.col(start) + shl(F.lit(1).cast("bigint"), F.col("__host_bits")) - F.lit(1))
    return out.drop("__addr", "__host_bits")


def store_ranges(
    blocks: DataFrame,
    path: str,
    network_col: str = "network",
    start: str = "start_ip",
    end: str = "end_ip",
    plen: str = "prefix_len",
    fmt: str = "parquet",
    rejects_path: str | None = None,
) -> DataFrame:
    """Parse a CIDR block table once and store it as a range table; returns the stored copy.

    Rows whose network does not parse are not in it; ``rejects_path`` names a folder that
    receives them as they came.

    Later runs read the stored table instead of parsing the text again. Rows are sorted
    by start (a distributed range sort), so scans filtered on addresses skip row groups
    by their min/max statistics.
    """
    parsed = cidr_ranges(blocks, network_col, start, end, plen).where(F.col(start).isNotNull())
    parsed.orderBy(start).write.mode("overwrite").format(fmt).save(path)
    if rejects_path is not None:
        unparsed = cidr_ranges(blocks, network_col, start, end, plen).where(F.col(start).isNull())
        unparsed.select(*blocks.columns).write.mode("overwrite").format(fmt).save(rejects_path)
    return blocks.sparkSession.read.format(fmt).load(path)


def _check_names(df: DataFrame, ranges: DataFrame) -> None:
    clash = set(df.columns) & set(ranges.columns)
    if clash:
        raise ValueError(f"columns on both sides of the range lookup: {sorted(clash)}")


def _last(end: str, end_inclusive: bool) -> Column:
    return F.col(end) if end_inclusive else F.try_subtract(F.col(end), F.lit(1))  # none before the least bigint


def _width_bits(start: Column, last: Column, bits: int) -> Column:
    """Bits of the narrowest bucket of which the range touches ``_MOST_BUCKETS`` plus one at most."""
    steps = list(range(bits, 64, _STEP_BITS))
    out = F.lit(steps[-1])
    for b in reversed(steps[:-1]):
        touched = F.shiftright(last, b).cast("double") - F.shiftright(start, b).cast("double")
        out = F.when(touched <= _MOST_BUCKETS, F.lit(b)).otherwise(out)
    return out


def _bucketed_ranges(ranges: DataFrame, start: str, end: str, bits: int, end_inclusive: bool) -> DataFrame:
    # No filter on the computed bounds: a null bound gives a null span, which explode
    # drops, and a range with start > end spans buckets but can never pass the range test.
    # (A filter here would be pushed into the scan with the bound expressions inlined.)
    bounds = ranges.withColumns({_FROM: F.col(start).cast("bigint"), _TO: _last(end, end_inclusive).cast("bigint")})
    wide = bounds.withColumn(_WIDTH, _width_bits(F.col(_FROM), F.greatest(_FROM, _TO), bits))
    span = F.sequence(shr(_FROM, F.col(_WIDTH)), shr(F.greatest(_FROM, _TO), F.col(_WIDTH)))
    return wide.withColumn(_BUCKET, F.explode(span))


def _profile_buckets(exploded: DataFrame, check: bool = True) -> tuple[Size, bool, list[int]]:
    """Size of the bucketed range table, whether two ranges of one bucket width overlap, and the
    widths present, in one job.

    Two overlapping ranges of one width share the bucket of a common address, so it suffices to
    sort each bucket's ranges by start and compare each start with the running maximum end of
    the ranges before it; groups are buckets of the range table.
    """
    hit = F.lit(0)
    if check:
        w = Window.partitionBy(_WIDTH, _BUCKET).orderBy(F.col(_FROM), F.col(_TO).desc())
        hit = (F.col(_FROM) <= F.max(_TO).over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int")
    flagged = exploded.select(hit.alias("__hit"), row_width(exploded).alias("__w"), _WIDTH)
    row = flagged.agg(
        F.count(F.lit(1)).alias("n"), F.sum("__w").alias("b"), F.max("__hit").alias("o"), F.collect_set(_WIDTH).alias("widths")
    ).first()
    return Size(int(row["n"]), int(row["b"] or 0)), bool(row["o"]), sorted(row["widths"])


def _widths_overlap(exploded: DataFrame, widths: list[int]) -> bool:
    """Whether a range overlaps one of another bucket width. A range of a narrower width cannot
    hold one of a wider width, so it overlaps it with one of its own ends."""
    for wide in widths[1:]:
        ends = exploded.where(F.col(_WIDTH) < wide).select(F.explode(F.array(_FROM, _TO)).alias("__p")).distinct()
        ends = ends.withColumn(_BUCKET, F.shiftright("__p", wide))
        over = exploded.where(F.col(_WIDTH) == wide).select(_BUCKET, _FROM, _TO)
        inside = F.col("__p").between(F.col(_FROM), F.col(_TO))
        if not skew_aware_join(ends, over, [_BUCKET], "inner", inside).isEmpty():
            return True
    return False


def ranges_overlap(ranges: DataFrame, start: str, end: str, bucket_bits: int = 16, end_inclusive: bool = True) -> bool:
    """True when two ranges share an address."""
    exploded = _bucketed_ranges(ranges, start, end, bucket_bits, end_inclusive)
    _, hit, widths = _profile_buckets(exploded)
    return hit or _widths_overlap(exploded, widths)


def range_lookup(
    df: DataFrame,
    ranges: DataFrame,
    key: str,
    *,
    start: str = "start_ip",
    end: str = "end_ip",
    strategy: str = "bucket",
    how: str = "inner",
    end_inclusive: bool = True,
    bucket_bits: int = 16,
    resolve_overlaps: str | bool = "auto",
    max_broadcast_bytes: int | None = None,
    group_bits: int = 16,
) -> DataFrame:
    """Rows of ``df`` with the columns of the range containing ``df[key]``.

    Bounds and keys are bigints of any size. ``how="inner"`` drops keys without a range;
    ``how="left"`` keeps them with nulls. ``end_inclusive=False`` treats ``end`` as exclusive
    (the last address never matches). Ranges with a null bound or with start after end match
    nothing. ``strategy``: ``bucket`` (default; overlapping ranges go to ``prefix``),
    ``between`` (nested-loop join against a broadcast range table, for very small tables; over
    the broadcast bound it raises), ``prefix`` (aligned blocks, found by halving the levels
    present), ``pandas`` (sorted search in pandas; keys and ranges are dealt over chunks of about
    as many rows, which begin at multiples of ``2^group_bits``).
    ``resolve_overlaps``: ``auto`` looks for overlaps, ``True`` and ``False`` say that there are
    some or none (with ``False`` a key in two ranges of one bucket width comes twice).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    _check_names(df, ranges)
    if strategy == "prefix":
        return _block_lookup(df, ranges, key, start, end, how, end_inclusive, max_broadcast_bytes)
    if strategy == "pandas":
        return _pandas_lookup(df, ranges, key, start, end, how, end_inclusive, group_bits, max_broadcast_bytes)

    pieces = _bucketed_ranges(ranges, start, end, bucket_bits, end_inclusive)
    size, overlap, widths = _profile_buckets(pieces, resolve_overlaps == "auto")
    if resolve_overlaps == "auto":
        overlap = overlap or _widths_overlap(pieces, widths)
    if overlap or resolve_overlaps is True:
        return _block_lookup(df, ranges, key, start, end, how, end_inclusive, max_broadcast_bytes)
    small = within_limit(pieces, size, max_broadcast_bytes)
    # Null-tolerant forms of the bucket and the range test: a null-intolerant join key or
    # condition makes the optimizer infer ``isnotnull`` filters and push them into the scan
    # with the key's (possibly costly) expression inlined a second time.
    in_range = F.coalesce(F.col(key).between(F.col(_FROM), F.col(_TO)), F.lit(False))
    if strategy == "between":
        if not small:
            raise ValueError(
                "strategy='between' compares every key with every range; "
                "the range table is over the broadcast bound: use 'bucket'"
            )
        # A range stands in every bucket that it touches: the key's own bucket counts.
        own = F.coalesce(shr(key, F.col(_WIDTH)) == F.col(_BUCKET), F.lit(False))
        joined = df.join(F.broadcast(pieces), own & in_range, how)
        return joined.select(*df.columns, *ranges.columns)

    def bucket(width: int) -> Column:
        # In a shuffle null buckets would meet in one task: the join leaves or drops them before it.
        b = F.shiftright(F.col(key), width)
        return F.coalesce(b, F.lit(_NO_BUCKET)) if small else b

    if len(widths) < 2:
        joined = skew_aware_join(
            df.withColumn(_BUCKET, bucket(widths[0] if widths else bucket_bits)), pieces, [_BUCKET], how, in_range,
            max_broadcast_bytes=max_broadcast_bytes, small_size=size,
        )
        return joined.select(*df.columns, *ranges.columns)
    out, hits = df, []
    for width in widths:  # disjoint ranges: at most one width has a range for a key
        own = pieces.where(F.col(_WIDTH) == width)
        own = own.select(_BUCKET, _FROM, _TO, F.struct(*_cols(ranges)).alias(f"__r{width}"))
        out = skew_aware_join(
            out.withColumn(_BUCKET, bucket(width)), own, [_BUCKET], "left", in_range,
            max_broadcast_bytes=max_broadcast_bytes, small_size=size if small else None,
        ).drop(_BUCKET, _FROM, _TO)
        hits.append(F.col(f"__r{width}"))
    return _unpacked(out.withColumn(_FOUND, F.coalesce(*hits)), df, ranges, how)


def _cols(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _unpacked(found: DataFrame, df: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """The key rows with the columns of the range struct in ``_FOUND``."""
    if how == "inner":
        found = found.where(F.col(_FOUND).isNotNull())
    return found.select(*_cols(df), *[F.col(f"{_FOUND}.`{c}`").alias(c) for c in ranges.columns])


def _bounds(ranges: DataFrame, start: str, end: str, end_inclusive: bool) -> DataFrame:
    """``(_FROM, _TO, __r)``: first and last key and row of each range that holds a key."""
    bounds = ranges.select(F.col(start).cast("bigint").alias(_FROM), _last(end, end_inclusive).cast("bigint").alias(_TO),
                           F.struct(*_cols(ranges)).alias("__r"))
    return bounds.where(F.col(_FROM) <= F.col(_TO))


def _aligned_blocks(ranges: DataFrame, start: str, end: str, end_inclusive: bool) -> DataFrame:
    """``(_LEVEL, _NET, _WIN)``: the innermost range of every aligned block that a range is made of.

    At level b the range's blocks are those of ``2^b`` keys from ``ceil(start / 2^b)`` to before
    ``floor((last + 1) / 2^b)`` that are not part of a wider one: the first if its number is odd,
    the last if its number is even. Sums are kept below 2^63.
    """
    one = F.lit(1).cast("bigint")
    s, e = F.col(_FROM), F.col(_TO)
    bounds = _bounds(ranges, start, end, end_inclusive)
    # Below the trailing zeros of start and of last + 1 there are no blocks, nor above the width.
    ends = s.bitwiseOR(F.bitwise_not(e))
    low = F.when(ends == F.lit(-(2**63)), F.lit(63)).otherwise(F.bit_count(ends.bitwiseAND(F.bitwise_not(ends) + one) - one))
    high = F.least(F.lit(63), F.ceil(F.log2(e.cast("double") - s.cast("double") + F.lit(1.0))).cast("int"))
    bounds = bounds.withColumns({"__low": low, "__high": F.greatest(low, high)})

    def at(b: Column) -> Column:
        mask = F.when(b == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(64) - b))
        first = shr(s, b) + F.when(s.bitwiseAND(mask) != 0, one).otherwise(one - one)
        final = shr(e, b) - F.when(e.bitwiseAND(mask) == mask, one - one).otherwise(one)
        left = F.when((first <= final) & (first.bitwiseAND(one) == 1), F.struct(b.alias(_LEVEL), first.alias(_NET)))
        right = F.when((first <= final) & (final.bitwiseAND(one) == 0), F.struct(b.alias(_LEVEL), final.alias(_NET)))
        return F.array(left, right)

    several = F.filter(F.flatten(F.transform(F.sequence("__low", "__high"), at)), lambda x: x.isNotNull())
    # Both ends are borders of level ``low``: within one block of it, the range is that block.
    only = F.array(F.struct(F.col("__low").alias(_LEVEL), shr(s, F.col("__low")).alias(_NET)))
    blocks = F.when(shr(s, F.col("__low")) == shr(e, F.col("__low")), only).otherwise(several)
    order = F.struct(s.alias("s"), F.bitwise_not(e).alias("e"), F.col("__r").alias("r"))
    each = bounds.select(F.explode(blocks).alias("__b"), order.alias(_WIN))
    return each.groupBy(F.col(f"__b.{_LEVEL}").alias(_LEVEL), F.col(f"__b.{_NET}").alias(_NET)).agg(F.max(_WIN).alias(_WIN))


def _search_paths(levels: list[int]) -> tuple[list[list[int | None]], dict[int, list[int]]]:
    """The halving search over the levels, widest first: ``steps[d][code]``, the level probed in
    step d after the outcomes ``code`` (a bit each, 1 for a hit), and for each level the wider
    ones at which the search must hit to reach it."""
    spans: list[tuple[int, int] | None] = [(0, len(levels))]
    steps: list[list[int | None]] = []
    marks: dict[int, list[int]] = {}
    turned: list[list[int]] = [[]]
    while any(spans):
        steps.append([levels[(x[0] + x[1]) // 2] if x else None for x in spans])
        next_spans, next_turned = [], []
        for x, before in zip(spans, turned):
            mid = (x[0] + x[1]) // 2 if x else 0
            if x:
                marks[levels[mid]] = before
            next_spans += [(x[0], mid) if x and x[0] < mid else None, (mid + 1, x[1]) if x and mid + 1 < x[1] else None]
            next_turned += [before, [*before, levels[mid]] if x else before]
        spans, turned = next_spans, next_turned
    return steps, marks


def _marked_blocks(blocks: DataFrame, size: Size, levels: list[int], marks: dict[int, list[int]]) -> DataFrame:
    """The blocks and their marks at wider levels, each with the innermost range of all blocks
    that hold it (null for a mark that none holds)."""

    def of_level(c: str, lists: dict[int, list[int]]) -> Column:
        out = F.lit(None).cast("array<int>")
        for level, own in lists.items():
            out = F.when(F.col(c) == level, F.lit(own).cast("array<int>")).otherwise(out)
        return out

    path = F.explode(of_level(_LEVEL, {level: [level, *wider] for level, wider in marks.items()}))
    places = blocks.select(path.alias("__w"), _LEVEL, _NET).select("__w", shr(_NET, F.col("__w") - F.col(_LEVEL)).alias("__n")).distinct()
    holders = F.explode(of_level("__w", {x: [w for w in levels if w >= x] for x in levels}))
    wider = places.select("__w", "__n", holders.alias(_LEVEL)).withColumn(_NET, shr("__n", F.col(_LEVEL) - F.col("__w")))
    held = skew_aware_join(wider, blocks, [_LEVEL, _NET], "inner", small_size=size).select("__w", "__n", _WIN)
    alone = places.withColumn(_WIN, F.lit(None).cast(blocks.schema[_WIN].dataType))
    best = held.unionByName(alone).groupBy("__w", "__n").agg(F.max(_WIN).alias(_WIN))
    return best.select(F.col("__w").alias(_LEVEL), F.col("__n").alias(_NET), F.col(f"{_WIN}.r").alias(_WIN))


def _block_lookup(df, ranges, key, start, end, how, end_inclusive, max_broadcast_bytes) -> DataFrame:
    """The innermost range of each key by aligned blocks (see the module's text).

    Blocks and marks within the broadcast bound are probed by broadcast joins that share one
    table; the keys are not shuffled. Range tables beyond the bound are not cut into blocks: the
    distinct keys are searched by chunks (see ``chunks``), the best per key is pinned and joined
    back.
    """
    if not fits_broadcast(ranges, max_broadcast_bytes):
        return _swept(df, ranges, key, start, end, how, end_inclusive, max_broadcast_bytes)
    # Pinned: counted, marked and joined without cutting the ranges again.
    ensure_checkpoint_dir(df.sparkSession)
    blocks = _aligned_blocks(ranges, start, end, end_inclusive).checkpoint(eager=True)
    profile = blocks.groupBy(_LEVEL).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_width(blocks)).alias("b"), F.max(row_width(blocks)).alias("w")
    ).collect()  # a row a level: 64 at most
    levels = sorted((r[_LEVEL] for r in profile), reverse=True)
    if not levels:
        return _no_match(df, ranges, how)
    steps, marks = _search_paths(levels)
    size, widest = Size(0, sum(r["b"] for r in profile)), max(r["w"] for r in profile)
    bound = Size(0, size.bytes + widest * sum(r["n"] * len(marks[r[_LEVEL]]) for r in profile))
    small = within_limit(ranges, size, max_broadcast_bytes)
    if small:
        # Pinned: every probe reads it, each with a filter of its own.
        marked = _marked_blocks(blocks, size, levels, marks).checkpoint(eager=True)
        # Blocks share most of their marks: counted only if the bound without sharing is too large.
        small = within_limit(marked, bound, max_broadcast_bytes) or fits_broadcast(marked, max_broadcast_bytes)
    if not small:
        return _swept(df, ranges, key, start, end, how, end_inclusive, max_broadcast_bytes)
    k = F.col(f"`{key}`")
    kind = marked.schema[_WIN].dataType
    out = df.withColumns({"__code": F.lit(0), _FOUND: F.lit(None).cast(kind)})
    for step in steps:
        probed = F.get(F.array(*[F.lit(x).cast("int") for x in step]), F.col("__code"))
        out = out.withColumn("__probe", probed).withColumn("__at", shr(k, F.col("__probe")))
        out = out.join(F.broadcast(marked), (F.col("__probe") == F.col(_LEVEL)) & (F.col("__at") == F.col(_NET)), "left")
        hit = F.col(_LEVEL).isNotNull()
        out = out.select(
            *_cols(df),
            (F.col("__code") * 2 + hit.cast("int")).alias("__code"),
            F.when(hit, F.col(_WIN)).otherwise(F.col(_FOUND)).alias(_FOUND),
        )
    return _unpacked(out, df, ranges, how)


def _swept(df, ranges, key, start, end, how, end_inclusive, max_broadcast_bytes) -> DataFrame:
    """Form for range tables over the broadcast bound: a sorted search over chunks of the keys."""
    bounds = _bounds(ranges, start, end, end_inclusive)
    keys = df.select(F.col(f"`{key}`").alias("__k")).where(F.col("__k").isNotNull())
    best = innermost(keys, bounds, ["__k"], [_FROM], [_TO], "__r")
    best = best.select(F.col("__k").cast(df.schema[key].dataType).alias(key), F.col("__r").alias(_FOUND))
    best = best.checkpoint(eager=True)  # measured and joined without recomputing
    return _unpacked(skew_aware_join(df, best, [key], how, max_broadcast_bytes=max_broadcast_bytes), df, ranges, how)


def _no_match(df: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in ranges.schema.fields]
    out = df.select("*", *nulls)
    return out if how == "left" else out.where(F.lit(False))


_NUMPY_DTYPES = {
    T.LongType: "int64",
    T.IntegerType: "int32",
    T.ShortType: "int16",
    T.ByteType: "int8",
    T.DoubleType: "float64",
    T.FloatType: "float32",
    T.BooleanType: "bool",
}


def _group_search(key: str, out_cols: list[str], dtypes: dict[str, str]):
    """The per-group search as a closure over plain values: it ships to Python workers by
    value, needing only numpy and pandas there (not this package)."""

    def search(keys: pd.DataFrame, rng: pd.DataFrame) -> pd.DataFrame:
        if keys.empty or rng.empty:  # zero rows with typed columns (object would not convert)
            return pd.DataFrame({c: pd.Series([], dtype=dtypes[c]) for c in out_cols})
        # Outer before inner: the wanted range is the last one in this order that begins at or
        # before the key and ends at or after it.
        rng = rng.sort_values(["__from", "__to"], ascending=[True, False], kind="stable")
        starts, lasts = rng["__from"].to_numpy(), rng["__to"].to_numpy()
        # The nearest range before each that ends later: all between them end too early as well.
        longer, open_ = np.full(len(lasts), -1), []
        for i, last in enumerate(lasts.tolist()):
            while open_ and open_[-1][0] <= last:
                open_.pop()
            if open_:
                longer[i] = open_[-1][1]
            open_.append((last, i))
        k = keys[key].to_numpy()
        idx = np.searchsorted(starts, k, side="right") - 1
        late = np.flatnonzero(idx >= 0)
        while len(late := late[k[late] > lasts[idx[late]]]):
            idx[late] = longer[idx[late]]
            late = late[idx[late] >= 0]
        ok = idx >= 0
        hits = rng.iloc[idx[ok]].reset_index(drop=True)
        hits.insert(0, key, k[ok])
        return hits[out_cols]

    return search


def _pandas_lookup(df, ranges, key, start, end, how, end_inclusive, bits, max_broadcast_bytes) -> DataFrame:
    """Sorted search per group: distinct keys and the ranges of the same chunk (see ``chunks``)
    meet in one pandas call; chunks begin at multiples of ``2^bits``."""
    bounds = _bounds(ranges, start, end, end_inclusive)
    keys = df.select(F.col(f"`{key}`").alias("__k")).where(F.col("__k").isNotNull())
    keys, pieces = deal(keys, bounds, ["__k"], [_FROM], [_TO], "__r", bits)
    key_field = df.schema[key]
    keys = keys.select(CHUNK, F.col("__k").cast(key_field.dataType).alias(key))
    pieces = pieces.select(CHUNK, _FROM, _TO, *[F.col(f"__r.`{c}`").alias(c) for c in ranges.columns])
    out_schema = T.StructType([T.StructField(key, key_field.dataType, True)] + list(ranges.schema.fields))
    dtypes = {
        f.name: next((d for t, d in _NUMPY_DTYPES.items() if isinstance(f.dataType, t)), "object")
        for f in out_schema.fields
    }
    search = _group_search(key, out_schema.fieldNames(), dtypes)
    matches = keys.groupBy(CHUNK).cogroup(pieces.groupBy(CHUNK)).applyInPandas(search, out_schema)
    # Pinned once: measuring and joining would otherwise run the pandas search twice.
    matches = matches.checkpoint(eager=True)
    out = skew_aware_join(df, matches, [key], how, max_broadcast_bytes=max_broadcast_bytes)
    return out.select(*df.columns, *ranges.columns)


def with_match_status(
    looked_up: DataFrame,
    ranges: DataFrame,
    key: str,
    start: str = "start_ip",
    status_col: str = "match_status",
) -> DataFrame:
    """Say why a key has no range: ``matched``, ``below`` (before the first range),
    ``gap`` (between or after ranges) or ``invalid`` (no key, e.g. unparsable text).

    ``looked_up`` is the result of a ``how="left"`` lookup; the first start is a scalar
    subquery over the range table.
    """
    first_start = ranges.select(F.min(F.col(start))).scalar()
    status = (
        F.when(F.col(key).isNull(), F.lit("invalid"))
        .when(F.col(start).isNotNull(), F.lit("matched"))
        .when(F.col(key) < first_start, F.lit("below"))
        .otherwise(F.lit("gap"))
    )
    return looked_up.withColumn(status_col, status)
