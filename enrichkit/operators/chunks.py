"""Points and ranges dealt over chunks of the key space, for range tables of any size.

A position is one bigint or several, compared in their order. Borders cut all positions into
chunks with about as many points and range ends each; they come from a sample that is chosen by
a hash and decide only which task does what, never the result.

A range stands in the chunks of its first and last position only. Of the chunks between them,
which it covers whole, each needs one range alone: the innermost of all that cover it. Two windows
of ``2^level`` chunks cover those of a range, so a range adds two rows whatever its width; the
best of each window is handed to its chunks. Within a chunk only the innermost is kept of ranges
that begin at one position and go on beyond the chunk, of those that come from before it and end
at one position, and of equal ones. So nests, copies and wide ranges do not add up in a chunk.

The innermost range wins: greatest start, then smallest end, then the greatest row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrichkit.session import ensure_checkpoint_dir

CHUNK = "__chunk"
# Points and ranges of a chunk, chunks at most, and sampled positions a chunk.
_CHUNK_ROWS, _MOST_CHUNKS, _SAMPLED = 20_000, 2048, 16


def _position(cols: list[str]) -> Column:
    return F.struct(*[F.col(c).cast("bigint").alias(f"p{i}") for i, c in enumerate(cols)])


def _borders(points: DataFrame, ranges: DataFrame, bits: int) -> list[tuple[int, ...]]:
    """Where a chunk begins, the first chunk left out: at most ``_MOST_CHUNKS`` positions, the last
    column's ``bits`` lowest bits cleared."""
    rows = points.select(F.lit(1).alias("n")).unionByName(ranges.select(F.lit(1).alias("n"))).count()
    chunks = min(_MOST_CHUNKS, -(-rows // _CHUNK_ROWS))
    if chunks < 2:
        return []
    nth = F.lit(max(1, rows // (_SAMPLED * chunks)))
    ends = ranges.where(F.pmod(F.xxhash64("s", "e"), nth) == 0).distinct().select(F.explode(F.array("s", "e")).alias("p"))
    sample = points.where(F.pmod(F.xxhash64("p"), nth) == 0).select("p").distinct().unionByName(ends)
    at = sorted(tuple(r.p) for r in sample.collect())  # some 2 * _SAMPLED * chunks at most
    cut = [at[i * len(at) // chunks] for i in range(1, chunks)] if at else []
    return sorted({(*p[:-1], p[-1] >> bits << bits) for p in cut})


def _chunk_of(position: str, borders: list[tuple[int, ...]]) -> Column:
    """The number of borders at or before the position, by halving."""
    if not borders:
        return F.lit(0)
    rows = ["named_struct({})".format(", ".join(f"'p{i}', bigint('{x}')" for i, x in enumerate(b))) for b in borders]
    table = F.expr(f"array({', '.join(rows)})")
    steps = F.lit([1 << b for b in reversed(range(len(borders).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, n: F.when(F.get(table, at + n - 1) <= F.col(position), at + n).otherwise(at))


def deal(
    points: DataFrame, ranges: DataFrame, at: list[str], first: list[str], last: list[str], row: str,
    bits: int = 0, carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(CHUNK, *at, *carry)``, the distinct points, and ``(CHUNK, *first, *last, row)``, the ranges
    that matter in each chunk. Positions are not null and no range begins after its end."""
    ensure_checkpoint_dir(points.sparkSession)
    # Pinned: counted, sampled and dealt.
    keys = points.select(_position(at).alias("p"), *carry).distinct().checkpoint(eager=True)
    spans = ranges.select(_position(first).alias("s"), _position(last).alias("e"), F.col(row).alias("r"))
    borders = _borders(keys, spans.select("s", "e"), bits)
    keys = keys.select(_chunk_of("p", borders).alias(CHUNK), *[F.col(f"p.p{i}").alias(c) for i, c in enumerate(at)], *carry)

    inner = F.struct(*[F.bitwise_not(F.col(f"e.p{i}")).alias(f"p{i}") for i in range(len(last))])
    spans = spans.withColumns({"i": _chunk_of("s", borders), "j": _chunk_of("e", borders)})
    spans = spans.select("s", "e", "i", "j", F.struct("s", inner.alias("e"), "r").alias("w"))
    none = F.lit(None).cast(spans.schema["s"].dataType)

    def piece(chunk: str, a: Column, b: Column) -> Column:
        return F.struct(F.col(chunk).alias("c"), a.alias("a"), b.alias("b"))

    s, e, between = F.col("s"), F.col("e"), F.col("j") - F.col("i") - 1
    ends = F.when(between < 0, F.array(piece("i", s, e))).otherwise(F.array(piece("i", s, none), piece("j", none, e)))
    pieces = spans.select(F.explode(ends).alias("x"), "w").select("x.*", "w")
    if len(borders) > 1:
        level = F.floor(F.log2(between.cast("double"))).cast("int")
        wide = spans.where(between > 0).withColumn("l", level)
        wide = wide.select("l", F.explode(F.array(F.col("i") + 1, F.expr("j - shiftleft(1, l)"))).alias("n"), "w")
        wide = wide.groupBy("l", "n").agg(F.max("w").alias("w"))
        whole = wide.select(F.explode(F.expr("sequence(n, n + shiftleft(1, l) - 1)")).alias("c"), none.alias("a"), none.alias("b"), "w")
        pieces = pieces.unionByName(whole)
    best = pieces.groupBy("c", "a", "b").agg(F.max("w").alias("w"))
    return keys, best.select(
        F.col("c").alias(CHUNK),
        *[F.col(f"w.s.p{i}").alias(c) for i, c in enumerate(first)],
        *[F.bitwise_not(F.col(f"w.e.p{i}")).alias(c) for i, c in enumerate(last)],
        F.col("w.r").alias(row),
    )


def innermost(
    points: DataFrame, ranges: DataFrame, at: list[str], first: list[str], last: list[str], row: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(*at, *carry, row)``: each distinct point that a range holds and the ``row`` of the innermost."""
    keys, pieces = deal(points, ranges, at, first, last, row, carry=carry)
    own = [*at, *carry]
    schema = T.StructType([keys.schema[c] for c in own] + [pieces.schema[row]])

    def search(k: pa.Table, r: pa.Table) -> pa.Table:
        """Ships by value: it needs numpy and pyarrow alone."""
        n = r.num_rows
        if not n or not k.num_rows:
            return pa.table({c: k.column(c).slice(0, 0) for c in own} | {row: r.column(row).slice(0, 0)})
        # Positions as their places in the chunk.
        cols = [np.concatenate([t.column(c).to_numpy() for t, c in ((r, a), (r, b), (k, x))]) for a, b, x in zip(first, last, at)]
        order = np.lexsort(cols[::-1])
        moved = np.any([np.diff(c[order]) != 0 for c in cols], axis=0)
        place = np.empty(len(order), np.int64)
        place[order] = np.concatenate([[0], np.cumsum(moved)])
        # Outer before inner: the wanted range is the last one in this order that begins at or
        # before the point and ends at or after it.
        by = np.lexsort((-place[n : 2 * n], place[:n]))
        starts, lasts, points = place[:n][by], place[n : 2 * n][by], place[2 * n :]
        # The nearest range before each that ends later: all between them end too early as well.
        longer, open_ = np.full(n, -1), []
        for i, end in enumerate(lasts.tolist()):
            while open_ and open_[-1][0] <= end:
                open_.pop()
            if open_:
                longer[i] = open_[-1][1]
            open_.append((end, i))
        idx = np.searchsorted(starts, points, side="right") - 1
        late = np.flatnonzero(idx >= 0)
        while len(late := late[points[late] > lasts[idx[late]]]):
            idx[late] = longer[idx[late]]
            late = late[idx[late] >= 0]
        ok = np.flatnonzero(idx >= 0)
        rows = r.column(row).combine_chunks().take(pa.array(by[idx[ok]]))
        return pa.table({c: k.column(c).take(pa.array(ok)) for c in own} | {row: rows})

    return keys.groupBy(CHUNK).cogroup(pieces.groupBy(CHUNK)).applyInArrow(search, schema)
