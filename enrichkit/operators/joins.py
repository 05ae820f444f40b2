"""Equi-joins (with an optional extra condition) that stay balanced under key skew.

Plan, in order:
1. the small side is measured; within the broadcast bound it is broadcast and the big
   side is never shuffled (skew cannot hurt a map-side join);
   otherwise, in a left join, rows with a null key (which cannot match, and would all
   hash to one task) bypass the shuffle with null lookup columns;
2. then, when hot-key detection is on, the big side's hot keys (keys with more rows than
   an even share of a shuffle task, or with ``hot_key_rows`` rows if given) are found with
   one partial-aggregated count. Detection costs a pass over the big side's key columns, so
   by default it runs only when AQE's skew-join split is off: with AQE on, the shuffle
   join's skewed partitions are split at run time from the shuffle statistics at no
   extra cost (``enrichkit.skew.detectHotKeys`` = ``auto`` / ``true`` / ``false``);
3. rows with cold keys take a plain shuffle join;
4. rows with hot keys join the small side's matching rows by broadcast when those are
   within the bound, else by a salted join that spreads every hot key over
   ``salt_buckets`` tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.operators.sizing import Size, fits_broadcast

# A key with less than this share of all rows never counts as hot, so the list of hot keys has
# a proven bound whatever ``hot_key_rows`` says.
LEAST_HOT_SHARE = 4096
DEFAULT_SALT_BUCKETS = 32
_SALT = "__salt"


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def check_names(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    """Raises if a column that is not a key is on both sides (names compare without case)."""
    keys = {c.lower() for c in on}
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - keys
    if clash:
        raise ValueError(f"columns on both sides of the join: {sorted(clash)}")


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """Join on equal ``on`` columns plus ``condition``; key columns appear once (left's),
    columns in the order of ``left`` then ``right``. Raises if another column is on both sides."""
    check_names(left, right, on)
    if condition is None:
        joined = left.join(right, on=on, how=how)
        if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
            return joined
        return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"`{c}`") for c in right.columns if c not in on])
    l, r = left.alias("__l"), right.alias("__r")
    cond = reduce(lambda a, b: a & b, [F.col(f"__l.`{k}`") == F.col(f"__r.`{k}`") for k in on])
    joined = l.join(r, cond & condition, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    keep = [F.col(f"__l.`{c}`") for c in left.columns]
    keep += [F.col(f"__r.`{c}`") for c in right.columns if c not in on]
    return joined.select(*keep)


def hot_keys(df: DataFrame, on: list[str], min_rows: int | None = None) -> DataFrame | None:
    """Keys of ``df`` with at least ``min_rows`` rows, or None if there are none.

    Without ``min_rows`` a key is hot with as many rows as an even share of the session's
    shuffle partitions. All of them are found: at most one key per share of all rows can
    be hot, so the list that reaches the driver is bounded by the number of shares
    (``LEAST_HOT_SHARE`` with ``min_rows``). One aggregation with map-side combine.
    """
    shares = LEAST_HOT_SHARE if min_rows else max(_conf_int(df, "spark.sql.shuffle.partitions", 200), 2)
    counts = df.where(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in on]))
    counts = counts.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    share = counts.select(F.sum("__n") / F.lit(shares)).scalar()
    top = counts.where((F.col("__n") >= F.lit(min_rows or 1)) & (F.col("__n") >= share)).select(*on).collect()
    if not top:
        return None
    schema = df.select(*on).schema
    return df.sparkSession.createDataFrame(top, schema)


def skew_aware_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    condition: Column | None = None,
    *,
    max_broadcast_bytes: int | None = None,
    hot_key_rows: int | None = None,
    salt_buckets: int | None = None,
    small_size: Size | None = None,
    detect_hot_keys: bool | None = None,
) -> DataFrame:
    """Join a big table with a lookup table on ``on`` (+ ``condition``).

    ``how`` is ``inner`` or ``left`` (big side preserved). Results equal a plain join.
    ``small_size`` passes a measurement of ``small`` made elsewhere (saves a pass).
    ``detect_hot_keys`` forces the explicit hot-key split on or off; by default it is on
    when ``hot_key_rows`` is given or AQE's skew-join split is not active.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_aware_join supports how='inner' or 'left'")
    if fits_broadcast(small, max_broadcast_bytes, small_size):
        return join_on(big, F.broadcast(small), on, how, condition)
    if detect_hot_keys is None:
        detect_hot_keys = hot_key_rows is not None or _detect_by_default(big)

    if how == "left":
        # Null keys never match, and in a shuffle they would all land in one task: keep
        # those rows aside with null lookup columns.
        any_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in on])
        extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema.fields if f.name not in on]
        keyless = big.where(any_null).select(*[F.col(f"`{c}`") for c in big.columns], *extra)
        keyed = _shuffled_join(big.where(~any_null), small, on, how, condition, max_broadcast_bytes,
                               hot_key_rows, salt_buckets, detect_hot_keys)
        return keyed.unionByName(keyless)
    return _shuffled_join(
        big, small, on, how, condition, max_broadcast_bytes, hot_key_rows, salt_buckets, detect_hot_keys
    )


def _detect_by_default(df: DataFrame) -> bool:
    mode = df.sparkSession.conf.get("enrichkit.skew.detectHotKeys", "auto").lower()
    if mode in ("true", "false"):
        return mode == "true"
    conf = df.sparkSession.conf
    aqe = conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    split = conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true"
    return not (aqe and split)


def _shuffled_join(
    big, small, on, how, condition, max_broadcast_bytes, hot_key_rows, salt_buckets, detect
):
    """Shuffle join with the big side's hot keys split off (steps 2-4 of the module doc).

    Finding hot keys costs one partial-aggregated pass over the big side's key columns.
    The small side is measured to be over the bound: without the hint Spark may broadcast either
    side by an estimate that does not see what an explode adds.
    """
    small = small.hint("merge")
    if not detect:
        return join_on(big, small, on, how, condition)
    hot = hot_keys(big, on, hot_key_rows or _conf_int(big, "enrichkit.skew.hotKeyRows", 0) or None)
    if hot is None:
        return join_on(big, small, on, how, condition)

    hot = F.broadcast(hot)
    big_hot = big.join(hot, on, "left_semi")
    big_cold = big.join(hot, on, "left_anti")
    small_hot = small.join(hot, on, "left_semi")
    cold_part = join_on(big_cold, small, on, how, condition)

    if fits_broadcast(small_hot, max_broadcast_bytes):
        hot_part = join_on(big_hot, F.broadcast(small_hot), on, how, condition)
    else:
        buckets = salt_buckets or _conf_int(big, "enrichkit.skew.saltBuckets", DEFAULT_SALT_BUCKETS)
        # Every salt value sees every matching small row, so any salt a big row gets
        # (even a different one after a task retry) yields the same join result.
        salted_big = big_hot.withColumn(_SALT, F.floor(F.rand(17) * buckets).cast("int"))
        salted_small = small_hot.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        hot_part = join_on(salted_big, salted_small, on + [_SALT], how, condition).drop(_SALT)
    return cold_part.unionByName(hot_part)
