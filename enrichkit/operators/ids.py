"""Substitute ids for record keys: lookup table, hash, UUID or gap-free sequence.

``get_or_create_ids`` gives every key its existing id and creates ids for keys the lookup
lacks, once per distinct key, then joins them to all rows. New ids are pinned (written
or checkpointed) before use, so a recomputed task cannot produce different ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from enrichkit.operators.joins import skew_aware_join
from enrichkit.session import ensure_checkpoint_dir

MODES = ("uuid", "hash", "sequence")
_LOCAL_BITS = 33  # monotonically_increasing_id = (partition << 33) + row index


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Each non-null key once (partial aggregation first, so hot keys shrink map-side)."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def missing_keys(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` that have no row in ``lookup``."""
    return distinct_keys(df, key).join(lookup.select(key), key, "left_anti")


def known_ids(df: DataFrame, lookup: DataFrame, key: str, out: str = "deid") -> DataFrame:
    """Each distinct key of ``df`` with its smallest id in ``lookup``, null where it has none yet;
    pinned, so that the lookup is read once, whatever is done with the result.

    The join keeps the partitioning of the distinct keys for the aggregate after it: the lookup
    is exchanged once at most.
    """
    ensure_checkpoint_dir(df.sparkSession)
    found = distinct_keys(df, key).join(lookup.select(key, out), key, "left")
    return found.groupBy(key).agg(F.min(out).alias(out)).checkpoint(eager=True)


def hash_ids(keys: DataFrame, key: str, salt: str, out: str = "deid") -> DataFrame:
    """Repeatable ids: hex SHA-256 of ``salt`` followed by the key."""
    return keys.withColumn(out, F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256))


def uuid_ids(keys: DataFrame, out: str = "deid") -> DataFrame:
    """Random UUID per row, pinned by a reliable checkpoint so every later use sees the same ids."""
    ensure_checkpoint_dir(keys.sparkSession)
    return keys.withColumn(out, F.uuid()).checkpoint(eager=True)


def dense_ids(
    keys: DataFrame,
    key: str,
    start: int | Column = 1,
    out: str = "seq_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Number the distinct keys ``start, start+1, ...`` in key order, without gaps.

    Distributed: keys are range-partitioned (``num_partitions``, or the session's shuffle
    partitions merged by AQE to fit the data) and sorted, then pinned with a reliable
    checkpoint (a recomputed range partitioning could place keys differently). Each row's
    id is its partition's offset plus its position in the partition; the offsets come
    from one count per partition (a table with one row per partition, broadcast).
    """
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    distinct = distinct_keys(keys, key)
    # Without an explicit count AQE may merge adjacent range partitions (order is kept).
    ranged = distinct.repartitionByRange(num_partitions, F.col(key)) if num_partitions else distinct.repartitionByRange(F.col(key))
    ordered = ranged.sortWithinPartitions(key)
    pinned = ordered.select(
        key, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__mid")
    ).checkpoint(eager=True)
    counts = pinned.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    position = F.col("__mid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = pinned.join(F.broadcast(offsets), "__part")
    return numbered.select(key, (first + F.col("__off") + position).cast("bigint").alias(out))


def new_ids(
    missing: DataFrame,
    key: str,
    mode: str,
    out: str,
    lookup: DataFrame,
    salt: str = "",
) -> DataFrame:
    """Ids for keys the lookup lacks: ``uuid``, ``hash`` (with ``salt``) or ``sequence``
    (continuing after the lookup's greatest id)."""
    if mode == "hash":
        if not salt:
            raise ValueError("mode='hash' needs a secret salt: ids without one are found by hashing every possible key")
        return hash_ids(missing, key, salt, out)
    if mode == "uuid":
        return uuid_ids(missing, out)
    if mode == "sequence":
        # Read now: the store may grow before the ids are used.
        greatest = lookup.agg(F.max(out).cast("bigint").alias("m")).first()["m"]
        return dense_ids(missing, key, (greatest or 0) + 1, out)
    raise ValueError(f"mode must be one of {MODES}")


def get_or_create_ids(
    events: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    mode: str = "uuid",
    out: str = "deid",
    salt: str = "",
    how: str = "left",
    store_path: str | None = None,
    store_format: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    """Give every row of ``events`` the id of its key; create ids for unknown keys.

    Returns ``(events with out column, new mappings)``. With ``store_path`` the new
    mappings are appended to the lookup store. Every event stays once: one with a null key
    has no id (``how="inner"`` drops it), and of a key that the lookup holds twice, as after
    two concurrent runs, the smallest id counts; one that it holds without an id gets one. One id
    per distinct key within a run; concurrent runs need a transactional table to stay
    unique.
    """
    state = known_ids(events, lookup, key, out)
    missing = state.where(F.col(out).isNull()).select(key)
    # The keys are pinned, and the ids follow from them or are pinned themselves: storing,
    # measuring and joining them see the same ids, also after the store has grown.
    created = new_ids(missing, key, mode, out, lookup, salt).select(key, out)
    mapping = state.where(F.col(out).isNotNull()).unionByName(created)
    if store_path is not None:
        created.write.mode("append").format(store_format).save(store_path)
    return skew_aware_join(events, mapping, [key], how), created
